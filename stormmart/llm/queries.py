"""Registered queries of the corpus operators and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from stormmart.llm.chat import ORACLE_OP5, op5_preference_formatting
from stormmart.llm.chosen_path import ORACLE_OP12, op12_chosen_path
from stormmart.llm.common import workers_can_import
from stormmart.llm.decontaminate import op7_pigeonhole_edit
from stormmart.llm.divergence import ORACLE_OP13, op13_term_tree
from stormmart.llm.language import op4_cross_parsing_entropy
from stormmart.llm.licenses import op9_minhash_licenses
from stormmart.llm.ngram_join import ORACLE_OP2, op2_heavy_light_join
from stormmart.llm.packing import op1_cutting_stock
from stormmart.llm.quality import ORACLE_OP3, op3_quality_cascade
from stormmart.llm.sharding import op8_fixed_virtual_slots
from stormmart.llm.spelling import ORACLE_OP11, op11_edit_composition
from stormmart.llm.suffix_dedup import op10_interval_expansion
from stormmart.llm.warc import ORACLE_OP6, op6_two_level_index

Query = Callable[[SparkSession, str], DataFrame]


def _importable(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_can_import(spark)
        return query(spark, sf_dir)
    return run


QUERIES: dict[str, Query] = {q.__name__: _importable(q) for q in (
    op1_cutting_stock,
    op2_heavy_light_join,
    op3_quality_cascade,
    op4_cross_parsing_entropy,
    op5_preference_formatting,
    op6_two_level_index,
    op7_pigeonhole_edit,
    op8_fixed_virtual_slots,
    op9_minhash_licenses,
    op10_interval_expansion,
    op11_edit_composition,
    op12_chosen_path,
    op13_term_tree,
)}

ORACLE: dict[str, str] = {
    "op2_heavy_light_join": ORACLE_OP2,
    "op3_quality_cascade": ORACLE_OP3,
    "op5_preference_formatting": ORACLE_OP5,
    "op6_two_level_index": ORACLE_OP6,
    "op11_edit_composition": ORACLE_OP11,
    "op12_chosen_path": ORACLE_OP12,
    "op13_term_tree": ORACLE_OP13,
}
