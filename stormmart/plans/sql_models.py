"""The layer models as Spark SQL, for users who keep their models in SQL.

Same semantics as ``plans.layers`` (tests compare the two). Column lists are
expanded from the catalog schema, as a star macro would do, so the helper
``rn`` column never leaks into the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stormmart.functions.amounts import LETTER as LETTERS
from stormmart.functions.amounts import NUMBER_TEXT, UNIT_FACTORS
from stormmart.schemas import DATE_LOADED, FILENAME, ROW_HASH
from stormmart.sinks.tables import BATCH


def _sql_text(s: str) -> str:
    """A Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _cols(spark: SparkSession, relation: str, skip: tuple[str, ...] = ()) -> list[str]:
    return [c for c in spark.table(relation).columns if c not in skip]


def create_staging_view(spark: SparkSession, raw_table: str, view: str,
                        temporary: bool = True) -> DataFrame:
    """``CREATE OR REPLACE [TEMP] VIEW <view> AS SELECT DISTINCT <cols> FROM <raw>``.

    The columns are the raw table's without the batch partition column; a
    catalog (non-temporary) view keeps the definition for other sessions.
    """
    kind = "TEMP VIEW" if temporary else "VIEW"
    if not temporary and "." in view:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{view.split('.')[0]}`")
    cols = ", ".join(f"`{c}`" for c in _cols(spark, raw_table, skip=(BATCH,)))
    spark.sql(f"CREATE OR REPLACE {kind} {view} AS SELECT DISTINCT {cols} FROM {raw_table}")
    return spark.table(view)


def clean_sql(spark: SparkSession, source: str, target: str | None = None,
              key: str = ROW_HASH) -> str:
    """SQL of the clean model: rows newer than the target, first row per key."""
    cols = _cols(spark, source)
    col_list = ", ".join(f"`{c}`" for c in cols)
    rest = [c for c in cols if c not in (key, DATE_LOADED, FILENAME)]
    order = ", ".join(f"`{c}`" for c in [DATE_LOADED, FILENAME, *rest])
    where = ""
    if target is not None:
        newest = f"(SELECT max(`{DATE_LOADED}`) FROM {target})"
        where = f"WHERE coalesce(`{DATE_LOADED}` > {newest}, {newest} IS NULL)"
    return f"""
SELECT {col_list} FROM (
  SELECT {col_list}, row_number() OVER (PARTITION BY `{key}` ORDER BY {order}) AS rn
  FROM {source} {where}
) WHERE rn = 1"""


def mart_sql(source: str, text_col: str = "damage_property") -> str:
    """SQL of the yearly damage mart over a clean relation: one grouping, whose
    summand is made by the unit table in ``functions.amounts``."""
    low = f"lower({text_col})"
    digits = f"regexp_replace({low}, {_sql_text('^([^' + LETTERS + ']*)[' + LETTERS + ']')}, '$1')"
    number = f"if(length({digits}) > 0 AND rlike({digits}, {_sql_text(NUMBER_TEXT)}), try_cast({digits} AS DOUBLE), NULL)"
    factors = ", ".join(f"'{u}', {f!r}D" for u, f in UNIT_FACTORS.items())
    factor = f"element_at(map({factors}), right({low}, 1))"
    return (f"SELECT left(CAST(begin_yearmonth AS STRING), 4) AS event_year, state, "
            f"sum(coalesce({number} * {factor}, if({factor} IS NULL, coalesce({number}, 0D), NULL))) "
            f"AS total_property_damage FROM {source} GROUP BY event_year, state")
