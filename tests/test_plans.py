"""The plan properties the scale design relies on, checked on executed plans."""

import re

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL


def _plan(spark, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def _long_plan_strings(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")


def test_mart_reads_only_the_columns_it_needs(spark):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", _plan(spark, "q01_yearly_amount"))
    cols = {c.split(":")[0] for c in schemas[0].split(",")}
    assert cols == {"o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"}


def test_incremental_bound_is_pushed_into_the_scan(spark):
    plan = _plan(spark, "q05_incremental_above_max")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(ts,", plan)


def test_calendar_is_broadcast_not_shuffled(spark):
    plan = _plan(spark, "q19_calendar")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_quality_suite_is_one_scan_and_one_aggregate(spark):
    plan = _plan(spark, "q08_dq_not_null")
    assert len(re.findall(r"FileScan parquet", plan)) == 1
    assert len(re.findall(r"Exchange SinglePartition", plan)) == 1


def test_cleaning_and_link_queries_do_not_shuffle(spark):
    for name in ("q02_parse_amount_edges", "q13_link_extract", "q16_conform_types"):
        assert "Exchange" not in _plan(spark, name), name


def test_uniqueness_rules_share_one_scan(spark):
    assert len(re.findall(r"FileScan parquet", _plan(spark, "q12_dq_unique"))) == 2      # two tables
    plan = _plan(spark, "q40_mixed_suite")      # two row rules and four uniqueness rules
    assert len(re.findall(r"FileScan parquet", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_set_tables_are_broadcast_by_their_measured_size(spark):
    from pyspark.sql import functions as F

    from stormmart.operators import quality as dq

    spark.range(0, 30_000).selectExpr("CAST(id * 2 AS STRING) AS v").unionByName(
        spark.sql("SELECT CAST(NULL AS STRING) AS v")).createOrReplaceTempView("even_numbers")
    rows = spark.range(0, 1000).select(F.when(F.col("id") != 7, F.col("id")).alias("k"))
    rule = dq.in_table("k", "even_numbers", "v")
    found = []
    for limit, join in ((dq.SET_BROADCAST_BYTES, "BroadcastHashJoin"), (1000, "SortMergeJoin")):
        df = dq.outside_table(rows, "s", rule, limit)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"{join}.*LeftAnti", plan), plan
        found.append([tuple(r) for r in df.collect()])
    assert found[0] == found[1] == [("s", dq.IN_SET, "k", 1000, 499, False)]
    back = dq.Suite.from_json(dq.Suite("s", [rule]).to_json())
    assert [tuple(r) for r in dq.run_suite(rows, back).collect()] == found[0]
    with pytest.raises(ValueError):
        dq.Rule(dq.IN_SET, "k", {"value_set": [], "value_table": "t", "value_column": "v"})
