import uuid

import pytest
from pyspark.sql import functions as F

from stormmart.functions.text import drop_suffix, strip_whitespace
from stormmart.operators import quality as dq
from stormmart.plans.validation import validate_and_store
from stormmart.sinks.tables import (
    SchemaDriftError,
    check_schema,
    ensure_raw_tables,
    materialize_table,
    materialize_view,
)
from stormmart.sources.landing import csv_name, is_csv


def test_name_predicates(spark):
    df = spark.createDataFrame([("a_d1950.csv.gz",), ("b.csv",), ("c.txt.gz",)], "n string")
    rows = df.select(csv_name("n").alias("c"), is_csv("n").alias("ok"),
                     drop_suffix("n", ".gz").alias("d")).collect()
    assert [(r.c, r.ok) for r in rows] == [("a_d1950.csv", True), ("b.csv", True), ("c.txt", False)]
    s = spark.createDataFrame([("  x y \n",)], "t string").select(strip_whitespace("t")).first()[0]
    assert s == "x y"


def test_view_and_table_materializations(spark):
    db = "mart_" + uuid.uuid4().hex[:8]
    df = spark.createDataFrame([("1950", "TEXAS", 1.0)], "event_year string, state string, total double")
    view = materialize_view(df, f"stg_{db}")
    assert view.count() == 1
    materialize_table(df, f"{db}.yearly")
    materialize_table(df.union(df), f"{db}.yearly")        # full refresh replaces
    assert spark.table(f"{db}.yearly").count() == 2


def test_schema_check_reports_retyped_column(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(SchemaDriftError, match="retyped=\\['v'\\]"):
        check_schema(b, a.schema)
    check_schema(a, a.schema)


def test_raw_tables_created_once(spark):
    db = "raw_" + uuid.uuid4().hex[:8]
    ensure_raw_tables(spark, f"{db}.t", f"{db}.log")
    ensure_raw_tables(spark, f"{db}.t", f"{db}.log")
    cols = spark.table(f"{db}.t").columns
    assert len(cols) == 55 and cols[-4:] == ["__date_loaded", "__row_hash", "__filename", "__batch"]


def test_validate_and_store_keeps_failed_results(spark):
    table = "dq_" + uuid.uuid4().hex[:8] + ".results"
    df = spark.createDataFrame([(1,), (None,)], "k int")
    with pytest.raises(dq.QualityGateError):
        validate_and_store(df, dq.Suite("s", [dq.not_null("k")]), table, batch="b1")
    stored = spark.table(table).collect()
    assert stored[0]["unexpected_count"] == 1 and stored[0]["batch"] == "b1"
    assert stored[0]["checked_at"] is not None
    validate_and_store(df.filter(F.col("k").isNotNull()), dq.Suite("s", [dq.not_null("k")]), table)
    assert spark.table(table).count() == 2
