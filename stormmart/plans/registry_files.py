"""Registered queries that go through real files and tables: the upsert sink, the
CSV reader, row hashes by value, cast failures, suites as JSON, SQL models."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormmart.functions.hashing import row_hash
from stormmart.functions.jsontext import json_amounts, map_total
from stormmart.functions.text import drop_suffix
from stormmart.operators import quality as dq
from stormmart.operators.cleaning import conform_types
from stormmart.plans.samples import first_model, non_null_ids
from stormmart.plans.sql_models import clean_sql
from stormmart.schemas import DATE_LOADED, FILENAME, MALFORMED, NOT_CAST
from stormmart.session import shared_path
from stormmart.sinks.tables import materialize_view
from stormmart.sinks.upsert import read_upsert_table, upsert_table
from stormmart.sources.landing import csv_name, is_csv, read_landing
from stormmart.sources.links import extract_links
from stormmart.sources.tables import inline_rows, parquet_table

# --- fixed values used to derive test inputs ---------------------------------
UPSERT_FROM = "1998-01-01 00:00:00"
MAX_ANCHORS = 3
# --- end of fixed values -------------------------------------------------------


def q30_upsert_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-06 / T-06: orders stored by the sink, their newest rows upserted (twice, as
    a replay) with another status, read back."""
    orders = parquet_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    path = shared_path(spark, "queries", f"upsert-{uuid.uuid4().hex}")
    upsert_table(spark, orders, path, "o_orderkey", 8)
    newest = orders.where(F.col("o_orderdate") >= F.lit(UPSERT_FROM)).withColumn("o_orderstatus", F.lit("U"))
    for _ in range(2):
        upsert_table(spark, newest, path, "o_orderkey", 8)
    return read_upsert_table(spark, path)


def q31_landing_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-01 / S-02: orders as gzip CSV files, read back by header name, typed again."""
    orders = parquet_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = shared_path(spark, "queries", f"landing-{uuid.uuid4().hex}")
    text = orders.select(*[F.col(c).cast("string").alias(c) for c in orders.columns])
    text.write.option("header", "true").option("compression", "gzip").csv(path)
    rows = read_landing(spark, path, text.schema)
    return rows.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderstatus",
                       F.col("o_totalprice").cast("double").alias("o_totalprice"),
                       F.col(MALFORMED).isNotNull().alias("malformed"),
                       csv_name(F.col(FILENAME)).endswith(".csv").alias("is_csv"))


def q32_not_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R-05 / U-01: ids of both inputs that are not null."""
    keys = parquet_table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey")).cast("int").alias("id"))
    return non_null_ids(first_model(keys, inline_rows(spark, [(None,), (-1,)], "id int"), "id"))


def q33_hash_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-05 / F-16: hash values of rows with nulls and empty texts."""
    c = parquet_table(spark, sf_dir, "customer")
    name = F.when(F.col("c_custkey") % 3 == 0, F.lit(None)).otherwise(F.col("c_name"))
    segment = F.when(F.col("c_custkey") % 4 == 0, F.lit("")).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", row_hash(F.col("c_custkey"), name, segment).alias("hash"))


def q34_cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-08: values that were present but did not parse, counted by a quality rule."""
    o = parquet_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    rows = o.select(
        F.when(k % 5 == 0, F.concat(k.cast("string"), F.lit("abc"))).when(k % 5 == 1, F.lit(None))
        .otherwise(k.cast("string")).alias("injuries_direct"),
        F.when(k % 4 == 0, F.lit("x")).otherwise(F.lit("12.5")).alias("begin_lat"))
    typed = conform_types(rows, report=True)
    return dq.run_suite(typed, dq.Suite("casts", [dq.be_null(NOT_CAST), dq.not_null("injuries_direct")])).select(
        "rule", "column_name", "element_count", "unexpected_count", "success")


def q35_suite_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-07 / K-11: a suite through its JSON form, with ``mostly``, results as rows."""
    suite = dq.Suite("s", [dq.Rule(dq.NOT_NULL, "event_type", {"mostly": 0.9}),
                           dq.Rule(dq.BETWEEN, "user_id", {"min_value": 50, "max_value": None, "mostly": 0.5}),
                           dq.Rule(dq.BETWEEN, "user_id", {"min_value": 1000000000, "max_value": None, "mostly": 0.5})])
    back = dq.Suite.from_json(suite.to_json())
    results = dq.run_suite(parquet_table(spark, sf_dir, "events"), back)
    return dq.results_json(results).select(
        F.get_json_object("result_json", "$.rule").alias("rule"),
        F.get_json_object("result_json", "$.unexpected_count").cast("long").alias("unexpected_count"),
        F.get_json_object("result_json", "$.success").cast("boolean").alias("success"))


def q36_first_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-03: the first links of every page; R-07 / F-14: which names are CSV files."""
    pages = parquet_table(spark, sf_dir, "pages")
    links = extract_links(pages, "th", max_anchors=MAX_ANCHORS).select("page_id", "link_pos")
    name = F.concat(F.col("page_id").cast("string"), F.when(F.col("page_id") % 3 == 0, ".csv.gz").otherwise(".txt.gz"))
    return links.select("page_id", F.col("link_pos").cast("long").alias("link_pos"),
                        drop_suffix(name, ".gz").alias("name"), is_csv(name).alias("csv"))


def q37_sql_clean_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-05 / S-06 / K-08 / P-02: the clean model as SQL over a view."""
    li = parquet_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), "l_quantity", F.col("l_shipdate").alias(DATE_LOADED),
        F.concat(F.lit("f"), F.col("l_linenumber").cast("string")).alias(FILENAME))
    view = f"q37_{uuid.uuid4().hex[:12]}"
    materialize_view(li, view)
    return spark.sql(clean_sql(spark, view, key="k"))


def q38_map_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-08: totals of JSON maps with several keys."""
    o = parquet_table(spark, sf_dir, "orders")
    text = F.to_json(F.struct(F.round("o_totalprice", 0).alias("a"), (F.col("o_orderkey") * 2).cast("double").alias("b"),
                              F.col("o_custkey").cast("double").alias("c")))
    return o.select("o_orderkey", map_total(json_amounts(text)).alias("total"))


FILE_QUERIES = {f.__name__: f for f in (
    q30_upsert_sink, q31_landing_round_trip, q32_not_null_rows, q33_hash_values, q34_cast_failures,
    q35_suite_json, q36_first_anchors, q37_sql_clean_model, q38_map_totals)}

FILE_ORACLE = {
    "q30_upsert_sink": """
select o_orderkey, case when o_orderdate >= timestamp '1998-01-01' then 'U' else o_orderstatus end as o_orderstatus,
       o_totalprice, o_orderdate
from orders""",
    "q31_landing_round_trip": """
select o_orderkey, o_orderstatus, o_totalprice, false as malformed, true as is_csv from orders""",
    "q32_not_null_rows": """
select cast(c_custkey as integer) as id from customer where c_custkey % 5 <> 0 union all select -1""",
    "q33_hash_values": """
select c_custkey, sha256(strlen(cast(c_custkey as varchar)) || ':' || c_custkey ||
  case when c_custkey % 3 = 0 then '~' else strlen(c_name) || ':' || c_name end ||
  case when c_custkey % 4 = 0 then '0:' else strlen(c_mktsegment) || ':' || c_mktsegment end) as hash
from customer""",
    "q34_cast_failures": """
with t as (select count(*) as n, count(*) filter (o_orderkey % 5 = 0 or o_orderkey % 4 = 0) as bad,
  count(*) filter (o_orderkey % 5 < 2) as missing from orders)
select 'expect_column_values_to_be_null' as rule, '__not_cast' as column_name, n as element_count,
  bad as unexpected_count, bad = 0 as success from t
union all select 'expect_column_values_to_not_be_null', 'injuries_direct', n, missing, missing = 0 from t""",
    "q35_suite_json": """
with t as (select count(*) as n, count(user_id) as v, count(*) filter (event_type is null) as a,
  count(*) filter (user_id < 50) as b, count(*) filter (user_id < 1000000000) as c from events)
select 'expect_column_values_to_not_be_null' as rule, a as unexpected_count, n - a >= 0.9 * n as success from t
union all select 'expect_column_values_to_be_between', b, v - b >= 0.5 * v from t
union all select 'expect_column_values_to_be_between', c, v - c >= 0.5 * v from t""",
    "q37_sql_clean_model": """
select * exclude (rn) from (
  select l_orderkey as k, l_quantity, l_shipdate as __date_loaded, 'f' || l_linenumber as __filename,
    row_number() over (partition by l_orderkey order by l_shipdate nulls first, l_linenumber, l_quantity nulls first) as rn
  from lineitem) where rn = 1""",
    "q38_map_totals": """
select o_orderkey, round(o_totalprice, 0) + o_orderkey * 2 + o_custkey as total from orders""",
}
