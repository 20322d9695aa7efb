"""Registered queries over the test tables: one per operator group of SURVEY §2.

Each query reads whole tables (``<sf_dir>/<name>.parquet``) and derives the
text inputs the operators need (amount texts, raw-like string rows, load
batches) with built-in expressions, so its work grows with the tables.
Modulo arithmetic below only *derives* values (which unit letter, which rows
carry a repeated header); no query filters rows away to save work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormmart.functions.amounts import amount_number, amount_unit, parse_amount
from stormmart.functions.timestamps import parse_event_timestamp
from stormmart.operators import quality as dq
from stormmart.operators.cleaning import (
    add_meta_columns,
    apply_null_tokens,
    conform_types,
    drop_repeated_headers,
    normalize_columns,
)
from stormmart.operators.dedupe import above_max, first_per_key, upsert_frames
from stormmart.operators.lookup import branch
from stormmart.plans.layers import clean, stage, yearly_damage, yearly_totals
from stormmart.plans.samples import day_activities, first_model, order_totals, second_model
from stormmart.plans.registry_files import FILE_QUERIES
from stormmart.plans.registry_tables import TABLE_QUERIES
from stormmart.schemas import DATE_LOADED, FILENAME, TIMESTAMP_TEXT_FORMAT
from stormmart.sources.catalog import loaded_files, missing_files
from stormmart.sources.links import count_links, extract_links
from stormmart.sources.tables import inline_rows, parquet_table

# --- fixed values used to derive test inputs ---------------------------------
# Unit letter appended to the amount text, by o_orderkey % 6.
Q01_UNITS = ["", "H", "k", "M", "B", "t"]
# Cut dates splitting a table into an existing target and a new batch.
EVENTS_TARGET_BEFORE = "2024-01-20 00:00:00"
EMPTY_TARGET_BEFORE = "1900-01-01 00:00:00"
ORDERS_TARGET_BEFORE = "1999-01-01 00:00:00"
ORDERS_BATCH_FROM = "1998-01-01 00:00:00"
# Load times and file names of the two simulated loads of orders.
FIRST_LOAD_AT = "2024-01-01 00:00:00"
SECOND_LOAD_AT = "2024-02-01 00:00:00"
FIRST_LOAD_UNTIL = "1998-01-01 00:00:00"
FIRST_FILE = "orders_d1997.csv.gz"
SECOND_FILE = "orders_d2001.csv.gz"
# Crop-damage unit letter, by o_orderkey % 3.
CROP_UNITS = ["", "K", "M"]
# Link token and the page filter standing for "already loaded".
LINK_TOKEN = "th"
LOADED_URL_PREFIX = "https://"
# --- end of fixed values -------------------------------------------------------


def _pick(values: list, index: Column) -> Column:
    """values[index] for a 0-based integer column (values may be Columns).

    A CASE chain: only the chosen value is computed for a row.
    """
    items = [v if isinstance(v, Column) else F.lit(v) for v in values]
    expr = F.when(index == 0, items[0])
    for i, item in enumerate(items[1:], start=1):
        expr = expr.when(index == i, item)
    return expr


def _thousands(price: str) -> Column:
    return F.floor(F.col(price) / 1000).cast("string")


def orders_as_damage_rows(orders: DataFrame, crops: Column | None = None) -> DataFrame:
    """Orders reshaped to the mart's input: state, begin_yearmonth, damage_property
    (and damage_crops when a crop-amount expression is given)."""
    extra = [] if crops is None else [crops.alias("damage_crops")]
    return orders.select(
        F.col("o_orderstatus").alias("state"),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("begin_yearmonth"),
        F.concat(_thousands("o_totalprice"),
                 _pick(Q01_UNITS, F.pmod(F.col("o_orderkey"), F.lit(6)))).alias("damage_property"),
        *extra,
    )


def q01_yearly_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-01 + M-02: yearly damage mart over derived amount texts."""
    return yearly_damage(orders_as_damage_rows(parquet_table(spark, sf_dir, "orders")))


def edge_amount_text(orders: DataFrame) -> Column:
    """Amount texts covering every branch of the parser, by o_orderkey % 12."""
    n = _thousands("o_totalprice")
    k = F.col("o_orderkey")
    cases = [
        F.concat(n, F.lit("K")),
        F.concat(n, F.lit("."), F.pmod(k, F.lit(10)).cast("string"), F.lit("M")),
        F.concat(n, F.lit("B")),
        F.concat(n, F.lit("H")),
        F.lit("K"),
        F.lit("0"),
        F.lit(""),
        F.lit(None).cast("string"),
        n,
        F.concat(n, F.lit("t")),
        F.concat(n, F.lit(".5KK")),
        F.concat(F.lit("-"), n, F.lit("k")),
    ]
    return _pick(cases, F.pmod(k, F.lit(12)))


def q02_parse_amount_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-01..F-10: number, unit and amount of every text, row by row."""
    orders = parquet_table(spark, sf_dir, "orders")
    t = orders.select("o_orderkey", edge_amount_text(orders).alias("amount_text"))
    return t.select(
        "o_orderkey", "amount_text",
        amount_number("amount_text").alias("damage_number"),
        amount_unit("amount_text").alias("damage_unit"),
        parse_amount("amount_text").alias("amount"),
    )


def q03_distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-03: staging's SELECT DISTINCT * over lineitem."""
    return stage(parquet_table(spark, sf_dir, "lineitem"))


def q04_first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W-01 + R-03: earliest shipment per (l_orderkey, l_linenumber)."""
    li = parquet_table(spark, sf_dir, "lineitem")
    rest = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus"]
    return first_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"], rest)


def q05_incremental_above_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R-02 + A-02: events newer than the newest row of the target."""
    ev = parquet_table(spark, sf_dir, "events")
    target = ev.filter(F.col("ts") < F.lit(EVENTS_TARGET_BEFORE).cast("timestamp_ntz"))
    return above_max(ev, target, "ts")


def q06_incremental_empty_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: an empty target has a null max, so every row is taken."""
    ev = parquet_table(spark, sf_dir, "events")
    target = ev.filter(F.col("ts") < F.lit(EMPTY_TARGET_BEFORE).cast("timestamp_ntz"))
    return above_max(ev, target, "ts")


def q07_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-06: batch rows replace target rows with the same key (delete + insert)."""
    orders = parquet_table(spark, sf_dir, "orders")
    target = orders.filter(F.col("o_orderdate") < F.lit(ORDERS_TARGET_BEFORE).cast("timestamp_ntz"))
    batch = orders.filter(F.col("o_orderdate") >= F.lit(ORDERS_BATCH_FROM).cast("timestamp_ntz")) \
        .withColumn("o_orderstatus", F.lower("o_orderstatus"))
    return upsert_frames(target, batch, "o_orderkey")


def events_for_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = parquet_table(spark, sf_dir, "events")
    return ev.withColumn(
        "purchase_value", F.when(F.col("event_type") == "purchase", F.col("value"))
    ).withColumn("refund_value", F.when(F.col("value") < 0, F.col("value")))


Q08_SUITE = dq.Suite("events_not_null", [dq.not_null(c) for c in (
    "event_id", "ts", "user_id", "event_type", "value", "props", "purchase_value")])
Q09_SUITE = dq.Suite("events_null", [dq.be_null("purchase_value"), dq.be_null("refund_value")])
Q10_SUITE = dq.Suite("events_in_set", [
    dq.in_set("event_type", ["click", "view", "purchase"]),
    dq.in_set("event_type", ["CLICK", "VIEW", "PURCHASE", "SIGNUP", "ERROR"], ignore_case=True),
    dq.in_set("purchase_value", [1.0, 2.0]),
])
Q11_SUITE = dq.Suite("lineitem_ranges", [
    dq.between("l_quantity", 1, 50),
    dq.between("l_discount", 0, 0.1),
    dq.between("l_tax", 0, 0.05),
    dq.between("l_tax", 0, 0.08, strict_min=True, strict_max=True),
    dq.between("l_extendedprice", None, 100000),
    dq.length_between("l_returnflag", None, 1),
    dq.length_between("l_linestatus", 1, 1),
])
Q12_LINEITEM = dq.Suite("lineitem_keys", [dq.unique("l_orderkey"),
                                          dq.unique("l_orderkey", "l_linenumber")])
Q12_ORDERS = dq.Suite("orders_keys", [dq.unique("o_orderkey"), dq.not_null("o_orderkey")])


def q08_dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.run_suite(events_for_quality(spark, sf_dir), Q08_SUITE)


def q09_dq_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.run_suite(events_for_quality(spark, sf_dir), Q09_SUITE)


def q10_dq_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.run_suite(events_for_quality(spark, sf_dir), Q10_SUITE)


def q11_dq_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.run_suite(parquet_table(spark, sf_dir, "lineitem"), Q11_SUITE)


def q12_dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = dq.run_suite(parquet_table(spark, sf_dir, "lineitem"), Q12_LINEITEM)
    od = dq.run_suite(parquet_table(spark, sf_dir, "orders"), Q12_ORDERS)
    return li.unionByName(od)


def q13_link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-04: link texts holding the token, per page and position."""
    return extract_links(parquet_table(spark, sf_dir, "pages"), LINK_TOKEN)


def q14_missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-10 / J-01: listed names (all links) not yet in the load log.

    The log is every link name of the https pages; the listing keeps its
    duplicates and order (page_id, link_pos).
    """
    pages = parquet_table(spark, sf_dir, "pages")
    listing = extract_links(pages, None).withColumnRenamed("link_text", FILENAME)
    log = extract_links(pages.filter(F.col("url").startswith(LOADED_URL_PREFIX)), None) \
        .select(F.col("link_text").alias(FILENAME))
    return missing_files(listing, log)


def documents_as_landing_rows(docs: DataFrame) -> DataFrame:
    """Documents as raw text rows; some rows repeat the header, some key fields are null."""
    k = F.pmod(F.col("doc_id"), F.lit(50))
    header = k == 7
    nulled = k == 13
    return docs.select(
        F.when(header, F.lit("DOC_ID")).when(nulled, F.lit(None))
        .otherwise(F.col("doc_id").cast("string")).alias('"DOC_ID"'),
        F.when(header, F.lit("LANG")).otherwise(F.col("lang")).alias('"LANG"'),
        F.when(header, F.lit("SOURCE")).otherwise(F.col("source")).alias("SOURCE"),
    )


def q15_repeated_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R-01 (null-safe, Q13) then P-03 names."""
    rows = documents_as_landing_rows(parquet_table(spark, sf_dir, "documents"))
    return normalize_columns(drop_repeated_headers(rows, '"DOC_ID"', "DOC_ID"))


def orders_as_landing_rows(orders: DataFrame) -> DataFrame:
    """Orders as CSV text in the event-file shape (upper-case dates, null tokens)."""
    k = F.pmod(F.col("o_orderkey"), F.lit(7))
    cents = F.floor(F.col("o_totalprice") * 100 + 0.5).cast("long")
    price_text = F.concat(F.floor(cents / 100).cast("long").cast("string"), F.lit("."),
                          F.lpad(F.pmod(cents, F.lit(100)).cast("string"), 2, "0"))
    ten_thousands = F.floor(cents / 1000000).cast("long").cast("string")
    hundredths = F.lpad(F.pmod(F.floor(cents / 10000).cast("long"), F.lit(100)).cast("string"), 2, "0")
    magnitude = (F.when(k == 0, F.lit("NA")).when(k == 1, F.lit(""))
                 .when(k == 2, F.concat(ten_thousands, F.lit(".5")))
                 .otherwise(F.concat(ten_thousands, F.lit("."), hundredths)))
    return orders.select(
        F.col("o_orderkey").cast("string").alias('"O_ORDERKEY"'),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("string").alias("BEGIN_YEARMONTH"),
        F.upper(F.date_format("o_orderdate", TIMESTAMP_TEXT_FORMAT)).alias("BEGIN_DATE_TIME"),
        magnitude.alias("MAGNITUDE"),
        F.when(k == 3, F.lit("null")).otherwise(price_text).alias("TOR_LENGTH"),
        F.when(k == 4, F.lit("N/A")).otherwise(F.col("o_orderstatus")).alias("STATE"),
    )


def q16_conform_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-03, P-07..P-09, F-17: names, null tokens, casts, century of dates."""
    rows = orders_as_landing_rows(parquet_table(spark, sf_dir, "orders"))
    return conform_types(apply_null_tokens(normalize_columns(rows)))


def q17_row_hash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-05/P-06: distinct content hashes per return flag (= distinct rows)."""
    li = parquet_table(spark, sf_dir, "lineitem")
    hashed = add_meta_columns(li.select([F.col(c).cast("string").alias(c) for c in li.columns]),
                              filename="lineitem.parquet")
    return hashed.groupBy("l_returnflag").agg(F.count_distinct("__row_hash").alias("distinct_hashes"))


def q18_json_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-03: JSON amount maps -> totals per event type -> formatted line."""
    return order_totals(parquet_table(spark, sf_dir, "events"), "props", ["event_type"])


def q19_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-01/C-02: day name, weekend flag, activity and branch task of every event."""
    ev = parquet_table(spark, sf_dir, "events").select("event_id", "ts")
    return day_activities(ev, "ts").select(
        "event_id", "day_name", "is_weekend", "is_weekday", "activity", "task_id", "message")


def q20_union_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-04: customer nation ids union all literal rows (1, null), then id = 1."""
    customer = parquet_table(spark, sf_dir, "customer")
    inline = inline_rows(spark, [(1,), (None,)], "id int")
    return second_model(first_model(customer, inline, "c_nationkey"), 1)


def orders_two_loads(orders: DataFrame) -> DataFrame:
    """Raw-table rows of two loads: older orders first, then every order again."""
    cols = list(orders.columns)
    first = orders.filter(F.col("o_orderdate") < F.lit(FIRST_LOAD_UNTIL).cast("timestamp_ntz")) \
        .withColumn(DATE_LOADED, F.lit(FIRST_LOAD_AT).cast("timestamp_ntz")) \
        .withColumn(FILENAME, F.lit(FIRST_FILE))
    second = orders.withColumn(DATE_LOADED, F.lit(SECOND_LOAD_AT).cast("timestamp_ntz")) \
        .withColumn(FILENAME, F.lit(SECOND_FILE))
    return first.unionByName(second).select(*cols, DATE_LOADED, FILENAME)


def q21_clean_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging + clean on an empty target: earliest load per key wins."""
    raw = orders_two_loads(parquet_table(spark, sf_dir, "orders"))
    return clean(raw, None, key="o_orderkey")


def q22_clean_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second run: rows newer than the clean table replace their keys in it."""
    orders = parquet_table(spark, sf_dir, "orders")
    raw = orders_two_loads(orders)
    target = first_per_key(
        raw.filter(F.col(DATE_LOADED) == F.lit(FIRST_LOAD_AT).cast("timestamp_ntz")),
        "o_orderkey", [DATE_LOADED, FILENAME])
    new_rows = clean(raw, target, key="o_orderkey", eager=False)
    return upsert_frames(target, new_rows, "o_orderkey")


def q23_yearly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q20: property and crop damage parsed by the same function, one aggregate."""
    orders = parquet_table(spark, sf_dir, "orders")
    crops = F.concat(F.pmod(F.col("o_custkey"), F.lit(1000)).cast("string"),
                     _pick(CROP_UNITS, F.pmod(F.col("o_orderkey"), F.lit(3))))
    return yearly_totals(orders_as_damage_rows(orders, crops))


def q24_observed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-06: distinct values of a column with their counts."""
    return dq.observed_values(parquet_table(spark, sf_dir, "events"), "event_type")


def q25_link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-09: number of matching links per page."""
    return count_links(extract_links(parquet_table(spark, sf_dir, "pages"), LINK_TOKEN))


def q26_loaded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-04 / S-09: distinct names in the load log (link names of the https pages)."""
    pages = parquet_table(spark, sf_dir, "pages")
    log = extract_links(pages.filter(F.col("url").startswith(LOADED_URL_PREFIX)), None) \
        .select(F.col("link_text").alias(FILENAME))
    return loaded_files(log)


def q27_day_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-02: weekday and weekend branches of the enriched events, counted per task
    (one pass: the branch is a column, not two filtered copies)."""
    enriched = day_activities(parquet_table(spark, sf_dir, "events").select("event_id", "ts"), "ts")
    return enriched.withColumn("branch", branch()).groupBy("branch", "task_id") \
        .agg(F.count(F.lit(1)).alias("n_events"))


Q28_SUITE = dq.Suite("document_lengths", [
    dq.not_null("text"),
    dq.length_between("text", 1, 20000),
    dq.length_between("lang", 2, 2),
    dq.length_between("source", None, 4),
])


def q28_dq_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-08: varchar(n)-style length limits over whole document texts."""
    return dq.run_suite(parquet_table(spark, sf_dir, "documents"), Q28_SUITE)


def lineitem_event_times(li: DataFrame) -> DataFrame:
    """Ship dates as event-time texts in the forms the files hold, by key % 5:
    upper-case, lower-case, unpadded day, an impossible date, padded with
    spaces; a third of the rows take their century from a year-month one
    century earlier."""
    ship = F.col("l_shipdate")
    canon = F.upper(F.date_format(ship, TIMESTAMP_TEXT_FORMAT))
    text = _pick([
        canon,
        F.lower(canon),
        F.date_format(ship, "d-MMM-yy H:mm:ss"),
        F.concat(F.lit("31-FEB-"), F.date_format(ship, "yy"), F.lit(" 00:00:00")),
        F.concat(F.lit(" "), canon, F.lit(" ")),
    ], F.pmod(F.col("l_orderkey"), F.lit(5)))
    year = F.year(ship) - F.when(F.pmod(F.col("l_linenumber"), F.lit(3)) == 0, 100).otherwise(0)
    return li.select("l_orderkey", "l_linenumber", text.alias("event_text"),
                     (year * 100 + F.month(ship)).alias("begin_yearmonth"))


def q29_event_time_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-17 / Q11: text forms, impossible dates and the century of the year-month."""
    rows = lineitem_event_times(parquet_table(spark, sf_dir, "lineitem"))
    return rows.withColumn("event_time", parse_event_timestamp("event_text", "begin_yearmonth"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q01_yearly_amount": q01_yearly_amount,
    "q02_parse_amount_edges": q02_parse_amount_edges,
    "q03_distinct_rows": q03_distinct_rows,
    "q04_first_per_key": q04_first_per_key,
    "q05_incremental_above_max": q05_incremental_above_max,
    "q06_incremental_empty_target": q06_incremental_empty_target,
    "q07_upsert": q07_upsert,
    "q08_dq_not_null": q08_dq_not_null,
    "q09_dq_null": q09_dq_null,
    "q10_dq_in_set": q10_dq_in_set,
    "q11_dq_between": q11_dq_between,
    "q12_dq_unique": q12_dq_unique,
    "q13_link_extract": q13_link_extract,
    "q14_missing_files": q14_missing_files,
    "q15_repeated_headers": q15_repeated_headers,
    "q16_conform_types": q16_conform_types,
    "q17_row_hash_groups": q17_row_hash_groups,
    "q18_json_totals": q18_json_totals,
    "q19_calendar": q19_calendar,
    "q20_union_filter": q20_union_filter,
    "q21_clean_first_run": q21_clean_first_run,
    "q22_clean_incremental": q22_clean_incremental,
    "q23_yearly_totals": q23_yearly_totals,
    "q24_observed_values": q24_observed_values,
    "q25_link_counts": q25_link_counts,
    "q26_loaded_files": q26_loaded_files,
    "q27_day_branches": q27_day_branches,
    "q28_dq_lengths": q28_dq_lengths,
    "q29_event_time_edges": q29_event_time_edges,
    **FILE_QUERIES,
    **TABLE_QUERIES,
}
