"""Registered queries over files, catalog tables and streams made from the given
tables: header scans, defaults, lengths, set tables, archives, validation runs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stormmart.operators import quality as dq
from stormmart.plans.ingest import Layout, archive_loaded
from stormmart.plans.validation import compare_runs, write_and_store
from stormmart.schemas import FILE_PATH, FILENAME
from stormmart.session import shared_path
from stormmart.sinks.tables import BATCH, ensure_raw_tables, ensure_table, insert_named, path_exists, route_lengths, write_files
from stormmart.sinks.upsert import read_upsert_table
from stormmart.sources.headers import read_by_header
from stormmart.sources.landing import file_key, list_landing
from stormmart.sources.links import extract_links
from stormmart.sources.tables import parquet_table
from stormmart.streaming.newest_stream import start_newest

# --- fixed values used to derive test inputs ---------------------------------
DOCUMENT_LENGTHS = {"text": 2000, "lang": 2, "source": 4}
LARGEST_PART = 40
FIRST_LOAD, SECOND_LOAD, LATE_LOAD = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2023-12-01 00:00:00"
CHANGED_FROM = "1997-01-01 00:00:00"
# --- end of fixed values -------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    return shared_path(spark, "queries", f"{name}-{uuid.uuid4().hex}")


def _name(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


def q39_header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-01 / P-08: orders in CSV files of four headers: as the schema, moved, one
    column less, one too many. The last kind's files are refused."""
    orders = parquet_table(spark, sf_dir, "orders").select(
        *[F.col(c).cast("string").alias(c.upper()) for c in ("o_orderkey", "o_orderstatus", "o_totalprice")])
    kinds = [["O_ORDERKEY", "O_ORDERSTATUS", "O_TOTALPRICE"], ["O_TOTALPRICE", "O_ORDERKEY", "O_ORDERSTATUS"],
             ["o_totalprice", "o_orderkey"], ["O_ORDERKEY", "O_EXTRA", "O_ORDERSTATUS", "O_TOTALPRICE"]]
    path = _folder(spark, "headers")
    rows = orders.withColumn("O_EXTRA", F.lit("x"))
    for i, names in enumerate(kinds):
        (rows.where(F.col("O_ORDERKEY").cast("long") % len(kinds) == i).select(*names)
         .write.option("header", "true").option("compression", "gzip").csv(f"{path}/kind{i}"))
    schema = StructType([StructField(c, StringType()) for c in kinds[0]])
    scan = read_by_header(spark, [f"{path}/kind{i}" for i in range(len(kinds))], schema)
    loaded = scan.rows.select(F.col("O_ORDERKEY").cast("long").alias("o_orderkey"), F.col("O_ORDERSTATUS").alias("o_orderstatus"),
                              F.col("O_TOTALPRICE").cast("double").alias("o_totalprice"), F.lit(None).cast("string").alias("refused"))
    refused = scan.refused.select("reason", "column").distinct().select(
        F.lit(None).cast("long").alias("o_orderkey"), F.lit(None).cast("string").alias("o_orderstatus"),
        F.lit(None).cast("double").alias("o_totalprice"), F.concat_ws(": ", "reason", "column").alias("refused"))
    return loaded.unionByName(refused)


MIXED_SUITE = dq.Suite("mixed", [
    dq.not_null("l_orderkey"), dq.unique("l_orderkey", "l_linenumber"), dq.unique("l_orderkey"),
    dq.between("l_quantity", 5, 40), dq.unique("l_orderkey", "l_partkey"), dq.unique("l_comment_key")])


def q40_mixed_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-05 / A-07: row-level and four uniqueness rules in one scan; one key has nulls."""
    li = parquet_table(spark, sf_dir, "lineitem")
    key = F.when(F.col("l_orderkey") % 3 != 0, F.concat_ws("-", F.col("l_orderkey"), F.col("l_suppkey")))
    return dq.run_suite(li.withColumn("l_comment_key", key), MIXED_SUITE)


def q41_set_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-04 / DQ-03: keys of lineitem that are no part of up to a size, and their
    text forms in another letter case; the set is a view with a null in it."""
    part = parquet_table(spark, sf_dir, "part").where(F.col("p_size") <= LARGEST_PART)
    view = _name("parts")
    part.select("p_partkey", F.concat(F.lit("Part-"), F.col("p_partkey").cast("string")).alias("name")).unionByName(
        spark.sql("SELECT CAST(NULL AS BIGINT) AS p_partkey, CAST(NULL AS STRING) AS name")).createOrReplaceTempView(view)
    li = parquet_table(spark, sf_dir, "lineitem").withColumn(
        "part_name", F.when(F.col("l_linenumber") != 2, F.concat(F.lit("PART-"), F.col("l_partkey").cast("string"))))
    suite = dq.Suite("sets", [dq.in_table("l_partkey", view, "p_partkey"), dq.in_table("part_name", view, "name", True),
                              dq.in_table("part_name", view, "name"), dq.not_null("l_partkey")])
    return dq.run_suite(li, suite).select("rule", "column_name", "element_count", "unexpected_count", "success")


def q42_column_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-03: an insert that names two of four columns; the catalog sets the others."""
    table = _name("defaults")
    schema = StructType.fromDDL("c_custkey BIGINT, c_name STRING, loaded_at TIMESTAMP, origin STRING")
    ensure_table(spark, table, schema, defaults={"loaded_at": "current_timestamp()", "origin": "'load'"})
    insert_named(parquet_table(spark, sf_dir, "customer").select("c_custkey", "c_name"), table)
    return spark.table(table).select("c_custkey", "c_name", "origin", F.col("loaded_at").isNotNull().alias("has_time"))


def q43_length_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-08: documents into a table with VARCHAR(n) columns; each text that is too
    long is a row of the reject table instead."""
    docs = parquet_table(spark, sf_dir, "documents").select("doc_id", *DOCUMENT_LENGTHS)
    stored, rejects = _name("documents"), _name("rejects")
    ensure_table(spark, stored, docs.schema, lengths=DOCUMENT_LENGTHS)
    fits, too_long = route_lengths(docs, DOCUMENT_LENGTHS)
    insert_named(fits, stored)
    too_long.drop(*DOCUMENT_LENGTHS).write.saveAsTable(rejects)
    none = [F.lit(None).cast(t).alias(c) for c, t in
            (("column_name", "string"), ("limit_length", "int"), ("found_length", "int"))]
    return spark.table(stored).select("doc_id", *none).unionByName(spark.table(rejects))


def _references(page_id: Column) -> list[Column]:
    """Character references of all kinds, by the page's number."""
    number = page_id.cast("string")
    plain = (page_id * 131 % 55000 + 160).cast("long")
    return [F.concat(F.lit("&#"), plain.cast("string"), F.lit(";")),
            F.concat(F.lit("&#x"), F.lower(F.hex(plain)), F.lit(";")),
            F.concat(F.lit("&#X"), F.hex(page_id % 900 + 0x1F300), F.lit(";")),
            F.concat(F.lit("&#"), (page_id % 32 + 128).cast("string"), F.lit(";")),
            F.concat(F.lit("&#0;&#55296;&#x110000;&#99999999999999;&amp;lt;&#38;#38;&Eacute;&nosuch; & "), number)]


def q44_character_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-04: link texts with numeric and named character references of all kinds."""
    pages = parquet_table(spark, sf_dir, "pages")
    links = F.concat(*[F.concat(F.lit("<a href='#'>"), c, F.lit("</a>")) for c in _references(F.col("page_id"))])
    return extract_links(pages.select("page_id", F.concat(links, F.col("html")).alias("html")), None).where(
        F.col("link_pos") < 5).select("page_id", "link_pos", "link_text")


def q45_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-01, T-02, T-04, T-05: orders as a file stream, stopped and started again
    from its checkpoint with repeated, newer and late rows, and once with no file."""
    orders = parquet_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    base = _folder(spark, "stream")

    def rows(status: Column, loaded: str, which: DataFrame) -> DataFrame:
        return which.withColumn("o_orderstatus", status).withColumn("loaded", F.lit(loaded).cast("timestamp_ntz"))

    changed = orders.where(F.col("o_orderdate") >= F.lit(CHANGED_FROM).cast("timestamp_ntz"))
    first = rows(F.col("o_orderstatus"), FIRST_LOAD, orders)
    waves = [first, rows(F.lit("U"), SECOND_LOAD, changed).unionByName(rows(F.lit("L"), LATE_LOAD, orders)).unionByName(first)]
    schema = first.schema
    for wave in [*waves, None]:
        if wave is not None:
            wave.repartition(6, "o_orderkey", "loaded").write.mode("append").parquet(f"{base}/landing")
        query = start_newest(spark, f"{base}/landing", schema, f"{base}/table", ["o_orderkey"], "loaded",
                             f"{base}/checkpoint", max_files_per_trigger=4, n_buckets=8)
        query.awaitTermination()
    return read_upsert_table(spark, f"{base}/table").select("o_orderkey", "o_orderstatus", "o_totalprice", "loaded")


def q46_archive_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-10 / T-03: order files whose names are in the load log, archived; the landing
    folder is empty after it, and the archive has every row."""
    orders = parquet_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    base, db = _folder(spark, "archive"), _name("raw")
    orders.repartition(5, "o_orderkey").write.option("header", "true").csv(f"{base}/landing")
    layout = Layout(raw_table=f"{db}.events", log_table=f"{db}.log", results_table=None)
    ensure_raw_tables(spark, layout.raw_table, layout.log_table)
    listing = list_landing(spark, f"{base}/landing").withColumn(BATCH, file_key(F.col(FILE_PATH)))
    write_files(listing.select(FILENAME, BATCH).withColumn("batch_id", F.lit("all")), layout.log_table)
    moves = archive_loaded(spark, f"{base}/landing", f"{base}/done", layout)
    left = list_landing(spark, f"{base}/landing").count() if path_exists(spark, f"{base}/landing") else 0
    archived = spark.read.schema("o_orderkey LONG, o_totalprice DOUBLE").option("header", "true").csv(f"{base}/done")
    sums = archived.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("sum_keys"))
    failed = moves.agg(F.count("error").alias("not_moved"))
    return sums.join(failed).withColumn("left_in_landing", F.lit(left).cast("long"))


def q47_checkpoint_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-10 / K-12: two writes of events, the second with worse values, each with
    its suite counted by the write; the stored results run by run."""
    events = parquet_table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value")
    worse = events.withColumn("event_type", F.when(F.col("event_id") % 11 != 0, F.col("event_type"))).withColumn(
        "event_id", F.when(F.col("event_id") % 50 == 0, 0).otherwise(F.col("event_id")))
    suite = dq.Suite("events", [dq.not_null("event_type"), dq.between("user_id", 10, None), dq.unique("event_id")])
    base, table = _folder(spark, "runs"), _name("results")
    for i, rows in enumerate((events, worse)):
        write_and_store(rows, suite, f"{base}/{i}", table, f"run-{i}")
    return compare_runs(spark, table)


def q48_listing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-03 / P-04: the listing of a folder joined with the rows that its files gave,
    by file name; orders in one folder for each status."""
    orders = parquet_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    path = _folder(spark, "listing")
    orders.write.partitionBy("o_orderstatus").parquet(path)
    listing = list_landing(spark, path, glob="*.parquet").select(FILE_PATH, FILENAME, "length")
    rows = (spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias(FILE_PATH), F.col("_metadata.file_name").alias("name"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")))
    both = listing.join(rows, FILE_PATH, "full")
    status = F.regexp_extract(FILE_PATH, "o_orderstatus=([^/]+)/", 1)
    return both.groupBy(status.alias("o_orderstatus")).agg(
        F.sum("n").alias("n_rows"), F.sum("keys").alias("sum_keys"),
        F.bool_and((F.col(FILENAME) == F.col("name")) & (F.col("length") > 0)).alias("all_listed"))


TABLE_QUERIES = {f.__name__: f for f in (
    q39_header_scan, q40_mixed_suite, q41_set_table, q42_column_defaults, q43_length_rejects,
    q44_character_references, q45_stream_restart, q46_archive_drain, q47_checkpoint_runs, q48_listing_counts)}
