import os

from pyspark.sql import functions as F

from stormmart.functions.hashing import row_hash
from stormmart.operators.cleaning import drop_repeated_headers, prepare_raw
from stormmart.sources.landing import list_landing, read_landing
from tests.landing_fixture import event_row, write_csv


def test_landing_read_and_prepare(spark, tmp_dir):
    rows = [event_row(i) for i in range(20)]
    rows[3]["event_narrative"] = 'He said "run",\nthen left'
    rows[4]["begin_yearmonth"] = None          # null key: kept
    rows[5]["state"] = "NA"                   # null token
    rows[6]["magnitude"] = "52.5"             # rounded, not truncated
    write_csv(os.path.join(tmp_dir, "f0.csv.gz"), rows, header_every=7)
    write_csv(os.path.join(tmp_dir, "f1.csv"), [event_row(100)], gz=False)
    landing = read_landing(spark, tmp_dir)
    assert landing.count() == 20 + 2 + 1          # two repeated header lines inside f0
    out = prepare_raw(landing).cache()
    assert out.count() == 21
    assert out.filter(F.col("begin_yearmonth").isNull()).count() == 1
    r3 = out.filter(F.col("event_id") == 10003).first()
    assert r3.event_narrative == 'He said "run",\nthen left'
    assert out.filter(F.col("event_id") == 10005).first().state is None
    assert out.filter(F.col("event_id") == 10006).first().magnitude == 53
    first = out.filter(F.col("event_id") == 10000).first()
    assert str(first.begin_date_time) == "2007-07-09 06:05:00"
    assert first["__filename"] == "f0.csv.gz"
    assert out.select("__row_hash").distinct().count() == 21
    assert set(out.columns[:3]) == {"begin_yearmonth", "begin_day", "begin_time"}
    listing = list_landing(spark, tmp_dir).collect()
    assert sorted(r["__filename"] for r in listing) == ["f0.csv.gz", "f1.csv"]


def test_header_filter_is_null_safe(spark):
    df = spark.createDataFrame([("BEGIN_YEARMONTH",), (None,), ("196205",)], "BEGIN_YEARMONTH string")
    assert drop_repeated_headers(df).count() == 2


def test_hash_keeps_null_positions(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "", "b")], "x string, y string, z string")
    hashes = df.select(row_hash("x", "y", "z").alias("h")).distinct().count()
    assert hashes == 3


def test_event_timestamp_parse_and_century(spark):
    from stormmart.functions.timestamps import parse_event_timestamp

    rows = [("17-MAY-62 03:20:10", "196205"), ("17-may-62 03:20:10", None), ("31-FEB-62 00:00:00", "196202"),
            ("01-Jan-99 1:05:09", "189901"), ("garbage", "196205"), ("10-MAR-24 02:30:00", "202403"),
            (None, "196205"), ("17-XYZ-62 03:20:10", "196205")]
    df = spark.createDataFrame(rows, "t string, ym string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [None if r.p is None else str(r.p)
               for r in df.select(parse_event_timestamp("t", "ym").alias("p")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["1962-05-17 03:20:10", "2062-05-17 03:20:10", None, "1899-01-01 01:05:09",
                   None, "2024-03-10 02:30:00", None, None]


def test_landing_rows_spread_after_unsplittable_scan(spark, tmp_dir):
    write_csv(os.path.join(tmp_dir, "big.csv.gz"), [event_row(i) for i in range(50)])
    one = read_landing(spark, tmp_dir)
    assert one.rdd.getNumPartitions() == 1                    # gzip: one task per file
    spread = read_landing(spark, tmp_dir, partitions=4)
    assert spread.rdd.getNumPartitions() == 4 and spread.count() == 50


def test_crlf_files_keep_clean_values(spark, tmp_dir):
    """Windows line endings: no trailing carriage return in any value; a line
    break inside a quoted field comes out as a plain newline (the CSV reader
    normalises it)."""
    rows = [event_row(i) for i in range(5)]
    rows[1]["event_narrative"] = "line one\r\nline two"
    write_csv(os.path.join(tmp_dir, "win.csv.gz"), rows, header_every=3, newline="\r\n")
    out = prepare_raw(read_landing(spark, tmp_dir)).cache()
    assert out.count() == 5
    assert out.filter(F.col("data_source") != "TST").count() == 0     # no trailing \r
    assert out.filter(F.col("event_id") == 10001).first().event_narrative == "line one\nline two"
