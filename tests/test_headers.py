import gzip
import os
import uuid

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from stormmart.operators import quality as dq
from stormmart.plans.ingest import Layout, ingest_directory
from stormmart.schemas import HEADER_NAMES
from stormmart.sources.headers import misfits, names_of, read_by_header
from stormmart.streaming.landing_stream import start_ingest
from tests.landing_fixture import event_row

SCHEMA = StructType([StructField(c, StringType()) for c in "ABC"])


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with (gzip.open if name.endswith(".gz") else open)(path, "wt", encoding="utf-8", newline="") as fh:
        fh.write(text)


def test_files_of_many_headers(spark, tmp_dir):
    write(tmp_dir, "plain.csv", "A,B,C\n1,2,3\n")
    write(tmp_dir, "moved.csv.gz", "C,A\n3,1\n9\n")
    write(tmp_dir, "case.csv", '﻿b,"A", c \r\n2,1,"x,""y""\nz"\r\n')
    write(tmp_dir, "more.csv", "A,B,C,D\n1,2,3,4\n")
    write(tmp_dir, "twice.csv", "A,B,a\n1,2,1\n")
    write(tmp_dir, "none.csv", "")
    write(tmp_dir, "header.csv", "A,B,C\n")
    write(tmp_dir, "long.csv", "B,C,A\n" + "2,3,1\n" * 50_000)
    scan = read_by_header(spark, tmp_dir, SCHEMA)
    rows = [(r["__filename"], r["A"], r["B"], r["C"], r["__malformed"]) for r in
            scan.rows.where("__filename != 'long.csv'").collect()]
    assert sorted(rows, key=str) == sorted([
        ("plain.csv", "1", "2", "3", None), ("moved.csv.gz", "1", None, "3", None),
        ("moved.csv.gz", None, None, "9", "9"), ("case.csv", "1", "2", 'x,"y"\nz', None)], key=str)
    assert scan.rows.where("A = '1' AND B = '2' AND C = '3' AND __filename = 'long.csv'").count() == 50_000
    assert sorted((r["__filename"], r["reason"], r["column"]) for r in scan.refused.collect()) == [
        ("more.csv", "unknown column", "D"), ("twice.csv", "column twice", "a")]
    assert scan.rows.columns == ["A", "B", "C", "__malformed", "__filename", "__file_path"]


def test_names_of_a_header():
    assert names_of('﻿A,"b, c",D \r\n') == ["A", "b, c", "D"]
    assert misfits(["a", "X", "A"], SCHEMA) == [("unknown column", "X"), ("column twice", "A")]


def events_csv(folder, name, names, rows):
    lines = [",".join(names)] + [",".join((r.get(n.lower()) or "") for n in names) for r in rows]
    write(folder, name, "\n".join(lines) + "\n")


@pytest.fixture()
def mixed_landing(tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    events_csv(landing, "plain.csv", HEADER_NAMES, [event_row(1)])
    events_csv(landing, "moved.csv.gz", HEADER_NAMES[::-1], [event_row(2)])
    events_csv(landing, "fewer.csv", [n for n in HEADER_NAMES if n != "MAGNITUDE"], [event_row(3)])
    events_csv(landing, "more.csv", [*HEADER_NAMES, "EXTRA"], [event_row(4)])
    return landing


def layout(tmp_dir):
    db = "raw_" + uuid.uuid4().hex[:8]
    return Layout(raw_table=f"{db}.events", log_table=f"{db}.log", clean_path=os.path.join(tmp_dir, "clean"),
                  results_table=f"{db}.results", n_buckets=2)


def check_loaded(spark, own):
    for name in (own.raw_table, own.log_table):
        spark.catalog.refreshTable(name)
    raw = {r["event_id"]: r for r in spark.table(own.raw_table).collect()}
    assert set(raw) == {10001, 10002, 10003}
    assert raw[10003]["magnitude"] is None and raw[10002]["magnitude"] == 2 and raw[10002]["state"] == "OKLAHOMA"
    assert {r["__filename"] for r in spark.table(own.log_table).collect()} == {"plain.csv", "moved.csv.gz", "fewer.csv"}


def test_ingest_refuses_only_the_file_that_does_not_fit(spark, tmp_dir, mixed_landing):
    own = layout(tmp_dir)
    with pytest.raises(dq.QualityGateError, match="unknown column.*EXTRA"):
        ingest_directory(spark, mixed_landing, own)
    check_loaded(spark, own)
    failed = spark.table(own.results_table).where("NOT success").collect()
    assert [(r["rule"], r["column_name"], r["unexpected_count"]) for r in failed] == [("header: unknown column", "EXTRA", 1)]


def test_stream_reads_by_header(spark, tmp_dir, mixed_landing):
    own = layout(tmp_dir)
    own.gate = False
    query = start_ingest(spark, mixed_landing, own, checkpoint=os.path.join(tmp_dir, "ckpt"))
    query.awaitTermination(300)
    check_loaded(spark, own)
