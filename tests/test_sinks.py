import os

import pytest
from pyspark.sql import functions as F

from stormmart.sinks import upsert
from stormmart.sinks.tables import SchemaDriftError, ensure_table, insert_named, route_lengths
from stormmart.sinks.upsert import merge_sql, read_upsert_table, upsert_exists, upsert_table


def _parts(path):
    """Data files by partition folder."""
    return {os.path.relpath(d, path): {f for f in fs if f.endswith(".parquet")}
            for d, _, fs in os.walk(os.path.join(path, "data")) if any(f.endswith(".parquet") for f in fs)}


def _left(path):
    return sorted(n for n in os.listdir(path) if n != "data")


def test_upsert_replaces_adds_and_replays(spark, tmp_dir):
    path = os.path.join(tmp_dir, "clean")
    first = spark.createDataFrame([(i, "v0") for i in range(1000)], "k long, v string")
    assert not upsert_exists(spark, path) and upsert_table(spark, first, path, "k", n_buckets=8) == 0
    batch = spark.createDataFrame([(3, "v1"), (7, "v1"), (5000, "v1")], "k long, v string")
    assert 1 <= upsert_table(spark, batch, path, "k", n_buckets=8) <= 2
    for _ in range(2):
        rows = read_upsert_table(spark, path).collect()
        found = {r.k: r.v for r in rows}
        assert len(rows) == len(found) == 1001 and found[3] == found[7] == found[5000] == "v1" and found[4] == "v0"
        upsert_table(spark, batch, path, "k", n_buckets=8)          # replay: no change
    assert _left(path) == [] and read_upsert_table(spark, path).columns == ["k", "v"]


def test_upsert_rejects_schema_change(spark, tmp_dir):
    path = os.path.join(tmp_dir, "clean")
    upsert_table(spark, spark.createDataFrame([(1, "a")], "k long, v string"), path, "k", 4)
    with pytest.raises(SchemaDriftError):
        upsert_table(spark, spark.createDataFrame([(1, "a", 1)], "k long, v string, extra int"), path, "k", 4)
    assert read_upsert_table(spark, path).count() == 1


def test_only_partitions_with_replaced_keys_are_rewritten(spark, tmp_dir):
    path = os.path.join(tmp_dir, "clean")
    rows = spark.range(0, 3000, 1, 8).selectExpr("id AS k", "CAST(1950 + id % 3 AS INT) AS year", "'v0' AS v")
    upsert_table(spark, rows, path, "k", 4, ["year"])
    before = _parts(path)
    assert len(before) == 12 and sum(map(len, before.values())) <= 24   # few files for each partition
    batch = spark.createDataFrame([(0, 1950, "v1"), (9000, 1950, "new")], "k long, year int, v string")
    assert upsert_table(spark, batch, path, "k", 4, ["year"]) == 1
    after = _parts(path)
    rewritten = [p for p in before if not before[p] <= after[p]]
    assert len(rewritten) == 1 and "__group=g1950" in rewritten[0]
    assert all(after[p] == before[p] for p in before if "__group=g1950" not in p)
    # New keys only add files.
    upsert_table(spark, spark.createDataFrame([(9001, 1951, "n")], "k long, year int, v string"), path, "k", 4, ["year"])
    assert all(after[p] <= files for p, files in _parts(path).items() if p in after)
    got = {r.k: (r.year, r.v) for r in read_upsert_table(spark, path).collect()}
    assert len(got) == 3002 and got[0] == (1950, "v1") and got[9000] == (1950, "new") and got[3] == (1950, "v0")


@pytest.mark.parametrize("step", ["staging", "merged", "half_replaced", "append"])
def test_crash_at_every_step_loses_and_doubles_nothing(spark, tmp_dir, monkeypatch, step):
    path = os.path.join(tmp_dir, "clean")
    old = spark.createDataFrame([(i, "v0") for i in range(1000)], "k long, v string")
    new = spark.createDataFrame([(i, "v1") for i in range(990, 1050)], "k long, v string")
    upsert_table(spark, old, path, "k", 16)
    write, replace = upsert._write, upsert._replace

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    def half(s, p):
        """The commit removed a partition's files and ended before the new ones came."""
        folder = next(d for d, _, fs in os.walk(os.path.join(p, "data")) if any(f.endswith(".parquet") for f in fs)
                      and os.path.exists(d.replace("/data/", "/merged/")))
        for f in os.listdir(folder):
            os.remove(os.path.join(folder, f))
        crash()

    with monkeypatch.context() as m:
        if step == "staging":
            m.setattr(upsert, "bucket_of", crash)
        elif step == "merged":
            m.setattr(upsert, "_replace", crash)
        elif step == "half_replaced":
            m.setattr(upsert, "_replace", half)
        else:
            m.setattr(upsert, "_write", lambda rows, p, cols, replace: write(rows, p, cols, replace) if replace else crash())
        with pytest.raises(RuntimeError):
            upsert_table(spark, new, path, "k", 16)
    assert upsert._replace is replace
    seen = {r.k: r.v for r in read_upsert_table(spark, path).collect()}
    assert set(range(1000)) <= set(seen)                     # nothing stored is lost
    upsert_table(spark, new, path, "k", 16)                  # replay
    rows = read_upsert_table(spark, path).collect()
    assert len(rows) == 1050 and {r.k: r.v for r in rows} == {i: "v1" if i >= 990 else "v0" for i in range(1050)}
    assert _left(path) == []


def test_empty_batches_and_null_keys(spark, tmp_dir):
    path = os.path.join(tmp_dir, "clean")
    none = spark.createDataFrame([], "k long, v string")
    upsert_table(spark, none, path, "k", 2)
    assert not upsert_exists(spark, path)
    upsert_table(spark, spark.createDataFrame([(1, "a"), (None, "n")], "k long, v string"), path, "k", 2)
    upsert_table(spark, none, path, "k", 2)
    assert read_upsert_table(spark, path).count() == 2


def test_merge_statement(spark):
    sql = merge_sql("cat.db.t", "s", ["a", "b"])
    spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    assert "t.`a` = s.`a` AND t.`b` = s.`b`" in sql


def test_defaults_and_lengths_are_the_tables(spark):
    from pyspark.errors import PySparkException
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("k BIGINT, v STRING, loaded TIMESTAMP, part STRING")
    spark.sql("DROP TABLE IF EXISTS defaults_t")
    ensure_table(spark, "defaults_t", schema, ["part"], {"loaded": "current_timestamp()", "v": "'?'"}, {"v": 3})
    insert_named(spark.createDataFrame([(1, "p")], "k long, part string"), "defaults_t")
    insert_named(spark.createDataFrame([(2, "é漢😀", "q"), (3, None, "q")], "k long, v string, part string"), "defaults_t")
    rows = {r.k: (r.v, r.loaded is not None) for r in spark.table("defaults_t").collect()}
    assert rows == {1: ("?", True), 2: ("é漢😀", True), 3: (None, True)}
    long = spark.createDataFrame([(4, "four", "q"), (5, "ok", "q")], "k long, v string, part string")
    with pytest.raises(PySparkException, match="(?i)length"):
        insert_named(long, "defaults_t")
    fits, rejected = route_lengths(long, {"v": 3, "absent": 1})
    insert_named(fits, "defaults_t", overwrite_partitions=True)      # replaces part q only
    assert sorted(r.k for r in spark.table("defaults_t").collect()) == [1, 5]
    assert [(r.k, r.column_name, r.limit_length, r.found_length) for r in rejected.collect()] == [(4, "v", 3, 4)]
    assert route_lengths(long, {})[1].count() == 0
    assert rejected.select(F.max("found_length")).first()[0] == 4
