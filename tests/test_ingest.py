import os
import uuid

import pytest
from pyspark.sql import functions as F

from stormmart.operators import quality as dq
from stormmart.plans.ingest import Layout, archive_loaded, ingest_directory, run_clean_model
from stormmart.plans.layers import yearly_damage
from stormmart.sinks.upsert import read_upsert_table
from tests.landing_fixture import event_row, write_csv


def _layout(tmp_dir) -> Layout:
    db = "raw_" + uuid.uuid4().hex[:8]
    return Layout(raw_table=f"{db}.storm_events", log_table=f"{db}.storm_events_log",
                  clean_path=os.path.join(tmp_dir, "clean"), results_table=f"{db}.quality_results",
                  n_buckets=4)


def _moved(spark, landing, archive, layout) -> list[str]:
    rows = archive_loaded(spark, landing, archive, layout).collect()
    assert all(r["error"] is None and os.path.exists(r["target"]) for r in rows)
    return sorted(r["__filename"] for r in rows)


def test_ingest_directory_once_per_file_and_clean_dedupe(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    rows = [event_row(i) for i in range(10)]
    write_csv(os.path.join(landing, "d1950.csv.gz"), rows, header_every=4)
    # a second file repeating three rows of the first: same content hash
    write_csv(os.path.join(landing, "d1950_again.csv.gz"), rows[:3])
    layout = _layout(tmp_dir)
    layout.spread_partitions = 4
    results = ingest_directory(spark, landing, layout)
    assert results and all(r["success"] for r in results)
    raw = spark.table(layout.raw_table)
    assert raw.count() == 13
    assert {r[0] for r in spark.table(layout.log_table).select("__filename").collect()} == \
        {"d1950.csv.gz", "d1950_again.csv.gz"}
    clean = read_upsert_table(spark, layout.clean_path)
    assert clean.count() == 10 and clean.select("__row_hash").distinct().count() == 10
    # second run: nothing new
    assert ingest_directory(spark, landing, layout) == []
    assert spark.table(layout.raw_table).count() == 13
    # a new file is picked up; its repeated row replaces the older clean row
    write_csv(os.path.join(landing, "d1951.csv.gz"), [rows[0], event_row(50)])
    ingest_directory(spark, landing, layout)
    assert spark.table(layout.raw_table).count() == 15
    assert spark.table(layout.log_table).count() == 3
    clean = read_upsert_table(spark, layout.clean_path)
    assert clean.count() == 11
    newest = clean.agg(F.max("__date_loaded")).first()[0]
    r0 = clean.filter(F.col("event_id") == 10000).first()
    assert r0["__date_loaded"] == newest and r0["__filename"] == "d1951.csv.gz"
    mart = {(r.event_year, r.state): r.total_property_damage for r in yearly_damage(clean).collect()}
    assert mart == {("2007", "OKLAHOMA"): 1000.0 * (sum(range(10)) + 50)}
    # archive what is loaded; a file that is not in the log stays
    write_csv(os.path.join(landing, "d1952.csv.gz"), [event_row(60)])
    archive = os.path.join(tmp_dir, "archive")
    assert _moved(spark, landing, archive, layout) == ["d1950.csv.gz", "d1950_again.csv.gz", "d1951.csv.gz"]
    assert sorted(n for n in os.listdir(landing) if not n.startswith(".")) == ["d1952.csv.gz"]


def test_failed_gate_writes_nothing(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    write_csv(os.path.join(landing, "bad.csv.gz"), [event_row(1, state="ATLANTIS")])
    layout = _layout(tmp_dir)
    with pytest.raises(dq.QualityGateError):
        ingest_directory(spark, landing, layout)
    assert spark.table(layout.raw_table).count() == 0
    assert spark.table(layout.log_table).count() == 0
    assert not os.path.exists(layout.clean_path)


def test_rerun_after_crash_before_log_completes_every_layer(spark, tmp_dir, monkeypatch):
    import stormmart.plans.ingest as ingest_mod

    landing = os.path.join(tmp_dir, "landing")
    write_csv(os.path.join(landing, "d1960.csv.gz"), [event_row(i) for i in range(6)])
    layout = _layout(tmp_dir)
    real_write = ingest_mod.write_files

    def crash_on_log(df, table):
        if table == layout.log_table:
            raise RuntimeError("executor lost while writing the log")
        return real_write(df, table)

    monkeypatch.setattr(ingest_mod, "write_files", crash_on_log)
    with pytest.raises(RuntimeError):
        ingest_directory(spark, landing, layout)
    monkeypatch.setattr(ingest_mod, "write_files", real_write)
    assert spark.table(layout.log_table).count() == 0           # not committed
    ingest_directory(spark, landing, layout)                     # rerun of the same file
    assert spark.table(layout.raw_table).count() == 6            # partition replaced, not doubled
    assert spark.table(layout.log_table).count() == 1
    assert read_upsert_table(spark, layout.clean_path).count() == 6
    assert ingest_directory(spark, landing, layout) == []        # now committed


def test_clean_model_run_over_raw_table(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    write_csv(os.path.join(landing, "d1970.csv.gz"), [event_row(i) for i in range(5)] + [event_row(0)])
    layout = _layout(tmp_dir)
    clean_path = layout.clean_path
    layout.clean_path = ""                       # ingest raw only
    ingest_directory(spark, landing, layout)
    layout.clean_path = clean_path
    assert spark.table(layout.raw_table).count() == 6
    run_clean_model(spark, layout)               # first run: all raw rows, one per hash
    assert read_upsert_table(spark, clean_path).count() == 5
    assert run_clean_model(spark, layout) == 0  # nothing newer than the clean table
    assert read_upsert_table(spark, clean_path).count() == 5
    # the SQL models over the same raw table give the same clean rows
    from stormmart.plans.sql_models import clean_sql, create_staging_view
    view = "stg_" + uuid.uuid4().hex[:8]
    create_staging_view(spark, layout.raw_table, view)
    sql_clean = spark.sql(clean_sql(spark, view))
    assert sorted(sql_clean.columns) == sorted(read_upsert_table(spark, clean_path).columns)
    assert sorted(r["__row_hash"] for r in sql_clean.collect()) == \
        sorted(r["__row_hash"] for r in read_upsert_table(spark, clean_path).collect())


def test_jobs_command_line(spark, tmp_dir):
    from stormmart import jobs

    landing = os.path.join(tmp_dir, "landing")
    write_csv(os.path.join(landing, "d1980.csv.gz"), [event_row(i) for i in range(4)])
    db = "raw_" + uuid.uuid4().hex[:8]
    common = ["--raw-table", f"{db}.t", "--log-table", f"{db}.log", "--results-table", f"{db}.res",
              "--buckets", "4"]
    clean_path = os.path.join(tmp_dir, "clean")
    out = jobs.run(["ingest", "--landing", landing, "--clean", clean_path, *common], spark)
    assert out["results"] and all(r["success"] for r in out["results"])
    jobs.run(["mart", "--clean", clean_path, "--mart", f"{db}.mart", *common], spark)
    assert spark.table(f"{db}.mart").first()["total_property_damage"] == 6000.0
    out = jobs.run(["archive", "--landing", landing, "--archive", os.path.join(tmp_dir, "arch"), *common], spark)
    assert out == {"archived": 1, "not_archived": {}}


def test_missing_landing_folder_loads_nothing(spark, tmp_dir):
    assert ingest_directory(spark, os.path.join(tmp_dir, "absent"), _layout(tmp_dir)) == []


def test_report_only_suite_is_observed_during_the_write(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    write_csv(os.path.join(landing, "d1990.csv.gz"),
              [event_row(i) for i in range(4)] + [event_row(9, state="ATLANTIS")])
    layout = _layout(tmp_dir)
    layout.gate = False
    results = ingest_directory(spark, landing, layout)
    by_rule = {(r["rule"], r["column_name"]): r for r in results}
    assert by_rule[(dq.IN_SET, "state")]["unexpected_count"] == 1      # reported, not fatal
    assert all(r["element_count"] == 5 for r in results)
    assert spark.table(layout.raw_table).count() == 5
    assert spark.table(layout.results_table).count() == len(results)
    assert read_upsert_table(spark, layout.clean_path).count() == 5


def test_gated_batch_without_persist(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    write_csv(os.path.join(landing, "d2000.csv.gz"), [event_row(i) for i in range(3)])
    layout = _layout(tmp_dir)
    layout.persist_batch = False
    assert all(r["success"] for r in ingest_directory(spark, landing, layout))
    assert spark.table(layout.raw_table).count() == 3
    assert read_upsert_table(spark, layout.clean_path).count() == 3


def test_crash_then_new_file_then_rerun_loads_each_row_once(spark, tmp_dir, monkeypatch):
    import stormmart.plans.ingest as ingest_mod

    landing = os.path.join(tmp_dir, "landing")
    write_csv(os.path.join(landing, "a.csv.gz"), [event_row(i) for i in range(4)])
    layout = _layout(tmp_dir)

    def crash(*args, **kwargs):
        raise RuntimeError("lost after the raw write")

    with monkeypatch.context() as m:
        m.setattr(ingest_mod, "upsert_table", crash)
        with pytest.raises(RuntimeError):
            ingest_directory(spark, landing, layout)
    write_csv(os.path.join(landing, "b.csv.gz"), [event_row(10 + i) for i in range(2)])
    ingest_directory(spark, landing, layout)
    assert spark.table(layout.raw_table).count() == 6
    assert spark.table(layout.log_table).count() == 2
    assert read_upsert_table(spark, layout.clean_path).count() == 6


def test_files_without_rows_are_logged_and_archived_once(spark, tmp_dir):
    landing, archive = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "archive")
    write_csv(os.path.join(landing, "empty.csv.gz"), [])
    layout = _layout(tmp_dir)
    ingest_directory(spark, landing, layout)
    assert [r["__filename"] for r in spark.table(layout.log_table).collect()] == ["empty.csv.gz"]
    assert _moved(spark, landing, archive, layout) == ["empty.csv.gz"]
    assert ingest_directory(spark, landing, layout) == [] and spark.table(layout.log_table).count() == 1


def test_one_name_in_two_folders_is_two_files(spark, tmp_dir):
    layout = _layout(tmp_dir)
    for i, folder in enumerate(("one", "two")):
        landing = os.path.join(tmp_dir, folder)
        write_csv(os.path.join(landing, "same.csv.gz"), [event_row(i)])
        ingest_directory(spark, landing, layout)
    assert spark.table(layout.raw_table).count() == 2
    archive = os.path.join(tmp_dir, "archive")
    assert _moved(spark, os.path.join(tmp_dir, "one"), archive, layout) == ["same.csv.gz"]
    assert _moved(spark, os.path.join(tmp_dir, "two"), archive, layout) == ["same.csv.gz"]
    assert len([n for n in os.listdir(archive) if not n.startswith(".")]) == 2


def test_files_that_can_not_be_moved_are_rows(spark, tmp_dir):
    landing, blocked = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "blocked")
    write_csv(os.path.join(landing, "a.csv.gz"), [event_row(1)])
    layout = _layout(tmp_dir)
    ingest_directory(spark, landing, layout)
    with open(blocked, "w") as fh:      # the archive's place is a file
        fh.write("x")
    moves = archive_loaded(spark, landing, blocked, layout).collect()
    assert [(r["__filename"], r["target"]) for r in moves] == [("a.csv.gz", None)] and moves[0]["error"]
    assert os.path.exists(os.path.join(landing, "a.csv.gz"))


@pytest.mark.skip(reason="open defect: does not end (report-only ingest with too long texts), see README")
def test_too_long_texts_are_rejected_without_gate(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    write_csv(os.path.join(landing, "d.csv.gz"), [event_row(1), event_row(2, cz_type="ZZ", wfo="W" * 101)])
    layout = _layout(tmp_dir)
    layout.gate, layout.reject_table = False, layout.raw_table + "_rejects"
    results = ingest_directory(spark, landing, layout)
    assert sorted(r["column_name"] for r in results if not r["success"]) == ["cz_type", "wfo"]
    assert [r["event_id"] for r in spark.table(layout.raw_table).collect()] == [10001]
    found = spark.table(layout.reject_table).collect()
    assert sorted((r["column_name"], r["limit_length"], r["found_length"]) for r in found) == [("cz_type", 1, 2), ("wfo", 100, 101)]
    assert all(r["__filename"] == "d.csv.gz" for r in found)


def test_a_bad_file_does_not_block_the_others(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    write_csv(os.path.join(landing, "good.csv.gz"), [event_row(i) for i in range(3)])
    write_csv(os.path.join(landing, "bad.csv.gz"), [event_row(9, state="ATLANTIS"), event_row(8)])
    write_csv(os.path.join(landing, "uncast.csv.gz"), [event_row(7, injuries_direct="12abc")])
    layout = _layout(tmp_dir)
    with pytest.raises(dq.QualityGateError, match="__not_cast"):
        ingest_directory(spark, landing, layout)
    assert spark.table(layout.raw_table).count() == 3
    assert [r["__filename"] for r in spark.table(layout.log_table).collect()] == ["good.csv.gz"]
    assert read_upsert_table(spark, layout.clean_path).count() == 3


def test_uniqueness_rules_run_without_gate(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    write_csv(os.path.join(landing, "d.csv.gz"), [event_row(1), event_row(1)])
    layout = _layout(tmp_dir)
    layout.gate = False
    results = ingest_directory(spark, landing, layout, dq.Suite("s", [dq.unique("event_id")]))
    assert [(r["rule"], r["unexpected_count"], r["success"]) for r in results] == [(dq.UNIQUE, 1, False)]
    assert spark.table(layout.raw_table).count() == 2


def test_lines_and_headers_that_do_not_fit(spark, tmp_dir):
    from stormmart.schemas import HEADER_NAMES
    from stormmart.sources.landing import read_landing

    path = write_csv(os.path.join(tmp_dir, "odd", "lines.csv"), [event_row(1), event_row(2)], gz=False)
    with open(path, "a", encoding="utf-8") as fh:
        fh.write("200707,1\n" + ",".join("x" * 60) + "\n")
    rows = read_landing(spark, os.path.join(tmp_dir, "odd")).collect()
    assert [r["__malformed"] is None for r in rows] == [True, True, False, False]
    layout = _layout(tmp_dir)
    with pytest.raises(dq.QualityGateError, match="__malformed"):
        ingest_directory(spark, os.path.join(tmp_dir, "odd"), layout)
    # The scan with a fixed header (no names looked up) fails on another one.
    os.makedirs(os.path.join(tmp_dir, "moved"))
    with open(os.path.join(tmp_dir, "moved", "f.csv"), "w", encoding="utf-8") as fh:
        fh.write(",".join([HEADER_NAMES[1], HEADER_NAMES[0], *HEADER_NAMES[2:]]) + "\n" + ",".join("1" for _ in HEADER_NAMES) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_landing(spark, os.path.join(tmp_dir, "moved")).collect()


def test_model_chain(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    write_csv(os.path.join(landing, "d.csv.gz"), [event_row(i) for i in range(4)] + [event_row(0)])
    layout = _layout(tmp_dir)
    clean_path, layout.clean_path = layout.clean_path, ""
    ingest_directory(spark, landing, layout)
    layout.clean_path = clean_path
    from stormmart.plans.ingest import run_models

    mart = layout.raw_table.split(".")[0] + ".mart"
    out = run_models(spark, layout, mart, "stg_" + uuid.uuid4().hex[:8])
    assert out["tests"] == {"success": True, "evaluated_rules": 2, "successful_rules": 2, "unsuccessful_rules": 0}
    assert spark.table(mart).first()["total_property_damage"] == 6000.0
