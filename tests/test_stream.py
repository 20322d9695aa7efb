import os
import uuid

from stormmart.plans.ingest import Layout, archive_loaded
from stormmart.sinks.upsert import read_upsert_table
from stormmart.streaming.landing_stream import start_ingest
from tests.landing_fixture import event_row, write_csv


def test_stream_each_file_once_batches_and_archive(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    archive = os.path.join(tmp_dir, "archive")
    for f in range(3):
        write_csv(os.path.join(landing, f"f{f}.csv.gz"), [event_row(10 * f + i) for i in range(5)],
                  header_every=2)
    db = "raw_" + uuid.uuid4().hex[:8]
    layout = Layout(raw_table=f"{db}.storm_events", log_table=f"{db}.storm_events_log",
                    clean_path=os.path.join(tmp_dir, "clean"), results_table=None, n_buckets=4)
    ckpt = os.path.join(tmp_dir, "ckpt")

    def run():
        q = start_ingest(spark, landing, layout, checkpoint=ckpt, max_files_per_trigger=2,
                         archive_dir=archive, query_name="landing_" + db)
        q.awaitTermination(300)
        return q

    def table(name):
        spark.catalog.refreshTable(name)
        return spark.table(name)

    run()
    log = table(layout.log_table)
    assert log.count() == 3
    assert log.select("batch_id").distinct().count() == 2          # 2 files + 1 file
    assert table(layout.raw_table).count() == 15
    run()                                                            # nothing new
    assert table(layout.raw_table).count() == 15
    write_csv(os.path.join(landing, "f9.csv.gz"), [event_row(99)])
    run()
    assert table(layout.raw_table).count() == 16
    assert read_upsert_table(spark, layout.clean_path).count() == 16
    # The stream archives a batch's files when a later one commits; the rest moves after the run.
    moves = archive_loaded(spark, landing, archive, layout).collect()
    assert all(r["error"] is None for r in moves)
    archived = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".gz")]
    assert sorted(archived) == ["f0.csv.gz", "f1.csv.gz", "f2.csv.gz", "f9.csv.gz"]
    assert [n for n in os.listdir(landing) if n.endswith(".gz")] == []


def test_stream_stops_on_failed_gate_and_writes_nothing(spark, tmp_dir):
    import pytest
    from pyspark.errors import StreamingQueryException

    landing = os.path.join(tmp_dir, "landing")
    write_csv(os.path.join(landing, "bad.csv.gz"), [event_row(1, begin_time=None)])
    db = "raw_" + uuid.uuid4().hex[:8]
    layout = Layout(raw_table=f"{db}.storm_events", log_table=f"{db}.storm_events_log",
                    clean_path=os.path.join(tmp_dir, "clean"), results_table=None, n_buckets=4)
    q = start_ingest(spark, landing, layout, checkpoint=os.path.join(tmp_dir, "ckpt"),
                     query_name="bad_" + db)
    with pytest.raises(StreamingQueryException, match="suite failed"):
        q.awaitTermination(300)
    spark.catalog.refreshTable(layout.raw_table)
    assert spark.table(layout.raw_table).count() == 0
    assert not os.path.exists(layout.clean_path)


def test_continuous_stream_picks_up_files(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    write_csv(os.path.join(landing, "c0.csv.gz"), [event_row(i) for i in range(3)])
    db = "raw_" + uuid.uuid4().hex[:8]
    layout = Layout(raw_table=f"{db}.storm_events", log_table=f"{db}.storm_events_log",
                    clean_path=os.path.join(tmp_dir, "clean"), results_table=None, n_buckets=4)
    q = start_ingest(spark, landing, layout, checkpoint=os.path.join(tmp_dir, "ckpt"),
                     available_now=False, interval="1 second")
    try:
        q.processAllAvailable()
        write_csv(os.path.join(landing, "c1.csv.gz"), [event_row(10)])
        q.processAllAvailable()
    finally:
        q.stop()
    spark.catalog.refreshTable(layout.raw_table)
    assert spark.table(layout.raw_table).count() == 4
    assert read_upsert_table(spark, layout.clean_path).count() == 4
