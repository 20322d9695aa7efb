import datetime
from types import SimpleNamespace

import pytest

from stormmart.operators.dedupe import above_max
from stormmart.operators import quality as dq
from stormmart.session import ensure_checkpoint_dir


def _session(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: folder, set=lambda key, value: None)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_cluster_without_shared_folder_is_refused():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(_session(master))
        assert ensure_checkpoint_dir(_session(master, "hdfs:///shared")) == "hdfs:///shared"
    assert ensure_checkpoint_dir(_session("local[4]"), "/tmp/x") == "/tmp/x"


@pytest.mark.parametrize("eager", [True, False])
def test_newest_row_in_the_repeated_hour_of_a_time_zone(spark, eager):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        at = [datetime.datetime(2024, 11, 3, h, 30, tzinfo=datetime.timezone.utc) for h in (5, 6, 7)]
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(at)], "id int, t timestamp")
        got = above_max(rows, rows.where("id < 2"), "t", eager)
        assert [r["id"] for r in got.collect()] == [2]
        assert above_max(rows, rows.where("id < 0"), "t", eager).count() == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_suites_refuse_what_they_would_ignore():
    for kind, kwargs in ((dq.NOT_NULL, {"typo": 1}), (dq.UNIQUE, {"mostly": 0.5}), (dq.NOT_NULL, {"mostly": 0}),
                         ("expect_something", {})):
        with pytest.raises(ValueError):
            dq.Rule(kind, "c", kwargs)
    text = '{"expectations": [{"expectation_type": "not_null", "kwargs": {"column": "c", "nosuch": true}}]}'
    with pytest.raises(ValueError, match="nosuch"):
        dq.Suite.from_json(text)


def test_mostly_counts_the_values_of_a_rule(spark):
    rows = spark.createDataFrame([(1,), (5,), (9,), (None,)], "n int")
    suite = dq.Suite("s", [dq.Rule(dq.BETWEEN, "n", {"max_value": 6, "mostly": 0.6}),
                           dq.Rule(dq.BETWEEN, "n", {"max_value": 6, "mostly": 0.7}),
                           dq.Rule(dq.NOT_NULL, "n", {"mostly": 0.75})])
    assert [r["success"] for r in dq.run_suite(rows, suite).collect()] == [True, False, True]
    observed, obs = dq.observe_suite(rows, suite)
    observed.collect()
    assert [r["success"] for r in dq.observation_results(suite, obs)] == [True, False, True]
    assert dq.run_summary(dq.run_suite(rows, suite).collect()) == {
        "success": False, "evaluated_rules": 3, "successful_rules": 2, "unsuccessful_rules": 1}
