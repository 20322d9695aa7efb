import json

import pytest

from stormmart.operators import quality as dq


@pytest.fixture()
def rows(spark):
    data = [(1, "OKLAHOMA", 5, "ab"), (2, "Kentucky", None, "abc"), (2, "ATLANTIS", 40, None),
            (None, None, 12, "a")]
    return spark.createDataFrame(data, "id int, state string, n int, s string")


def _by_rule(results):
    return {(r["rule"], r["column_name"]): r for r in results.collect()}


def test_suite_runs_in_one_pass_and_counts(spark, rows):
    suite = dq.Suite("s", [
        dq.not_null("state"), dq.be_null("s"), dq.in_set("state", dq.STATE_NAMES, ignore_case=True),
        dq.between("n", 1, 31), dq.length_between("s", None, 2), dq.unique("id"),
        dq.unique("id", "state"),
    ])
    res = _by_rule(dq.run_suite(rows, suite))
    assert res[(dq.NOT_NULL, "state")]["unexpected_count"] == 1
    assert res[(dq.BE_NULL, "s")]["unexpected_count"] == 3
    assert res[(dq.IN_SET, "state")]["unexpected_count"] == 1    # ATLANTIS; null ignored
    assert res[(dq.BETWEEN, "n")]["unexpected_count"] == 1       # 40
    assert res[(dq.LENGTH_BETWEEN, "s")]["unexpected_count"] == 1
    assert res[(dq.UNIQUE, "id")]["unexpected_count"] == 1       # id 2 twice, null left out
    assert res[(dq.COMPOUND_UNIQUE, "id,state")]["unexpected_count"] == 0
    assert all(r["element_count"] == 4 for r in res.values())


def test_row_rules_are_one_aggregate(spark, rows):
    suite = dq.Suite("s", [dq.not_null("state"), dq.between("n", 0, 10)])
    plan = dq.run_suite(rows, suite)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") <= 2  # partial + final of a single agg


def test_gate_raises_and_passes(spark, rows):
    with pytest.raises(dq.QualityGateError):
        dq.validate(rows, dq.Suite("s", [dq.not_null("id")]))
    passed = dq.validate(rows, dq.Suite("s", [dq.between("id", 0, 5), dq.between("n", 1, 40)]))
    assert [r["success"] for r in passed] == [True, True]


def test_suite_json_round_trip(tmp_dir):
    suite = dq.source_suite()
    path = f"{tmp_dir}/suite.json"
    suite.save(path)
    back = dq.Suite.load(path)
    assert back.name == suite.name and [r.kind for r in back.rules] == [r.kind for r in suite.rules]
    doc = {"expectation_suite_name": "x", "expectations": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "BEGIN_TIME"}},
        {"expectation_type": "unique", "kwargs": {"column": "k"}}]}
    parsed = dq.Suite.from_json(json.dumps(doc))
    assert parsed.rules[0] == dq.not_null("BEGIN_TIME") and parsed.rules[1].kind == dq.UNIQUE


def test_observed_values_and_json(spark, rows):
    obs = {r["state"]: r["count"] for r in dq.observed_values(rows, "state").collect()}
    assert obs["OKLAHOMA"] == 1 and obs[None] == 1
    js = dq.results_json(dq.run_suite(rows, dq.Suite("s", [dq.not_null("id")]))).first()[0]
    assert json.loads(js)["unexpected_count"] == 1


def test_observed_suite_equals_one_pass_suite(spark, rows):
    suite = dq.Suite("s", [dq.not_null("state"), dq.between("n", 1, 31), dq.unique("id")])
    observed, obs = dq.observe_suite(rows, suite)
    observed.write.format("noop").mode("overwrite").save()
    got = {(r["rule"], r["column_name"]): r for r in dq.observation_results(suite, obs)}
    want = {(r["rule"], r["column_name"]): r.asDict() for r in dq.run_suite(rows, suite).collect()
            if r["rule"] != dq.UNIQUE}
    assert got == want
