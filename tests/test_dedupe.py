from pyspark.sql import functions as F

from stormmart.operators.dedupe import above_max, first_per_key, upsert_frames


def test_first_per_key_uses_order_then_ties(spark):
    df = spark.createDataFrame(
        [("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a"), ("j", 5, "q")], "key string, t int, v string")
    out = {r.key: (r.t, r.v) for r in first_per_key(df, "key", ["t"], ["v"]).collect()}
    assert out == {"k": (1, "a"), "j": (5, "q")}


def test_first_per_key_plans_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    plan = first_per_key(df, "k", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_above_max_and_empty_target(spark):
    batch = spark.createDataFrame([(1,), (5,), (None,)], "t int")
    target = spark.createDataFrame([(3,)], "t int")
    assert sorted(r.t for r in above_max(batch, target, "t").collect()) == [5]
    empty = target.filter("t > 100")
    assert above_max(batch, empty, "t").count() == 3
    assert above_max(batch, None, "t").count() == 3
    assert sorted(r.t for r in above_max(batch, target, "t", eager=False).collect()) == [5]
    assert above_max(batch, empty, "t", eager=False).count() == 3


def test_above_max_literal_reaches_parquet(spark, tmp_dir):
    spark.range(100).selectExpr("id as t").write.parquet(f"{tmp_dir}/b")
    batch = spark.read.parquet(f"{tmp_dir}/b")
    target = spark.createDataFrame([(90,)], "t long")
    plan = above_max(batch, target, "t")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(t,90)" in plan


def test_upsert_frames_replaces_and_keeps_null_keys(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (None, "nk")], "k int, v string")
    batch = spark.createDataFrame([(2, "new"), (3, "new"), (None, "nk2")], "k int, v string")
    out = sorted((r.k if r.k is not None else -1, r.v) for r in upsert_frames(target, batch, "k").collect())
    assert out == [(-1, "nk"), (-1, "nk2"), (1, "old"), (2, "new"), (3, "new")]
