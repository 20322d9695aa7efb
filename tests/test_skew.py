"""A key holding a third of all rows: results stay whole and exact."""

from pyspark.sql import functions as F

from stormmart.operators import quality as dq
from stormmart.operators.dedupe import first_per_key, upsert_frames
from stormmart.plans.layers import yearly_damage


def _skewed(spark, n=30000):
    # a third of the rows share key 0 (and a third has a null key)
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id")).cast("long").alias("k"),
        F.col("id").alias("v"))


def test_first_per_key_hot_and_null_keys(spark):
    df = _skewed(spark)
    out = first_per_key(df, "k", ["v"])
    rows = {r.k: r.v for r in out.collect()}
    assert rows[0] == 0 and rows[None] == 1
    assert len(rows) == 2 + 10000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_upsert_frames_with_hot_null_keys(spark):
    df = _skewed(spark)
    batch = spark.createDataFrame([(2, -1), (None, -2)], "k long, v long")
    out = upsert_frames(df, batch, "k")
    assert out.count() == 30000 - 1 + 2            # key 2 replaced, null keys all kept
    assert out.filter(F.col("k").isNull()).count() == 10000 + 1


def test_unique_rule_and_mart_on_hot_group(spark):
    df = _skewed(spark)
    res = dq.run_suite(df, dq.Suite("s", [dq.unique("k")])).first()
    assert res["unexpected_count"] == 1 and res["element_count"] == 30000
    mart_in = df.select(F.lit("TEXAS").alias("state"), F.lit(195004).alias("begin_yearmonth"),
                        F.concat(F.col("v").cast("string"), F.lit("K")).alias("damage_property"))
    total = yearly_damage(mart_in).first()["total_property_damage"]
    assert total == 1000.0 * sum(range(30000))
