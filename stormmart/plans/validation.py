"""Validation runs: suite + data + stored result, and their comparison run by run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stormmart.operators import quality as dq
from stormmart.sinks.tables import save_results


def validate_and_store(df: DataFrame, suite: dq.Suite, results_table: str,
                       batch: str | None = None, fail: bool = True) -> list[dict]:
    """Run the suite in one pass, append the results, then gate (optional).

    Results are stored even when the gate fails, so a failed batch leaves its
    reason in the store.
    """
    results = dq.run_suite(df, suite)
    rows = [r.asDict() for r in results.collect()]
    save_results(df.sparkSession.createDataFrame(rows, results.schema), results_table, batch)
    if fail:
        dq.gate(df.sparkSession.createDataFrame(rows, results.schema))
    return rows


def write_and_store(df: DataFrame, suite: dq.Suite, path: str, results_table: str, batch: str) -> list[dict]:
    """Write ``df`` and store what its suite finds. Row-level rules are counted by
    the write itself (observed metrics: the rows are read once); rules that need a
    grouping run on the written rows."""
    spark = df.sparkSession
    observed, obs = dq.observe_suite(df, suite)
    observed.write.parquet(path)
    rows = dq.observation_results(suite, obs)
    grouped = dq.key_rules(suite)
    if grouped.rules:
        rows += [r.asDict() for r in dq.run_suite(spark.read.schema(df.schema).parquet(path), grouped).collect()]
    save_results(spark.createDataFrame(rows, dq.QUALITY_RESULT_SCHEMA), results_table, batch)
    return rows


def compare_runs(spark: SparkSession, results_table: str) -> DataFrame:
    """The stored results, each beside the run before it of the same rule: how many
    more rows break the rule, and whether its success has changed."""
    rule = Window.partitionBy("suite", "rule", "column_name").orderBy("checked_at", "batch")
    before = F.lag("unexpected_count").over(rule)
    return spark.table(results_table).select(
        "suite", "rule", "column_name", "batch", F.row_number().over(rule).alias("run"),
        "element_count", "unexpected_count", "success", before.alias("unexpected_before"),
        (F.col("unexpected_count") - before).alias("change"),
        (F.lag("success").over(rule) != F.col("success")).alias("turned"))
