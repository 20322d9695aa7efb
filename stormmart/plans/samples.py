"""The small sample jobs, re-aimed at tables: JSON totals, calendar, union models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormmart.functions.jsontext import json_amounts, map_total, total_line
from stormmart.operators.lookup import enrich_calendar


def order_totals(df: DataFrame, json_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Total of all JSON amounts (per group) and its formatted line.

    Parsing and per-row totals run in the scan tasks; the sum is a partial +
    final aggregate.
    """
    per_row = df.select(*group_cols, map_total(json_amounts(json_col)).alias("__t"))
    return (
        per_row.groupBy(*group_cols)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("__t").alias("total_value"))
        .withColumn("total_line", total_line(F.col("total_value")))
    )


def day_activities(df: DataFrame, ts_col: str) -> DataFrame:
    """Calendar enrichment of every row (day, weekend flag, activity, task)."""
    return enrich_calendar(df, ts_col)


def first_model(ids: DataFrame, inline: DataFrame, col: str = "id") -> DataFrame:
    """Union all of table ids and literal rows (one column ``id``)."""
    return ids.select(F.col(col).cast("int").alias("id")).unionByName(inline)


def second_model(first: DataFrame, value: int = 1) -> DataFrame:
    """``select * from first where id = value``."""
    return first.filter(F.col("id") == value)


def non_null_ids(first: DataFrame) -> DataFrame:
    return first.filter(F.col("id").isNotNull())
