"""Day-of-week calendar lookup joined onto timestamped rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: day -> (is a weekday, activity).
DAY_ACTIVITIES = [
    ("monday", True, "guitar lessons"),
    ("tuesday", True, "studying"),
    ("wednesday", True, "soccer practice"),
    ("thursday", True, "contributing to Airflow"),
    ("friday", True, "family dinner"),
    ("saturday", False, "going to the beach"),
    ("sunday", False, "sleeping in"),
]
WEEKDAY_GROUP = "weekday_activities"
WEEKEND_GROUP = "weekend_activities"
# --- end of fixed values


def calendar(spark: SparkSession) -> DataFrame:
    """The 7-row calendar table."""
    return spark.createDataFrame(DAY_ACTIVITIES, "day_name string, is_weekday boolean, activity string")


def day_name(ts) -> F.Column:
    return F.lower(F.date_format(F.col(ts) if isinstance(ts, str) else ts, "EEEE"))


def is_weekend(ts) -> F.Column:
    return F.dayofweek(F.col(ts) if isinstance(ts, str) else ts).isin(1, 7)


def enrich_calendar(df: DataFrame, ts_col: str, cal: DataFrame | None = None) -> DataFrame:
    """Adds day_name, is_weekend, is_weekday, activity, task_id and message.

    The calendar has exactly seven rows, so it is broadcast: the join is a
    map-side hash lookup, no shuffle of ``df``.
    """
    cal = calendar(df.sparkSession) if cal is None else cal
    enriched = (
        df.withColumn("day_name", day_name(ts_col))
        .withColumn("is_weekend", is_weekend(ts_col))
        .join(F.broadcast(cal), on="day_name", how="inner")
    )
    activity_id = F.replace(F.col("activity"), F.lit(" "), F.lit("_"))
    group = F.when(F.col("is_weekday"), F.lit(WEEKDAY_GROUP)).otherwise(F.lit(WEEKEND_GROUP))
    return (
        enriched.withColumn("task_id", F.concat(group, F.lit("."), activity_id))
        .withColumn("message", F.concat(F.lit("It's "), F.initcap("day_name"),
                                        F.lit(" and I'm busy with "), F.col("activity"), F.lit(".")))
    )


def branch(enriched_is_weekday: str = "is_weekday") -> F.Column:
    """'weekday' / 'weekend': both branches as one column of a single pass."""
    return F.when(F.col(enriched_is_weekday), F.lit("weekday")).otherwise(F.lit("weekend"))


def weekday_rows(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("is_weekday"))


def weekend_rows(enriched: DataFrame) -> DataFrame:
    return enriched.filter(~F.col("is_weekday"))
