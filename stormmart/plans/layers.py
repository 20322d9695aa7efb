"""The three model layers over the raw table: staging view, clean table, mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormmart.functions.amounts import amount_number, amount_unit, parse_amount
from stormmart.operators.dedupe import above_max, distinct_rows, first_per_key
from stormmart.schemas import DATE_LOADED, FILENAME, ROW_HASH


def stage(raw: DataFrame) -> DataFrame:
    """Staging view: ``SELECT DISTINCT *`` of the raw table.

    The load time is part of the row, so a second load of the same file is not
    collapsed here; the clean layer does that.
    """
    return distinct_rows(raw)


def latest_batch(staged: DataFrame, clean_target: DataFrame | None, eager: bool = True) -> DataFrame:
    """Staged rows loaded after the newest row of the clean table (all if empty)."""
    return above_max(staged, clean_target, DATE_LOADED, eager)


def dedupe(rows: DataFrame, key: str = ROW_HASH) -> DataFrame:
    """One row per key: the earliest load, then file name, then content.

    Rows with the same content hash have the same content, so for that key
    (load time, file name) already decides; other keys also sort on content.
    """
    ties = [] if key == ROW_HASH else None
    return first_per_key(rows, key, [DATE_LOADED, FILENAME], ties)


def clean(rows: DataFrame, clean_target: DataFrame | None = None,
          key: str = ROW_HASH, eager: bool = True) -> DataFrame:
    """New clean rows for this run: incremental filter, then first row per key.

    ``rows`` may be the raw table or the staging view: the staging DISTINCT
    cannot change which row is first per key, so it is not run again here
    (one shuffle instead of two). Merging the result into the stored clean
    table (newer load replaces an older row with the same key) is
    ``sinks.upsert.upsert_table``.
    """
    return dedupe(latest_batch(rows, clean_target, eager), key)


def damage_columns(df: DataFrame, text_col: str = "damage_property") -> DataFrame:
    """Adds event_year, damage_number, damage_unit and property_damage."""
    text = F.col(text_col)
    return (
        df.withColumn("event_year", F.substring(F.col("begin_yearmonth").cast("string"), 1, 4))
        .withColumn("damage_number", amount_number(text))
        .withColumn("damage_unit", amount_unit(text))
        .withColumn(
            "property_damage",
            parse_amount(text, F.col("damage_number"), F.col("damage_unit")),
        )
    )


# Amount text columns of the raw table and the mart column of their totals.
DAMAGE_TOTALS = {"damage_property": "total_property_damage", "damage_crops": "total_crop_damage"}


def yearly_totals(clean_rows: DataFrame, totals: dict[str, str] | None = None) -> DataFrame:
    """Mart with one total per amount column (property and crop damage by default).

    All columns are parsed in the same projection and summed in one aggregate.
    """
    totals = totals or DAMAGE_TOTALS
    year = F.substring(F.col("begin_yearmonth").cast("string"), 1, 4).alias("event_year")
    parsed = clean_rows.select(year, "state", *[parse_amount(F.col(c)).alias(c) for c in totals])
    return parsed.groupBy("event_year", "state").agg(
        *[F.sum(c).alias(out) for c, out in totals.items()])


def yearly_damage(clean_rows: DataFrame, text_col: str = "damage_property") -> DataFrame:
    """Mart: total property damage per (event_year, state).

    Only three columns reach the scan; the group-by runs as partial + final hash
    aggregate, so a hot (year, state) only adds one row per map task.
    """
    return (
        clean_rows.select("state", "begin_yearmonth", text_col)
        .transform(lambda d: damage_columns(d, text_col))
        .groupBy("event_year", "state")
        .agg(F.sum("property_damage").alias("total_property_damage"))
    )
