"""Which files are already loaded, and which listed files still need a load."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stormmart.schemas import FILENAME


def loaded_files(log: DataFrame, name_col: str = FILENAME) -> DataFrame:
    """``SELECT DISTINCT __filename FROM log``."""
    return log.select(name_col).distinct()


def missing_files(listing: DataFrame, log: DataFrame, name_col: str = FILENAME) -> DataFrame:
    """Listed entries whose name is not in the log (duplicates of the listing kept).

    A left-anti join; Spark broadcasts the log side only when its measured
    size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles
    otherwise.
    """
    return listing.join(loaded_files(log, name_col), on=name_col, how="left_anti")
