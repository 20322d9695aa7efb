"""Table sources: catalog tables, parquet folders and inline rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, name: str) -> DataFrame:
    """``source(...)`` / ``ref(...)``: a catalog table or view by name."""
    return spark.table(name)


def parquet_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table stored as ``<base>/<name>.parquet`` (the test-data layout)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def inline_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Literal rows (``select 1 as id union all select null``), typed by DDL."""
    return spark.createDataFrame(rows, ddl)
