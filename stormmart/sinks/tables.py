"""Materializations of the layers.

* raw table and load log: partitioned by the load key of the file, written by
  dynamic overwrite, so loading a file again (at-least-once ``foreachBatch``, a
  rerun with other files beside it) replaces its partition instead of
  appending twice;
* load times are column defaults of the catalog: an insert that does not name
  them gets the time of the insert;
* clean table: upsert by key, see ``sinks.upsert``;
* views and full-refresh tables for staging and marts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stormmart.schemas import (
    DATE_LOADED,
    FILENAME,
    LOG_FILENAME_LENGTH,
    ROW_HASH,
    log_schema,
    raw_table_schema,
    text_length_limits,
)
from stormmart.session import settings

BATCH = "__batch"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


class SchemaDriftError(ValueError):
    """The incoming rows do not have the stored table's columns and types."""


def check_schema(df: DataFrame, expected: StructType, ignore: Sequence[str] = ()) -> None:
    """Fail (before any write) when columns were added, removed or retyped."""
    def shape(schema: StructType) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() for f in schema.fields if f.name not in ignore}
    got, want = shape(df.schema), shape(expected)
    if got != want:
        added = sorted(set(got) - set(want))
        removed = sorted(set(want) - set(got))
        retyped = sorted(k for k in set(got) & set(want) if got[k] != want[k])
        raise SchemaDriftError(f"schema change: added={added} removed={removed} retyped={retyped}")


def _ddl(schema: StructType, defaults: dict[str, str], lengths: dict[str, int]) -> str:
    def column(f: StructField) -> str:
        kind = f"VARCHAR({lengths[f.name]})" if f.name in lengths else f.dataType.simpleString()
        default = f" DEFAULT {defaults[f.name]}" if f.name in defaults else ""
        return f"`{f.name}` {kind}{default}"
    return ", ".join(column(f) for f in schema.fields)


def ensure_table(spark: SparkSession, name: str, schema: StructType, partition_cols: Sequence[str] = (),
                 defaults: dict[str, str] | None = None, lengths: dict[str, int] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet`` (database created too).

    ``defaults``: SQL expressions that the catalog puts into columns an insert
    does not name. ``lengths``: texts that are ``VARCHAR(n)`` in the table; Spark
    itself refuses to write a longer one (``route_lengths`` parts them before)."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name.split('.')[0]}`")
    part = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema, defaults or {}, lengths or {})}) USING parquet{part}")


NOW = "current_timestamp()"


def ensure_raw_tables(spark: SparkSession, raw: str, log: str) -> None:
    """Raw table (54 columns + batch partition) and load log (+ batch partition);
    the catalog sets their load times and holds the lengths of their texts."""
    batch = StructType([StructField(BATCH, StringType())])
    ensure_table(spark, raw, StructType(raw_table_schema().fields + batch.fields), [BATCH],
                 {DATE_LOADED: NOW}, text_length_limits())
    ensure_table(spark, log, StructType(log_schema().fields + batch.fields), [BATCH],
                 {"date_loaded": NOW}, {FILENAME: LOG_FILENAME_LENGTH})


def insert_named(df: DataFrame, table: str, overwrite_partitions: bool = False) -> None:
    """Insert the columns that ``df`` has; the table's other columns take their
    default. With ``overwrite_partitions`` the partitions that occur in ``df``
    are replaced."""
    spark = df.sparkSession
    names = [f.name for f in spark.table(table).schema.fields if f.name in df.columns]
    listed = ", ".join(f"`{n}`" for n in names)
    # The insert of a catalog table takes the mode from the session only.
    with settings(spark, {OVERWRITE_MODE: "dynamic"}):
        how = "OVERWRITE" if overwrite_partitions else "INTO"
        spark.sql(f"INSERT {how} {table} ({listed}) SELECT {listed} FROM {{rows}}", rows=df)


def route_lengths(df: DataFrame, limits: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """The rows whose texts fit their columns, and one row for each text that does
    not: the row's other columns as they are, with the column's name, its limit
    and the length found."""
    limits = {c: n for c, n in limits.items() if c in df.columns}
    over = [F.when(F.length(c) > n, F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("limit_length"),
                                             F.length(c).alias("found_length"))) for c, n in limits.items()]
    if not over:
        return df, df.limit(0).select("*", F.lit("").alias("column_name"), F.lit(0).alias("limit_length"),
                                      F.lit(0).alias("found_length"))
    too_long = F.filter(F.array(*over), lambda x: x.isNotNull())
    rejected = df.where(F.size(too_long) > 0).select("*", F.inline(too_long))
    return df.where(F.size(too_long) == 0), rejected


def write_files(df: DataFrame, table: str) -> None:
    """Write rows into the partitions of their files (``__batch`` = load key).

    A dynamic overwrite replaces just the partitions that occur in ``df``, so
    loading a file again replaces what an earlier attempt wrote of it.
    """
    insert_named(df, table, overwrite_partitions=True)


def read_raw(spark: SparkSession, table: str) -> DataFrame:
    """The raw table as the models see it (without the batch partition column)."""
    return spark.table(table).drop(BATCH)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """View materialization: the plan is inlined into every reader."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize_table(df: DataFrame, name: str) -> None:
    """Full-refresh table."""
    if "." in name:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{name.split('.')[0]}`")
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def save_results(results: DataFrame, table: str, batch: str | None = None) -> None:
    """Append quality results with their check time (validation store)."""
    out = results.withColumn("checked_at", F.current_timestamp()) \
        .withColumn("batch", F.lit(batch).cast("string"))
    if "." in table:
        results.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{table.split('.')[0]}`")
    out.write.mode("append").format("parquet").saveAsTable(table)


def save_rejects(rejected: DataFrame, table: str, batch: str | None = None) -> None:
    """Append texts that were too long: their file, row hash, column and lengths."""
    kept = [c for c in (FILENAME, ROW_HASH) if c in rejected.columns]
    if "." in table:
        rejected.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{table.split('.')[0]}`")
    (rejected.select(*kept, "column_name", "limit_length", "found_length")
     .withColumn("rejected_at", F.current_timestamp()).withColumn("batch", F.lit(batch).cast("string"))
     .write.mode("append").format("parquet").saveAsTable(table))


def _file_system(spark: SparkSession, path: str) -> tuple:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, place = _file_system(spark, path)
    return fs.exists(place)


def has_files(spark: SparkSession, path: str) -> bool:
    """The folder has files or folders of its own, not only those of a writer."""
    fs, place = _file_system(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(place)] if fs.exists(place) else []
    return any("=" in n or not n.startswith(("_", ".")) for n in names)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, place = _file_system(spark, path)
    fs.delete(place, True)
