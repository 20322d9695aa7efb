"""File stream into an upserted table in which the newest row of a key stays.

Each file is read once (the checkpoint has what was read); a stopped stream goes on
where it stood. Rows may come again, late or in a batch that is repeated after a
crash: a stored row is replaced only by one with a later time, so any order of the
files gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stormmart.operators.dedupe import first_per_key
from stormmart.sinks.upsert import read_upsert_table, upsert_exists, upsert_table


def newer_than_stored(batch: DataFrame, stored: DataFrame, keys: Sequence[str], time_column: str) -> DataFrame:
    """Rows of ``batch`` (one for each key) that the table lacks, or has an older row of."""
    times = stored.select(*keys, F.col(time_column).alias("__stored_time"))
    return (batch.join(times, list(keys), "left")
            .where(F.col("__stored_time").isNull() | (F.col(time_column) > F.col("__stored_time")))
            .select(*batch.columns))


def upsert_newest(batch: DataFrame, path: str, keys: Sequence[str], time_column: str, n_buckets: int = 64) -> int:
    """Upsert the newest row of every key, unless the table has a newer one."""
    spark = batch.sparkSession
    newest = first_per_key(batch, keys, [F.desc(time_column)])
    if upsert_exists(spark, path):
        newest = newer_than_stored(newest, read_upsert_table(spark, path), keys, time_column)
    return upsert_table(spark, newest, path, keys, n_buckets)


def start_newest(spark: SparkSession, landing_dir: str, schema: StructType, path: str, keys: Sequence[str],
                 time_column: str, checkpoint: str, max_files_per_trigger: int = 64, n_buckets: int = 64,
                 available_now: bool = True, interval: str = "1 minute") -> StreamingQuery:
    """Start the stream over the parquet files of a folder."""
    rows = (spark.readStream.schema(schema).option("maxFilesPerTrigger", str(max_files_per_trigger))
            .parquet(landing_dir))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        upsert_newest(batch, path, keys, time_column, n_buckets)

    writer = rows.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()
