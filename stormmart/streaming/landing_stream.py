"""Landing folder -> raw/log/clean, as a file stream with ``foreachBatch``.

* each file once: the file source records processed files in the checkpoint;
  a second run with ``availableNow`` reads nothing new (T-01);
* files per micro-batch: ``maxFilesPerTrigger`` (T-02);
* archive: ``cleanSource=archive`` moves a processed file to the archive folder
  once a later batch commits; ``archive_loaded`` moves the last batch's (T-03);
* per batch: read by header name, quality gate, raw append, clean upsert, log,
  all idempotent on replay (file partitions + upsert by key) (T-04..T-06).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stormmart.operators import quality as dq
from stormmart.plans.ingest import Layout, ingest_files, logged
from stormmart.schemas import FILENAME
from stormmart.session import shared_path
from stormmart.sinks.tables import BATCH
from stormmart.sources.catalog import missing_files
from stormmart.sources.landing import CSV_GLOB, file_key


# A gzip file is one task; a micro-batch should fill a cluster.
FILES_PER_TRIGGER = 64


# What the binary file source gives; the content is not selected, so never read.
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def landing_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int = FILES_PER_TRIGGER,
                   archive_dir: str | None = None) -> DataFrame:
    """Stream of the landing folder's files: path, name and load key. Their content
    is read for each batch by its files' own headers."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", CSV_GLOB)
              .option("maxFilesPerTrigger", str(max_files_per_trigger)))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(landing_dir).select(
        "path", F.col("_metadata.file_name").alias(FILENAME), file_key(F.col("_metadata.file_path")).alias(BATCH))


def start_ingest(spark: SparkSession, landing_dir: str, layout: Layout,
                 checkpoint: str | None = None, suite: dq.Suite | None = None,
                 max_files_per_trigger: int = FILES_PER_TRIGGER, archive_dir: str | None = None,
                 available_now: bool = True, query_name: str | None = None,
                 interval: str = "1 minute") -> StreamingQuery:
    """Start the ingest stream.

    ``available_now`` processes what is in the folder and stops (a scheduled
    run); otherwise the stream keeps polling every ``interval``.
    """
    own = "|".join([landing_dir, layout.raw_table, layout.log_table, layout.clean_path])
    checkpoint = checkpoint or shared_path(
        spark, "streams", query_name or "landing-" + hashlib.sha256(own.encode("utf-8")).hexdigest()[:16])
    # Batch ids must differ between streams writing the same tables: the
    # default prefix comes from the stream's own checkpoint location.
    prefix = query_name or "stream-" + hashlib.sha256(checkpoint.encode("utf-8")).hexdigest()[:12]

    def per_batch(batch_df: DataFrame, batch_id: int) -> None:
        session = batch_df.sparkSession
        # A repeated batch may find files that are logged, and archived, already.
        pending = missing_files(batch_df, logged(session, layout), BATCH)
        paths = [r["path"] for r in pending.select("path").toLocalIterator()]
        if paths:
            ingest_files(session, paths, pending, f"{prefix}-{batch_id}", layout, suite)

    writer = (landing_stream(spark, landing_dir, max_files_per_trigger, archive_dir)
              .writeStream.foreachBatch(per_batch)
              .option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
