"""Batch ingestion of landing-zone files: gate -> raw partition -> clean upsert -> log."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormmart.operators import quality as dq
from stormmart.operators.cleaning import prepare_raw
from stormmart.plans.layers import clean, stage, yearly_damage
from stormmart.schemas import DATE_LOADED, FILE_PATH, FILENAME, MALFORMED, NOT_CAST, ROW_HASH, text_length_limits
from stormmart.session import shared_path
from stormmart.sinks.tables import (
    BATCH,
    ensure_raw_tables,
    materialize_table,
    materialize_view,
    path_exists,
    read_raw,
    route_lengths,
    save_rejects,
    save_results,
    write_files,
)
from stormmart.sinks.upsert import read_upsert_table, upsert_exists, upsert_table
from stormmart.sources.catalog import loaded_files, missing_files
from stormmart.sources.headers import read_by_header
from stormmart.sources.landing import file_key, list_landing


@dataclass
class Layout:
    """Where the layers live: catalog tables for raw/log, a folder for clean."""
    raw_table: str = "raw.storm_events"
    log_table: str = "raw.storm_events_log"
    clean_path: str = ""
    results_table: str | None = "raw.quality_results"
    # Texts that were too long for their columns (report-only runs).
    reject_table: str | None = "raw.length_rejects"
    n_buckets: int = 64
    # Content column(s) above the hash buckets of the clean table: event files
    # come per year, so a batch touches one or two years.
    clean_group_cols: tuple[str, ...] = ("year",)
    # Spread a batch's rows over this many tasks after parsing. Compressed or
    # multi-line CSV is one task per file, so a micro-batch of a few big files
    # would otherwise hash, check and write in a few tasks. None: no shuffle.
    spread_partitions: int | None = None
    # False: the suite only reports. Its row-level counts are then observed
    # during the raw write (one pass, no persisted copy) instead of gating it.
    gate: bool = True
    # Persist a gated batch so the gate and the write share one read. For a
    # very large backfill batch, False reads the files twice instead of
    # holding the whole batch in executor memory / disk.
    persist_batch: bool = True


def default_suite() -> dq.Suite:
    """Source rules, the varchar(n) limits of the raw table, and rules that no
    line was malformed and no value lost in its cast."""
    suite = dq.source_suite()
    whole = [dq.be_null(MALFORMED), dq.be_null(NOT_CAST)]
    return dq.Suite(suite.name, suite.rules + dq.length_suite(text_length_limits()).rules + whole)


def model_suite() -> dq.Suite:
    """Tests of the clean model after its run: the row hash is there and unique."""
    return dq.Suite("clean_model", [dq.not_null(ROW_HASH), dq.unique(ROW_HASH)])


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with the load key of their file (by path; by name if there is none)."""
    path = F.col(FILE_PATH) if FILE_PATH in rows.columns else F.col(FILENAME)
    return rows.withColumn(BATCH, file_key(path))


def ingest_batch(spark: SparkSession, landing_rows: DataFrame, batch_id: int | str, layout: Layout,
                 suite: dq.Suite | None = None, files: DataFrame | None = None,
                 misfits: DataFrame | None = None) -> list[dict]:
    """Load one batch of landing rows (all text, with their file).

    Every file has a partition of its own in the raw table and in the log, so a
    rerun with any set of files replaces what an earlier attempt wrote of them.
    Order: gate -> raw partitions -> clean upsert -> log. The log is the commit
    mark of a file: only then every layer has it, and logged files are skipped.

    The gate judges each file by itself: files that break a row rule are left
    out (raw, clean and log), the others are loaded, and then the run fails,
    naming the rules. A broken uniqueness rule stops the whole batch. Without
    gate the suite only reports; its row rules are counted during the raw
    write, its uniqueness rules on the written rows.

    Without gate, texts that are too long for their columns keep their row out
    of the raw table; each such text is a row of the reject table.

    ``files`` (file name and load key of all files of the batch) lets files
    without rows enter the log, too. ``misfits`` (``HeaderScan.refused``) are
    files that could not be read; they fail the gate by their columns. Returns
    the quality results.
    """
    ensure_raw_tables(spark, layout.raw_table, layout.log_table)
    done = spark.table(layout.log_table).select(BATCH).distinct()
    if layout.spread_partitions:
        # Content hash partitioning: deterministic, so a retried task gets
        # the same rows without the sort a round-robin repartition needs.
        landing_rows = landing_rows.repartition(
            layout.spread_partitions, F.xxhash64(*landing_rows.columns))
    # The load time is the raw table's default.
    rows = _keyed(prepare_raw(landing_rows).drop(DATE_LOADED)).join(done, on=BATCH, how="left_anti")
    for c in (MALFORMED, NOT_CAST):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    suite = suite or default_suite()
    keys = dq.key_rules(suite)
    unread = [] if misfits is None else header_results(suite, misfits)
    refused: list[dict] = []
    if layout.gate:
        if layout.persist_batch:
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            results, bad = dq.run_row_rules_by(rows, suite, [FILENAME, BATCH])
            checked = [r.asDict() for r in results.collect()] + unread
            bad = bad.select(BATCH)
            good = rows.join(bad, on=BATCH, how="left_anti")
            if keys.rules:
                checked += dq.gate(dq.run_suite(good, keys))
            refused = [r for r in checked if not r["success"]]
            if files is not None:
                files = files.join(bad, on=BATCH, how="left_anti")
            write_files(good, layout.raw_table)
            loaded = good.select(BATCH, FILENAME).distinct() if files is None else files
            # Which files go on is read again below, from a table that stays.
            loaded = _kept(loaded)
        finally:
            if layout.persist_batch:
                rows.unpersist()
    else:
        observed, obs = dq.observe_suite(rows, suite)
        fits, too_long = route_lengths(observed, text_length_limits())
        write_files(fits, layout.raw_table)
        checked = dq.observation_results(suite, obs) + unread
        over = [r for r in checked if r["rule"] == dq.LENGTH_BETWEEN and not r["success"]]
        if over and layout.reject_table:
            save_rejects(route_lengths(rows, text_length_limits())[1], layout.reject_table, str(batch_id))
        loaded = _kept(rows.select(BATCH, FILENAME).distinct() if files is None else files)
        if keys.rules:
            checked += [r.asDict() for r in dq.run_suite(_written(spark, layout, loaded), keys).collect()]
    if loaded.isEmpty() and not refused:
        return []
    if layout.results_table and checked:
        save_results(spark.createDataFrame(checked, dq.QUALITY_RESULT_SCHEMA),
                     layout.results_table, str(batch_id))
    if refused and loaded.isEmpty():
        raise dq.QualityGateError(dq.failures(refused))
    # Later steps read the partitions just written: the lineage stops there.
    if layout.clean_path:
        # The batch is the increment: its rows were loaded now, after every
        # stored row, so the clean model's "newer than the target" filter
        # keeps all of them and the target's max is not scanned.
        upsert_table(spark, clean(_written(spark, layout, loaded)), layout.clean_path, ROW_HASH,
                     layout.n_buckets, layout.clean_group_cols)
    write_files(loaded.withColumn("batch_id", F.lit(str(batch_id))), layout.log_table)
    if refused:
        raise dq.QualityGateError(dq.failures(refused) + "; files that break a rule were not loaded")
    return checked


def header_results(suite: dq.Suite, misfits: DataFrame) -> list[dict]:
    """A failed result for each column that kept files from being read."""
    found = misfits.groupBy("reason", "column").agg(F.count_distinct(FILE_PATH).alias("n")).collect()
    return [{"suite": suite.name, "rule": f"header: {r['reason']}", "column_name": r["column"],
             "element_count": r["n"], "unexpected_count": r["n"], "success": False} for r in found]


def _kept(files: DataFrame) -> DataFrame:
    """A list of files as a small table in the shared folder."""
    path = shared_path(files.sparkSession, "ingest", uuid.uuid4().hex)
    files.select(BATCH, FILENAME).write.parquet(path)
    return files.sparkSession.read.schema(files.select(BATCH, FILENAME).schema).parquet(path)


def _written(spark: SparkSession, layout: Layout, loaded: DataFrame) -> DataFrame:
    raw = spark.table(layout.raw_table)
    return raw.join(loaded.select(BATCH), on=BATCH, how="left_semi").drop(BATCH)


def logged(spark: SparkSession, layout: Layout) -> DataFrame:
    """The load log as it is now."""
    ensure_raw_tables(spark, layout.raw_table, layout.log_table)
    spark.catalog.refreshTable(layout.log_table)
    return spark.table(layout.log_table)


def files_to_load(spark: SparkSession, landing_dir: str, layout: Layout) -> DataFrame:
    """Landing files whose path is not in the load log."""
    listing = list_landing(spark, landing_dir).withColumn(BATCH, file_key(F.col(FILE_PATH)))
    return missing_files(listing, logged(spark, layout), BATCH)


def ingest_directory(spark: SparkSession, landing_dir: str, layout: Layout,
                     suite: dq.Suite | None = None, batch_id: str | None = None) -> list[dict]:
    """Batch run: list the folder, read only the files not loaded yet, ingest them.

    Only file paths (one per pending file, never rows) reach the driver, to hand
    the reader its inputs.
    """
    if not path_exists(spark, landing_dir):     # no landing folder yet: nothing to load
        return []
    pending = files_to_load(spark, landing_dir, layout)
    paths = [r.path for r in pending.select("path").toLocalIterator()]
    if not paths:
        return []
    # The files that are read, also if more arrive meanwhile.
    listed = pending.join(spark.createDataFrame([(p,) for p in paths], "path string"), on="path", how="left_semi")
    return ingest_files(spark, paths, listed, batch_id or f"run-{uuid.uuid4().hex[:16]}", layout, suite)


def ingest_files(spark: SparkSession, paths: list[str], listed: DataFrame, batch_id: int | str, layout: Layout,
                 suite: dq.Suite | None = None) -> list[dict]:
    """Read files by their own headers and load them as one batch; ``listed`` has
    their path, name and load key. A file whose header does not fit is left out,
    the others load."""
    scan = read_by_header(spark, paths)
    unread = scan.refused.withColumn(BATCH, file_key(F.col(FILE_PATH))).select(BATCH)
    files = listed.select(FILENAME, BATCH).join(unread, on=BATCH, how="left_anti")
    return ingest_batch(spark, scan.rows, batch_id, layout, suite, files, scan.refused)


#: Renames that one task makes.
FILES_PER_MOVE_TASK = 500
MOVES = f"path string, {FILENAME} string, target string, error string"


def archive_loaded(spark: SparkSession, landing_dir: str, archive_dir: str, layout: Layout) -> DataFrame:
    """Move landing files that are in the load log into ``archive_dir``.

    A job over the listing: its rows, dealt by path, are renamed in the tasks,
    and each gives a result row (path, name, target, error). Also the last
    batch's files move, so the folder is empty after a run that loaded all. A name
    that the archive has already gets its load key in front. A file that can not
    be moved stays, with the reason in its row; one that an earlier attempt of
    the task has moved counts as moved. Files are reached through pyarrow's file
    systems (local, HDFS, S3, GCS).
    """
    ensure_raw_tables(spark, layout.raw_table, layout.log_table)
    listing = list_landing(spark, landing_dir).withColumn(BATCH, file_key(F.col(FILE_PATH)))
    done = listing.join(loaded_files(spark.table(layout.log_table), BATCH), on=BATCH, how="left_semi")
    done = done.select("path", FILENAME, BATCH)
    tasks = max(1, math.ceil(done.count() / FILES_PER_MOVE_TASK))
    moved = done.repartition(tasks, "path").mapInArrow(_mover(archive_dir), MOVES)
    out = shared_path(spark, "archive", uuid.uuid4().hex)
    moved.write.parquet(out)
    return spark.read.schema(MOVES).parquet(out)


def _mover(archive_dir: str) -> Callable:
    """The map function of ``archive_loaded``."""
    def move(batches: Iterator) -> Iterator:
        import re

        import pyarrow as pa
        from pyarrow import fs

        def place(uri: str) -> tuple:
            return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri if ":/" in uri else f"file://{uri}"))

        for batch in batches:
            targets, errors = [], []
            for path, name, key in zip(*(batch.column(i).to_pylist() for i in range(3))):
                target = error = None
                try:
                    system, source = place(path)
                    _, folder = place(archive_dir)
                    system.create_dir(folder, recursive=True)
                    plain, own = f"{folder}/{name}", f"{folder}/{key}-{name}"
                    here, there, again = (i.type != fs.FileType.NotFound
                                          for i in system.get_file_info([source, plain, own]))
                    target = own if again or (there and here) else plain
                    if here:
                        system.move(source, target)
                    elif not there and not again:
                        raise FileNotFoundError(path)
                except Exception as e:  # one row for each file, whatever its end
                    target, error = None, f"{type(e).__name__}: {e}"
                targets.append(target)
                errors.append(error)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(targets, pa.string()), pa.array(errors, pa.string())],
                names=["path", name_column, "target", "error"])

    name_column = FILENAME
    return move


def run_clean_model(spark: SparkSession, layout: Layout) -> int:
    """The clean model as a scheduled incremental run over the whole raw table.

    Raw rows loaded after the newest clean row (all rows on the first run; the
    bound reaches the raw scan as a literal) -> first row per content hash ->
    upsert into the clean table. Returns the number of rewritten partitions.
    """
    raw = read_raw(spark, layout.raw_table)
    target = read_upsert_table(spark, layout.clean_path) \
        if upsert_exists(spark, layout.clean_path) else None
    return upsert_table(spark, clean(raw, target), layout.clean_path, ROW_HASH,
                        layout.n_buckets, layout.clean_group_cols)


def run_models(spark: SparkSession, layout: Layout, mart: str, view: str = "stg_storm_events") -> dict:
    """The model chain in order: staging view, clean model, its tests, mart."""
    materialize_view(stage(read_raw(spark, layout.raw_table)), view)
    rewritten = run_clean_model(spark, layout)
    rows = read_upsert_table(spark, layout.clean_path)
    tests = dq.validate(rows, model_suite())
    materialize_table(yearly_damage(rows), mart)
    return {"rewritten": rewritten, "tests": dq.run_summary(tests), "mart": mart}
