"""Helpers shared by the corpus operators: staging, gapless ranks, worker path."""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stormmart.session import shared_path

REPO_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Rows of one group that a single rank task sorts.
ROWS_PER_RANK_TASK = 50_000


#: Rows of an Arrow batch: long texts would make the default a large one.
ARROW_ROWS = "2000"


def workers_can_import(spark: SparkSession) -> None:
    """Let Python workers import this package when it is not installed there
    (local runs and shared checkouts; a cluster ships it with ``--py-files``),
    and get whole texts in batches that fit beside an executor's heap."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if REPO_ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([REPO_ROOT, *parts])


#: The model (tokenizer, automata, matcher) that this worker has loaded last.
_loaded: dict = {}


def loaded(kind: str, key: object, make: Callable) -> object:
    """A model that a worker keeps for its next task of the same kind. There is one
    at a time: workers are used again by all operators of a job."""
    if (kind, key) not in _loaded:
        _loaded.clear()
        free_memory()
        _loaded[kind, key] = make()
    return _loaded[kind, key]


def make_room(uses: str | None) -> None:
    """Drop a loaded model of another kind."""
    if any(kind != uses for kind, _ in _loaded):
        _loaded.clear()
        free_memory()


def tidy(run: Callable, uses: str | None = None) -> Callable:
    """A map function that gives its memory back when its task ends: Python
    workers are used again, and what one keeps is missing beside the heap. Models
    of another kind than ``uses`` go before it starts."""
    def wrapped(batches: Iterator) -> Iterator:
        make_room(uses)
        try:
            yield from run(batches)
        finally:
            free_memory()
    return wrapped


def free_memory() -> None:
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def groups_of(batches: Iterator, n_keys: int) -> Iterator:
    """The groups of rows, as tables, of batches that are sorted by their first
    ``n_keys`` columns of numbers; a group may lie in several batches."""
    import numpy as np
    import pyarrow as pa

    held: list = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)])
        starts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        edges = [0, *starts.tolist(), batch.num_rows]
        if held and (keys[:, 0] != last).any():
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(edges[:-2], edges[1:-1]):
            yield pa.Table.from_batches([*held, batch.slice(a, b - a)])
            held = []
        held.append(batch.slice(edges[-2]))
        last = keys[:, -1]
    if held:
        yield pa.Table.from_batches(held)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    return shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor never repeats the work before this point,
    and several readers share one result.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def gapless_rank(df: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """Add ``out``: a 0-based rank without gaps among the rows of each group.

    A group is split by a hash of ``order`` into parts of about
    ``ROWS_PER_RANK_TASK`` rows, so that a hot group is ranked by many tasks:
    rank = rows of the group's earlier parts + row number in the own part.
    ``df`` is read twice and should be a staged table.
    """
    parts = max(1, math.ceil(df.count() / ROWS_PER_RANK_TASK))
    part = f"__{out}_part"
    before = f"__{out}_before"
    salted = df.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    if parts == 1:
        w = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn(out, F.row_number().over(w).cast("long") - 1)
    earlier = (Window.partitionBy(*group).orderBy(part)
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (salted.groupBy(*group, part).agg(F.count(F.lit(1)).alias("__n"))
               .withColumn(before, F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
               .drop("__n"))
    inside = Window.partitionBy(*group, part).orderBy(*order)
    return (salted.join(offsets, [*group, part])
            .withColumn(out, F.row_number().over(inside) - 1 + F.col(before))
            .drop(part, before))


def text_bytes(col: str | Column) -> Column:
    """UTF-8 bytes of a text column; null becomes empty."""
    return F.encode(F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")), "UTF-8")
