"""Connected components of an edge table, by alternating stars in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormmart.llm.common import staged


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(pairs: DataFrame) -> DataFrame:
    """Every (u, v) with the least of u and its neighbours. ``pairs`` is staged."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return pairs.join(least, "u")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """(node, component) of every node that an edge (u, v) names; the component
    is its least node. With ``rows_per_task``, each step's result is written by as
    many tasks as its edges need, not by one for each shuffle partition.

    Large star links the greater neighbours of a node to the least one, small
    star the node itself and the lesser ones; when nothing changes, every edge
    joins a node to its component. Each step is written to the shared folder.
    """
    edges = staged(edges.where(F.col("u") != F.col("v"))
                   .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(edges)
    tasks = None if rows_per_task is None else max(1, -(-2 * before[0] // rows_per_task))

    def sized(df: DataFrame) -> DataFrame:
        return df if tasks is None else df.coalesce(tasks)

    while True:
        large = _star(staged(sized(_both_ways(edges)), "pairs")).where(F.col("v") > F.col("u"))
        # Each row links v > m, so the same table serves the small star.
        large = staged(sized(large.select(F.col("v").alias("u"), F.col("m").alias("v"))
                             .where(F.col("u") != F.col("v")).distinct()), "large")
        small = _star(large)
        edges = staged(sized(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                             .unionByName(small.select("u", F.col("m").alias("v")))
                             .where(F.col("u") != F.col("v")).distinct()), "small")
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
