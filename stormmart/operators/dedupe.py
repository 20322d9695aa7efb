"""Distinct rows, first row per key, incremental filter and frame-level upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormmart.functions.hashing import row_hash

_UNORDERABLE = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def _cols(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def distinct_rows(df: DataFrame) -> DataFrame:
    """``SELECT DISTINCT *`` (partial hash aggregate before the shuffle)."""
    return df.distinct()


def first_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: Sequence[str | Column],
    tie_breakers: Sequence[str | Column] | None = None,
    rank_col: str = "__rn",
) -> DataFrame:
    """Keep row number 1 per key in the given order.

    ``row_number() over (partition by keys order by ...) = 1``: Spark plans a
    partial ``WindowGroupLimit`` before the shuffle, so every map task sends at
    most one row per key and a hot key cannot pile up in one reducer.
    Ties are broken by ``tie_breakers`` (default: every other column, plus a
    hash of the columns that have no ordering), so the kept row does not
    depend on task order.
    """
    keys = _cols(keys)
    if tie_breakers is None:
        tie_breakers = default_tie_breakers(df, keys, order_by)
    order = [F.col(c) if isinstance(c, str) else c for c in [*order_by, *tie_breakers]]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(rank_col, F.row_number().over(w))
        .filter(F.col(rank_col) == 1)
        .drop(rank_col)
    )


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, _UNORDERABLE):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def default_tie_breakers(df: DataFrame, keys: Sequence[str],
                         order_by: Sequence[str | Column]) -> list[Column]:
    used = set(keys) | {c for c in order_by if isinstance(c, str)}
    rest = [f for f in df.schema.fields if f.name not in used]
    ties: list[Column] = [F.col(f.name) for f in rest if _orderable(f.dataType)]
    unordered = [f.name for f in rest if not _orderable(f.dataType)]
    if unordered:
        ties.append(row_hash(*[F.to_json(F.col(c)) for c in unordered]))
    return ties


def above_max(batch: DataFrame, target: DataFrame | None, column: str,
              eager: bool = True) -> DataFrame:
    """Rows of ``batch`` strictly newer than ``max(target.column)``.

    An empty or missing target has a null max: then every row is taken.
    ``eager`` (default) runs the one-value max first and filters with a
    literal, which parquet can use to skip row groups (and partitions) of old
    loads; ``eager=False`` keeps it a scalar subquery inside one lazy plan.
    """
    if target is None:
        return batch
    if eager:
        # A timestamp travels as microseconds (its text form is ambiguous in the
        # hour that a time zone repeats), other values as Spark's own text.
        dtype = target.schema[column].dataType
        newest = F.max(column)
        instant = isinstance(dtype, T.TimestampType)
        mx = target.agg(F.unix_micros(newest) if instant else newest.cast("string")).first()[0]
        if mx is None:
            return batch
        return batch.filter(F.col(column) > (F.timestamp_micros(F.lit(mx)) if instant else F.lit(mx).cast(dtype)))
    mx = target.select(F.max(column)).scalar()
    return batch.filter(F.coalesce(F.col(column) > mx, mx.isNull()))


def upsert_frames(target: DataFrame, batch: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Delete target rows whose key is in the batch, then insert the batch.

    Anti join + union by name. Null keys never match, so such target rows stay;
    they bypass the join (all nulls would hash to one join partition).
    """
    keys = _cols(key)
    return anti_by_key(target, batch.select(*keys), keys).unionByName(batch)


def anti_by_key(rows: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``keys_df``; rows with a null key part are kept
    without entering the join."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    matched = rows.filter(present).join(keys_df.select(*keys).distinct(), on=list(keys), how="left_anti")
    return matched.unionByName(rows.filter(~present))
