"""Raw CSV rows -> typed rows: header removal, null tokens, meta columns, types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormmart.functions.amounts import is_number_text
from stormmart.functions.hashing import row_hash
from stormmart.functions.text import DEFAULT_NULL_TOKENS, normalize_name, null_tokens_to_null
from stormmart.functions.timestamps import parse_event_timestamp
from stormmart.schemas import (
    DATE_LOADED,
    FILE_PATH,
    FILENAME,
    MALFORMED,
    NOT_CAST,
    RAW_COLUMNS,
    ROUNDED_INT_COLUMNS,
    ROW_HASH,
    TIMESTAMP_CENTURY_SOURCE,
)


def drop_repeated_headers(df: DataFrame, column: str = "BEGIN_YEARMONTH",
                          header_text: str | None = None) -> DataFrame:
    """Drop header lines repeated inside a file.

    Null-safe: a row whose key field is null is kept (only the header text
    itself is removed).
    """
    header_text = column if header_text is None else header_text
    return df.filter(~F.col(column).eqNullSafe(F.lit(header_text)))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Column names without quotes, lower case."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def apply_null_tokens(df: DataFrame, columns: Sequence[str] | None = None,
                      tokens: Sequence[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """Turn null-token texts (``NA``, ``null``, empty ...) into nulls."""
    columns = set(df.columns if columns is None else columns)
    return df.select(
        *[null_tokens_to_null(c, tokens).alias(c) if c in columns else F.col(c)
          for c in df.columns]
    )


def add_meta_columns(df: DataFrame, source_columns: Sequence[str] | None = None,
                     filename: str | Column | None = None) -> DataFrame:
    """Row hash over the source columns, file name, then normalized names.

    The hash is taken over the text values before any cast, so number
    formatting can not change the key. ``filename`` defaults to an existing
    ``__filename`` column (set by the landing reader from file metadata).
    """
    source_columns = [c for c in (source_columns or df.columns) if c != FILENAME]
    out = df.withColumn(ROW_HASH, row_hash(*source_columns))
    if filename is not None:
        out = out.withColumn(FILENAME, F.lit(filename) if isinstance(filename, str) else filename)
    return normalize_columns(out)


def _as_int(c: Column) -> Column:
    # Integer text directly; decimal text is rounded as the warehouse does.
    return F.coalesce(
        c.try_cast("int"),
        F.when(is_number_text(c), F.round(c.try_cast("double")).try_cast("int")),
    )


def conform_types(df: DataFrame, columns=RAW_COLUMNS,
                  rounded: Sequence[str] = ROUNDED_INT_COLUMNS,
                  century_source: dict[str, str] = TIMESTAMP_CENTURY_SOURCE,
                  report: bool = False) -> DataFrame:
    """One projection casting every text column to its table type.

    Every cast is a ``try_cast`` (ANSI mode is on): a bad value becomes null
    instead of failing the job. With ``report``, ``__not_cast`` names the columns
    of a row whose text was present but did not parse (null if there is none),
    for a quality rule to count.
    """
    kinds = dict(columns)
    out = []
    failed = []
    for name in df.columns:
        kind = kinds.get(name)
        c = F.col(name)
        if kind == "int":
            if name in rounded:
                expr = F.when(is_number_text(c), F.round(c.try_cast("float"))).try_cast("int")
            else:
                expr = _as_int(c)
        elif kind == "double":
            expr = F.when(is_number_text(c), c.try_cast("double"))
        elif kind == "timestamp":
            src = century_source.get(name)
            expr = parse_event_timestamp(c, F.col(src) if src in df.columns else None)
        else:
            out.append(c)
            continue
        out.append(expr.alias(name))
        failed.append(F.when(c.isNotNull() & expr.isNull(), F.lit(name)))
    if report:
        named = F.concat_ws(",", *failed)
        out.append(F.when(named != "", named).alias(NOT_CAST))
    return df.select(*out)


def prepare_raw(rows: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Landing rows (all text, upper-case header names) -> raw table rows.

    Header removal -> null tokens -> hash + file name + names -> types -> load time.
    """
    source = [c for c in rows.columns if c not in (FILENAME, FILE_PATH, MALFORMED)]
    out = drop_repeated_headers(rows, source[0])
    out = apply_null_tokens(out, source)
    out = add_meta_columns(out, source)
    out = conform_types(out, report=True)
    return out.withColumn(DATE_LOADED, F.current_timestamp() if loaded_at is None else loaded_at)
