"""Small text helpers used by the cleaning steps and the link extraction."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: field texts that a pandas CSV read turns into nulls by
# default (pandas documentation, ``na_values``).
DEFAULT_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# --- end of fixed values


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_name(name: str) -> str:
    """Column name as stored: quotes removed, lower case."""
    return name.replace('"', "").lower()


def null_tokens_to_null(c, tokens=DEFAULT_NULL_TOKENS) -> Column:
    """Null when the whole field equals one of the null tokens."""
    c = _col(c)
    return F.when(~c.isin(list(tokens)) | c.isNull(), c)


def strip_whitespace(c) -> Column:
    """Whitespace removed at both ends (like Python's str.strip)."""
    return F.regexp_replace(_col(c), r"^[\s\x{00A0}]+|[\s\x{00A0}]+$", "")


def drop_suffix(c, suffix: str) -> Column:
    """Drop a literal suffix when present (``name[:-3]`` for '.gz')."""
    return F.regexp_replace(_col(c), re.escape(suffix) + "$", "")
