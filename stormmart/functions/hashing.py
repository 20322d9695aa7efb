"""Content hash of a row.

Values only (names do not matter), in column order, nulls kept by place and
distinct from empty text: every value is cast to text and written behind its
length in bytes (``1:a~0:`` for a, null, empty), which no other row of values
gives, before SHA-256. The text is built inside generated code; no row becomes
an object. A 64-bit hash is not used: it is the dedupe key, and at 1e11 rows a
64-bit key space already produces collisions (which would silently drop distinct
rows). Bare ``xxhash64(cols)`` would also skip nulls, so (a, null, b) and
(a, b, null) would collide.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "~"


def encode_values(*cols) -> Column:
    """Injective text encoding of the values of ``cols``."""
    parts = []
    for c in cols:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit(NULL_MARK)))
    return F.concat(*parts)


def row_hash(*cols) -> Column:
    return F.sha2(encode_values(*cols), 256)
