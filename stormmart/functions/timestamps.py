"""Event time text ('28-APR-50 14:45:00') -> TIMESTAMP_NTZ with the right century.

The text is parsed with an explicit ``+0000`` offset, so the parse is an
exact instant in UTC (UTC has no daylight-saving gaps), and the wall clock is
rebuilt as NTZ epoch + seconds: the session time zone never takes part, and
impossible dates (31-FEB) give null instead of an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormmart.schemas import TIMESTAMP_PARSE_FORMAT

# --- fixed values: the two-digit year rule used when no year-month column
# gives the century (00-69 -> 20xx, 70-99 -> 19xx).
TWO_DIGIT_PIVOT = 70
# --- end of fixed values

_EPOCH_NTZ = "1970-01-01 00:00:00"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def century_year(two_digit: Column, year: Column | None) -> Column:
    """Four-digit year: century of ``year`` when known, else the pivot rule."""
    pivot = F.when(two_digit < TWO_DIGIT_PIVOT, two_digit + 2000).otherwise(two_digit + 1900)
    if year is None:
        return pivot
    return F.coalesce(year - F.pmod(year, F.lit(100)) + two_digit, pivot)


def parse_wall_clock(text, fmt: str = TIMESTAMP_PARSE_FORMAT) -> Column:
    """Text in ``fmt`` (month names in any case) -> TIMESTAMP_NTZ, or null."""
    instant = F.try_to_timestamp(F.concat(F.trim(_col(text)), F.lit(" +0000")), F.lit(fmt + " Z"))
    return F.timestamp_add("SECOND", F.unix_seconds(instant),
                           F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def parse_event_timestamp(text, yearmonth=None, fmt: str = TIMESTAMP_PARSE_FORMAT) -> Column:
    """Parse the event time; ``yearmonth`` (YYYYMM as text or int) gives the century.

    A two-digit year parses into 2000-2099; it is moved into the century of
    the row's own year-month, or by the pivot rule when that is missing.
    """
    ts = parse_wall_clock(text, fmt)
    year = None
    if yearmonth is not None:
        year = F.substring(_col(yearmonth).cast("string"), 1, 4).try_cast("int")
    parsed = F.year(ts)
    shift = century_year(F.pmod(parsed, F.lit(100)), year) - parsed
    return F.timestamp_add("YEAR", shift, ts)
