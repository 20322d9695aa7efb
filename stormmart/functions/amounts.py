"""Shorthand amount text -> number ('250K' -> 250000.0, '2.5M' -> 2500000.0).

Semantics of the mart's CASE expressions, kept as the warehouse ran them:

* the number is the lower-cased text with its *first* letter removed (a
  regex replace without the global flag), cast to double; empty -> null;
* the unit is the last character, lower-cased, when it is a letter;
* h/k/m/b scale by 1e2/1e3/1e6/1e9; a lone unit ('K') stays null;
  any other unit letter ('3t') leaves the number unscaled; no unit -> the
  number, or 0 when there is none (null and empty text count 0);
* text that is not a number after that removal ('1.5KK') is null instead of
  a hard cast error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: unit letters and their factors.
UNIT_FACTORS = {"h": 100.0, "k": 1000.0, "m": 1000000.0, "b": 1000000000.0}
# --- end of fixed values

# A letter in any script (the POSIX [[:alpha:]] class of a UTF-8 locale).
LETTER = r"\p{L}"
# Decimal number text that a SQL float cast accepts; Spark's own cast would
# also take suffixes such as '1d' or 'NaN', so the text is checked first.
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_first_letter(text) -> Column:
    """Remove only the first letter of the lower-cased text."""
    return F.regexp_replace(F.lower(_col(text)), r"^(\P{L}*)\p{L}", "$1")


def is_number_text(text) -> Column:
    return _col(text).rlike(NUMBER_TEXT)


def amount_number(text) -> Column:
    """Numeric part of the amount text, or null."""
    rest = strip_first_letter(text)
    return F.when(
        (F.length(rest) > 0) & is_number_text(rest), rest.try_cast("double")
    )


def amount_unit(text) -> Column:
    """Last character, lower-cased, when it is a letter; else null."""
    last = F.lower(F.right(_col(text), F.lit(1)))
    return F.when(last.rlike(LETTER), last)


def parse_amount(text, number: Column | None = None, unit: Column | None = None) -> Column:
    """Amount in base units as double (see module doc for the edge cases)."""
    number = amount_number(text) if number is None else number
    unit = amount_unit(text) if unit is None else unit
    expr = None
    for letter, factor in UNIT_FACTORS.items():
        expr = (F.when(unit == letter, number * F.lit(factor)) if expr is None
                else expr.when(unit == letter, number * F.lit(factor)))
    return expr.otherwise(F.coalesce(number, F.lit(0.0)))
