"""JSON text of amounts keyed by id: parse, total per row, formatted total line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT_MAP = "map<string,double>"
TOTAL_LINE = "Total order value is: %.2f"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_amounts(text) -> Column:
    """'{"1001": 301.27, ...}' -> map<string,double> (null when not JSON)."""
    return F.from_json(_col(text), AMOUNT_MAP)


def map_total(amounts) -> Column:
    """Sum of the map's values (null values count 0; an empty map gives 0)."""
    return F.aggregate(F.map_values(_col(amounts)), F.lit(0.0),
                       lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))


def total_line(total) -> Column:
    """'Total order value is: 1236.70'."""
    return F.format_string(TOTAL_LINE, _col(total).cast("double"))
