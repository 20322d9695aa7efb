"""Column-level building blocks (all built-in Spark expressions, no UDFs)."""

from stormmart.functions.amounts import (  # noqa: F401
    amount_number,
    amount_unit,
    is_number_text,
    parse_amount,
    strip_first_letter,
)
from stormmart.functions.hashing import row_hash  # noqa: F401
from stormmart.functions.text import (  # noqa: F401
    drop_suffix,
    normalize_name,
    null_tokens_to_null,
    strip_whitespace,
)
from stormmart.functions.timestamps import century_year, parse_event_timestamp, parse_wall_clock  # noqa: F401
