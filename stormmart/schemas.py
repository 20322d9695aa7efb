"""Schemas of the raw event files, the raw table, the load log and results."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: source column names (CSV header order) and their warehouse
# types. The header in the files is the upper-case form of each name.
# Kinds: "int", "double", "timestamp", or ("string", max_length | None).
RAW_COLUMNS: list[tuple[str, object]] = [
    ("begin_yearmonth", "int"),
    ("begin_day", "int"),
    ("begin_time", "int"),
    ("end_yearmonth", "int"),
    ("end_day", "int"),
    ("end_time", "int"),
    ("episode_id", "int"),
    ("event_id", "int"),
    ("state", ("string", 200)),
    ("state_fips", "int"),
    ("year", "int"),
    ("month_name", ("string", 30)),
    ("event_type", ("string", 200)),
    ("cz_type", ("string", 1)),
    ("cz_fips", "int"),
    ("cz_name", ("string", 200)),
    ("wfo", ("string", 100)),
    ("begin_date_time", "timestamp"),
    ("cz_timezone", ("string", 50)),
    ("end_date_time", "timestamp"),
    ("injuries_direct", "int"),
    ("injuries_indirect", "int"),
    ("deaths_direct", "int"),
    ("deaths_indirect", "int"),
    ("damage_property", ("string", 100)),
    ("damage_crops", ("string", 100)),
    ("source", ("string", 200)),
    ("magnitude", "int"),
    ("magnitude_type", ("string", 100)),
    ("flood_cause", ("string", 200)),
    ("category", ("string", 100)),
    ("tor_f_scale", ("string", 50)),
    ("tor_length", "double"),
    ("tor_width", "int"),
    ("tor_other_wfo", ("string", 500)),
    ("tor_other_cz_state", ("string", 500)),
    ("tor_other_cz_fips", ("string", 200)),
    ("tor_other_cz_name", ("string", 200)),
    ("begin_range", "int"),
    ("begin_azimuth", ("string", 100)),
    ("begin_location", ("string", 200)),
    ("end_range", "int"),
    ("end_azimuth", ("string", 50)),
    ("end_location", ("string", 200)),
    ("begin_lat", "double"),
    ("begin_lon", "double"),
    ("end_lat", "double"),
    ("end_lon", "double"),
    ("episode_narrative", ("string", None)),
    ("event_narrative", ("string", None)),
    ("data_source", ("string", 200)),
]

# Timestamp text columns and the year-month column whose century they take.
TIMESTAMP_CENTURY_SOURCE = {
    "begin_date_time": "begin_yearmonth",
    "end_date_time": "end_yearmonth",
}
# Text form of the timestamp columns, e.g. 28-APR-50 14:45:00, and the
# pattern used to read it (day and hour may also have one digit).
TIMESTAMP_TEXT_FORMAT = "dd-MMM-yy HH:mm:ss"
TIMESTAMP_PARSE_FORMAT = "d-MMM-yy H:mm:ss"
# Column that is rounded (not truncated) on its way to an integer.
ROUNDED_INT_COLUMNS = ("magnitude",)

# Meta columns, in table order.
DATE_LOADED = "__date_loaded"
ROW_HASH = "__row_hash"
FILENAME = "__filename"
# Set by the landing reader: where a row comes from, and the line if it does not
# have the header's number of fields.
FILE_PATH = "__file_path"
MALFORMED = "__malformed"
# Names of the columns whose text the table types could not take.
NOT_CAST = "__not_cast"
META_COLUMNS = (DATE_LOADED, ROW_HASH, FILENAME)
META_LENGTHS = {ROW_HASH: 1000, FILENAME: 100}
LOG_FILENAME_LENGTH = 200
# --- end of fixed values

SOURCE_NAMES = [name for name, _ in RAW_COLUMNS]
HEADER_NAMES = [name.upper() for name in SOURCE_NAMES]


def _spark_type(kind) -> T.DataType:
    if kind == "int":
        return T.IntegerType()
    if kind == "double":
        return T.DoubleType()
    if kind == "timestamp":
        return T.TimestampNTZType()
    return T.StringType()


def landing_schema(upper: bool = True) -> T.StructType:
    """All-string schema used to read the CSV files (never inferred)."""
    names = HEADER_NAMES if upper else SOURCE_NAMES
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def typed_source_schema() -> T.StructType:
    return T.StructType(
        [T.StructField(n, _spark_type(k), True) for n, k in RAW_COLUMNS]
    )


def raw_table_schema() -> T.StructType:
    """51 typed source columns + load time, row hash and file name."""
    return T.StructType(
        typed_source_schema().fields
        + [
            T.StructField(DATE_LOADED, T.TimestampType(), True),
            T.StructField(ROW_HASH, T.StringType(), True),
            T.StructField(FILENAME, T.StringType(), True),
        ]
    )


def log_schema() -> T.StructType:
    return T.StructType(
        [
            T.StructField(FILENAME, T.StringType(), True),
            T.StructField("date_loaded", T.TimestampType(), True),
            T.StructField("batch_id", T.StringType(), True),
        ]
    )


def text_length_limits() -> dict[str, int]:
    """varchar(n) limits of the raw table, checked as data-quality rules."""
    limits = {
        n: k[1]
        for n, k in RAW_COLUMNS
        if isinstance(k, tuple) and k[1] is not None
    }
    limits.update(META_LENGTHS)
    return limits


QUALITY_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("suite", T.StringType(), False),
        T.StructField("rule", T.StringType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("element_count", T.LongType(), False),
        T.StructField("unexpected_count", T.LongType(), False),
        T.StructField("success", T.BooleanType(), False),
    ]
)
