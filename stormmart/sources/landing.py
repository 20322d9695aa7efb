"""Landing zone: listing of files and the CSV scan (gzip handled by the reader)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from stormmart.functions.text import drop_suffix
from stormmart.schemas import FILE_PATH, FILENAME, MALFORMED, landing_schema

CSV_GLOB = "*.csv*"


def csv_options(multi_line: bool = True) -> dict[str, str]:
    """Header line, comma, double-quote quoting with doubled quotes inside.

    The header must name the schema's columns in their order (letter case
    aside): a file with added, missing or moved columns fails the read. A line
    with too few or too many fields is kept whole in the malformed column.
    """
    return {
        "enforceSchema": "false",
        "columnNameOfCorruptRecord": MALFORMED,
        "header": "true",
        "sep": ",",
        "quote": '"',
        "escape": '"',
        "multiLine": str(multi_line).lower(),
        "mode": "PERMISSIVE",
        "nullValue": "",
    }


def with_malformed(schema: StructType) -> StructType:
    return StructType(list(schema.fields)).add(MALFORMED, StringType())


def with_file_columns(df: DataFrame) -> DataFrame:
    return (df.withColumn(FILENAME, F.col("_metadata.file_name"))
            .withColumn(FILE_PATH, F.col("_metadata.file_path")))


def file_key(path_col) -> F.Column:
    """Load key of a file: a hash of its whole path, so that two files of one
    name in different folders are two files."""
    return F.concat(F.lit("file-"), F.substring(F.sha2(path_col, 256), 1, 40))


def read_landing(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
                 glob: str = CSV_GLOB, multi_line: bool = True,
                 partitions: int | None = None) -> DataFrame:
    """Scan the CSV files of a folder (or a list of files) as text, with the
    file's name and path and the malformed line, if it is one.

    The schema is given, never inferred: a header line repeated inside a file
    stays recognisable as text. A ``.gz`` file (and any file read with
    ``multiLine``) is one task; pass ``partitions`` to spread the rows before
    the heavy steps.
    """
    reader = spark.read.schema(with_malformed(schema or landing_schema())).options(**csv_options(multi_line))
    df = with_file_columns(reader.option("pathGlobFilter", glob).csv(path))
    return df.repartition(partitions) if partitions else df


def list_landing(spark: SparkSession, path: str, glob: str = CSV_GLOB) -> DataFrame:
    """Files in the landing folder: path, name, size, modification time and the
    path as file metadata writes it (what rows carry).

    ``binaryFile`` only opens a file when its ``content`` column is selected,
    so this reads directory metadata only.
    """
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
        .select(
            "path",
            F.regexp_extract("path", r"([^/]+)$", 1).alias(FILENAME),
            "length",
            "modificationTime",
            F.col("_metadata.file_path").alias(FILE_PATH),
        )
    )


def csv_name(name_col) -> F.Column:
    """Name of the unpacked file: the '.gz' suffix removed."""
    return drop_suffix(name_col, ".gz")


def is_csv(name_col) -> F.Column:
    return csv_name(name_col).endswith("csv")
