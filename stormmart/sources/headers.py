"""CSV scan by header name: files whose headers differ, each read by its own.

Columns are found by the names in a file's first line, wherever they stand; a
column that a file lacks is null there. A file that has a column too many, or one
twice, is refused, that file only.

The first lines are read by a pass that stops behind them: files are not packed
into shared tasks, and a task that has its line asks its reader for no more. Files
with one header are one scan with a given schema; there are as many scans as
different headers, not files.
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stormmart.schemas import FILE_PATH, FILENAME, MALFORMED, landing_schema
from stormmart.session import settings, shared_path
from stormmart.sources.landing import CSV_GLOB, csv_options, with_file_columns, with_malformed

HEADER = "header"
UNKNOWN, TWICE = "unknown column", "column twice"


@dataclass
class HeaderScan:
    """Rows of the files that fit, and the files that do not, with the reason."""
    rows: DataFrame
    refused: DataFrame


def first_lines(spark: SparkSession, path: str | Sequence[str], glob: str = CSV_GLOB) -> DataFrame:
    """File path, file name and first line of every file that is not empty, as a
    table in the shared folder."""
    def first(batches: Iterator) -> Iterator:
        for batch in batches:
            starts = [i for i, at in enumerate(batch.column(3).to_pylist()) if at == 0]
            if starts:
                yield batch.slice(starts[0], 1).select([0, 1, 2])
            return  # a later batch of this split holds no first line

    out = shared_path(spark, "headers", uuid.uuid4().hex)
    schema = f"{FILE_PATH} string, {FILENAME} string, {HEADER} string"
    # A file is at least one task of its own, so that a task may stop early; a
    # small batch keeps what is read ahead small.
    own_task = {"spark.sql.files.openCostInBytes": spark.conf.get("spark.sql.files.maxPartitionBytes"),
                "spark.sql.execution.arrow.maxRecordsPerBatch": "16"}
    with settings(spark, own_task):
        reader = spark.read.option("pathGlobFilter", glob)
        lines = reader.text(path if isinstance(path, str) else list(path)).select(
            F.col("_metadata.file_path").alias(FILE_PATH), F.col("_metadata.file_name").alias(FILENAME),
            F.col("value").alias(HEADER), F.col("_metadata.file_block_start").alias("start"))
        lines.mapInArrow(first, schema).write.parquet(out)
    return spark.read.schema(schema).parquet(out)


def names_of(header: str) -> list[str]:
    """Column names of a header line."""
    return [n.strip() for n in next(csv.reader([header.lstrip("﻿").rstrip("\r\n")]), [])]


def misfits(names: Sequence[str], schema: StructType) -> list[tuple[str, str]]:
    """(reason, column) of the names that the schema can not take; letter case aside."""
    known = {n.lower() for n in schema.names}
    lower = [n.lower() for n in names]
    return ([(UNKNOWN, n) for n in names if n.lower() not in known]
            + [(TWICE, n) for i, n in enumerate(names) if n.lower() in lower[:i] and n.lower() in known])


def read_by_header(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None,
                   glob: str = CSV_GLOB, multi_line: bool = True) -> HeaderScan:
    """All rows of the files of a folder (or of a list of files) as the schema's
    text columns, the malformed line, the file's name and path."""
    schema = schema or landing_schema()
    columns = with_malformed(schema)
    files = first_lines(spark, path, glob)
    own_case = {n.lower(): n for n in schema.names}
    empty = StructType(columns.fields).add(FILENAME, StringType()).add(FILE_PATH, StringType())
    rows, bad = spark.createDataFrame([], empty), []
    # One row for each different header; files reach the driver as paths only,
    # which the reader takes from there.
    for header in [r[0] for r in files.select(HEADER).distinct().collect()]:
        names = names_of(header)
        found = misfits(names, schema)
        if found:
            bad += [(header, reason, name) for reason, name in found]
            continue
        own = StructType([StructField(own_case[n.lower()], StringType()) for n in names])
        paths = [r[0] for r in files.where(F.col(HEADER) == header).select(FILE_PATH).toLocalIterator()]
        # The schema is in the header's own order: the reader need not compare names.
        options = {**csv_options(multi_line), "enforceSchema": "true"}
        scan = spark.read.schema(with_malformed(own)).options(**options).csv(paths)
        rows = rows.unionByName(with_file_columns(scan), allowMissingColumns=True)
    reasons = spark.createDataFrame(bad, f"{HEADER} string, reason string, column string")
    refused = files.join(reasons, HEADER).select(FILE_PATH, FILENAME, "reason", "column")
    return HeaderScan(rows.select(*empty.names), refused)
