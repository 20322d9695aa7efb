"""Upsert by key into a partitioned parquet folder: delete + insert.

Rows are partitioned by ``__bucket = pmod(xxhash64(key), n_buckets)``, below an
optional ``__group`` level of columns that the key determines (as a content hash
does), so a stored row and its replacement lie in one partition. An upsert

1. writes the batch to staging (it may be derived from the stored table);
2. finds the batch's partitions that hold a replaced key, by a semi join;
3. writes the remaining rows of these partitions and their new rows to staging,
   and replaces the partitions from there (dynamic partition overwrite);
4. appends the batch's rows of all other partitions.

Step 3's staged rows stay until the replacement is through: the next upsert or
``finish_upsert`` repeats one that a crash has interrupted. After that a replay of
the batch finds its own rows by key and replaces them, so no step doubles or
loses a row. One writer at a time; readers should not run during step 3. Where a
table format with ``MERGE INTO`` is present, ``merge_into`` is that one statement.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from stormmart.operators.dedupe import anti_by_key
from stormmart.sinks.tables import check_schema, has_files, path_exists, remove_path

BUCKET = "__bucket"
GROUP = "__group"


def _cols(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def bucket_of(keys: Sequence[str], n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n_buckets)).cast("int")


def group_of(group_cols: Sequence[str]) -> Column:
    """Text partition value of the group columns ('g' prefix: never numeric)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in group_cols]
    return F.concat(F.lit("g"), F.concat_ws("|", *parts))


def _with_parts(schema: StructType, part_cols: Sequence[str]) -> StructType:
    kinds = {GROUP: StringType(), BUCKET: IntegerType()}
    return StructType([f for f in schema.fields if f.name not in kinds] + [StructField(c, kinds[c]) for c in part_cols])


def _data(path: str) -> str:
    return f"{path.rstrip('/')}/data"


def _merged(path: str) -> str:
    return f"{path.rstrip('/')}/merged"


def upsert_exists(spark: SparkSession, path: str) -> bool:
    return has_files(spark, _data(path)) or path_exists(spark, _merged(path))


def read_upsert_table(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows, without helper columns."""
    finish_upsert(spark, path)
    return spark.read.parquet(_data(path)).drop(GROUP, BUCKET)


def _stored(spark: SparkSession, path: str, part_cols: Sequence[str]) -> DataFrame:
    known = spark.read.parquet(_data(path)).schema
    return spark.read.schema(_with_parts(known, part_cols)).parquet(_data(path))


def _write(rows: DataFrame, path: str, part_cols: Sequence[str], replace: bool) -> None:
    """Rows clustered by partition: a few files for each, and adaptive execution
    splits a hot partition over several tasks."""
    writer = rows.hint("rebalance", *part_cols).write.partitionBy(*part_cols)
    if replace:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)


def finish_upsert(spark: SparkSession, path: str) -> None:
    """Repeat a replacement of partitions that a crash has interrupted; staged rows
    that were not complete are dropped."""
    merged = _merged(path)
    if not path_exists(spark, merged):
        return
    if path_exists(spark, f"{merged}/_SUCCESS"):
        _replace(spark, path)
    remove_path(spark, merged)


def _replace(spark: SparkSession, path: str) -> None:
    rows = spark.read.parquet(_merged(path))
    part_cols = [c for c in (GROUP, BUCKET) if c in rows.columns]
    rows = spark.read.schema(_with_parts(rows.schema, part_cols)).parquet(_merged(path))
    _write(rows, _data(path), part_cols, replace=True)


def upsert_table(spark: SparkSession, batch: DataFrame, path: str, key: str | Sequence[str],
                 n_buckets: int = 64, group_cols: Sequence[str] = ()) -> int:
    """Delete stored rows whose key is in ``batch``, insert ``batch``. The key must
    determine ``group_cols``. Returns the number of replaced rows' partitions."""
    keys = _cols(key)
    part_cols = [GROUP, BUCKET] if group_cols else [BUCKET]
    finish_upsert(spark, path)
    exists = has_files(spark, _data(path))
    names = batch.columns
    if exists:
        stored_schema = StructType([f for f in _stored(spark, path, part_cols).schema.fields if f.name not in (GROUP, BUCKET)])
        check_schema(batch, stored_schema)
        names = stored_schema.names
    parts = batch.select(*names).withColumn(BUCKET, bucket_of(keys, n_buckets))
    if group_cols:
        parts = parts.withColumn(GROUP, group_of(group_cols))
    staging = f"{path.rstrip('/')}/staging-{uuid.uuid4().hex[:12]}"
    try:
        parts.select(*names, *part_cols).write.parquet(f"{staging}/new")
        new = spark.read.schema(_with_parts(parts.select(*names).schema, part_cols)).parquet(f"{staging}/new")
        if not exists:
            _write(new, _data(path), part_cols, replace=False)
            return 0
        own = new.select(*part_cols, *keys).distinct()
        hits = _stored(spark, path, part_cols).select(*part_cols, *keys).join(own, [*part_cols, *keys], "left_semi")
        hits.select(*part_cols).distinct().write.parquet(f"{staging}/hits")
        hits = spark.read.schema(_with_parts(StructType([]), part_cols)).parquet(f"{staging}/hits")
        replaced = hits.count()
        if replaced:
            # Partition values reach the scan at run time (dynamic partition pruning).
            held = _stored(spark, path, part_cols).join(hits, part_cols, "left_semi")
            rows = anti_by_key(held, new.select(*keys), keys).select(*names, *part_cols).unionByName(
                new.join(hits, part_cols, "left_semi").select(*names, *part_cols))
            rows.hint("rebalance", *part_cols).write.partitionBy(*part_cols).parquet(_merged(path))
            _replace(spark, path)
            remove_path(spark, _merged(path))
        rest = new.join(hits, part_cols, "left_anti").select(*names, *part_cols)
        if not rest.isEmpty():
            _write(rest, _data(path), part_cols, replace=False)
        return replaced
    finally:
        remove_path(spark, staging)


def merge_into(spark: SparkSession, batch: DataFrame, table: str, key: str | Sequence[str]) -> DataFrame:
    """The upsert as one statement, for catalogs whose tables take ``MERGE INTO``."""
    check_schema(batch, spark.table(table).schema)
    return spark.sql(merge_sql(table, "{rows}", _cols(key)), rows=batch)


def merge_sql(table: str, source: str, keys: Sequence[str]) -> str:
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    return (f"MERGE INTO {table} t USING {source} s ON {on} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")
