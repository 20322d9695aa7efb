"""Operator 8: fixed virtual slots.

Every record hashes into one of ``N_SLOTS`` virtual slots for good. The bytes
of each slot are summed, and a small table maps slots to shards. The map is
stored by version; rebalancing writes a new version in which only the slots
that must move have another shard. Records are never hashed anew.

The law that holds is ``bytes``: shards have nearly equal sizes (as equal as
whole slots allow). DataFrame and SQL functions only.

Defined cases: a null text has size 1 and the checksum of no bytes; null
doc_ids are spread by their text; repeated rows each get a slot and a position
of their own; an empty table gives no rows (the map then spreads empty slots);
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stormmart.llm.common import gapless_rank, scratch, staged, text_bytes

N_SLOTS = 4096
N_SHARDS = 16
LAW = "bytes"
#: A slot stays where it is while its shard is at most this far above the mean.
TOLERANCE = 0.01


def hash_into_slots(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32 and the virtual slot of every record."""
    data = text_bytes("text")
    sized = docs.select("doc_id", (F.octet_length(data) + 1).cast("long").alias("size"),
                        F.crc32(data).alias("text_crc32"))
    return sized.withColumn(
        "virtual_slot",
        F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(n_slots)).cast("int"))


def slot_bytes(records: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """Bytes of every slot, empty slots included: always ``n_slots`` rows."""
    sums = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))
    every = records.sparkSession.range(n_slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(sums, "virtual_slot", "left").fillna(0, ["bytes"])


def place_slots(weights: DataFrame, n_shards: int, current: DataFrame | None = None,
                tolerance: float = TOLERANCE) -> DataFrame:
    """A slot-to-shard map: (virtual_slot, shard, bytes).

    Slots are taken from heavy to light. A slot keeps its shard of ``current``
    while that shard stays within ``tolerance`` of the mean; otherwise, and in a
    first map, it goes to the lightest shard. One fold over ``n_slots`` rows, a
    number that does not depend on the data.
    """
    if current is None:
        rows = weights.withColumn("held", F.lit(None).cast("int"))
    else:
        rows = weights.join(current.select("virtual_slot", F.col("shard").alias("held")),
                            "virtual_slot", "left")
    ordered = rows.agg(
        F.array_sort(F.collect_list(F.struct(
            (-F.col("bytes")).alias("neg_bytes"), "virtual_slot", "held"))).alias("slots"),
        (F.sum("bytes") / n_shards * (1 + tolerance)).alias("limit"))
    lightest = "cast(array_position(acc.loads, array_min(acc.loads)) - 1 as int)"
    choice = (f"if(s.held is not null and s.held < {n_shards} and "
              f"(element_at(acc.loads, s.held + 1) = 0 or "
              f"element_at(acc.loads, s.held + 1) - s.neg_bytes <= limit), s.held, {lightest})")
    fold = f"""
      aggregate(slots,
        named_struct('loads', array_repeat(cast(0 as bigint), {n_shards}),
                     'picked', -1, 'shards', cast(array() as array<int>)),
        (acc, s) -> aggregate(array({choice}), acc, (a, k) -> named_struct(
          'loads', transform(a.loads, (v, i) -> if(i = k, v - s.neg_bytes, v)),
          'picked', k,
          'shards', concat(a.shards, array(k)))))
    """
    placed = ordered.select(F.explode(F.arrays_zip(
        "slots", F.expr(fold)["shards"].alias("shards"))).alias("x"))
    return placed.select(F.col("x.slots.virtual_slot").alias("virtual_slot"),
                         F.col("x.shards").alias("shard"),
                         (-F.col("x.slots.neg_bytes")).alias("bytes"))


def save_map(slot_map: DataFrame, store: str, version: int) -> None:
    """Store a version of the map; an existing version is never overwritten."""
    slot_map.coalesce(1).write.parquet(f"{store}/version={version}")


def load_map(spark: SparkSession, store: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{store}/version={version}").withColumn(
        "map_version", F.lit(version))


def rebalance(spark: SparkSession, store: str, version: int, weights: DataFrame,
              n_shards: int, tolerance: float = TOLERANCE) -> DataFrame:
    """Edit version ``version`` for new slot weights or another shard count and
    store the result as the next version."""
    edited = place_slots(weights, n_shards, load_map(spark, store, version), tolerance)
    save_map(edited, store, version + 1)
    return load_map(spark, store, version + 1)


def shard_records(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records with their shard and a gapless position in it (column ``slot``)."""
    mapped = records.join(F.broadcast(slot_map.drop("bytes")), "virtual_slot")
    return gapless_rank(mapped, ["shard"], ["doc_id", "text_crc32", "size"], "slot")


def shard_loads(slot_map: DataFrame) -> DataFrame:
    """Bytes of each shard and its share of the largest one."""
    sums = slot_map.groupBy("shard").agg(F.sum("bytes").alias("bytes"))
    return sums.withColumn("of_largest", F.col("bytes") / F.max("bytes").over(Window.partitionBy()))


def op8_fixed_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 under the law ``bytes``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    records = staged(hash_into_slots(docs), "slots")
    store = scratch(spark, "slot-map")
    save_map(place_slots(slot_bytes(records), N_SHARDS), store, 1)
    out = shard_records(records, load_map(spark, store, 1))
    return out.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
