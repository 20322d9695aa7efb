"""Operator 10: removal of repeated byte strings by interval expansion on a
Burrows-Wheeler order.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier:
in a document before (by doc_id), or earlier in the same one. Strings are
judged on the input and never cross documents.

Equal strings must meet in one task. Each string of ``LENGTH`` bytes has a
signpost, its least ``GRAM``-byte gram in a fixed pseudo-random order; equal
strings have the same one at the same place. Neighbouring strings with one
signpost are kept as one segment of text, so every string is in exactly one
segment. Segments go to the bucket of their signpost, packed into a few
compressed rows per task and bucket. Grams that are frequent in a sample come
last in the order, so that common lines do not become signposts; the sample
changes only how work is spread, not the result.

Segments with equal bytes are joined before the shuffle and again behind it:
the earliest stays, the others are covered wholly. Where a signpost is left with
different segments, ``bwt.prefix_classes`` finds which of their strings are
equal. Covered runs then go back to their documents.

Defined cases: a null or empty text has no bytes and nothing removed; null
doc_ids come last; several rows with one doc_id are ordered by their text, and
equal rows (doc_id and text) are one document, so they remove nothing from each
other; an empty table gives no rows; further columns are ignored by the query
and kept by ``dedup_texts``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from stormmart.llm.bwt import prefix_classes
from stormmart.llm.common import free_memory, staged, text_bytes, tidy

LENGTH = 100
GRAM = 16
#: Strings that can share a signpost, and bytes of the longest segment.
REACH = LENGTH - GRAM + 1
WIDEST = LENGTH + REACH - 1
#: Text bytes that are cut into segments at once, and whose equal segments are joined.
CUT_BYTES = 1_000_000
FLUSH_BYTES = 4_000_000
#: Text bytes whose segments a task holds, in order of buckets, before it packs a
#: row for each bucket: rows of little content cost the more, the more buckets are.
PACK_BYTES = 12_000_000
#: Segments whose bytes are laid out in rows at once.
ROWS_AT_ONCE = 16_384
#: Text bytes for each bucket of signposts.
BUCKET_BYTES = 8_000_000
#: Segment bytes whose order is made at once (more if one signpost has more).
ORDER_BYTES = 400_000
#: Documents of the sample that tells frequent grams, and how often these occur.
SAMPLE_DOCS = 4000
FREQUENT = 8
FREQUENT_BITS = 20

_RNG = np.random.default_rng(20240229)
_BYTE32 = _RNG.integers(1, 1 << 32, 256, dtype=np.uint32)
_WORDS = _RNG.integers(1, 1 << 63, -(-WIDEST // 8), dtype=np.uint64) | np.uint64(1)
_ODD64 = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """Pseudo-random 32-bit value of the GRAM bytes from every position on."""
    h = _BYTE32[text]
    step, factor = 1, np.uint32(0x01000193)
    while step < GRAM:
        h = h[:-step] * factor + h[step:]
        factor = np.uint32((int(factor) * int(factor)) & 0xFFFFFFFF)
        step *= 2
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(12)
    return h


def signposts(text: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Position of the signpost of the string that starts at every position."""
    h = gram_hashes(text)
    late = frequent[h >> np.uint32(32 - FREQUENT_BITS)]
    order = ((h >> np.uint32(1)) | (late.astype(np.uint32) << np.uint32(31))).astype(np.uint64)
    order <<= np.uint64(32)
    order |= np.arange(len(order), dtype=np.uint64)
    span = 1
    while 2 * span <= REACH:
        order = np.minimum(order[:-span], order[span:])
        span *= 2
    if span < REACH:
        order = np.minimum(order[:-(REACH - span)], order[REACH - span:])
    return (order & np.uint64(0xFFFFFFFF)).astype(np.int64)


def rows_at(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Matrix of the bytes from each start on, zero beyond its length."""
    padded = np.zeros(len(flat) + width, dtype=np.uint8)
    padded[:len(flat)] = flat
    rows = np.lib.stride_tricks.sliding_window_view(padded, width)[starts]
    return rows * (np.arange(width) < lengths[:, None])


def row_blocks(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
               width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Matrices of the bytes from some starts on, and which of these lie within their lengths."""
    padded = np.zeros(len(flat) + width, dtype=np.uint8)
    padded[:len(flat)] = flat
    windows, places = np.lib.stride_tricks.sliding_window_view(padded, width), np.arange(width)
    for i in range(0, len(starts), ROWS_AT_ONCE):
        some = slice(i, i + ROWS_AT_ONCE)
        yield windows[starts[some]], places < lengths[some, None]


def row_hashes(rows: np.ndarray) -> np.ndarray:
    """64-bit value of every matrix row."""
    width = -(-rows.shape[1] // 8) * 8
    if width != rows.shape[1]:
        rows = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
    words = np.ascontiguousarray(rows).view("<u8")
    mixed = (words ^ (words >> np.uint64(31))) * _WORDS[:words.shape[1]]
    mixed ^= mixed >> np.uint64(29)
    mixed *= _ODD64
    total = mixed.sum(axis=1, dtype=np.uint64)
    total ^= total >> np.uint64(32)
    return total * _ODD64


def hashes_at(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """64-bit value of the bytes from each start on."""
    return np.concatenate([np.zeros(0, dtype=np.uint64), *(
        row_hashes(rows * inside) for rows, inside in row_blocks(flat, starts, lengths, width))])


@cache
def _zstandard() -> tuple:
    """Compressor and decompressor of packed segments; making one for each costs
    as much as a small row takes."""
    import zstandard

    return zstandard.ZstdCompressor(level=6), zstandard.ZstdDecompressor()


class Segments:
    """Segments of text: document, start there, signpost's place and bytes."""

    FIELDS = ("doc", "start", "length", "post")

    def __init__(self, doc, start, length, post, flat):
        self.doc, self.start, self.length, self.post, self.flat = doc, start, length, post, flat
        self.at = np.cumsum(length, dtype=np.int64) - length

    def __len__(self) -> int:
        return len(self.doc)

    def take(self, chosen: np.ndarray) -> Segments:
        length = self.length[chosen]
        flat = np.concatenate([np.zeros(0, dtype=np.uint8), *(
            rows[inside] for rows, inside in row_blocks(self.flat, self.at[chosen], length, WIDEST))])
        return Segments(self.doc[chosen], self.start[chosen], length, self.post[chosen], flat)

    def between(self, begin: int, end: int) -> Segments:
        """One or more segments that lie side by side; their bytes are not copied."""
        flat = self.flat[self.at[begin]:self.at[end - 1] + self.length[end - 1]]
        return Segments(*(getattr(self, f)[begin:end] for f in Segments.FIELDS), flat)

    @staticmethod
    def joined(parts: list[Segments]) -> Segments:
        return Segments(*(np.concatenate([getattr(p, f) for p in parts])
                          for f in (*Segments.FIELDS, "flat")))

    def keys(self) -> np.ndarray:
        """Value of the signpost's bytes."""
        full = np.full(len(self), GRAM)
        return hashes_at(self.flat, self.at + self.post, full, GRAM)

    def contents(self) -> np.ndarray:
        """Value of the whole bytes, length and signpost's place."""
        own = (self.length * 256 + self.post).astype(np.uint64) * _ODD64
        return hashes_at(self.flat, self.at, self.length, WIDEST) ^ own

    def packed(self) -> bytes:
        head = np.array([len(self)], dtype="<i8").tobytes()
        # Numbers byte by byte, documents as differences: they compress better.
        numbers = [x.astype("<i8").view("u1").reshape(-1, 8).T
                   for x in (np.diff(self.doc, prepend=np.int64(0)), self.start)]
        cols = (*numbers, self.length.astype("u1"), self.post.astype("u1"), self.flat)
        return _zstandard()[0].compress(head + b"".join(c.tobytes() for c in cols))

    @staticmethod
    def unpacked(blob: bytes) -> Segments:
        raw = _zstandard()[1].decompress(blob)
        n, at = int(np.frombuffer(raw, "<i8", 1)[0]), 8
        cols = []
        for size in (8, 8, 1, 1):
            part = np.frombuffer(raw, "u1", n * size, at).reshape(size, n)
            cols.append(np.ascontiguousarray(part.T).view("<i8").ravel() if size == 8 else part[0].astype(np.int64))
            at += n * size
        return Segments(np.cumsum(cols[0]), *cols[1:], np.frombuffer(raw, "u1", offset=at))

    def joined_copies(self) -> tuple[Segments, np.ndarray]:
        """The earliest of every group of equal segments, in order of document
        and start; and indices of the others, which are covered wholly."""
        order = np.lexsort((self.start, self.doc))
        _, first, group = np.unique(self.contents()[order], return_index=True, return_inverse=True)
        earliest = order[first]
        later = np.ones(len(self), dtype=bool)
        later[earliest] = False
        ahead = np.empty(len(self), dtype=np.int64)
        ahead[order] = earliest[group]
        # The same place read twice (equal rows of the table) covers nothing.
        later &= (self.doc != self.doc[ahead]) | (self.start != self.start[ahead])
        return self.take(order[np.sort(first)]), np.flatnonzero(later)


def cut(doc: np.ndarray, start: np.ndarray, texts: list[bytes], frequent: np.ndarray) -> Segments:
    """Segments of texts that start at ``start`` of their documents. Texts that
    follow each other in a document overlap by LENGTH - 1 bytes."""
    flat = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    post = signposts(flat, frequent)
    for e in ends[:-1]:
        post[max(0, e - LENGTH + 1):e] = -1
    edges = np.flatnonzero(post[1:] != post[:-1]) + 1
    first = np.concatenate([[0], edges])
    last = np.concatenate([edges, [len(post)]]) - 1
    chosen = post[first] >= 0
    first, last = first[chosen], last[chosen]
    owner = np.searchsorted(ends, first, side="right")
    length = last - first + LENGTH
    place = post[first] - first
    rows = rows_at(flat, first, length, WIDEST)
    return Segments(doc[owner], start[owner] + first - (ends - sizes)[owner], length, place,
                    rows[np.arange(WIDEST) < length[:, None]])


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes]]:
    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        text = text.as_py() or b""
        for at in range(0, max(0, len(text) - LENGTH + 1), CUT_BYTES):
            yield doc, at, text[at:at + CUT_BYTES + LENGTH - 1]


def _flushes(batches: Iterator[pa.RecordBatch], frequent: np.ndarray) -> Iterator[Segments]:
    """Segments of about FLUSH_BYTES of text at a time."""
    held, doc, start, texts, size, total = [], [], [], [], 0, 0

    def segments() -> Segments:
        return cut(np.array(doc, dtype=np.int64), np.array(start, dtype=np.int64), texts, frequent)

    for batch in batches:
        for d, at, text in _chunks(batch):
            doc.append(d)
            start.append(at)
            texts.append(text)
            size += len(text)
            if size >= CUT_BYTES:
                held.append(segments())
                total += size
                doc, start, texts, size = [], [], [], 0
                if total >= FLUSH_BYTES:
                    yield Segments.joined(held)
                    held, total = [], 0
    if texts:
        held.append(segments())
    if held:
        yield Segments.joined(held)


RUNS = "doc long, from_byte long, to_byte long"


def joined_runs(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Runs (doc, from, to) of segments, as one where they meet or overlap: those of
    a copied text are a single run. Of two segments of a document, the one that
    starts later also ends later."""
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    heads = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (begin[1:] > end[:-1]))[:len(doc)])
    return np.stack([doc[heads], begin[heads], end[np.append(heads[1:], len(doc))[:len(heads)] - 1]])


def _routed(buckets: int, frequent: np.ndarray):
    def packed(held: list[tuple[Segments, list[int]]], runs: list[np.ndarray]) -> pa.RecordBatch:
        where, blobs = [], []
        for b in range(buckets):
            parts = [s.between(edges[b], edges[b + 1]) for s, edges in held if edges[b] < edges[b + 1]]
            if parts:
                where.append(b)
                blobs.append(Segments.joined(parts).packed())
        # Runs that are known already travel along, some with each bucket.
        known = [x.astype("<i8").tobytes() for x in np.array_split(np.concatenate(runs, axis=1), len(blobs), axis=1)]
        return pa.RecordBatch.from_pydict(
            {"bucket": pa.array(where, pa.int32()), "segments": pa.array(blobs, pa.binary()),
             "runs": pa.array(known, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, runs = [], []
        for segments in _flushes(batches, frequent):
            distinct, later = segments.joined_copies()
            bucket = (distinct.keys() >> np.uint64(33)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            held.append((distinct.take(order), np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()))
            runs.append(joined_runs(segments.doc[later], segments.start[later],
                                    segments.start[later] + segments.length[later]))
            if len(held) * FLUSH_BYTES >= PACK_BYTES:
                yield packed(held, runs)
                held, runs = [], []
        if held:
            yield packed(held, runs)
    return run


def _with_partner(values: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    _, back, counts = np.unique(values, return_inverse=True, return_counts=True)
    return counts[back] > 1


def covered_strings(segments: Segments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (doc, from, to) of bytes in strings that an earlier one equals.
    ``segments`` are distinct, in order of document and start."""
    size = segments.length + 1
    at = np.cumsum(size) - size
    text = np.zeros(int(size.sum()), dtype=np.uint8)
    inside = np.ones(len(text), dtype=bool)
    inside[at + segments.length] = False
    text[inside] = segments.flat
    classes = prefix_classes(text, LENGTH)
    strings = segments.length - LENGTH + 1
    where = np.repeat(at - (np.cumsum(strings) - strings), strings) + np.arange(int(strings.sum()))
    owner = np.repeat(np.arange(len(segments)), strings)
    own = classes[where]
    earliest = np.zeros(int(classes.max()) + 1, dtype=np.int64)
    earliest[own[::-1]] = where[::-1]
    hit = earliest[own] != where
    where, owner = where[hit], owner[hit]
    if not len(where):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty
    head = np.ones(len(where), dtype=bool)
    head[1:] = (where[1:] != where[:-1] + 1) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(head)
    tails = np.append(heads[1:], len(where)) - 1
    own = owner[heads]
    start = segments.start[own] + where[heads] - at[own]
    return segments.doc[own], start, start + (where[tails] - where[heads]) + LENGTH


def _batches(keys: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Indices of whole signpost groups with about ORDER_BYTES of text each."""
    order = np.argsort(keys, kind="stable")
    ends = np.append(np.flatnonzero(np.diff(keys[order])) + 1, len(order))
    filled = np.cumsum(lengths[order])
    begin = 0
    while begin < len(order):
        goal = (filled[begin - 1] if begin else 0) + ORDER_BYTES
        fitting = ends[(ends > begin) & (filled[ends - 1] <= goal)]
        end = int(fitting[-1]) if len(fitting) else int(ends[ends > begin][0])
        yield np.sort(order[begin:end])
        begin = end


def bucket_runs(table: pa.Table) -> pa.Table:
    """Covered runs of one bucket of signposts."""
    runs = [np.frombuffer(r, "<i8").reshape(3, -1) for r in table.column("runs").to_pylist() if r]
    segments = Segments.joined([Segments.unpacked(b) for b in table.column("segments").to_pylist()])
    segments = segments.take(np.flatnonzero(_with_partner(segments.keys())))
    if len(segments):
        copies = segments
        segments, later = copies.joined_copies()
        runs.append(np.stack([copies.doc[later], copies.start[later],
                              copies.start[later] + copies.length[later]]))
    if len(segments):
        # Strings that are equal agree on the signpost and on half of the bytes
        # beside it, to its left or to its right: a segment without a partner
        # in both cannot hold one.
        keys, half = segments.keys(), (LENGTH - GRAM) // 2
        span = np.full(len(segments), GRAM + half)
        left, right = segments.post >= half, segments.length - segments.post >= GRAM + half
        partner = np.zeros(len(segments), dtype=bool)
        for side, begin in ((left, segments.at + segments.post - half), (right, segments.at + segments.post)):
            found = _with_partner(hashes_at(segments.flat, begin[side], span[side], GRAM + half))
            partner[np.flatnonzero(side)[found]] = True
        chosen = np.flatnonzero(partner)
        segments, keys = segments.take(chosen), keys[chosen]
        for part in _batches(keys, segments.length):
            runs.append(np.stack(covered_strings(segments.take(part))))
    doc, begin, end = np.concatenate(runs, axis=1) if runs else np.zeros((3, 0), dtype=np.int64)
    return pa.table({"doc": pa.array(doc, pa.int64()), "from_byte": pa.array(begin, pa.int64()),
                     "to_byte": pa.array(end, pa.int64())})


def _bucket(table: pa.Table) -> pa.Table:
    try:
        return bucket_runs(table)
    finally:
        free_memory()


def frequent_grams(texts: DataFrame) -> np.ndarray:
    """Table of gram values that occur in FREQUENT or more sampled documents."""
    n = texts.count()
    share = min(1.0, SAMPLE_DOCS / max(n, 1))
    picked = texts.where(F.pmod(F.xxhash64("doc"), F.lit(1_000_000)) < int(share * 1_000_000))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.zeros(1 << FREQUENT_BITS, dtype=np.int64)
            for text in batch.column(0):
                data = np.frombuffer(text.as_py() or b"", dtype=np.uint8)
                if len(data) >= GRAM:
                    counts[np.unique(gram_hashes(data) >> np.uint32(32 - FREQUENT_BITS))] += 1
            slots = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots, pa.int64()), pa.array(counts[slots], pa.int64())], names=["slot", "n"])

    # At most 2 ** FREQUENT_BITS slots, whatever the corpus.
    found = (picked.select("text").mapInArrow(tidy(values), "slot long, n long")
             .groupBy("slot").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
             .select("slot").toArrow().column(0).to_numpy())
    table = np.zeros(1 << FREQUENT_BITS, dtype=bool)
    table[found] = True
    return table


def numbered_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__doc``, a number in the order of documents: the doc_id
    itself where it names one row, else a number made from a sort."""
    ids = docs.agg(F.count(F.lit(1)), F.count("doc_id"), F.count_distinct("doc_id")).first()
    if ids[0] == ids[1] == ids[2]:
        return docs.withColumn("__doc", F.col("doc_id").cast("long"))
    value = F.xxhash64(text_bytes("text"))
    order = staged(docs.select("doc_id", value.alias("__value")).distinct()
                   .orderBy(F.asc_nulls_last("doc_id"), "__value")
                   .withColumn("__doc", F.monotonically_increasing_id()), "doc-order")
    order = order.withColumnRenamed("doc_id", "__id").withColumnRenamed("__value", "__v")
    return docs.join(order, docs["doc_id"].eqNullSafe(order["__id"])
                     & (value == order["__v"])).drop("__id", "__v")


def covered_runs(numbered: DataFrame) -> DataFrame:
    """Byte runs to remove of every document that has some: doc and an array."""
    spark = numbered.sparkSession
    texts = numbered.select(F.col("__doc").alias("doc"), text_bytes("text").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(math.ceil(size / BUCKET_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    frequent = spark.sparkContext.broadcast(np.packbits(frequent_grams(texts)))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _routed(buckets, np.unpackbits(frequent.value).astype(bool))(batches)

    routed = texts.mapInArrow(tidy(route), "bucket int, segments binary, runs binary")
    runs = routed.groupBy("bucket").applyInArrow(
        _bucket, RUNS)
    return runs.groupBy("doc").agg(F.collect_list(F.struct("from_byte", "to_byte")).alias("__runs"))


def kept_parts(text: bytes, runs: list[dict]) -> tuple[list[bytes], int]:
    """What is left of a text, and the number of maximal removed runs."""
    parts, at, spans = [], 0, 0
    end = -1
    for begin, to in sorted((r["from_byte"], r["to_byte"]) for r in runs):
        if begin > end:
            spans += 1
            parts.append(text[at:begin])
            end = to
        else:
            end = max(end, to)
        at = end
    parts.append(text[at:])
    return parts, spans


def _with_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__text``, the compressed bytes of ``text`` in its place, and
    ``__runs``: whole texts cross the network once, compressed."""
    numbered = numbered_texts(docs)
    others = [c for c in numbered.columns if c != "text"]
    schema = StructType([*(numbered.schema[c] for c in others), StructField("__text", BinaryType())])

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        small = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = [None if t.as_py() is None else small(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(texts, pa.binary())],
                names=schema.names)

    packed = (numbered.select(*others, F.encode("text", "UTF-8").alias("__text"))
              .mapInArrow(tidy(compress), schema))
    return packed.join(covered_runs(numbered).withColumnRenamed("doc", "__doc"), "__doc", "left")


def _kept(batch: pa.RecordBatch) -> Iterator[tuple[bytes | None, bytes, int]]:
    """Per row: whole text, what is left of it, and removed runs."""
    import zstandard

    whole = zstandard.ZstdDecompressor().decompress
    for packed, runs in zip(batch.column("__text"), batch.column("__runs")):
        text = None if packed.as_py() is None else whole(packed.as_py())
        kept, spans = kept_parts(text or b"", runs.as_py() or [])
        yield text, b"".join(kept), spans


REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def removal_report(docs: DataFrame) -> DataFrame:
    """Per document: bytes, removed bytes and runs, and the digest of the rest."""
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(text or b""), len(text or b"") - len(rest), spans, hashlib.sha256(rest).hexdigest())
                    for text, rest, spans in _kept(batch)]
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, [pa.int64()] * 3 + [pa.string()]))],
                names=[x.split()[0] for x in REPORT.split(", ")])

    joined = _with_runs(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return joined.select("doc_id", "__text", "__runs").mapInArrow(tidy(report), REPORT)


def dedup_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text``; what a cut leaves of a
    character goes too. Other columns stay as they are."""
    columns = docs.columns

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if text is None else left.decode("utf-8", "ignore") for text, left, _ in _kept(batch)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns],
                names=columns)

    return _with_runs(docs).mapInArrow(tidy(rest), docs.schema)


def op10_interval_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated strings of 100 bytes remove from every document."""
    return removal_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
