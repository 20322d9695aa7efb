"""Operator 7: benchmark decontamination by pigeonhole edit matching.

Both sides are normalised (lower case, words of letters and digits with single
spaces). An item of n characters may differ by ``n // CHARS_PER_ERROR`` edits;
it is split into one piece more than that, so within the budget at least one
piece is found unchanged. One scan of a document finds all piece hits; hits on
nearly the same diagonal form one window, and Myers' bit-parallel distance
decides whether the item occurs in it within its budget.

The items are a stated query set. They are taken in blocks of bounded size,
one pass over the documents for each block; documents are never shuffled.

Defined cases: null and empty texts match nothing; an item without letters and
digits matches nothing; an item too short for an error must occur as whole
words; repeated rows are matched each, and the query reports a (doc_id,
item_id) once with its least distance; items without an item_id count like others
and are reported together, with a null item_id; an empty benchmark or document
table gives no matches; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormmart.llm.common import loaded, tidy

#: One edit is allowed for so many characters of an item.
CHARS_PER_ERROR = 16
#: Characters of items that one pass over the documents looks for.
BLOCK_CHARS = 8_000_000

HITS = "__benchmark_hits"
_HIT_TYPE = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int64())]))

_NOT_WORD = re.compile(r"[\W_]+")
def normalise(text: str | None) -> str:
    return _NOT_WORD.sub(" ", (text or "").lower()).strip()


def myers_distance(pattern: str, text: str, limit: int) -> int | None:
    """Least edit distance of ``pattern`` to any part of ``text``, if at most ``limit``."""
    m = len(pattern)
    peq: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        peq[c] |= 1 << i
    top, mask = 1 << (m - 1), (1 << m) - 1
    vp, vn, score, best = mask, 0, m, m
    for c in text:
        eq = peq.get(c, 0)
        d0 = (((eq & vp) + vp) ^ vp) | eq | vn
        hp = vn | ~(d0 | vp) & mask
        hn = d0 & vp
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        # A match may start anywhere: nothing is carried into the first row.
        hp = (hp << 1) & mask
        hn = (hn << 1) & mask
        vp = (hn | ~(d0 | hp)) & mask
        vn = d0 & hp
        if score < best:
            best = score
    return best if best <= limit else None


def pieces(item: str, chars_per_error: int = CHARS_PER_ERROR) -> list[tuple[int, str]]:
    """(offset, piece): one piece more than the item's error budget."""
    parts = len(item) // chars_per_error + 1
    cuts = [i * len(item) // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class ItemMatcher:
    """All pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int | None, str]], chars_per_error: int):
        import ahocorasick

        self.items = [(i, n) for i, t in items if (n := normalise(t))]
        self.budgets = [len(n) // chars_per_error for _, n in self.items]
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, n) in enumerate(self.items):
            for offset, piece in pieces(n, chars_per_error) if self.budgets[k] else [(0, f" {n} ")]:
                where[piece].append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def find(self, text: str | None) -> list[tuple[int | None, int]]:
        """(item_id, distance) of all items that the text holds."""
        if self.empty or not text:
            return []
        doc = f" {normalise(text)} "
        diagonals: dict[int, list[int]] = defaultdict(list)
        for end, (size, places) in self.automaton.iter(doc):
            for k, offset in places:
                diagonals[k].append(end - size + 1 - offset)
        found = []
        for k, starts in diagonals.items():
            item_id, item = self.items[k]
            if not self.budgets[k]:
                found.append((item_id, 0))
                continue
            best = self._verify(doc, item, self.budgets[k], sorted(set(starts)))
            if best is not None:
                found.append((item_id, best))
        return found

    @staticmethod
    def _verify(doc: str, item: str, budget: int, starts: list[int]) -> int | None:
        best: int | None = None
        i = 0
        while i < len(starts) and best != 0:
            first = last = starts[i]
            while i < len(starts) and starts[i] - last <= 2 * budget:
                last = starts[i]
                i += 1
            window = doc[max(0, first - budget):last + len(item) + budget]
            got = 0 if item in window else myers_distance(item, window, budget if best is None else best)
            if got is not None and (best is None or got < best):
                best = got
        return best


def _matcher(items: list[tuple[int | None, str]], chars_per_error: int) -> ItemMatcher:
    return loaded("matcher", (hash(tuple(items)), chars_per_error), lambda: ItemMatcher(items, chars_per_error))


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of about ``block_chars`` characters, one at a time."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(chars / block_chars))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for b in range(n):
        rows = items.where(block == b).distinct().collect()
        if rows:
            yield sorted(((r["item_id"], r["text"]) for r in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def with_hits(docs: DataFrame, items: list[tuple[int | None, str]],
              chars_per_error: int = CHARS_PER_ERROR) -> DataFrame:
    """``docs`` with one more column: the block's items that the text holds."""
    schema = docs.schema
    out = F.struct(F.lit(None).cast("long").alias("item_id"), F.lit(0).cast("long").alias("distance"))
    hit_field = docs.sparkSession.range(0).select(F.array(out).alias(HITS)).schema.fields[0]
    full = type(schema)([*schema.fields, hit_field])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _matcher(items, chars_per_error).find
        for batch in batches:
            hits = [[{"item_id": i, "distance": d} for i, d in find(t.as_py())] for t in batch.column(at)]
            arrays = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(hits, _HIT_TYPE)],
                                             names=[f.name for f in full.fields])

    return docs.mapInArrow(tidy(run, "matcher"), full)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance) of every document and item within the budget."""
    found = None
    for items in item_blocks(benchmark):
        hits = with_hits(docs.select("doc_id", "text"), items)
        rows = hits.select("doc_id", F.explode(HITS).alias("h")).select("doc_id", "h.item_id", "h.distance")
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        found = docs.select("doc_id", F.lit(None).cast("long").alias("item_id"),
                            F.lit(0).cast("long").alias("distance")).where(F.lit(False))
    return found.groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no benchmark item."""
    for items in item_blocks(benchmark):
        docs = with_hits(docs, items).where(F.size(HITS) == 0).drop(HITS)
    return docs


def op7_pigeonhole_edit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return benchmark_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
