"""Operator 2: n-gram Jaccard join, size-aware with light and heavy sets.

Two texts link when their sets of word shingles have a Jaccard similarity of
``percent`` / 100 or more. Sets up to a size boundary are light: all their
subsets of the overlap size that a partner of each possible size demands are
enumerated, and linked sets share one. Larger sets are heavy: a set is dealt
by hash into more parts than linked sets can have differences, so linked sets
agree on a whole part, and the parts' inverted lists are scanned. Sizes are
banded; a set enters the lists of its own band and of the next. Both schemes
lose no link, at any similarity or size. The boundary between them is the one
with the least number of list entries, from the histogram of set sizes.

Members of a list that sizes or parities (a bitmap of each set) show to be too
far apart are not joined; the others are, pair by pair only in short lists,
which gives candidate groups. Inside a group, sets are compared unless they are
connected already. Equal sets are one class throughout. Groups are verified in blocks of bounded
size: a large group is split into blocks, and every two blocks meet in one task.

Defined cases: words are runs without white space (0x20, 0x09-0x0D), A-Z count
as a-z; a text with fewer words than a shingle is one shingle; null and empty
texts have an empty set and no link; rows link by their texts only, so rows that
share a doc_id with different texts are linked no more than others; repeated
rows are one class, and each row of the table is one of the result; rows with a
null doc_id carry links like others, but a component has the least doc_id that
is not null, and null if it has none; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormmart.llm.common import free_memory, staged, text_bytes, tidy
from stormmart.llm.components import components
from stormmart.llm.shingle_sql import components_sql
from stormmart.llm.shingles import mixed, shingle_set, words_of

#: Largest size that may become light.
MAX_LIGHT = 40
#: Text bytes whose sets are made, and list entries packed, at once.
CUT_BYTES = 2_000_000
#: Sets' bytes for each bucket of list entries (by input text).
BUCKET_BYTES = 8_000_000
#: Shingles of a group that one task verifies; larger groups are split into blocks.
BLOCK_SHINGLES = 2_000_000
#: Lists of up to so many sets are joined pair by pair; lists of more than
#: LONG_LIST sets are joined to their least member unseen.
SHORT_LIST = 8
LONG_LIST = 5000
PARITY_BITS = 1024
#: Groups of up to so many sets are compared without lists.
SMALL_GROUP = 12


@dataclass(frozen=True)
class Scheme:
    """Similarity, shingle width and the largest light size."""
    k: int
    percent: int
    light: int = 0

    def partner_sizes(self, n: int) -> range:
        return range(-(-self.percent * n // 100), 100 * n // self.percent + 1)

    def overlap(self, a: int, b: int) -> int:
        """Least intersection of linked sets of these sizes."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def subset_sizes(self, n: int) -> list[int]:
        """Subset sizes that a set of n shows to light partners."""
        if n > 100 * self.light // self.percent:
            return []
        return sorted({self.overlap(n, b) for b in self.partner_sizes(n)
                       if 0 < min(n, b) <= self.light and self.overlap(n, b) <= n})

    def bands(self, n: int) -> list[tuple[int, int]]:
        """(band, its largest size): the band of n and the next one."""
        tops = _band_tops(self.percent, 100 * n // self.percent + 1)
        own = int(np.searchsorted(tops, n))
        return [(own, int(tops[own])), (own + 1, int(tops[own + 1]))]

    def parts(self, top: int) -> tuple[int, int]:
        """Parts of a set in a band up to ``top``, and how many of them may be
        left out because they are empty."""
        differences = (100 - self.percent) * 2 * top // (100 + self.percent)
        spare = differences // 16 + 1
        return differences + 1 + spare, spare

    def links(self, inter: int, a: int, b: int) -> bool:
        return 100 * inter >= self.percent * (a + b - inter)

    def entries(self, n: int) -> tuple[float, float]:
        """List entries of a set of n shingles if it is light, and if it is heavy."""
        as_light = Scheme(self.k, self.percent, n)
        return (sum(math.comb(n, s) for s in as_light.subset_sizes(n)),
                sum(self.parts(top)[0] for _, top in self.bands(n)))


@lru_cache(maxsize=8)
def _tops_to(percent: int, power: int) -> np.ndarray:
    tops = [1]
    while len(tops) < 3 or tops[-3] < 1 << power:
        tops.append(100 * (tops[-1] + 1) // percent)
    return np.array(tops, dtype=np.int64)


def _band_tops(percent: int, size: int) -> np.ndarray:
    return _tops_to(percent, max(20, size.bit_length()))


def with_boundary(scheme: Scheme, sizes: dict[int, int]) -> Scheme:
    """The scheme with the light boundary of the fewest list entries."""
    cost, best, at = 0.0, 0.0, 0
    for n in range(1, MAX_LIGHT + 1):
        light, heavy = scheme.entries(n)
        cost += sizes.get(n, 0) * (light - heavy)
        if cost < best or (cost == best and light <= heavy):
            best, at = cost, n
        if light > 1000:
            break
    return Scheme(scheme.k, scheme.percent, at)


def signatures(sets: np.ndarray, scheme: Scheme) -> np.ndarray:
    """Keys of all inverted lists that a set enters."""
    n = len(sets)
    values = mixed(sets)
    total = values.sum(dtype=np.uint64)
    out = []
    for size in scheme.subset_sizes(n):
        salt = np.uint64(2 * size)
        if size == n:
            sums = np.array([total])
        else:
            away = np.array(list(combinations(range(n), n - size)), dtype=np.int64)
            sums = total - values[away].sum(axis=1, dtype=np.uint64)
        out.append(mixed(sums + mixed(np.array([salt]))))
    if n > scheme.light:
        for band, top in scheme.bands(n):
            parts, spare = scheme.parts(top)
            part = (sets % np.uint64(parts)).astype(np.int64)
            sums = np.zeros(parts, dtype=np.uint64)
            np.add.at(sums, part, values)
            places = np.arange(parts, dtype=np.uint64)
            keys = mixed(sums + mixed(places * np.uint64(4096) + np.uint64(2 * band + 1)))
            filled = np.bincount(part, minlength=parts) > 0
            # Linked sets agree on more than ``spare`` parts, so on one that is
            # not empty unless both have more empty parts than that.
            out.append(keys[filled] if parts - int(filled.sum()) <= spare else keys)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Rows' other columns and their sets, some bytes of text at a time."""
    for batch in batches:
        others = [batch.column(i) for i in range(batch.num_columns - 1)]
        held, texts, size = [], [], 0
        for i, text in enumerate(batch.column(batch.num_columns - 1)):
            texts.append(text.as_py() or b"")
            held.append(i)
            size += len(texts[-1])
            if size >= CUT_BYTES or i == batch.num_rows - 1:
                chosen = pa.array(held)
                yield [c.take(chosen).to_pylist() for c in others], [shingle_set(w, k) for w in words_of(texts)]
                held, texts, size = [], [], 0


def _digest(sets: np.ndarray) -> tuple[int, int]:
    """Two 64-bit values of a set, as signed numbers."""
    a = mixed(sets).sum(dtype=np.uint64)
    b = mixed(sets ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return tuple(int(x) for x in np.array([a, b]).view(np.int64))


def parity(sets: np.ndarray) -> np.ndarray:
    """Parities of the set's elements in cells, as 64-bit words. Two sets differ
    in at least as many elements as their parities in bits. Larger sets have more
    cells, by powers of two, and fold to fewer by xor."""
    bits = PARITY_BITS << max(0, (len(sets) - 1) // PARITY_BITS).bit_length()
    cells = np.bincount((sets >> np.uint64(13)).astype(np.int64) % bits, minlength=bits)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64)


def set_digests(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """doc_id, value of the text, n_shingles, digest (node, check) and parity of
    every row's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids, values), sets in _sets(batches, scheme.k):
            digests = [_digest(s) for s in sets]
            words = [parity(s) for s in sets]
            ends = np.cumsum([0] + [len(w) for w in words], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(values, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                 pa.ListArray.from_arrays(ends, np.concatenate(words))],
                names=["doc_id", "value", "n_shingles", "node", "check", "parity"])

    return _valued(docs).mapInArrow(
        tidy(run), "doc_id long, value long, n_shingles long, node long, check long, parity array<long>")


def _valued(docs: DataFrame) -> DataFrame:
    """doc_id, value of the text, and its bytes."""
    text = text_bytes("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("value"),
                       text.alias("text"))


# Kinds of rows that the inverted lists give.
PAIR, MEMBER, STAR = 0, 1, 2


def _list_rows(keys: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """(kind, u, v) of the lists with two or more members, each once: all pairs
    of a short list, the members of a longer one (u: the value of its member
    set, so that lists with the same members are one), or, of a very long list,
    edges to its least member."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    keys, nodes = keys[new], nodes[new]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    size = np.diff(np.append(first, len(keys)))
    own = np.repeat(first, size)
    length = np.repeat(size, size)
    rows = []
    for d in range(1, SHORT_LIST):
        at = np.flatnonzero((length <= SHORT_LIST) & (np.arange(len(keys)) - own >= d))
        rows.append(np.stack([np.full(len(at), PAIR), nodes[at], nodes[at - d]]))
    value = np.add.reduceat(mixed(nodes.view(np.uint64)), first).view(np.int64) if len(first) else first
    at = np.flatnonzero((length > SHORT_LIST) & (length <= LONG_LIST))
    rows.append(np.stack([np.full(len(at), MEMBER), np.repeat(value, size)[at], nodes[at]]))
    at = np.flatnonzero((length > LONG_LIST) & (own != np.arange(len(keys))))
    rows.append(np.stack([np.full(len(at), STAR), nodes[at], nodes[own[at]]]))
    return np.unique(np.concatenate(rows, axis=1), axis=1)


def list_rows(docs: DataFrame, scheme: Scheme, buckets: int) -> DataFrame:
    """(kind, u, v) of all inverted lists with two or more members."""
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, scheme.k):
            distinct = {_digest(s)[0]: s for s in sets if len(s)}
            keyed = [signatures(s, scheme) for s in distinct.values()]
            if not keyed:
                continue
            nodes = np.repeat(np.fromiter(distinct, dtype=np.int64), [len(x) for x in keyed])
            keys = np.concatenate(keyed)
            bucket = (keys >> np.uint64(20)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            where = [b for b in range(buckets) if edges[b] < edges[b + 1]]
            blobs = [np.stack([keys[o].view(np.int64), nodes[o]]).tobytes()
                     for b in where for o in [order[edges[b]:edges[b + 1]]]]
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(where, pa.int32()),
                                              "entries": pa.array(blobs, pa.binary())})

    def match(table: pa.Table) -> pa.Table:
        entries = np.concatenate([np.frombuffer(b, np.int64).reshape(2, -1)
                                  for b in table.column("entries").to_pylist()], axis=1)
        kind, u, v = _list_rows(entries[0], entries[1])
        free_memory()
        return pa.table({"kind": pa.array(kind, pa.int32()), "u": pa.array(u, pa.int64()),
                         "v": pa.array(v, pa.int64())})

    routed = docs.select(text_bytes("text").alias("text")).mapInArrow(tidy(route), "bucket int, entries binary")
    return routed.groupBy("bucket").applyInArrow(match, "kind int, u long, v long").distinct()


def _near(sizes: np.ndarray, words: np.ndarray, i: int, others: np.ndarray, percent: int) -> np.ndarray:
    """Which of ``others`` can link to set i by size and parity."""
    a, b = sizes[i], sizes[others]
    apart = np.bitwise_count(words[others] ^ words[i]).sum(axis=1, dtype=np.int64)
    return ((100 * np.minimum(a, b) >= percent * np.maximum(a, b))
            & ((100 + percent) * apart <= (100 - percent) * (a + b)))


def possible_edges(rows: DataFrame, nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """Edges (u, v) that connect all sets of a list that can link: sets whose
    sizes, or whose parities, are too far apart have no edge of their own.
    ``nodes``: node, n_shingles and parity of every distinct set."""
    p = scheme.percent
    a = nodes.select(F.col("node").alias("u"), F.col("n_shingles").alias("nu"), F.col("parity").alias("pu"))
    b = nodes.select(F.col("node").alias("v"), F.col("n_shingles").alias("nv"), F.col("parity").alias("pv"))

    def folded(own: str, other: str) -> Column:
        """Parity words as few as the other set's: half of them at most is missing."""
        words, half = F.col(own), (F.size(own) / 2).cast("int")
        both = F.zip_with(F.slice(words, F.lit(1), half), F.slice(words, half + 1, half),
                          lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(own) > F.size(other), both).otherwise(words)

    apart = F.aggregate(F.zip_with(folded("pu", "pv"), folded("pv", "pu"), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                        F.lit(0), lambda s, x: s + x)
    can_link = F.when(100 * F.least("nu", "nv") >= p * F.greatest("nu", "nv"),
                      (100 + p) * apart <= (100 - p) * (F.col("nu") + F.col("nv"))).otherwise(False)
    pairs = rows.where(F.col("kind") == PAIR).join(a, "u").join(b, "v").where(can_link).select("u", "v")
    stars = rows.where(F.col("kind") == STAR).select("u", "v")

    def connect(table: pa.Table) -> pa.Table:
        node = np.array(table.column("v").to_pylist(), dtype=np.int64)
        sizes = np.array(table.column("nv").to_pylist(), dtype=np.int64)
        words = [np.array(w, dtype=np.int64).view(np.uint64) for w in table.column("pv").to_pylist()]
        few = min(map(len, words))
        words = np.stack([np.bitwise_xor.reduce(w.reshape(-1, few), axis=0) for w in words])
        left, u, v = np.arange(len(node)), [], []
        while len(left):
            todo, left = [int(left[0])], left[1:]
            while todo and len(left):
                i = todo.pop()
                near = _near(sizes, words, i, left, p)
                u += node[left[near]].tolist()
                v += [int(node[i])] * int(near.sum())
                todo += left[near].tolist()
                left = left[~near]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    members = rows.where(F.col("kind") == MEMBER).join(b, "v").select("u", "v", "nv", "pv")
    lists = members.groupBy("u").applyInArrow(connect, "u long, v long")
    return pairs.unionByName(stars).unionByName(lists).distinct()


class Clusters:
    """Union-find over the sets of one task."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)


def _linked(a: np.ndarray, b: np.ndarray, scheme: Scheme) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < scheme.percent * len(b):
        return False
    at = np.searchsorted(b, a)
    inter = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return scheme.links(inter, len(a), len(b))


def clusters(sets: list[np.ndarray], scheme: Scheme) -> Clusters:
    """Connected sets of a group. Two sets are compared if they share a list
    (any two in a small group) and are not connected yet."""
    found = Clusters(len(sets))
    if len(sets) <= SMALL_GROUP:
        lists = [list(range(len(sets)))]
    else:
        keyed = [signatures(s, scheme) for s in sets]
        keys = np.concatenate(keyed)
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in keyed])
        order = np.lexsort((owner, keys))
        ends = np.flatnonzero(np.diff(keys[order])) + 1
        lists = sorted((p.tolist() for p in np.split(owner[order], ends) if len(p) > 1), key=len)
    apart: set[tuple[int, int]] = set()

    def meet(a: list[int], b: list[int]) -> bool:
        for x in a:
            for y in b:
                pair = (min(x, y), max(x, y))
                if pair not in apart:
                    if _linked(sets[x], sets[y], scheme):
                        found.union(x, y)
                        return True
                    apart.add(pair)
        return False

    for members in lists:
        by_root: dict[int, list[int]] = {}
        for x in members:
            by_root.setdefault(found.find(x), []).append(x)
        rest = list(by_root.values())
        while len(rest) > 1:
            own, todo = rest.pop(), True
            while todo:
                near = next((g for g in rest if meet(own, g)), None)
                todo = near is not None
                if todo:
                    rest.remove(near)
                    own = own + near
    return found


def linked_classes(docs: DataFrame, classes: DataFrame, groups: DataFrame, scheme: Scheme) -> DataFrame:
    """(node, component_id) of the classes that have a link. ``groups`` has the
    candidate group of every node; a node is in one group."""
    members = staged(groups.join(classes, "node").select(
        "component", "node", "check", "rep", "value", "n_shingles"), "members")
    sizes = members.groupBy("component").agg(F.sum("n_shingles").alias("shingles"), F.count(F.lit(1)).alias("sets"))
    blocks = F.ceil(F.col("shingles") / BLOCK_SHINGLES).cast("int")
    sizes = sizes.where(F.col("sets") > 1).select("component", blocks.alias("blocks"))
    total, parted = members.agg(F.sum("n_shingles")).first()[0] or 0, sizes.where(F.col("blocks") > 1)
    tasks = max(math.ceil(total / BLOCK_SHINGLES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    wanted = members.join(sizes, "component")
    # A block meets every block of its group; groups of one block share tasks.
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    meet = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    wanted = (wanted.withColumn("own", own).withColumn("other", meet)
              .select("node", "check", "rep", "value", "component",
                      F.least("own", "other").cast("int").alias("low"),
                      F.greatest("own", "other").cast("int").alias("high"),
                      F.when(F.col("blocks") > 1, F.col("component"))
                      .otherwise(F.pmod(F.xxhash64("component"), F.lit(tasks))).alias("task")))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()

        def fresh() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = [i for i, node in enumerate(batch.column(0).to_pylist()) if node not in done]
                yield batch.take(pa.array(at, pa.int64()))

        for (nodes, checks, reps, keys), sets in _sets(fresh(), scheme.k):
            rows = []
            for node, check, rep, many, s in zip(nodes, checks, reps, keys, sets):
                # Repeated rows have the same set, and another text of the same value has another.
                if node not in done and _digest(s) == (node, check):
                    done.add(node)
                    rows += [(k["task"], k["low"], k["high"], k["component"], node, rep, s.tobytes()) for k in many]
            cols = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             names=["task", "low", "high", "component", "node", "rep", "shingles"])

    def verify(table: pa.Table) -> pa.Table:
        # By node: a skewed join may deal the rows of one class to several tasks.
        by_group: dict[int, dict[int, tuple]] = {}
        for component, node, rep, shingles in zip(*(table.column(c).to_pylist()
                                                    for c in ("component", "node", "rep", "shingles"))):
            by_group.setdefault(component, {})[node] = (rep, np.frombuffer(shingles, np.uint64))
        rows = []
        for group in by_group.values():
            # The root of connected sets is that with the least representative, nulls last.
            order = sorted(group, key=lambda n: (group[n][0] is None, group[n][0] or 0, n))
            found = clusters([group[n][1] for n in order], scheme)
            for i, node in enumerate(order):
                root = order[found.find(i)]
                if root != node:
                    rows.append((node, root, group[root][0]))
        free_memory()
        cols = list(zip(*rows)) or [()] * 3
        return pa.table({"u": pa.array(cols[0], pa.int64()), "v": pa.array(cols[1], pa.int64()),
                         "component_id": pa.array(cols[2], pa.int64())})

    listed = wanted.groupBy("node", "check", "rep", "value").agg(
        F.collect_list(F.struct("task", "low", "high", "component")).alias("meets"))
    listed = listed.withColumnRenamed("value", "rep_value")
    # The list of representatives grows with the corpus and is never broadcast.
    texts = _valued(docs)
    sets = (texts.join(listed.hint("merge"), texts["doc_id"].eqNullSafe(listed["rep"])
                       & (texts["value"] == listed["rep_value"]))
            .select("node", "check", "rep", "meets", "text")
            .mapInArrow(tidy(sets_of), "task long, low int, high int, component long, node long, rep long, "
                                       "shingles binary"))
    stars = staged(sets.groupBy("task", "low", "high").applyInArrow(verify, "u long, v long, component_id long"),
                   "links")
    if not parted.isEmpty():
        found = staged(components(stars).join(classes.select("node", "rep"), "node"), "parted")
        least = staged(found.groupBy("component").agg(F.min("rep").alias("component_id")), "least")
        return found.join(least, "component").select("node", "component_id")
    # Every group was seen whole, once: each star is a component around its root.
    return (stars.select(F.col("u").alias("node"), "component_id")
            .unionByName(stars.select(F.col("v").alias("node"), "component_id").distinct()))


def near_duplicate_components(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles and component_id (least doc_id in reach) of every row."""
    spark = docs.sparkSession
    digests = staged(set_digests(docs, Scheme(k, percent)), "digests")
    small = digests.where(F.col("n_shingles") <= MAX_LIGHT).groupBy("n_shingles").count().collect()
    scheme = with_boundary(Scheme(k, percent), {r["n_shingles"]: r["count"] for r in small})
    # The representative is a row of the class, by doc_id (nulls last) and text.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "value"))
    classes = (digests.where(F.col("n_shingles") > 0).groupBy("node", "check", "n_shingles")
               .agg(first.alias("row"), F.first("parity").alias("parity")))
    classes = staged(classes.select("node", "check", "n_shingles", F.col("row.doc_id").alias("rep"),
                                    F.col("row.value").alias("value"), "parity"), "classes")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(math.ceil(size / BUCKET_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    nodes = classes.select("node", "n_shingles", "parity")
    groups = components(possible_edges(staged(list_rows(docs, scheme, buckets), "lists"), nodes, scheme))
    linked = linked_classes(docs, classes, groups, scheme)
    reach = classes.join(linked, "node", "left").select(
        "node", "check", F.col("n_shingles").alias("n"), F.coalesce("component_id", "rep").alias("component_id"))
    found = digests.join(reach, (digests["node"] == reach["node"]) & (digests["check"] == reach["check"])
                         & (digests["n_shingles"] == reach["n"]), "left")
    # A set has the least doc_id in reach, which is null if there is none; an empty set has its own.
    return found.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def numbered_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__row``, a number of every row in the order of doc_id (nulls
    last): the doc_id itself where it names one row, else a number made from a sort."""
    own = F.col("doc_id").cast("long")
    ids = docs.agg(F.count(F.lit(1)), F.count(own), F.count_distinct(own)).first()
    if ids[0] == ids[1] == ids[2]:
        return docs.withColumn("__row", own)
    rows = docs.withColumn("__at", F.monotonically_increasing_id())
    rows = rows.orderBy(F.asc_nulls_last("doc_id"), F.xxhash64(text_bytes("text")), "__at")
    return staged(rows.withColumn("__row", F.monotonically_increasing_id()).drop("__at"), "rows")


def one_of_each(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """One row of every component of ``docs``, that with the least doc_id (nulls
    last). Each row is a document of its own: repeated rows are copies, rows that
    share a doc_id or have none go only if another row of their component stays."""
    rows = numbered_rows(docs)
    found = near_duplicate_components(rows.select(F.col("__row").alias("doc_id"), "text"), k, percent)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("__kept"))
    return rows.join(kept, rows["__row"] == kept["__kept"], "left_semi").drop("__row")


def op2_heavy_light_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: 3-word shingles, similarity of 0.9 or more."""
    return near_duplicate_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), 3, 90)


ORACLE_OP2 = components_sql(3, 90)
