"""Operator 12: near-duplicates by a chosen-path set similarity join.

Two texts link when their sets of word shingles have a Jaccard similarity of
``percent`` / 100 or more. A set shows ``POSITIONS`` minwise tokens. A tree
branches recursively: a node chooses one or two positions by its own name (in
the mean 1 / similarity of them) and sends every member, for each chosen
position, to the child named by the member's token there. Linked sets agree on a
token with at least the similarity, so the mean number of children that they
share is at least one at any depth, while others part. Small nodes are compared
exhaustively, and independent trees are repeated until a pair of just the
similarity is met with probability 1 - ``MISS`` at the deepest level reached.

The trees grow breadth-first, all at once, as tables of (node name, set). Only
components are asked for, so sets that are connected already need no comparison:
a node whose members are all connected is closed, and the size of a node is that
of its members outside its largest component. Those meet all members, in blocks.
A large node first links its members within blocks, along a spanning tree of the
nearest, each block with the node's least member in it; this contracts groups of
copies, and the node branches if that leaves it large. Before the trees, the same
is done once for the nodes of the first ``FIRST_TREES``.

What moves is kept small: a comparison gets the low bytes of the tokens and the
parity, not the tokens, and deeper levels read a table of the classes in large
nodes, not all classes. Otherwise every level would shuffle the whole table.

Compared are 8-bit tokens and parities: pairs that agree on fewer than
``agreeing`` positions are left out, which a linked pair does with a probability
below 1e-9, and those whose parities (a bitmap of each set, folded to one size)
differ in more bits than linked sets have differences, which never loses a link.
All others are confirmed on the full sets of their texts. Equal sets are one class.

Defined cases: words are runs without white space (0x20, 0x09-0x0D), A-Z count
as a-z; a text with fewer words than a shingle is one shingle; null and empty
texts have an empty set and no link; repeated rows are one class, and each row of
the table is one of the result; rows with a null doc_id carry links like others,
but a component has the least doc_id that is not null, and null if it has none,
in which case they are kept; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormmart.llm.common import groups_of, staged, text_bytes, tidy
from stormmart.llm.components import components
from stormmart.llm.shingle_sql import components_sql
from stormmart.llm.shingles import mixed, shingle_set, words_of

POSITIONS = 128
#: Chance that no tree brings a pair of just the similarity together.
MISS = 1e-6
#: Members outside the largest component up to which a node is compared.
SMALL_NODE = 4000
FIRST_TREES = 2
#: Depth that the number of trees is made for at first; deeper trees bring more.
FIRST_DEPTH = 4
#: Shingles of the partners of one set that are confirmed by one task.
TASK_SHINGLES = 2_000_000
#: Bits of the parity of a set of up to so many shingles; larger sets have more.
PARITY_BITS = 1024
#: Links that one task writes when they are connected.
EDGES_PER_TASK = 200_000
#: Rows that name the texts to confirm up to which they are broadcast (some 40 MB);
#: more are joined by a shuffle of the texts.
BROADCAST_ROWS = 500_000
#: Text bytes whose sets are made at once.
CUT_BYTES = 2_000_000

_RNG = np.random.default_rng(120)
_FACTORS = _RNG.integers(1, 1 << 62, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def meeting_chance(depth: int, similarity: float) -> float:
    """Chance that one tree keeps a pair of this similarity together to ``depth``."""
    two = 1 / similarity - 1
    met = 1.0
    for _ in range(depth):
        agree = similarity * met
        met = (1 - two) * agree + two * (1 - (1 - agree) ** 2)
    return met


def trees_for(depth: int, similarity: float, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - meeting_chance(depth, similarity)))


def agreeing(similarity: float) -> int:
    """Positions that linked sets agree on, but for six and more deviations."""
    return math.floor(POSITIONS * similarity - 6.2 * math.sqrt(POSITIONS * similarity * (1 - similarity)))


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """The minwise tokens (sets x POSITIONS, 32 bits) of sets that aren't empty."""
    out = np.empty((len(sets), POSITIONS), dtype=np.uint32)
    if sets:
        values = np.concatenate(sets)
        starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
        for i, factor in enumerate(_FACTORS):
            out[:, i] = mixed(np.minimum.reduceat(values * factor, starts)) >> np.uint64(32)
    return out


def parity(shingles: np.ndarray) -> bytes:
    """Parities of the number of elements in cells. Two sets differ in at least as
    many elements as their parities in bits. The cells are a power of two, so a
    larger bitmap folds to a smaller one by xor of its halves."""
    bits = PARITY_BITS << max(0, (len(shingles) - 1) // PARITY_BITS).bit_length()
    cells = np.bincount((shingles >> np.uint64(13)).astype(np.int64) % bits, minlength=bits)
    return np.packbits((cells & 1).astype(np.uint8)).tobytes()


class Distances:
    """How far apart the sets of a block are at least, by their parities."""

    def __init__(self, parities: list[bytes]):
        self.words = np.array([len(p) for p in parities]) // 8
        self.place = np.zeros(len(parities), dtype=np.int64)
        self.grids: dict[int, np.ndarray] = {}
        for w in np.unique(self.words):
            at = np.flatnonzero(self.words == w)
            self.place[at] = np.arange(len(at))
            self.grids[int(w)] = np.frombuffer(b"".join([parities[i] for i in at]), dtype=np.uint64).reshape(len(at), -1)

    @staticmethod
    def _folded(grid: np.ndarray, words: int) -> np.ndarray:
        while grid.shape[-1] > words:
            half = grid.shape[-1] // 2
            grid = grid[..., :half] ^ grid[..., half:]
        return grid

    def of(self, i: int, others: np.ndarray) -> np.ndarray:
        out = np.zeros(len(others), dtype=np.int64)
        own = self.grids[int(self.words[i])][self.place[i]]
        for w in np.unique(self.words[others]):
            at = np.flatnonzero(self.words[others] == w)
            words = min(int(w), len(own))
            theirs = self._folded(self.grids[int(w)][self.place[others[at]]], words)
            out[at] = np.bitwise_count(theirs ^ self._folded(own, words)).sum(axis=1, dtype=np.int64)
        return out


def planes(tokens: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """The low bytes of each row's tokens, and their other bytes."""
    split = np.ascontiguousarray(tokens, dtype="<u4").view(np.uint8).reshape(-1, POSITIONS, 4)
    return ([row.tobytes() for row in split[:, :, 0]], [row.tobytes() for row in split[:, :, 1:]])


def low_bytes(shown: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The 8-bit tokens (rows x POSITIONS) in front of the parities."""
    return np.frombuffer(b"".join([t[:POSITIONS] for t in shown.to_pylist()]), dtype=np.uint8).reshape(-1, POSITIONS)


def whole_tokens(shown: pa.Array | pa.ChunkedArray, rest: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The tokens that ``planes`` has split."""
    low = low_bytes(shown)
    split = np.empty((len(low), POSITIONS, 4), dtype=np.uint8)
    split[:, :, 0] = low
    split[:, :, 1:] = np.frombuffer(b"".join(rest.to_pylist()), dtype=np.uint8).reshape(-1, POSITIONS, 3)
    return split.view("<u4").reshape(-1, POSITIONS)


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit values of a set, as signed numbers."""
    sums = [mixed(shingles ^ np.uint64(salt)).sum(dtype=np.uint64) for salt in (0x51ED2701, 0xA0B428DB << 20)]
    return tuple(int(x) for x in np.array(sums).view(np.int64))


def _sets(batch: pa.RecordBatch, at: int, k: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Rows and the sets of their texts (bytes, column ``at``), some at a time."""
    rows, texts, size = [], [], 0
    for i, text in enumerate(batch.column(at)):
        rows.append(i)
        texts.append(text.as_py() or b"")
        size += len(texts[-1])
        if size >= CUT_BYTES:
            yield rows, [shingle_set(w, k) for w in words_of(texts)]
            rows, texts, size = [], [], 0
    if rows:
        yield rows, [shingle_set(w, k) for w in words_of(texts)]


def _valued(docs: DataFrame) -> DataFrame:
    """doc_id, value of the text, and its bytes."""
    text = text_bytes("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("value"),
                       text.alias("text"))


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, value of the text, n_shingles, the set's digest (node, check) and
    minwise tokens of every row: their low bytes with the parity behind them
    (shown), and their other bytes (rest)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, sets in _sets(batch, 2, k):
                own = batch.take(pa.array(rows, pa.int64()))
                digests = np.array([_digest(s) for s in sets], dtype=np.int64).reshape(-1, 2)
                full = [i for i, s in enumerate(sets) if len(s)]
                shown: list[bytes | None] = [None] * len(sets)
                rest = list(shown)
                for i, low, others in zip(full, *planes(minwise([sets[i] for i in full]))):
                    shown[i], rest[i] = low + parity(sets[i]), others
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array(shown, pa.binary()),
                     pa.array(rest, pa.binary())],
                    names=["doc_id", "value", "n_shingles", "node", "check", "shown", "rest"])

    return _valued(docs).mapInArrow(
        tidy(run), "doc_id long, value long, n_shingles long, node long, check long, shown binary, rest binary")


def root(tree: int) -> int:
    return int(mixed(np.array([tree + 1], dtype=np.uint64)).view(np.int64)[0])


def children(rows: DataFrame, similarity: float, roots: list[int] | None = None) -> DataFrame:
    """key, node and component of the next level. ``rows``: key, node, component,
    shown and rest; without a key column, every row begins at all ``roots``."""
    two = np.uint64(int((1 / similarity - 1) * 2 ** 32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = whole_tokens(batch.column("shown"), batch.column("rest"))
            node, component = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "component"))
            for parent in roots if roots is not None else [None]:
                key = (batch.column("key").to_numpy(zero_copy_only=False) if parent is None
                       else np.full(len(node), parent)).astype(np.int64).view(np.uint64)
                choice = mixed(key + np.uint64(0x9E3779B9))
                first = choice % np.uint64(POSITIONS)
                # The second position, where there is one, is another.
                second = (first + np.uint64(1) + (choice >> np.uint64(8)) % np.uint64(POSITIONS - 1)) % np.uint64(POSITIONS)
                more = np.flatnonzero((choice >> np.uint64(32)) < two)
                for position, at in ((first, np.arange(len(node))), (second, more)):
                    place = position[at]
                    own = tokens[at, place.astype(np.int64)].astype(np.uint64)
                    name = mixed(mixed(key[at] + place) + own).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(node[at]), pa.array(component[at])],
                                                     names=["key", "node", "component"])

    return rows.mapInArrow(tidy(run), "key long, node long, component long")


class Join:
    """The trees over the classes (node, check, n_shingles, rep, value, shown, rest)
    of ``docs``; links found so far are staged tables of (u, v)."""

    def __init__(self, docs: DataFrame, classes: DataFrame, k: int, percent: int):
        self.docs, self.classes, self.k, self.percent = docs, classes, k, percent
        self.similarity = percent / 100
        self.links: list[DataFrame] = []
        self.component: DataFrame | None = None

    def run(self) -> DataFrame | None:
        """(node, component) of all classes with a link, or None."""
        if self.classes.isEmpty():
            return None
        roots = [root(t) for t in range(FIRST_TREES)]
        self._contract(staged(children(self._named(), self.similarity, roots), "members"), self.classes)
        done, wanted = 0, trees_for(FIRST_DEPTH, self.similarity)
        while done < wanted:
            depth = self._grow(done, wanted)
            done, wanted = wanted, max(wanted, trees_for(depth, self.similarity))
        return self.component

    def _named(self) -> DataFrame:
        """node, component, shown and rest of every class."""
        if self.component is None:
            return self.classes.select("node", F.col("node").alias("component"), "shown", "rest")
        return self.classes.join(self.component, "node", "left").select(
            "node", F.coalesce("component", "node").alias("component"), "shown", "rest")

    def _open(self, rows: DataFrame) -> DataFrame:
        """Rows of nodes with more than one component, with the node's number of
        members and its largest component."""
        rows = staged(rows, "members")
        parts = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
        nodes = parts.groupBy("key").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("components"),
                                         F.max(F.struct("n", "component")).alias("top"))
        nodes = nodes.where(F.col("components") > 1).select(
            "key", "total", F.col("top.component").alias("top"), F.col("top.n").alias("top_n"))
        return staged(rows.join(nodes, "key"), "nodes")

    def _level(self, rows: DataFrame, first: int, last: int) -> DataFrame:
        return self._open(children(rows, self.similarity, [root(t) for t in range(first, last)]))

    def _narrowed(self, classes: DataFrame, rows: DataFrame) -> DataFrame:
        """``classes`` without those that ``rows`` don't name, as a table of its own
        if that is half of them at most."""
        wanted = staged(rows.select("node").distinct(), "wanted")
        n = wanted.count()
        if 2 * n > classes.count():
            return classes
        wanted = F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted
        return staged(classes.join(wanted, "node", "left_semi"), "classes")

    def _grow(self, first: int, last: int) -> int:
        """Trees ``first`` to ``last``, to their leaves; the deepest level. The
        pairs of all leaves are confirmed together."""
        nodes, depth = self._level(self._named(), first, last), 1
        large = F.col("total") - F.col("top_n") > SMALL_NODE
        pairs, classes = [], self.classes
        while True:
            pairs.append(self._compare(nodes.where(~large), classes))
            rows = nodes.where(large).select("key", "node", "component")
            if rows.isEmpty():
                break
            classes = self._narrowed(classes, rows)
            if self._contract(rows, classes):
                rows = rows.drop("component").join(self.component, "node", "left").select(
                    "key", "node", F.coalesce("component", "node").alias("component"))
                nodes = self._open(rows)
                pairs.append(self._compare(nodes.where(~large), classes))
            wide = nodes.where(large).join(classes.select("node", "shown", "rest"), "node")
            nodes = self._open(children(wide.select("key", "node", "component", "shown", "rest"), self.similarity))
            depth += 1
        self._confirm(reduce(DataFrame.unionByName, pairs).distinct())
        return depth

    def _contract(self, rows: DataFrame, classes: DataFrame) -> bool:
        """Links within blocks of each node and to its least member; whether there are any."""
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("pivot"))
        blocks = F.ceil(F.col("members") / SMALL_NODE).cast("int")
        sizes = staged(sizes.where(F.col("members") > 1).select("key", "pivot", blocks.alias("blocks")), "blocks")
        own = (rows.join(sizes, "key").where(F.col("node") != F.col("pivot"))
               .select("key", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
                       F.lit(1).alias("guest"), "node"))
        pivots = sizes.select("key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                              F.lit(0).alias("guest"), F.col("pivot").alias("node"))
        both = own.unionByName(pivots).withColumn("component", F.col("node"))
        return self._confirm(self._pairs(both, classes, _nearest_tree))

    def _compare(self, nodes: DataFrame, classes: DataFrame) -> DataFrame:
        """Pairs of small nodes that can link: members outside the largest
        component (guests, in every block) with all members."""
        blocks = F.greatest(F.ceil(F.col("top_n") / SMALL_NODE).cast("int"), F.lit(1))
        guest = F.col("component") != F.col("top")
        block = F.when(guest, F.sequence(F.lit(0), blocks - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("node"), blocks).cast("int")))
        rows = nodes.select("key", F.explode(block).alias("block"), guest.cast("int").alias("guest"), "node", "component")
        return self._pairs(rows, classes, _all_pairs)

    def _pairs(self, rows: DataFrame, classes: DataFrame, pairs_of) -> DataFrame:
        """(u, v) that ``pairs_of`` finds among the rows of each (key, block);
        ``classes`` has all that they name."""
        percent, least = self.percent, agreeing(self.similarity)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in groups_of(batches, 2):
                if table.num_rows > 1:
                    n, guest, node, component = (table.column(c).to_numpy() for c in
                                                 ("n_shingles", "guest", "node", "component"))
                    shown = low_bytes(table.column("shown"))
                    distances = Distances([t[POSITIONS:] for t in table.column("shown").to_pylist()])

                    def near(i: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                        """Which of ``others`` can link to i, and how far they are."""
                        others = others[100 * np.minimum(n[i], n[others]) >= percent * np.maximum(n[i], n[others])]
                        others = others[(shown[others] == shown[i]).sum(axis=1) >= least]
                        apart, both = distances.of(i, others), n[i] + n[others]
                        can = (100 + percent) * apart <= (100 - percent) * both
                        return others[can], apart[can] / both[can]

                    u, v = pairs_of(near, guest, component, int(table.column("block")[0].as_py()))
                    u, v = node[u], node[v]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))],
                                                     names=["u", "v"])

        full = rows.join(classes.select("node", "n_shingles", "shown"), "node").select("key", "block", "guest", "node", "component", "n_shingles", "shown")
        dealt = full.repartition("key", "block").sortWithinPartitions("key", "block", "guest", "node")
        found = dealt.mapInArrow(tidy(run), "u long, v long").where(F.col("u") != F.col("v")).distinct()
        return staged(found, "pairs")

    def _confirm(self, pairs: DataFrame) -> bool:
        """Add the pairs whose full sets link, and connect them; whether there are
        pairs. Sets meet by pairs: the lesser one once for each task, the other one
        once for each pair."""
        if pairs.isEmpty():
            return False
        sizes = self.classes.select("node", "n_shingles")
        rooms = (pairs.join(sizes.withColumnRenamed("node", "v"), "v").groupBy("u")
                 .agg(F.ceil(F.sum("n_shingles") / TASK_SHINGLES).cast("int").alias("parts")))
        rooms = staged(rooms, "rooms")
        own = rooms.select("u", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                           F.lit(0).alias("other"), F.col("u").alias("node"))
        others = pairs.join(rooms, "u").select(
            "u", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int").alias("part"),
            F.lit(1).alias("other"), F.col("v").alias("node"))
        wanted = staged(own.unionByName(others).join(self.classes.select("node", "check", "rep", "value"), "node")
                        .withColumnRenamed("value", "rep_value"), "wanted")
        wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted.hint("merge")
        k, percent = self.k, self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            here, held = None, np.zeros(0, dtype=np.uint64)
            for batch in batches:
                u, part, other, node, check = (batch.column(i).to_pylist() for i in range(5))
                found = []
                for rows, sets in _sets(batch, 5, k):
                    for i, s in zip(rows, sets):
                        if _digest(s) != (node[i], check[i]):
                            continue  # another text of the same value
                        if not other[i]:
                            here, held = (u[i], part[i]), s
                        elif here == (u[i], part[i]) and _linked(held, s, percent):
                            found.append((u[i], node[i]))
                cols = list(zip(*found)) or [(), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["u", "v"])

        texts = _valued(self.docs)
        full = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["rep"]) & (texts["value"] == wanted["rep_value"]))
        dealt = (full.select("u", "part", "other", "node", "check", "text")
                 .repartition("u", "part").sortWithinPartitions("u", "part", "other"))
        self.links.append(staged(dealt.mapInArrow(tidy(run), "u long, v long").distinct(), "links"))
        self.component = components(reduce(DataFrame.unionByName, self.links), EDGES_PER_TASK)
        return True


def _all_pairs(near, guest: np.ndarray, component: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Guests with all members that aren't connected to them; guests meet each
    other in the first block."""
    u, v = [], []
    guests, members = np.flatnonzero(guest == 1), np.flatnonzero(guest == 0)
    for i, g in enumerate(guests.tolist()):
        others = np.concatenate([members, guests[i + 1:]]) if block == 0 else members
        found, _ = near(g, others[component[others] != component[g]])
        u += [g] * len(found)
        v += found.tolist()
    return np.array(u, dtype=np.int64), np.array(v, dtype=np.int64)


def _nearest_tree(near, guest: np.ndarray, component: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of members that can link: each joins the nearest one."""
    u, v = [], []
    best, parent = np.full(len(guest), np.inf), np.full(len(guest), -1)
    left = np.ones(len(guest), dtype=bool)
    while left.any():
        at = np.flatnonzero(left)
        i = int(at[np.argmin(best[at])])
        left[i] = False
        if parent[i] >= 0:
            u.append(int(parent[i]))
            v.append(i)
        found, far = near(i, np.flatnonzero(left))
        closer = far < best[found]
        best[found[closer]], parent[found[closer]] = far[closer], i
    return np.array(u, dtype=np.int64), np.array(v, dtype=np.int64)


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < percent * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    inter = int((b[at] == a).sum())
    return 100 * inter >= percent * (len(a) + len(b) - inter)


def near_duplicates(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id in reach) and kept (it is
    the row's own) of every row."""
    rows = staged(sketches(docs, k), "sketches")
    # The representative is a row of the class, by doc_id (nulls last) and text.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "value"))
    classes = (rows.where(F.col("n_shingles") > 0).groupBy("node", "check", "n_shingles")
               .agg(first.alias("row"), F.first("shown").alias("shown"), F.first("rest").alias("rest")))
    classes = staged(classes.select("node", "check", "n_shingles", F.col("row.doc_id").alias("rep"),
                                    F.col("row.value").alias("value"), "shown", "rest"), "classes")
    found = Join(docs, classes, k, percent).run()
    reach = classes.select("node", "check", F.col("n_shingles").alias("n"), F.col("rep").alias("component_id"))
    if found is not None:
        named = staged(classes.select("node", "check", "n_shingles", "rep").join(found, "node"), "named")
        least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
        linked = named.join(least, "component").select("node", "check", "component_id")
        reach = (reach.withColumnRenamed("component_id", "rep").join(linked, ["node", "check"], "left")
                 .select("node", "check", "n", F.coalesce("component_id", "rep").alias("component_id")))
    own = rows.drop("shown", "rest")
    joined = own.join(reach, (own["node"] == reach["node"]) & (own["check"] == reach["check"])
                      & (own["n_shingles"] == reach["n"]), "left")
    # A class has the least doc_id in reach, null if there is none; an empty set its own.
    component_id = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component_id.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component_id).alias("kept"))


def op12_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: 5-word shingles, similarity of 0.85 or more."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), 5, 85)


ORACLE_OP12 = components_sql(5, 85, ", s.doc_id = min(r.v) AS kept")
