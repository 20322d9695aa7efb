"""Operator 11: spelling variants by finite-state composition.

The vocabulary is what whole texts have: runs of letters, counted in the tasks
that read them. Two words are near if one edit (a code point replaced, inserted
or deleted) makes one of the other. Near words are what the composition of the
vocabulary's minimised acceptor, a one-edit transducer and the acceptor again
accepts. The edit's place is the length of the common prefix, so every pair has
one path: words of equal length meet through a replacement, words of L and L + 1
code points through an insertion whose symbol does not come next as well.

No task has the whole acceptor. Pairs whose shorter word has L code points and
whose edit lies in a window [a, b) of places agree on the first a and on the last
L - b code points. So each word enters, for both windows of L and of L - 1, the
partition of what it would agree on: the initial state of that prefix, and the
suffix. A partition builds its own minimised acceptor of what lies between and
enumerates the accepted pairs. Partitions of more than ``PARTITION_WORDS`` words
are split: their window is halved, which makes more code points agree. A window
of one place has no more words than the square of the alphabet.

A word's form is its near word with the largest count, if that is at least twice
its own; roots follow the forms by pointer doubling, in as many joins as the
logarithm of the longest chain, which itself is logarithmic in the counts.

Defined cases: null and empty texts have no words; a null doc_id counts as an
empty text in the hash; repeated rows count each; ties go to the least word in
code-point order; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormmart.llm.common import staged, tidy
from stormmart.llm.words import HELD_WORDS, word_blocks, word_table

LEAST_LENGTH = 5
LEAST_COUNT = 3
#: One in so many (doc_id, run) pairs loses a code point.
DROP_EVERY = 97
#: A form has at least so many times the word's count.
TIMES = 2
#: Words of a partition before its window is halved.
PARTITION_WORDS = 5000

_LETTERS = word_table("abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100))))
KEY = ["size", "start", "stop", "head", "tail"]


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n, its occurrences, of all words of at least LEAST_LENGTH code points."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(held.values(), pa.int64())],
                names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts: Counter = Counter()
                # One byte for each code point; those beyond Latin-1 part words.
                for words in word_blocks(text.as_py().encode("latin-1", "replace"), _LETTERS):
                    counts.update(words)
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in counts.items():
                    size = len(word)
                    if size < LEAST_LENGTH:
                        continue
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
                    if h % DROP_EVERY == 0:
                        word = word[:h % size] + word[h % size + 1:]
                        if size == LEAST_LENGTH:
                            continue
                    held[word] = held.get(word, 0) + n
                if len(held) > HELD_WORDS:
                    yield rows()
                    held.clear()
        yield rows()

    text = F.coalesce("text", F.lit(""))
    return (docs.select(F.col("doc_id").cast("string").alias("doc_id"), text.alias("text"))
            .mapInArrow(tidy(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))


def _placed(entries: DataFrame) -> DataFrame:
    """Key and middle of (word, n, size, start, stop): words of a partition share
    head and tail."""
    tail = F.greatest(F.col("size") - F.col("stop"), F.lit(0))
    length = F.length("word")
    return entries.select(
        "size", "start", "stop", F.substring("word", F.lit(1), F.col("start")).alias("head"),
        F.substring("word", length - tail + 1, tail).alias("tail"),
        F.substring("word", F.col("start") + 1, length - F.col("start") - tail).alias("middle"), "n")


def partitions(words: DataFrame, most: int = PARTITION_WORDS) -> DataFrame:
    """Every word in the partitions in which it meets its near words. ``size`` is
    the length of the shorter word of a pair, [start, stop) the edit's window."""
    length = F.length("word")
    half = F.floor((F.col("size") + 1) / 2).cast("int")
    window = F.explode(F.array(F.struct(F.lit(0).alias("start"), half.alias("stop")),
                               F.struct(half.alias("start"), (F.col("size") + 1).alias("stop"))))
    both = words.withColumn("size", F.explode(F.array(length, length - 1))).where(F.col("size") >= LEAST_LENGTH)
    todo = staged(_placed(both.withColumn("window", window).select("word", "n", "size", "window.*")), "entries")
    ready = None
    while True:
        large = staged(todo.groupBy(*KEY).count()
                       .where((F.col("count") > most) & (F.col("stop") - F.col("start") > 1)).select(*KEY), "large")
        if large.isEmpty():
            return todo if ready is None else ready.unionByName(todo)
        small = todo.join(large, KEY, "left_anti")
        ready = small if ready is None else ready.unionByName(small)
        half = F.floor((F.col("start") + F.col("stop")) / 2).cast("int")
        window = F.explode(F.array(F.struct("start", half.alias("stop")), F.struct(half.alias("start"), "stop")))
        again = (todo.join(large, KEY, "left_semi").withColumn("window", window)
                 .select(F.concat("head", "middle", "tail").alias("word"), "n", "size", "window.*"))
        todo = staged(_placed(again), "entries")


class Acceptor:
    """Minimised acyclic acceptors of words of one length each, in one set of
    states; state 0 accepts the empty word only."""

    def __init__(self) -> None:
        self.edges: list[dict[str, int]] = [{}]
        self.known: dict[tuple, int] = {(): 0}
        self.meeting: dict[tuple[int, int], list[str]] = {}

    def _state(self, edges: dict[str, int]) -> int:
        key = tuple(edges.items())
        if key not in self.known:
            self.known[key] = len(self.edges)
            self.edges.append(edges)
        return self.known[key]

    def add(self, words: list[str]) -> int:
        """The initial state of sorted distinct words of one length."""
        path: list[dict[str, int]] = [{}]
        last = ""

        def fold(depth: int) -> None:
            while len(path) > depth + 1:
                state = self._state(path.pop())
                path[-1][last[len(path) - 1]] = state

        for word in words:
            same = 0
            while same < len(last) and word[same] == last[same]:
                same += 1
            fold(same)
            path += [{} for _ in range(len(word) - same)]
            last = word
        fold(0)
        return self._state(path[0])

    def common(self, x: int, y: int) -> list[str]:
        """The words that both states accept."""
        key = (x, y) if x < y else (y, x)
        if key not in self.meeting:
            steps = []
            while True:  # symbols without a choice, in one go
                a, b = self.edges[x], self.edges[y]
                both = [c for c in a if c in b]
                if len(both) != 1:
                    break
                steps.append(both[0])
                x, y = a[both[0]], b[both[0]]
            rests = [c + rest for c in both for rest in self.common(a[c], b[c])] if x or y else [""]
            start = "".join(steps)
            self.meeting[key] = [start + rest for rest in rests]
        return self.meeting[key]

    def replaced(self, state: int) -> Iterator[tuple[str, str]]:
        """Pairs that the composition accepts through one replacement."""
        todo = [("", state)]
        while todo:
            before, state = todo.pop()
            steps = []
            while len(self.edges[state]) == 1:
                (c, state), = self.edges[state].items()
                steps.append(c)
            before += "".join(steps)
            edges = list(self.edges[state].items())
            for i, (c, x) in enumerate(edges):
                for d, y in edges[i + 1:]:
                    for rest in self.common(x, y):
                        yield before + c + rest, before + d + rest
                todo.append((before + c, x))

    def inserted(self, short: int, long: int, places: int) -> Iterator[tuple[str, str]]:
        """Pairs of a shorter and a longer word with one insertion in the first
        ``places`` places; of equal symbols the last is the inserted one."""
        todo = [("", short, long, places)]
        while todo:
            before, short, long, places = todo.pop()
            steps: list[str] = []
            while places > 0:
                a, b = self.edges[short], self.edges[long]
                for c, y in b.items():
                    if not a and not y:
                        start = before + "".join(steps)
                        yield start, start + c
                    for d in a:
                        if d != c and d in self.edges[y]:
                            for rest in self.common(a[d], self.edges[y][d]):
                                start = before + "".join(steps)
                                yield start + d + rest, start + c + d + rest
                both = [c for c in a if c in b]
                if len(both) != 1:
                    start = before + "".join(steps)
                    todo += [(start + c, a[c], b[c], places - 1) for c in both]
                    break
                steps.append(both[0])
                short, long, places = a[both[0]], b[both[0]], places - 1


def accepted_pairs(middles: list[str], size: int, start: int, stop: int) -> Iterator[tuple[str, str]]:
    """Near middles of a partition, each pair once."""
    short = size - start - max(size - stop, 0)
    shorter, longer = ([m for m in middles if len(m) == n] for n in (short, short + 1))
    if not shorter:
        return
    acceptor = Acceptor()
    state = acceptor.add(shorter)
    yield from acceptor.replaced(state)
    if longer:
        yield from acceptor.inserted(state, acceptor.add(longer), stop - start)


def nearest(entries: DataFrame) -> DataFrame:
    """word, n_near (near words), top (the near word of largest n) and top_n of
    the words that have near ones."""
    def found(key: tuple, held: dict[str, int]) -> Iterator[tuple]:
        size, start, stop, head, tail = key
        best: dict[str, list] = {}
        for u, v in accepted_pairs(sorted(held), size, start, stop):
            for own, other in ((u, v), (v, u)):
                own_best = best.setdefault(own, [0, 0, ""])
                own_best[0] += 1
                n = held[other]
                if n > own_best[1] or (n == own_best[1] and other < own_best[2]):
                    own_best[1:] = n, other
        for own, (many, n, other) in best.items():
            yield head + own + tail, many, n, head + other + tail

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [()] * 4
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                          names=["word", "n_near", "top_n", "top"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ``Acceptor.common`` goes one call deeper at each choice on a path.
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))
        key, held, rows = None, {}, []
        for batch in batches:
            for *own, middle, n in zip(*(c.to_pylist() for c in batch.columns)):
                own = tuple(own)
                if own != key:
                    if len(held) > 1:
                        rows += found(key, held)
                    key, held = own, {}
                    if len(rows) > 10_000:
                        yield batch_of(rows)
                        rows = []
                held[middle] = n
        if len(held) > 1:
            rows += found(key, held)
        yield batch_of(rows)

    dealt = entries.repartition(*KEY).sortWithinPartitions(*KEY).select(*KEY, "middle", "n")
    near = dealt.mapInArrow(tidy(run), "word string, n_near long, top_n long, top string")
    best = F.min(F.struct((-F.col("top_n")).alias("less"), "top"))
    return (near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", (-F.col("best.less")).alias("top_n"), F.col("best.top").alias("top")))


def roots(links: DataFrame) -> DataFrame:
    """word and root of (word, form): the end of each chain of forms."""
    links = staged(links.select("word", F.col("form").alias("root")), "links")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = staged(links.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "links")
        if step.where("moved").isEmpty():
            return step.drop("moved")
        links = step.drop("moved")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary."""
    words = staged(word_counts(docs).where(F.col("n") >= LEAST_COUNT), "words")
    near = words.join(nearest(partitions(words)), "word", "left")
    is_form = F.col("top_n") >= TIMES * F.col("n")
    forms = staged(near.select("word", F.when(is_form, F.col("top")).alias("form"), "n",
                               F.coalesce("n_near", F.lit(0)).alias("n_near"),
                               F.when(is_form, F.col("top_n")).alias("form_n")), "forms")
    ends = roots(forms.where(F.col("form").isNotNull()))
    return forms.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"),
                                                   "n", "n_near", "form_n")


def op11_edit_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of the vocabulary of all documents."""
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# The CRC's table is made from its polynomial; a run's bytes are its UTF-8.
ORACLE_OP11 = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(value ORDER BY byte) AS crc FROM (
    SELECT byte, list_reduce(list_prepend(byte::UBIGINT, range(8)::UBIGINT[]),
                             lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END) AS value
    FROM range(256) t(byte))),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295::UBIGINT, list_reduce(
           list_prepend(4294967295::UBIGINT, list_transform(
             range(octet_length(b)), lambda i: ('0x' || substr(hex(b), 2 * i + 1, 2))::UBIGINT)),
           lambda c, x: xor(crc[xor(c % 256, x)::BIGINT + 1], c >> 8))) AS h
  FROM (SELECT *, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS b FROM runs), crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN run[:(h % length(run))::INT] || run[(h % length(run))::INT + 2:] ELSE run END AS word, n
    FROM hashed) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
  SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, w.word, w.n FROM cut a JOIN words w ON a.rest = w.word
  UNION SELECT w.word, a.word, a.n FROM cut a JOIN words w ON a.rest = w.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS top, max(other_n) AS top_n
  FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN top_n >= 2 * w.n THEN top END AS form,
         CASE WHEN top_n >= 2 * w.n THEN top_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
chain AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON f.word = c.word JOIN forms e ON e.word = c.at WHERE e.form IS NULL
"""
