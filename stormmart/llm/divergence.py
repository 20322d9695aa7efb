"""Operator 13: source divergence audit over a frequent-pattern tree of term rows.

Every language keeps the terms that enough of its documents have. A kept term is
a row: its sources with a count, in the order of the sources. Rows are inserted
into a prefix tree with their multiplicities; a node is a source with its
smoothed share p of the term, below the sources before it. Two sources differ by
the sum over all kept terms of f(p, q) = floor((p - q)^2 / (p + q)). With p0 and
q0, the shares of terms that a source lacks, that sum is

    V * f(p0, q0)                                     no term counted yet
    + sum of f(p, q0) - f(p0, q0)                     over nodes of one source
    + sum of f(p0, q) - f(p0, q0)                     over nodes of the other
    + sum of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)  over nodes and ancestors

so each node meets each of its ancestors once, however many terms share the path.

The tree is laid out over tasks by the range of its paths: rows arrive sorted, a
task sees whole branches, and a node at the edge of a task (or of a batch) is
counted in two parts, which add up. Terms are counted in the tasks that read
them; all sums are of whole numbers.

Defined cases: null text, lang and source count as ''; a group whose documents
have no kept term has only p0; a language without kept terms gives pairs of
value 0; repeated rows are documents of their own, doc_id is not read; ties go
to the lesser item in UTF-8 order; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stormmart.llm.common import staged, tidy
from stormmart.llm.words import HELD_WORDS, word_blocks, word_table

#: Documents of a language that must have a term.
LEAST_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Cells (rows x sources) of the tree that are laid out at once.
CELLS = 500_000

# Bytes of a term; every byte of a character beyond ASCII is 0x80 or more.
_TERMS = word_table("abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0x80, 0x100))))


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents that have it); the
    empty term stands for the documents of a group themselves."""
    def rows(held: dict) -> pa.RecordBatch:
        """A row for each group: its terms and their numbers as lists."""
        ends = np.cumsum([0] + [len(n) for n, _ in held.values()], dtype=np.int32)
        terms = [t for n, _ in held.values() for t in n]
        try:
            words = pa.array(terms, pa.string())
        except pa.ArrowInvalid:  # not UTF-8
            words = pa.array([t.decode(errors="replace") for t in terms], pa.string())
        numbers = [pa.array(x, pa.int64()) for x in
                   ([c for n, _ in held.values() for c in n.values()], [own[t] for n, own in held.values() for t in n])]
        return pa.RecordBatch.from_arrays(
            [pa.array([g[i] for g in held], pa.string()) for i in (0, 1)]
            + [pa.ListArray.from_arrays(ends, x) for x in (words, *numbers)],
            names=["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            groups = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for group, text in zip(groups, batch.column(2)):
                n, own = held.setdefault(group, (Counter(), Counter()))
                before, seen = len(n), {b""}
                n[b""] += 1
                for words in word_blocks(text.as_py(), _TERMS):
                    n.update(words)
                    seen.update(words)
                own.update(seen)
                size += len(n) - before
                if size > HELD_WORDS:
                    yield rows(held)
                    held, size = {}, 0
        yield rows(held)

    text = F.coalesce("text", F.lit("")).cast("binary")
    named = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]
    found = docs.select(*named, text.alias("text")).mapInArrow(
        tidy(run), "lang string, source string, term array<string>, n array<long>, docs array<long>")
    found = found.select("lang", "source", F.inline(F.arrays_zip("term", "n", "docs")))
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, term, n, lang_n (occurrences in the language) and first (one
    row of a term has it) of the terms that enough documents of the language have."""
    of_term = Window.partitionBy("lang", "term")
    return (counts.where(F.col("term") != "")
            .withColumns({"own_docs": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term),
                          "first": F.min("source").over(of_term) == F.col("source")})
            .where(F.col("own_docs") >= least_docs)
            .select("lang", "source", "term", "n", "lang_n", "first"))


def share(n: Column, total: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / total), in decimals: counts may be large."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(19,0)")
    below = F.greatest(total, F.lit(1)).cast("decimal(19,0)")
    return F.call_function("div", above, below) + 1


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def source_groups(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """Every (lang, source) with its total and its language's (counts and two for
    each kept term), the number of kept terms and p0."""
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count_if("first").alias("terms"))
    terms = F.coalesce("terms", F.lit(0))
    total = F.coalesce("n", F.lit(0)) + 2 * terms
    return (counts.where(F.col("term") == "").select("lang", "source")
            .join(own, ["lang", "source"], "left").join(langs, "lang", "left")
            .select("lang", "source", terms.alias("terms"), total.alias("total"),
                    (F.coalesce("lang_n", F.lit(0)) + 2 * terms).alias("lang_total"),
                    share(F.lit(0).cast("long"), total).alias("p0")))


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _grid(values: np.ndarray, lengths: np.ndarray, empty: int) -> np.ndarray:
    out = np.full((len(lengths), int(lengths.max())), empty, dtype=np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


def tree_sums(ids: np.ndarray, p: np.ndarray, p0: np.ndarray, lengths: np.ndarray,
              times: np.ndarray, n_ids: int) -> tuple[np.ndarray, np.ndarray]:
    """The tree of sorted rows: (source, p, terms) of its nodes, and for every two
    sources the sum over nodes and ancestors. Rows are flat, ``lengths`` each."""
    ids, p, p0 = _grid(ids, lengths, -1), _grid(p, lengths, 0), _grid(p0, lengths, 0)
    both = np.zeros((n_ids, n_ids), dtype=np.int64)
    # shared: the node of this cell is that of the row before.
    shared = np.zeros(ids.shape, dtype=bool)
    shared[1:] = (ids[1:] == ids[:-1]) & (p[1:] == p[:-1]) & (ids[1:] >= 0)
    shared = np.logical_and.accumulate(shared, axis=1)
    before = np.append(0, np.cumsum(times))
    nodes = []
    for j in range(ids.shape[1]):
        breaks = np.append(np.flatnonzero(~shared[:, j]), len(ids))
        starts, ends = breaks[:-1], breaks[1:]
        real = ids[starts, j] >= 0
        starts, ends = starts[real], ends[real]
        terms = before[ends] - before[starts]
        own, q, q0 = ids[starts, j], p[starts, j], p0[starts, j]
        nodes.append(np.stack([own, q, terms]))
        if j:
            up, a, a0, q, q0 = ids[starts, :j], p[starts, :j], p0[starts, :j], q[:, None], q0[:, None]
            corrections = (_f(a, q) - _f(a, q0) - _f(a0, q) + _f(a0, q0)) * terms[:, None]
            np.add.at(both, (up, np.broadcast_to(own[:, None], up.shape)), corrections)
    return np.concatenate(nodes, axis=1), both


def tree_corrections(rows: DataFrame) -> DataFrame:
    """From rows (lang, path, times), a path being an array of (source, p, p0):
    lang, a, b, p, value; value is a pair's sum, or where b is null the number
    of terms that source a has with share p."""
    names = ["lang", "a", "b", "p", "value"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]

    def sums(lang: str, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        paths = part.column(1)
        cells = paths.flatten()
        sources = cells.field(0).dictionary_encode()
        offered = sources.dictionary.to_pylist()
        nodes, both = tree_sums(
            sources.indices.to_numpy(zero_copy_only=False).astype(np.int64),
            cells.field(1).to_numpy(zero_copy_only=False), cells.field(2).to_numpy(zero_copy_only=False),
            paths.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64),
            part.column(2).to_numpy(zero_copy_only=False), len(offered))
        place, own = np.unique(nodes[:2], axis=1, return_inverse=True)
        terms = np.zeros(place.shape[1], dtype=np.int64)
        np.add.at(terms, own.ravel(), nodes[2])
        a, b = np.nonzero(both)
        columns = ([lang] * (len(terms) + len(a)), [offered[i] for i in [*place[0], *a]],
                   [None] * len(terms) + [offered[i] for i in b],
                   [*place[1].tolist(), *[None] * len(a)], [*terms.tolist(), *both[a, b].tolist()])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            lengths = batch.column(1).value_lengths().to_pylist()
            start, cells = 0, 0
            for i, (lang, n) in enumerate(zip(langs, lengths)):
                if i > start and (lang != langs[start] or cells + n > CELLS):
                    yield from sums(langs[start], batch.slice(start, i - start))
                    start, cells = i, 0
                cells += n
            if batch.num_rows:
                yield from sums(langs[start], batch.slice(start))

    return rows.mapInArrow(tidy(run), "lang string, a string, b string, p long, value long")


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source) and value of all pairs, each both ways."""
    cells = (kept.join(groups, ["lang", "source"])
             .select("lang", "term", F.struct("source", share(F.col("n"), F.col("total")).alias("p"), "p0").alias("cell")))
    paths = cells.groupBy("lang", "term").agg(F.array_sort(F.collect_list("cell")).alias("path"))
    rows = paths.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times"))
    sums = staged(tree_corrections(rows.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")),
                  "tree")
    a = groups.select("lang", F.col("source").alias("a"), F.col("p0").alias("a0"), "terms")
    b = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("b0"))
    others = a.join(b, "lang").where(F.col("a") != F.col("b"))
    none = others.select("lang", "a", "b", (F.col("terms") * apart(F.col("a0"), F.col("b0"))).alias("value"))
    nodes = sums.where(F.col("b").isNull()).groupBy("lang", "a", "p").agg(F.sum("value").alias("n"))
    p, a0, b0 = F.col("p"), F.col("a0"), F.col("b0")
    one = (nodes.join(others, ["lang", "a"]).groupBy("lang", "a", "b")
           .agg(F.sum(F.col("n") * (apart(p, b0) - apart(a0, b0))).alias("value")))
    two = sums.where(F.col("b").isNotNull()).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    half = one.unionByName(two)
    turned = half.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")
    return (none.unionByName(half).unionByName(turned).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
            .select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value"))


def telling_terms(kept: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, item (a kept term), value and rank: the terms that a source
    has more of than its language."""
    both = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total")).alias("q"))
    more = both.where(F.col("p") > F.col("q")).select("lang", "source", "item",
                                                      apart(F.col("p"), F.col("q")).alias("value"))
    return more.withColumn("rank", _rank()).where(F.col("rank") <= top)


def _rank() -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))


def source_divergence(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: all pairs of sources of a language,
    and each source's most telling terms."""
    counts = staged(term_counts(docs), "counts")
    kept = staged(kept_terms(counts), "kept")
    groups = staged(source_groups(counts, kept), "groups")
    parts = [(source_pairs(kept, groups).withColumn("rank", _rank()), "pair"), (telling_terms(kept, groups), "term")]
    pairs, terms = (df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
                    for df, part in parts)
    return pairs.unionByName(terms)


def op13_term_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of every language of all documents."""
    return source_divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_OP13 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
lang_terms AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
counts AS (
  SELECT w.lang, w.source, w.term, count(*) AS n
  FROM words w JOIN lang_terms t ON w.lang = t.lang AND w.term = t.term GROUP BY ALL),
langs AS (SELECT lang, sum(n)::HUGEINT AS n, count(*) AS v FROM lang_terms GROUP BY lang),
sizes AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM counts GROUP BY lang, source),
groups AS (
  SELECT g.lang, g.source, coalesce(l.v, 0) AS v, coalesce(s.n, 0) + 2 * coalesce(l.v, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source LEFT JOIN langs l ON l.lang = g.lang),
shares AS (
  SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // g.total AS p,
         1 + (1000000000::HUGEINT * (t.n + 2)) // (l.n + 2 * l.v) AS q
  FROM groups g JOIN lang_terms t ON t.lang = g.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
         coalesce((SELECT sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) FROM shares x
                   JOIN shares y ON x.lang = y.lang AND x.term = y.term
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM pairs
  UNION ALL
  SELECT * FROM (
    SELECT lang, source, 'term' AS part, item, value,
           row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM terms)
  WHERE rank <= 10)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
"""
