"""Operator 13 against its definition, in whole numbers."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from stormmart.llm import divergence
from stormmart.llm.divergence import source_divergence, tree_sums

LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def apart(p, q):
    return (p - q) ** 2 // (p + q)


def by_definition(rows, least=10):
    docs, n, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        groups[lang].add(source)
        terms = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER)))
        docs[lang].update(set(terms))
        n[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, c in docs[lang].items() if c >= least)

        def shares(counts):
            total = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 2) // total for t in kept}

        q = shares(sum((n[lang, s] for s in sources), Counter()))
        p = {s: shares(n[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(apart(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, apart(p[s][t], q[t])) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, found, top in (("pair", pairs, None), ("term", terms, 10)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:top]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def test_divergence_by_definition(spark, monkeypatch):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdé漢😀") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    rows = []
    for i in range(400):
        lang, source = rng.choice(["en", "en", "en", None, "de"]), rng.choice(["a", "b", "c", "", None, "é", "z"])
        own = words[: 40 + 10 * len(source or "")] if lang == "en" else words
        rows.append((" ".join(rng.choices(own, k=rng.randint(0, 25))), lang, source))
    rows += rows[:30] + [(None, "en", "silent"), ("", "xx", "p"), ("one Two", "xx", "q"), ("[A]Z_a`b{c", "en", "a"),
                         ("word " * 30_000, "en", "long")]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                  "doc_id long, text string, lang string, source string")
    frame = frame.withColumn("term", F.lit(1)).withColumn("n", F.lit("x")).withColumn("p0", F.lit(2.5))
    want = by_definition(rows)
    assert sorted(map(tuple, source_divergence(frame).collect())) == want
    # Counts passed on in parts, texts cut into blocks, the tree laid out row by row.
    monkeypatch.setattr(divergence, "CELLS", 1)
    monkeypatch.setattr(divergence, "HELD_WORDS", 3)
    assert sorted(map(tuple, source_divergence(frame.repartition(5)).collect())) == want
    assert source_divergence(frame.limit(0)).collect() == []


def test_tree_meets_each_node_and_ancestor_once():
    paths = [[(0, 5), (1, 7)], [(0, 5), (1, 7), (2, 9)], [(0, 5), (2, 9)], [(1, 7)]]
    times = np.array([3, 2, 4, 1])
    flat = [c for p in paths for c in p]
    nodes, both = tree_sums(np.array([c[0] for c in flat]), np.array([c[1] for c in flat]),
                            np.full(len(flat), 2), np.array([len(p) for p in paths]), times, 3)
    assert sorted(map(tuple, nodes.T.tolist())) == [(0, 5, 9), (1, 7, 1), (1, 7, 5), (2, 9, 2), (2, 9, 4)]

    def correction(p, q):
        return apart(p, q) - apart(p, 2) - apart(2, q) + apart(2, 2)

    assert both.tolist() == [[0, 5 * correction(5, 7), 6 * correction(5, 9)], [0, 0, 2 * correction(7, 9)], [0, 0, 0]]
