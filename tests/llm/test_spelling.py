"""Operator 11 against its definition, word by word."""
import random
import re
import zlib
from collections import Counter

from stormmart.llm import spelling
from stormmart.llm.spelling import accepted_pairs, partitions, spelling_variants
from llm_helpers import DOCS, docs_frame

LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def near(u, v):
    u, v = sorted((u, v), key=len)
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def by_definition(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    form, many = {}, {}
    for w in n:
        others = [v for v in n if near(w, v)]
        many[w] = len(others)
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n[w], many[w], n.get(form[w])) for w in n)


def variant_rows():
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdeé×ÿ") for _ in range(rng.randint(5, 9))) for _ in range(40)]
    pool = []
    for word in base:
        for _ in range(rng.randint(1, 6)):
            i = rng.randrange(len(word))
            word = rng.choice([word[:i] + word[i + 1:], word[:i] + rng.choice("abc") + word[i:],
                               word[:i] + rng.choice("xyz") + word[i + 1:], word])
            pool += [word] * rng.choice([1, 3, 6, 14, 40])
    rng.shuffle(pool)
    rows = [(i, " ".join(pool[i::60])) for i in range(60)]
    rows += [(None, " ".join(pool[:50])), (None, None), (100, None), (101, ""), (102, "ABCDE,abcde.Abcde"),
             (3, rows[3][1]), (3, rows[3][1]), (103, "漢字abcde漢字 😀vwxyz😀vwxyz😀vwxyz"),
             (104, " ".join(["ab" * 3000, "ab" * 3000 + "c", "a" * 2000, "a" * 2001] * 4))]
    return rows


def test_variants_by_definition(spark, monkeypatch):
    rows = variant_rows()
    want = by_definition(rows)
    assert any(x[1] and x[2] != x[1] for x in want)  # a chain
    got = sorted(map(tuple, spelling_variants(docs_frame(spark, rows)).collect()), key=lambda x: x[0])
    assert got == want
    # Tables counted in many parts, and partitions split to single places.
    monkeypatch.setattr(spelling, "partitions", lambda words: partitions(words, most=2))
    rows = [r for r in rows if r[0] != 104]
    got = sorted(map(tuple, spelling_variants(docs_frame(spark, rows)).collect()), key=lambda x: x[0])
    assert got == by_definition(rows)


def test_no_words(spark):
    assert spelling_variants(spark.createDataFrame([], DOCS)).collect() == []
    assert spelling_variants(docs_frame(spark, [(1, "a bc def"), (2, None)])).collect() == []


def test_composition_accepts_each_pair_once():
    rng = random.Random(3)
    for _ in range(100):
        size = rng.randint(5, 8)
        words = {"".join(rng.choice("aabc") for _ in range(rng.choice([size, size + 1])))
                 for _ in range(rng.randint(2, 50))}
        want = {tuple(sorted((u, v))) for u in words for v in words if near(u, v) and min(len(u), len(v)) == size}
        half = (size + 1) // 2
        got = []
        for start, stop in rng.choice([[(0, half), (half, size + 1)], [(i, i + 1) for i in range(size + 1)]]):
            tail, parts = max(0, size - stop), {}
            for w in words:
                parts.setdefault((w[:start], w[len(w) - tail:]), []).append(w[start:len(w) - tail])
            for (head, end), middles in parts.items():
                got += [tuple(sorted((head + u + end, head + v + end)))
                        for u, v in accepted_pairs(sorted(middles), size, start, stop)]
        assert len(got) == len(set(got)) and set(got) == want
