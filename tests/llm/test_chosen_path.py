"""Operator 12 against all pairs of a small table."""
import random
import re

import numpy as np
import pyarrow as pa

from stormmart.llm import chosen_path
from stormmart.llm.chosen_path import POSITIONS, agreeing, meeting_chance, near_duplicates, trees_for
from llm_helpers import DOCS, docs_frame


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def by_all_pairs(rows, k, percent):
    """Sorted (doc_id, n_shingles, component_id, kept)."""
    sets = [shingles(text, k) for _, text, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    ids = {}
    for i, row in enumerate(rows):
        ids.setdefault(find(i), []).append(row[0])
    least = [min((x for x in ids[find(i)] if x is not None), default=None) for i in range(len(rows))]
    return sorted(((r[0], len(s), c, r[0] == c) for r, s, c in zip(rows, sets, least)), key=str)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def near_copies(words):
    """Chains of texts whose neighbours lie just above and below the similarity."""
    rng = random.Random(2)
    rows = []
    for size in (6, 9, 30, 100, 300):
        for _ in range(4):
            text = [rng.choice(words) + str(rng.randrange(99)) for _ in range(size)]
            for _ in range(8):
                rows.append((len(rows) + 1000, " ".join(text)))
                for _ in range(max(1, round(size * rng.choice([0.005, 0.01, 0.02])))):
                    text[rng.randrange(size)] = rng.choice(words)
    return rows


def test_all_pairs(spark, corpus, words):
    rows = [*corpus, *near_copies(words), (None, corpus[40][1]), (None, "no other text"), (5, corpus[41][1])]
    rows += rows[40:44]
    want = by_all_pairs(rows, 5, 85)
    assert any(w[2] != w[0] for w in want)
    assert rows_of(near_duplicates(docs_frame(spark, rows), 5, 85)) == want


def test_large_nodes_branch(spark, words, monkeypatch):
    monkeypatch.setattr(chosen_path, "SMALL_NODE", 12)
    monkeypatch.setattr(chosen_path, "TASK_SHINGLES", 100)
    rng = random.Random(4)
    rows = near_copies(words)[::4]
    base = [rng.choice(words) for _ in range(40)]
    # One passage in many texts that have little else in common.
    rows += [(i, " ".join(base + [rng.choice(words) for _ in range(rng.randint(4, 30))])) for i in range(30)]
    want = by_all_pairs(rows, 5, 85)
    assert rows_of(near_duplicates(docs_frame(spark, rows), 5, 85)) == want


def test_nothing_to_join(spark):
    assert near_duplicates(spark.createDataFrame([], DOCS), 5, 85).collect() == []
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (None, None)]
    assert rows_of(near_duplicates(docs_frame(spark, rows), 5, 85)) == by_all_pairs(rows, 5, 85)


def test_recall_of_the_trees():
    rng = random.Random(1)

    def met(depth):
        if not depth:
            return True
        tries = 2 if rng.random() < 1 / 0.85 - 1 else 1
        return any(rng.random() < 0.85 and met(depth - 1) for _ in range(tries))

    for depth in (1, 3):
        share = sum(met(depth) for _ in range(20_000)) / 20_000
        assert abs(share - meeting_chance(depth, 0.85)) < 0.015
        assert (1 - meeting_chance(depth, 0.85)) ** trees_for(depth, 0.85) <= chosen_path.MISS
    assert 0 < agreeing(0.85) < 0.7 * POSITIONS


def test_levels_move_their_own_rows_only(spark, words, monkeypatch):
    """Deeper levels read the classes in large nodes, comparisons no whole tokens."""
    monkeypatch.setattr(chosen_path, "SMALL_NODE", 12)
    moved, grown, pairs_of, grow = [], [], chosen_path.Join._pairs, chosen_path.Join._grow

    def spied(self, rows, classes, *args):
        wide = classes.select("shown").first()
        moved.append((classes.count(), wide and len(wide.shown)))
        return pairs_of(self, rows, classes, *args)

    monkeypatch.setattr(chosen_path.Join, "_pairs", spied)
    monkeypatch.setattr(chosen_path.Join, "_grow", lambda self, *trees: grown.append(trees) or grow(self, *trees))
    rng = random.Random(6)
    base = [rng.choice(words) for _ in range(40)]
    rows = [(i, " ".join(base + [rng.choice(words) for _ in range(rng.randint(4, 30))])) for i in range(30)]
    rows += [(100 + i, " ".join(f"{rng.choice(words)}{rng.randrange(99)}" for _ in range(30))) for i in range(90)]
    assert rows_of(near_duplicates(docs_frame(spark, rows), 5, 85)) == by_all_pairs(rows, 5, 85)
    assert moved[0] == (120, POSITIONS + chosen_path.PARITY_BITS // 8)
    # All classes are read once before the trees and once by each set of trees.
    whole = [n for n, _ in moved if n > 30]
    assert whole == [120] * (1 + len(grown)) and len(moved) > len(whole)


def test_planes_keep_the_tokens():
    tokens = np.random.default_rng(3).integers(0, 1 << 32, (5, POSITIONS), dtype=np.uint32)
    low, rest = chosen_path.planes(tokens)
    shown = pa.array([x + b"parity" for x in low], pa.binary())
    assert (chosen_path.whole_tokens(shown, pa.array(rest, pa.binary())) == tokens).all()
    assert (chosen_path.low_bytes(shown) == (tokens & 255)).all()
