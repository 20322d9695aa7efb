"""Operators 2 and 10 against brute force."""
import hashlib
import random
import re

import numpy as np
import pytest
from llm_helpers import docs_frame

from stormmart.llm import bwt, ngram_join, suffix_dedup
from stormmart.llm.components import components


def brute_repeats(rows, length=100):
    seen, out = {}, {}
    for place, (doc, text) in enumerate(sorted(rows, key=lambda r: r[0])):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if seen.setdefault(data[p:p + length], (place, p)) != (place, p):
                covered[p:p + length] = b"\1" * length
        rest = bytes(b for b, c in zip(data, covered) if not c)
        spans = len(re.findall(b"\1+", bytes(covered)))
        out[doc] = (len(data), sum(covered), spans, hashlib.sha256(rest).hexdigest())
    return out


def brute_components(rows, k, percent):
    sets = {}
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc] = (frozenset() if not w else frozenset([tuple(w)]) if len(w) < k
                     else frozenset(zip(*(w[i:] for i in range(k)))))
    label = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                s, t = sets[a], sets[b]
                if s and t and label[a] < label[b] and 100 * len(s & t) >= percent * len(s | t):
                    label[b], changed = label[a], True
    return {d: (len(s), label[d]) for d, s in sets.items()}


def test_prefix_classes_are_equal_substrings():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n, length = int(rng.integers(1, 120)), int(rng.integers(1, 20))
        text = rng.integers(97, 99, n).astype(np.uint8)
        classes, data = bwt.prefix_classes(text, length), text.tobytes()
        for i in range(n - length + 1):
            for j in range(i):
                assert (data[i:i + length] == data[j:j + length]) == (classes[i] == classes[j])


def test_suffix_dedup_matches_brute_force(spark, corpus):
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.removal_report(docs_frame(spark, corpus)).collect()}
    assert got == brute_repeats(corpus)


def test_suffix_dedup_does_not_depend_on_sizes(spark, corpus, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CUT_BYTES", 700)
    monkeypatch.setattr(suffix_dedup, "FLUSH_BYTES", 1500)
    frequent = np.zeros(1 << suffix_dedup.FREQUENT_BITS, dtype=bool)
    docs, starts, texts = [], [], []
    for doc, text in corpus:
        data = (text or "").encode()
        for at in range(0, max(0, len(data) - 99), 700):
            docs.append(doc)
            starts.append(at)
            texts.append(data[at:at + 799])
    segments = suffix_dedup.cut(np.array(docs), np.array(starts), texts, frequent)
    # Every string of 100 bytes lies in exactly one segment.
    strings = sorted((d, s + i) for d, s, n in zip(segments.doc, segments.start, segments.length) for i in range(n - 99))
    assert strings == sorted((d, p) for d, t in corpus for p in range(len((t or "").encode()) - 99))
    again = suffix_dedup.Segments.unpacked(segments.packed())
    assert all((getattr(again, f) == getattr(segments, f)).all() for f in (*segments.FIELDS, "flat"))


def test_suffix_dedup_packs_a_row_for_each_bucket_of_many_texts(monkeypatch):
    """Rows and copies of bytes follow the text and not the buckets; known runs do not meet in one bucket."""
    import pyarrow as pa
    import pyarrow.compute as pc

    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 123, 3000).astype(np.uint8).tobytes() for _ in range(20)]
    texts += texts[:10] + [t[500:900] + t[:300] for t in texts]
    batch = pa.RecordBatch.from_pydict({"doc": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.binary())})
    monkeypatch.setattr(suffix_dedup, "CUT_BYTES", 7000)
    monkeypatch.setattr(suffix_dedup, "FLUSH_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "PACK_BYTES", 60_000)
    taken, take = [], suffix_dedup.Segments.take
    monkeypatch.setattr(suffix_dedup.Segments, "take", lambda self, chosen: taken.append(len(self)) or take(self, chosen))
    frequent = np.zeros(1 << suffix_dedup.FREQUENT_BITS, dtype=bool)
    routed = pa.Table.from_batches(list(suffix_dedup._routed(40, frequent)(iter([batch]))))
    flushes = sum(map(len, texts)) // 20_000 + 1
    assert len(taken) <= 2 * flushes  # one of all buckets, one of the earliest
    assert routed.num_rows <= 40 * (flushes // 3 + 1)
    runs = [r for r in routed.column("runs").to_pylist() if r]
    assert len(runs) > 5 and max(map(len, runs)) < sum(map(len, runs)) / 3

    def covered(tables):
        found = set()
        for t in tables:
            for doc, begin, end in zip(*(suffix_dedup.bucket_runs(t).column(c).to_pylist() for c in range(3))):
                found.update((doc, i) for i in range(begin, end))
        return found

    seen, want = {}, set()
    for doc, text in enumerate(texts):
        for i in range(len(text) - 99):
            if seen.setdefault(text[i:i + 100], (doc, i)) != (doc, i):
                want.update((doc, j) for j in range(i, i + 100))
    buckets = set(routed.column("bucket").to_pylist())
    assert covered(routed.filter(pc.equal(routed.column("bucket"), b)) for b in buckets) == want


def test_joined_runs():
    doc, begin, end = (np.array(x) for x in ([2, 1, 1, 1, 2, 2], [50, 0, 40, 150, 50, 151], [150, 100, 140, 250, 150, 260]))
    assert suffix_dedup.joined_runs(doc, begin, end).T.tolist() == [[1, 0, 140], [1, 150, 250], [2, 50, 150], [2, 151, 260]]
    none = np.zeros(0, dtype=np.int64)
    assert suffix_dedup.joined_runs(none, none, none).shape == (3, 0)


def test_suffix_dedup_cuts_texts_and_keeps_columns(spark, corpus):
    docs = docs_frame(spark, corpus)
    out = suffix_dedup.dedup_texts(docs)
    assert out.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[77] == "" if len(dict(corpus)[3]) >= 100 else texts[77] == dict(corpus)[3]
    assert texts[72] is None and texts[0] == dict(corpus)[0]


def test_suffix_dedup_repeated_rows_and_null_ids(spark):
    long = "x" + " ".join(str(i) for i in range(80))
    rows = [(1, long), (1, long), (None, long), (2, long + "y"), (None, "short")]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_removed"])
                 for r in suffix_dedup.removal_report(docs_frame(spark, rows)).collect())
    n = len(long)
    assert got == [(False, 1, 0), (False, 1, 0), (False, 2, n), (True, 0, 0), (True, 0, n)]
    assert suffix_dedup.removal_report(docs_frame(spark, [])).count() == 0


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_components_match_brute_force(spark, corpus, k, percent):
    got = ngram_join.near_duplicate_components(docs_frame(spark, corpus), k, percent)
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == brute_components(corpus, k, percent)


def test_linked_sets_always_share_a_list():
    rng = random.Random(5)
    for percent in (90, 80):
        for light in (0, 6, 12):
            scheme = ngram_join.Scheme(3, percent, light)
            for _ in range(1500):
                n = rng.choice([1, 2, 5, 9, 10, 11, 12, 13, 20, 60, 200])
                a = set(rng.sample(range(10**9), n))
                b = set(a)
                for _ in range(rng.randint(0, 1 + n // 6)):
                    if rng.random() < 0.5 and len(b) > 1:
                        b.remove(rng.choice(sorted(b)))
                    else:
                        b.add(rng.randrange(10**9))
                if scheme.links(len(a & b), len(a), len(b)):
                    lists = [set(ngram_join.signatures(np.array(sorted(s), dtype=np.uint64), scheme).tolist())
                             for s in (a, b)]
                    assert lists[0] & lists[1], (percent, light, len(a), len(b))


def test_split_groups_give_the_same_components(spark, corpus, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 300)
    got = ngram_join.near_duplicate_components(docs_frame(spark, corpus), 3, 90)
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == brute_components(corpus, 3, 90)


def test_join_of_repeated_null_and_empty_rows(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "A B C D"), (2, "a b"), (3, "A  b"), (4, None), (5, "")]
    got = ngram_join.near_duplicate_components(docs_frame(spark, rows), 3, 90)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, 2, 1), (1, 2, 1), (None, 2, 1), (2, 1, 2), (3, 1, 2), (4, 0, 4), (5, 0, 5)], key=str)
    assert ngram_join.near_duplicate_components(docs_frame(spark, []), 3, 90).count() == 0


@pytest.mark.parametrize("block", [2_000_000, 60])
def test_join_of_repeated_rows_and_shared_ids_in_a_group(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", block)

    def near(name, change):
        w = [f"{name}{i}" for i in range(60)]
        return " ".join(w[:-1] + [f"{name}{change}"]) if change else " ".join(w)

    rows = [(3, near("a", "x")), (5, near("a", "")), (5, near("a", "")), (3, near("a", "x")), (6, near("a", "")),
            (7, near("b", "")), (7, near("c", "")), (7, near("b", "x")), (8, near("c", "y")), (9, near("b", "z")),
            # 20 and 21 are linked only through a row without an id.
            (20, " ".join(f"d{i}" for i in range(58))), (None, " ".join(f"d{i}" for i in range(2, 60))),
            (21, " ".join(f"d{i}" for i in range(4, 62))),
            (None, near("e", "")), (None, near("e", "x")), (None, near("e", "x"))]
    got = ngram_join.near_duplicate_components(docs_frame(spark, rows), 3, 90)
    want = [(3, 3), (3, 3), (5, 3), (5, 3), (6, 3), (7, 7), (7, 7), (7, 7), (8, 7), (9, 7), (20, 20), (21, 20),
            (None, 20), (None, None), (None, None), (None, None)]
    assert sorted(((r[0], r[2]) for r in got.collect()), key=str) == sorted(want, key=str)


def test_one_of_each_keeps_the_least_id(spark, corpus):
    docs = docs_frame(spark, corpus)
    kept = ngram_join.one_of_each(docs, 5, 80)
    want = {d for d, (_, c) in brute_components(corpus, 5, 80).items() if c == d}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == want


def test_components_of_random_edges(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100, 101), (101, 102), (102, 103), (7, 7)]
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(edges, "u long, v long"))
    assert {r["node"]: r["component"] for r in got.collect()} == label
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
