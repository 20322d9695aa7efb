"""Operators 5, 6 and 8, the pipeline and the registered queries."""
import base64
import hashlib
import zlib
from collections import Counter

import duckdb
import pytest
from llm_helpers import docs_frame
from pyspark.sql import functions as F

import corpus_pipeline
from stormmart.llm import chat, queries, sharding, warc
from stormmart.llm.common import scratch, staged

SF = "/root/testdata/sf0.001"


# --- sharding ------------------------------------------------------------------

def sharded(spark, rows, n_shards=4):
    records = staged(sharding.hash_into_slots(docs_frame(spark, rows)), "t-slots")
    store = scratch(spark, "t-map")
    sharding.save_map(sharding.place_slots(sharding.slot_bytes(records), n_shards), store, 1)
    return records, store, sharding.shard_records(records, sharding.load_map(spark, store, 1))


def test_shards_are_even_gapless_and_whole(spark, corpus):
    rows = corpus + [corpus[5]] * 30 + [(None, "x"), (None, None)] + [(1000 + i, "same") for i in range(400)]
    _, _, out = sharded(spark, rows)
    got = out.collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    loads, slots = Counter(), {}
    for r in got:
        loads[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len((t or "").encode()) for _, t in rows)
    assert max(loads.values()) - min(loads.values()) <= largest + 1


def test_gapless_rank_with_split_groups(spark, monkeypatch):
    from stormmart.llm import common

    monkeypatch.setattr(common, "ROWS_PER_RANK_TASK", 20)
    rows = staged(spark.range(500).select("id", F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 7).alias("g")), "t-rank")
    out = {}
    for r in common.gapless_rank(rows, ["g"], ["id"], "rank").collect():
        out.setdefault(r["g"], []).append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in out.values()) and sum(map(len, out.values())) == 500


def test_rebalancing_moves_few_slots_and_keeps_versions(spark, corpus):
    corpus = [r for r in corpus if r[0] != 78]  # one text of half the bytes leaves nothing to move
    records, store, _ = sharded(spark, corpus)
    weights = sharding.slot_bytes(records)
    first = {r["virtual_slot"]: r["shard"] for r in sharding.load_map(spark, store, 1).collect()}
    same = sharding.rebalance(spark, store, 1, weights, 4, tolerance=0.5)
    assert {r["virtual_slot"]: r["shard"] for r in same.collect()} == first
    grown = {r["virtual_slot"]: r["shard"] for r in sharding.rebalance(spark, store, 2, weights, 5, 0.02).collect()}
    assert len(first) == len(grown) == sharding.N_SLOTS and set(grown.values()) == set(range(5))
    loads = {r["shard"]: r["bytes"] for r in sharding.shard_loads(sharding.load_map(spark, store, 3)).collect()}
    assert max(loads.values()) <= 1.3 * sum(loads.values()) / 5 + max(len((t or "").encode()) for _, t in corpus)
    assert {r["virtual_slot"]: r["shard"] for r in sharding.load_map(spark, store, 1).collect()} == first
    _, _, none = sharded(spark, [])
    assert none.count() == 0


# --- chat formatting -----------------------------------------------------------

def test_preferences_of_small_conversations(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "hi"), (1, 1, "assistant", "good day"), (1, 1, "assistant", "good day"),
         (2, 0, "user", "é?"), (2, 1, "assistant", "12"), (2, 2, "user", None), (2, 3, None, "x"),
         (3, 0, "system", "only"), (None, 0, "user", "lost"), (4, None, "assistant", "abcd"), (4, 0, "user", "z")],
        "conv_id long, turn long, role string, text string").withColumn("prompt", F.lit("clash"))
    arrays = chat.conversations_as_arrays(turns, "conv_id", "chosen_turns")
    pairs = arrays.withColumn("rejected_turns", chat.with_cut_reply(F.col("chosen_turns")))
    got = {r["conv_id"]: r for r in chat.format_preferences(pairs, "conv_id").collect()}
    assert set(got) == {1, 2, 3, 4}
    assert got[1]["prompt"] == "<|im_start|>user\nhi<|im_end|>\n"
    for side, text in (("chosen", "good day"), ("rejected", "good")):
        rendered, mask = got[1][side], got[1][side + "_mask"]
        assert rendered == f"<|im_start|>assistant\n{text}<|im_end|>\n"
        at, n = map(int, mask.split(":"))
        assert rendered[at:at + n] == text + "<|im_end|>\n"
    assert got[2]["prompt_turns"] == 1 and got[2]["chosen"].count("<|im_start|>") == 3
    assert got[3]["prompt_turns"] == 1 and not got[3]["usable"] and got[3]["chosen"] == ""
    assert got[4]["prompt"] == "" and got[4]["usable"]


def test_preferences_match_sql(spark):
    got = chat.op5_preference_formatting(spark, SF).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.execute(chat.ORACLE_OP5).df()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    assert (got[cols].sort_values("conv_id").reset_index(drop=True)
            .equals(want[cols].sort_values("conv_id").reset_index(drop=True)))


# --- WARC ----------------------------------------------------------------------

def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    rows = [(i, f"https://h{i % 4}.example.com/p/{i % 5}?q=1", f"<p>{i % 17} é</p>\r\n\r\nx") for i in range(60)]
    rows += [(100, None, None), (101, "no url", ""), (102, "http://a b.example/ \n", "a"), (None, "http://x.org/", "a"),
             (103, "HTTP://X.org", "a")] + [(200 + i, "http://hot.example/", "hot") for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit("clash"))
    folder = scratch(spark, "t-warc")
    ranges = warc.write_archives(warc.with_originals(warc.captures(pages)), folder)
    assert sum(r["captures"] for r in ranges.collect()) == len(rows)
    wanted = pages.select(warc.capture_key(F.col("url")).alias("key"), "page_id")
    out = warc.read_captures(wanted, ranges, folder).collect()
    last = {}
    for page, _, html in rows:
        if page is not None:
            last[html or ""] = max(page, last.get(html or "", page))
    want = set()
    for page, _, html in rows:
        data = (html or "").encode()
        again = page is not None and last[html or ""] != page
        want.add((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                  "revisit" if again else "response", last[html or ""] if again else None, True))
    assert {tuple(r) for r in out} == want and len(out) == len(rows)
    missing = spark.createDataFrame([("zzz)", 1), ("", None), ("com,example,h0)/p/0?q=1", 7)], "key string, page_id long")
    assert warc.read_captures(missing, ranges, folder).count() == 0
    none = warc.write_archives(warc.with_originals(warc.captures(pages.where("page_id < -1"))), folder)
    assert warc.read_captures(wanted, none, folder).count() == 0


def test_pages_that_share_key_and_id_are_all_read_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    url = "http://x.org/"
    rows = [(None, url, f"<p>{i}") for i in range(7)] + [(None, url, "<p>3"), (None, None, "a"), (None, None, "b"),
            (5, url, "one"), (5, url, "two"), (5, url, "two"), (6, url, "one"), (6, "https://x.org/", "one"),
            (-(1 << 63), url, "least")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = scratch(spark, "t-warc")
    ranges = warc.write_archives(warc.with_originals(warc.captures(pages)), folder)
    wanted = pages.select(warc.capture_key(F.col("url")).alias("key"), "page_id")
    out = warc.read_captures(wanted, ranges, folder).collect()
    digest = lambda text: warc.digest_text(text.encode())
    want = Counter((p, digest(h)) for p, _, h in rows)
    assert Counter((r["page_id"], r["payload_digest"]) for r in out) == want and all(r["verified"] for r in out)


def test_records_are_plain_gzip_members(spark):
    data = warc.record(5, "http://x.org/", b"body", None)
    assert warc.parsed(warc._unzip(warc._zip(data)))["payload"] == b"body"
    keys = spark.createDataFrame([("https://A.B.example:80/p?q#f",), (None,), ("x",)], "u string")
    assert [r[0] for r in keys.select(warc.capture_key(F.col("u"))).collect()] == ["example:80,b,a)/p?q#f", "", ")x"]


# --- pipeline and registration ---------------------------------------------------

def test_pipeline_against_brute_force(spark, corpus):
    from test_dedup_ops import brute_components
    from stormmart.llm import suffix_dedup

    item = " ".join(f"quiz{i} answer" for i in range(12))
    rows = [(i, t, "en") for i, t in corpus] + [(300, "some words before " + item.upper() + " and after", "en"), (301, "!!! 12", "en")]
    docs = docs_frame(spark, rows)
    folder = scratch(spark, "t-pipeline")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "packing"]
    named = staged(stages["language_id"](spark, docs, folder), "t1")
    texts = {d: t for d, t, _ in rows if t and any(c.isalpha() for c in t)}
    assert {r["doc_id"] for r in named.collect()} == set(texts) and named.columns == docs.columns
    single = staged(stages["ngram_jaccard_join"](spark, named, folder), "t2")
    kept = {d for d, (_, c) in brute_components(list(texts.items()), 5, 80).items() if c == d}
    assert {r["doc_id"] for r in single.collect()} == kept and single.columns == docs.columns
    cut = staged(stages["suffix_array_dedup"](spark, single, folder), "t3")
    seen, left = set(), {}
    for d in sorted(kept):
        data = texts[d].encode()
        covered = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p:p + 100] in seen:
                covered[p:p + 100] = b"\1" * 100
            seen.add(data[p:p + 100])
        left[d] = bytes(b for b, c in zip(data, covered) if not c).decode("utf-8", "ignore")
    got = {r["doc_id"]: r for r in cut.collect()}
    assert {d: r["text"] for d, r in got.items()} == {d: t for d, t in left.items() if t}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values()) and cut.columns == docs.columns
    clean = staged(stages["benchmark_decontamination"](spark, cut, folder), "t4")
    assert {r["doc_id"] for r in clean.collect()} == set(got) - {300} and clean.columns == docs.columns
    packed = stages["packing"](spark, clean, folder).collect()
    assert {r["doc_id"] for r in packed} == set(got) - {300}
    assert suffix_dedup.LENGTH == 100


def test_near_duplicate_stage_with_null_and_repeated_ids(spark):
    def near(name, change=""):
        return " ".join([f"{name}{i}" for i in range(80)] + [name + change])

    rows = [(None, near("a")), (4, near("b")), (4, near("b")), (None, near("b", "x")), (5, near("c")), (5, near("c", "x")),
            (6, near("d")), (6, near("e")), (None, near("f")), (None, near("f")), (None, near("f", "x")),
            # 8 and 9 are linked only through a row without an id.
            (8, " ".join(f"g{i}" for i in range(100))), (None, " ".join(f"g{i}" for i in range(8, 108))),
            (9, " ".join(f"g{i}" for i in range(16, 116)))]
    docs = docs_frame(spark, rows)
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    got = Counter((r["doc_id"], r["text"].split()[0][0]) for r in out.collect())
    assert got == Counter([(None, "a"), (4, "b"), (5, "c"), (6, "d"), (6, "e"), (None, "f"), (8, "g")])
    assert out.columns == docs.columns


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run_on_whole_tables(spark, name):
    table = {"op5": "conversations", "op6": "pages"}.get(name.split("_")[0], "documents")
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    got = queries.QUERIES[name](spark, SF).count()
    if name.split("_")[0] in ("op2", "op3", "op4", "op6", "op8", "op10", "op12"):
        assert got == n
    else:
        assert got > 0


def test_stages_carry_columns_of_any_name(spark):
    names = ["a.b", "__row", "__doc", "__lang", "__benchmark_hits", "se`lect", "further", "x0"]
    words = [f"{w} {w}ing und der die {i}" for i, w in enumerate(["alpha", "beta", "gamma", "delta"] * 10)]
    rows = [(i, " ".join(words[i:i + 30])) for i in range(8)] + [(8, " ".join(words[:30])), (9, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, *[f"{n}{i}" for n in names]) for i, t in rows],
                                 ["doc_id", "text", "lang", "source", "n_chars", *names])
    docs = docs.select(names[0].join("``"), *[f"`{c.replace('`', '``')}`" for c in docs.columns if c != names[0]])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        kept = out.collect()
        assert kept and all(r[c] == f"{c}{r['doc_id']}" for r in kept for c in names), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == len(rows)
