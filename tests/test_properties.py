"""Property tests: Spark operators against small brute-force Python models."""

import os
import re
import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stormmart.functions.amounts import parse_amount
from stormmart.operators.dedupe import first_per_key
from stormmart.sinks.upsert import read_upsert_table, upsert_exists, upsert_table

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

NUMBER = re.compile(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?\s*$")
FACTORS = {"h": 100.0, "k": 1000.0, "m": 1e6, "b": 1e9}


def amount_model(text):
    """The mart's CASE logic written out in plain Python."""
    if text is None:
        return 0.0
    low = text.lower()
    rest = low
    for i, ch in enumerate(low):
        if ch.isalpha():
            rest = low[:i] + low[i + 1:]
            break
    number = float(rest) if rest and NUMBER.match(rest) else None
    last = low[-1:] if low else ""
    unit = last if last.isalpha() else None
    if unit in FACTORS:
        return None if number is None else number * FACTORS[unit]
    return 0.0 if number is None else number


amount_text = st.one_of(
    st.none(),
    st.text(alphabet="0123456789.-+ kKmMbBhHtxe", max_size=8),
    st.builds(lambda n, u: f"{n}{u}", st.decimals(min_value=-1000, max_value=1000, places=2,
                                                   allow_nan=False), st.sampled_from(["", "K", "M", "B", "H", "t"])),
)


@SETTINGS
@given(st.lists(amount_text, min_size=1, max_size=60))
def test_parse_amount_matches_model(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.a for r in df.select("i", parse_amount("t").alias("a")).collect()}
    for i, t in enumerate(texts):
        want = amount_model(t)
        assert (got[i] is None and want is None) or (got[i] is not None and want is not None
                                                     and abs(got[i] - want) <= 1e-9 * max(1.0, abs(want))), (t, got[i], want)


rows_strategy = st.lists(st.tuples(st.sampled_from([None, 1, 2, 3]), st.integers(0, 5), st.integers(0, 3)),
                         min_size=1, max_size=40)


@SETTINGS
@given(rows_strategy)
def test_first_per_key_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, v int")
    got = sorted(((r.k if r.k is not None else -1), r.t, r.v) for r in first_per_key(df, "k", ["t"]).collect())
    best = {}
    for k, t, v in rows:
        kk = -1 if k is None else k
        best[kk] = min(best.get(kk, (t, v)), (t, v))
    assert got == sorted((k, t, v) for k, (t, v) in best.items())


batches_strategy = st.lists(
    st.lists(st.tuples(st.integers(0, 30), st.text(alphabet="abc", max_size=2)), min_size=1, max_size=12,
             unique_by=lambda r: r[0]),
    min_size=1, max_size=4)


@SETTINGS
@given(batches_strategy)
def test_upsert_table_matches_model(spark, tmp_dir, batches):
    path = os.path.join(tmp_dir, "t_" + uuid.uuid4().hex[:8])
    model = {}
    for batch in batches:
        upsert_table(spark, spark.createDataFrame(batch, "k long, v string"), path, "k", n_buckets=4)
        model.update(dict(batch))
    assert upsert_exists(spark, path) == any(batches)
    got = {r.k: r.v for r in read_upsert_table(spark, path).collect()} if any(batches) else {}
    assert got == model
