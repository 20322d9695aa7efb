"""Every registered query against its DuckDB SQL on the smallest test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from stormmart.plans.oracle import ORACLE
from stormmart.plans.registry import QUERIES
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _sorted_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())
    # Queries of optional parts may have none; their own tests name what they are held against.
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _sorted_rows(df.columns, rows) == _sorted_rows(dcols, res.fetchall())


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["event_year", "state", "total_property_damage"]
    assert df.count() > 0
