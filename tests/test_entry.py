"""Registered queries against their SQL on the smallest tables, where those are there."""

import glob
import math
import os
from collections import Counter

import pytest

import __spark_entry__ as entry
from rodado import queries as core

ROOT = os.environ.get("RODADO_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(f"{ROOT}/places.parquet"), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for p in glob.glob(f"{ROOT}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return float(v) if type(v).__name__ == "Decimal" else v


def test_names():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q) and len(q) > 100
    assert set(core.queries()) <= set(q)


@pytest.mark.parametrize("name", sorted(core.sql()))
def test_twin(spark, duck, name):
    df = core.queries()[name](spark, ROOT)
    cols = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    q = duck.execute(core.sql()[name])
    names = [d[0] for d in q.description]
    assert sorted(names) == cols
    want = Counter(tuple(plain(r[names.index(c)]) for c in cols) for r in q.fetchall())
    assert got == want


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "composite" in df.columns
