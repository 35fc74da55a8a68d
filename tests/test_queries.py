"""Every query against its SQL at the smallest size."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans import queries as Q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) or (math.isnan(a) and math.isnan(b))
    return a == b


@pytest.fixture(scope="session")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        c.execute(f"create view {t} as select * from read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return c


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, sf, duck, name):
    df = Q.QUERIES[name](spark, sf)
    got = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    if name not in Q.SQL:
        assert got
        return
    cur = duck.execute(Q.SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    want = [tuple(r[cols.index(c)] for c in sorted(cols)) for r in cur.fetchall()]
    key = lambda r: tuple("" if x is None else f"{x:.6f}" if isinstance(x, float) else str(x) for x in r)
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert len(got) == len(want)
    assert all(all(map(same, a, b)) for a, b in zip(got, want, strict=True))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
