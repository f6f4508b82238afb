"""Every catalogue query against DuckDB on the small tables."""

import math

import duckdb
import pytest

from foliant.plans.every import ORACLES, QUERIES


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return int(v) if isinstance(v, bool) else v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    names = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in names) for r in df.collect()), key=str)
    if name not in ORACLES:
        assert got
        return
    t = duck.execute(ORACLES[name])
    cols = [d[0] for d in t.description]
    assert sorted(cols) == names
    want = sorted((tuple(norm(float(r[cols.index(c)]) if type(r[cols.index(c)]).__name__ == "Decimal" else r[cols.index(c)]) for c in names) for r in t.fetchall()), key=str)
    assert got == want
