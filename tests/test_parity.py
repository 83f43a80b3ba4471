"""Every registered query against its SQL oracle (DuckDB) on the smallest data set."""
from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = ["events", "supplier"]


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["port", "dow", "hour", "avg_vessel_count"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


entry.registry.load_all()


@pytest.mark.parametrize("name", sorted(entry.registry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert isinstance(rows, list)
        return
    cur = con.execute(sql)
    orows = cur.fetchall()
    ocols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    idx = [ocols.index(c) for c in df.columns]
    assert sorted(tuple(_norm(x) for x in r) for r in rows) == sorted(tuple(_norm(r[i]) for i in idx) for r in orows)
