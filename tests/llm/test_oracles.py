"""Queries of this subpackage that SQL can express, against DuckDB on the smallest tables."""
from __future__ import annotations

import duckdb
import pytest

from quayside.llm import registry

SF = "/root/testdata/sf0.001"
registry.load_all()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_operators_and_their_sql():
    assert sorted(int(n.split("_")[0][2:]) for n in registry.QUERIES) == list(range(1, 14))
    assert set(registry.ORACLES) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(registry.ORACLES[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns) and rows
    want = [tuple(r[cols.index(c)] for c in df.columns) for r in cur.fetchall()]
    assert sorted(map(repr, rows)) == sorted(map(repr, want))
