"""Nearest neighbours by the graph, against brute force."""
from __future__ import annotations

import numpy as np
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from quayside.llm import op11_ann as ann

SCHEMA = "vec_id long, embedding array<double>"


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, k=20, every=20):
    """(query row, rank) -> (vec_id, score); rows by place."""
    rows = [(i, v) for i, v in rows if usable(v)]
    out = []
    for at, (i, v) in enumerate(rows):
        if i is None or i % every:
            continue
        near = sorted((-float(np.dot(v, w)), j is None, j or 0, b) for b, (j, w) in enumerate(rows) if b != at and len(w) == len(v))[:k]
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j, _) in enumerate(near)]
    return out


def found(spark, rows, extra=(), **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in extra:
        df = df.withColumn(c, F.lit("x"))
    return [tuple(r) for r in ann.nearest(df, **options).select("query_id", "rank", "vec_id", "score").collect()]


def same(got, want):
    key = lambda r: (r[0], r[1], r[2] is None, r[2] or 0)
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    np.testing.assert_allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12, atol=1e-12)


def recall(got, want, rows, k):
    """Share of the true nearest that were found, ties counting as found by score."""
    worst = {}
    for q, r, _, s in want:
        worst[q] = min(worst.get(q, np.inf), s)
    good = sum(s >= worst[q] - 1e-12 for q, _, _, s in got)
    return good / len(want)


@pytest.mark.parametrize("kind", ["unit", "lengths", "clusters", "copies"])
def test_recall_over_shards(spark, monkeypatch, kind):
    monkeypatch.setattr(ann, "SHARD", 700)
    monkeypatch.setattr(ann, "BLOCK", 40)
    rng = np.random.default_rng(3)
    x = rng.standard_normal((2500, 32))
    if kind == "clusters":
        x = x * 0.1 + rng.standard_normal((12, 32))[rng.integers(0, 12, len(x))]
    if kind == "copies":
        x[rng.random(len(x)) < 0.4] = x[0]
    if kind == "lengths":
        x *= np.exp(rng.standard_normal((len(x), 1)))
    else:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = found(spark, rows), brute(rows)
    assert len(got) == len(want) and recall(got, want, rows, 20) >= 0.97
    for q, _, i, s in got:
        assert i != q and abs(float(x[q] @ x[i]) - s) < 1e-10
    got = sorted(got)
    for (q, r, i, s), (q1, r1, i1, s1) in zip(got, got[1:]):
        assert (r1 == 1) if q != q1 else (r1 == r + 1 and (-s, i) < (-s1, i1))


def test_recall_on_the_given_table(spark):
    sf = "/root/testdata/sf0.1"
    t = ds.dataset(f"{sf}/embeddings.parquet").to_table(columns=["vec_id", "embedding"])
    rows = list(zip(t.column("vec_id").to_pylist(), t.column("embedding").to_pylist()))
    got, want = [tuple(r) for r in ann.op11_ann(spark, sf).collect()], brute(rows)
    assert len(got) == len(want) and recall(got, want, rows, 20) >= 0.98


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v) for i, v in enumerate(rng.integers(-2, 3, (60, 3)).astype(float).tolist())]  # many ties and copies, some zero
    same(found(spark, rows, ("row", "key", "score", "dim")), brute(rows))
    same(found(spark, rows, k=3, every=7), brute(rows, 3, 7))


def test_defined_cases(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [1.0, 0.0]), (None, [1.0, 0.0]), (1, [1.0, 0.0]), (40, None), (60, []), (80, [0.0, 0.0]), (100, [1.0, None]),
            (120, [float("nan"), 1.0]), (140, [float("inf"), 1.0]), (160, [1.0, 2.0, 3.0]), (-20, [0.5, -0.0]), (2, [0.5, 0.0]), (None, [3.0, 1.0]), (180, [1e200, -1e200])]
    same(found(spark, rows), brute(rows))
    assert found(spark, []) == [] and found(spark, [(0, [1.0])]) == [] and found(spark, [(3, [1.0]), (5, [2.0])]) == []
    assert {r[0] for r in found(spark, rows)} == {0, 20, -20, 180}  # 160 has no other of its length


def test_pruning_keeps_the_nearest_and_what_it_does_not_cover():
    x = ann.level(np.array([[1, 0, 0], [0.99, 0.1, 0], [0.98, 0.11, 0], [0.7, -0.7, 0], [0, 0, 1.0]]))
    kept = ann.robust_prune(x, np.array([0]), np.array([[4, 3, 2, 1, 1, 0, -1]]), 1.2)[0]
    assert kept[:3].tolist() == [1, 3, 4] and (kept[3:] == -1).all()  # 2 is covered by 1; repeats and the point itself go
