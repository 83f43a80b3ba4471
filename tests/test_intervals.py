"""As-of and trail joins and the region cover, against brute force."""
from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.operators import intervals, regions

POINTS, REQUESTS = "mmsi long, t long, event_id long, lat double", "request long, mmsi long, at long, length long"


def cases(seed, hot=False):
    rng = random.Random(seed)
    vessel = (lambda: 1) if hot else (lambda: rng.randrange(6))
    points = [(vessel(), rng.choice([rng.randrange(-300, 3000), 500, 501]), i, float(i)) for i in range(400)]
    requests = [(i, rng.randrange(8) if not hot else 1, rng.choice([rng.randrange(-400, 3500), 500]), rng.choice([None, 0, 5, 100, 100_000, -1])) for i in range(150)]
    return points, requests


def newest(points, mmsi, at):
    found = [p for p in points if p[0] == mmsi and p[1] <= at]
    return max(found, key=lambda p: (p[1], p[2]), default=None)


@pytest.mark.parametrize("seed, hot, block", [(0, False, 100), (1, False, 7), (2, True, 50), (3, False, 10**6)])
def test_asof(spark, seed, hot, block):
    points, requests = cases(seed, hot)
    got = intervals.asof(spark.createDataFrame(points, POINTS), spark.createDataFrame(requests, REQUESTS), block=block)
    got = sorted((r.request, r.point and (r.mmsi, r.point.t, r.point.event_id, r.point.lat)) for r in got.collect())
    assert got == sorted((i, newest(points, m, at)) for i, m, at, _ in requests)


@pytest.mark.parametrize("seed, hot, width", [(0, False, 100), (1, False, 13), (2, True, 5000)])
def test_trails(spark, seed, hot, width):
    points, requests = cases(seed, hot)
    got = intervals.trails(spark.createDataFrame(points, POINTS), spark.createDataFrame(requests, REQUESTS), width=width, block=90)
    want = []
    for i, m, at, length in requests:
        last = newest(points, m, at)
        want += [(i, p[2], p == last) for p in points if p[0] == m and p[1] <= at and (p == last or length is None or p[1] >= at - length)]
    assert sorted((r.request, r.event_id, r.is_latest) for r in got.collect()) == sorted(want)


def test_asof_reads_points_once(spark):
    points, requests = cases(0)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    df = spark.createDataFrame(points, POINTS).withColumn("lat", counted("lat"))
    intervals.asof(df, spark.createDataFrame(requests, REQUESTS), block=100).collect()
    assert seen.value == len(points)


def test_no_points_or_requests(spark):
    points, requests = cases(0)
    none, some = spark.createDataFrame([], POINTS), spark.createDataFrame(requests, REQUESTS)
    assert all(r.point is None for r in intervals.asof(none, some).collect())
    assert intervals.trails(none, some).count() == 0
    assert intervals.asof(spark.createDataFrame(points, POINTS), spark.createDataFrame([], REQUESTS)).count() == 0


# --- regions ------------------------------------------------------------------------------------------------------

def boxes(seed, n=120):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        h, w = (rng.choice([0, 0.001, 0.01, 0.1, 1, 7.5, 100, 400]) for _ in range(2))
        lat, lon = rng.uniform(50, 60), rng.uniform(5, 15)
        out.append((i, lat - h / 2, lat + h / 2, lon - w / 2, lon + w / 2))
    inf, nan = math.inf, math.nan
    return out + [(900, -inf, inf, -inf, inf), (901, 55.0, inf, 9.0, 9.0), (902, 56.0, 55.0, 0.0, 20.0), (903, nan, nan, 0.0, 20.0), (904, 50.0, nan, 0.0, 20.0),
                  (905, None, 60.0, 0.0, 20.0), (906, 50.0, 60.0, 5.0, 15.0)]


BOX = "region long, lat_min float, lat_max float, lon_min float, lon_max float"


@pytest.mark.parametrize("seed", range(3))
def test_region_join_of_any_sizes(spark, seed):
    rng = random.Random(seed + 50)
    regs = boxes(seed)
    points = [(i, rng.uniform(49, 61), rng.uniform(4, 16)) for i in range(300)]
    points += [(1000 + i, *rng.choice([(b[1], b[3]), (b[2], b[4])])) for i, b in enumerate(regs[:120])]  # corners
    points += [(2000, math.nan, 9.0), (2001, None, 9.0), (2002, 1e9, -1e9)]
    got = regions.region_join(spark.createDataFrame(points, "event_id long, latitude float, longitude float"), spark.createDataFrame(regs, BOX))
    got = sorted((r.event_id, r.region) for r in got.select("event_id", "region").collect())
    f = np.float32
    want = sorted((i, r) for i, y, x in points for r, a, b, c, d in regs
                  if None not in (y, x, a, b, c, d) and f(a) <= f(y) <= f(b) and f(c) <= f(x) <= f(d))
    assert got == want and len(want) > 500


def test_a_region_has_four_cells_at_most(spark):
    cells = regions.region_cells(spark.createDataFrame(boxes(9, 400), BOX)).groupBy("region").count()
    assert 1 <= cells.agg(F.min("count")).first()[0] and cells.agg(F.max("count")).first()[0] <= 4
    assert regions.region_join(spark.createDataFrame([(1, 5.0, 5.0)], "event_id long, latitude float, longitude float"), spark.createDataFrame([], BOX)).count() == 0


@pytest.mark.parametrize("seed, dense", [(0, 1), (1, 3), (2, 256)])
def test_region_counts_against_every_pair(spark, monkeypatch, seed, dense):
    monkeypatch.setattr(regions, "DENSE", dense)
    rng, f = random.Random(seed + 90), np.float32
    regs = boxes(seed, 60)
    regs += regs[:5] + [(None, 50.0, 60.0, 5.0, 15.0)]  # repeated, and without a key
    near = [(rng.uniform(54, 56), rng.uniform(9, 11)) for _ in range(4)]
    ship = lambda: rng.choice([None, 0, -40_000, 219_000_001, 219_000_002, 219_000_003, 219_400_000, 1 << 40])
    pings = [(i, ship(), *((a + rng.gauss(0, 0.2), o + rng.gauss(0, 0.2)) if i % 2 else (rng.uniform(49, 61), rng.uniform(4, 16)))) for i, (a, o) in
             ((i, rng.choice(near)) for i in range(500))]
    pings += [(1000 + i, ship(), *rng.choice([(b[1], b[3]), (b[2], b[4])])) for i, b in enumerate(regs[:60])]  # corners
    pings += [(2000, 1, math.nan, 9.0), (2001, 1, None, 9.0), (2002, 1, 1e9, -1e9), (2003, 1, math.inf, 9.0), (2004, 1, 55.125, 9.125), (None, 1, 55.0, 9.0)]
    got = regions.region_counts(spark.createDataFrame(pings, "event_id long, mmsi long, latitude float, longitude float"), spark.createDataFrame(regs, BOX))
    want: dict = {}
    for r, a, b, c, d in regs:
        for e, m, y, x in pings:
            if None not in (y, x, a, b, c, d) and f(a) <= f(y) <= f(b) and f(c) <= f(x) <= f(d):
                want.setdefault(r, []).append((e, m))
    ids = lambda v: [e for e, _ in v if e is not None]
    assert {r.region: (r.pings, r.vessels, r.first_event, r.last_event) for r in got.collect()} == {
        r: (len(v), len({m for _, m in v}), min(ids(v), default=None), max(ids(v), default=None)) for r, v in want.items()}


def test_a_box_takes_tiles_as_a_whole(spark, monkeypatch):
    """2,000 pings in 100 boxes that hold them all: no row for each ping and box."""
    made, join = [], regions.region_join
    monkeypatch.setattr(regions, "region_join", lambda p, r: made.append(join(p, r)) or made[-1])
    pings = spark.range(2000).selectExpr("id AS event_id", "id % 300 AS mmsi", "FLOAT(55 + id % 41 / 100) AS latitude", "FLOAT(9 + id % 37 / 100) AS longitude")
    found = regions.region_counts(pings, spark.createDataFrame([(i, 54.0 - i, 57.0, 8.0, 11.0 + i) for i in range(100)], BOX)).collect()
    assert [(r.pings, r.vessels, r.first_event, r.last_event) for r in found] == [(2000, 300, 0, 1999)] * 100
    assert made and sum(m.count() for m in made) < 2000


@pytest.mark.parametrize("leaf, small", [(1, -1), (4, 10**6)])
def test_region_counts_of_split_tiles(spark, monkeypatch, leaf, small):
    """Pings in heaps of a few metres to some kilometres, so that borders cross tiles of all levels; with no table broadcast, or all."""
    monkeypatch.setattr(regions, "LEAF", leaf)
    monkeypatch.setattr(regions, "SMALL", small)
    monkeypatch.setattr(regions, "FEW_BITS", small)
    monkeypatch.setattr(regions, "DENSE", 5)
    rng, f = random.Random(leaf), np.float32
    heaps = [(rng.uniform(-20, 60), rng.uniform(-20, 15), rng.choice([1e-4, 1e-3, 0.01, 0.1])) for _ in range(6)]
    pings = [(i, rng.randrange(40), rng.gauss(a, d), rng.gauss(o, d)) for i in range(600) for a, o, d in [rng.choice(heaps)]]
    pings += [(700, 1, 3e5, 3e5), (701, 2, 1e30, -1e30), (702, 3, math.inf, 0.0), (703, 4, -0.0, 0.0)]
    regs = [(i, a - h, a + rng.random() * h, o - rng.random() * w, o + w) for i in range(80) for a, o, d in [rng.choice(heaps)]
            for h, w in [(d * rng.choice([0.5, 1, 2, 100]), d * rng.choice([0.5, 1, 2, 100]))]]
    regs += [(90, 2.5e5, math.inf, 0.0, math.inf), (91, 1e29, 1e31, -math.inf, 0.0), (92, 4e5, math.inf, -1.0, 1.0), (93, 0.0, 0.0, -0.0, 0.0)]
    got = regions.region_counts(spark.createDataFrame(pings, "event_id long, mmsi long, latitude float, longitude float"), spark.createDataFrame(regs, BOX))
    want: dict = {}
    for r, a, b, c, d in regs:
        for e, m, y, x in pings:
            if f(a) <= f(y) <= f(b) and f(c) <= f(x) <= f(d):
                want.setdefault(r, []).append((e, m))
    assert "BroadcastExchange" not in got._jdf.queryExecution().executedPlan().toString() or small > 0
    assert {r.region: (r.pings, r.vessels, r.first_event, r.last_event) for r in got.collect()} == {
        r: (len(v), len({m for _, m in v}), min(v)[0], max(v)[0]) for r, v in want.items()}
    assert len(want) > 60 and {90, 91, 92, 93} <= want.keys()


def test_pings_are_never_broadcast(spark, monkeypatch):
    """However small Spark takes the pings to be: ``inline`` makes a row of each for every pair of levels."""
    monkeypatch.setattr(regions, "SMALL", 1000, raising=False)
    pings = spark.range(5000).selectExpr("id AS event_id", "FLOAT(54 + id % 100 / 20) AS latitude", "FLOAT(8 + id % 90 / 30) AS longitude")
    for n in (100, 1000):
        boxes = spark.range(n).selectExpr("id AS region", "FLOAT(54) AS lat_min", "FLOAT(54.1 + id % 7) AS lat_max", "FLOAT(8) AS lon_min", "FLOAT(8.1 + id % 5) AS lon_max")
        boxes = boxes.crossJoin(spark.range(1).toDF("one")).drop("one").checkpoint()  # taken for larger than it is
        plan = regions.region_join(pings, boxes)._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan and "BuildRight" in plan) if n == 100 else "Broadcast" not in plan
