"""Boxes, port labels, Aarhus zones and the fact tables on them: hand-made days with worked-out results."""
from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, ping
from quayside import config
from quayside.operators import facts, regions
from quayside.plans.tables import Tables


def points(spark, *lat_lon):
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(lat_lon)],
                                 "event_id long, latitude float, longitude float")


def label_of(spark, *lat_lon, regions_=config.PORTS):
    return {r.event_id: r.port for r in regions.port_label(points(spark, *lat_lon), regions_).collect()}


def test_edges_belong_to_a_box_in_float32(spark):
    """Each port's four edges, from one step inside over the edge itself to one step outside (in float32)."""
    probes, inside = [], []
    for a, b, c, e in config.PORTS.values():
        mid_lat, mid_lon = np.float32((a + b) / 2), np.float32((c + e) / 2)
        for low, high, at in ((a, b, lambda v: (v, mid_lon)), (c, e, lambda v: (mid_lat, v))):
            for edge, out in ((np.float32(low), -np.inf), (np.float32(high), np.inf)):
                probes += [at(np.nextafter(edge, np.float32(-out))), at(edge), at(np.nextafter(edge, np.float32(out)))]
                inside += [True, True, False]
    kept = {r.event_id for r in regions.bbox_filter(points(spark, *probes)).collect()}
    assert [i in kept for i in range(len(probes))] == inside
    # compared in double, some of the edges themselves would be lost
    assert any(float(np.float32(v)) < v for box in config.PORTS.values() for v in (box[0], box[2]))


def test_labels_of_a_route(spark):
    """A voyage from Fredericia past open water to Aarhus and Aalborg; the last point has no position."""
    route = [(55.5701, 9.7512), (55.80, 9.95), (56.1555, 10.2218), (56.60, 10.60), (57.0444, 9.9171)]
    df = points(spark, *route).union(spark.createDataFrame([(9, None, 10.2)], "event_id long, latitude float, longitude float"))
    got = {r.event_id: r.port for r in regions.port_label(df).collect()}
    assert [got[i] for i in (0, 1, 2, 3, 4)] == ["fredericia", "", "aarhus", "", "aalborg"] and got[9] == ""
    assert {r.event_id for r in regions.filter_and_label(df).collect()} == {0, 2, 4}


def test_later_regions_win_where_boxes_overlap(spark):
    nested = {"sound": (54.0, 58.0, 9.0, 13.0), "bay": (56.0, 56.4, 10.0, 10.5), "quay": (56.1, 56.2, 10.1, 10.2)}
    at = [(56.15, 10.15), (56.3, 10.4), (55.0, 12.0), (50.0, 0.0)]
    assert label_of(spark, *at, regions_=nested) == {0: "quay", 1: "bay", 2: "sound", 3: ""}
    joined = regions.region_join(points(spark, *at), regions.regions_frame(spark, nested))
    assert sorted((r.event_id, r.region) for r in joined.collect()) == [
        (0, "bay"), (0, "quay"), (0, "sound"), (1, "bay"), (1, "sound"), (2, "sound")]


def test_region_join_equals_a_comparison_of_every_pair(spark):
    raw = Tables(spark, SF_SMALL).raw
    boxes = {**config.PORTS, **config.AARHUS_ZONES}
    got = {(r.event_id, r.region) for r in regions.region_join(raw, regions.regions_frame(spark, boxes)).collect()}
    f = np.float32
    want = {(r.event_id, n) for r, (n, (a, b, c, e)) in itertools.product(raw.select("event_id", "latitude", "longitude").collect(), boxes.items())
            if f(a) <= f(r.latitude) <= f(b) and f(c) <= f(r.longitude) <= f(e)}
    assert got == want and want


#: Positions around the harbour: where the zones are, one per stretch of an east-west line at three latitudes.
TRANSECTS = {
    56.12: [(10.16, "outer_approach"), (10.29, "outer_approach")],
    56.15: [(10.16, "anchorage"), (10.22, "anchorage"), (10.2234, "south_terminal"), (10.24, "south_terminal"), (10.29, "south_terminal")],
    56.165: [(10.24, "anchorage"), (10.2434, "south_terminal"), (10.26, "south_terminal")],
    56.20: [(10.16, None), (10.19, "north_terminal"), (10.29, "north_terminal")],
}


def test_zones_along_transects(spark, make_pings):
    """The diagonal runs from (56.14, 10.21) to (56.17, 10.25), so at 56.15 it is at 10.22333, at 56.165 at 10.24333."""
    spots = [(lat, lon, z) for lat, line in TRANSECTS.items() for lon, z in line]
    df = make_pings([ping(i, 7, lat=a, lon=b) for i, (a, b, _) in enumerate(spots)]).withColumn("port", F.lit("aarhus"))
    got = {r.event_id: r.zone for r in regions.assign_zones(df).collect()}
    assert [got.get(i) for i in range(len(spots))] == [z for *_, z in spots]


@pytest.fixture()
def harbour_day(make_pings):
    """A ferry that comes twice, a tanker at anchor over midnight, a tug whose type changes, and a silent one."""
    spot = {"o": (56.12, 10.2), "a": (56.15, 10.18), "s": (56.15, 10.28), "n": (56.2, 10.2)}
    log = [  # id, vessel, time, place, speed, status, type
        (1, 50, "2026-03-04 05:50:00", "o", 12.0, "Under way using engine", "Passenger"),
        (2, 50, "2026-03-04 06:05:00", "s", 3.0, "Under way using engine", "Passenger"),
        (3, 50, "2026-03-04 06:35:00", "s", 0.0, "Moored", "Passenger"),
        (4, 50, "2026-03-04 19:20:00", "s", 0.2, "Moored", "Passenger, HSC"),
        (5, 61, "2026-03-04 23:40:00", "a", 0.1, "At anchor", "Tanker"),
        (6, 61, "2026-03-05 00:10:00", "a", 0.4, "At anchor", "Tanker"),
        (7, 61, "2026-03-05 00:50:00", "a", 102.3, "At anchor", None),
        (8, 72, "2026-03-04 06:10:00", "s", 5.0, "Under way using engine", "Tug"),
        (9, 72, "2026-03-04 06:20:00", "s", 7.0, None, "Tug"),
        (10, 72, "2026-03-04 06:50:00", "n", 102.3, "Under way using engine", "Cargo"),
    ]
    rows = [ping(i, m, t, *spot[p], v, nav, typ) for i, m, t, p, v, nav, typ in log]
    return regions.assign_zones(make_pings(rows).withColumn("port", F.lit("aarhus")))


def by_key(df, *cols):
    return sorted(tuple(str(r[c]) if c == "date" else r[c] for c in cols) for r in df.collect())


def test_vessels_per_zone_hour(harbour_day):
    got = by_key(facts.hourly_stats(harbour_day, "zone"), "zone", "date", "hour", "vessel_type", "vessel_count")
    assert got == sorted([
        ("outer_approach", "2026-03-04", 5, "Passenger", 1), ("south_terminal", "2026-03-04", 6, "Passenger", 1),
        ("south_terminal", "2026-03-04", 6, "Tug", 1), ("south_terminal", "2026-03-04", 19, "HSC", 1),
        ("anchorage", "2026-03-04", 23, "Tanker", 1), ("anchorage", "2026-03-05", 0, "Tanker", 1),
        ("anchorage", "2026-03-05", 0, "Other", 1), ("north_terminal", "2026-03-04", 6, "Cargo", 1)])


def test_zone_visits(harbour_day):
    got = by_key(facts.visits(harbour_day, "zone", False), "mmsi", "zone", "date", "vessel_type", "ping_count", "dwell_minutes")
    assert got == sorted([
        (50, "outer_approach", "2026-03-04", "Passenger", 1, 0.0),
        (50, "south_terminal", "2026-03-04", "Passenger", 3, 795.0),  # 06:05 to 19:20; two of three pings are Passenger
        (61, "anchorage", "2026-03-04", "Tanker", 1, 0.0),
        (61, "anchorage", "2026-03-05", "Other", 2, 40.0),            # one ping each of Other and Tanker: the smaller name
        (72, "south_terminal", "2026-03-04", "Tug", 2, 10.0), (72, "north_terminal", "2026-03-04", "Cargo", 1, 0.0)])


def test_status_counts_skip_null(harbour_day):
    got = by_key(facts.navstatus_stats(harbour_day, "zone", True), "zone", "date", "vessel_type", "nav_status", "ping_count")
    assert ("south_terminal", "2026-03-04", "Tug", "Under way using engine", 1) in got
    assert ("anchorage", "2026-03-05", "Other", "At anchor", 1) in got and sum(r[-1] for r in got) == 9


def test_speeds_without_the_sentinel(harbour_day):
    got = by_key(facts.zone_speed_stats(harbour_day), "zone", "hour", "vessel_type", "sog_mean", "sog_median", "sog_p025", "sog_p95", "sog_p975")
    # of 5 and 7 knots: mean 6, and 5 + 2q at quantile q
    assert ("south_terminal", 6, "Tug", 6.0, 6.0, 5.05, 6.9, 6.95) in got
    assert ("anchorage", 0, "Tanker", 0.4, 0.4, 0.4, 0.4, 0.4) in got
    assert not [r for r in got if r[0] == "north_terminal" or r[2] == "Other"]  # only the sentinel there


def test_type_of_the_first_ping_of_a_day(make_pings):
    """Equal times go by event id, missing times come last."""
    rows = [ping(8, 1, "2026-03-04 10:00:00", ship_type="Tug"), ping(3, 1, "2026-03-04 10:00:00", ship_type="Cargo"),
            ping(1, 1, "2026-03-04 11:00:00", ship_type="Tanker"), ping(5, 2, "2026-03-04 09:00:00", ship_type="Fishing"),
            ping(-4, 3, "2026-03-04 09:00:00", ship_type="Tug"), ping(-9, 3, "2026-03-04 09:00:00", ship_type="SAR")]
    df = make_pings(rows).withColumn("port", F.lit("aarhus"))
    late = make_pings([ping(2, 2, None, ship_type="Cargo")]).withColumn("date", F.lit("2026-03-04").cast("date")).withColumn("port", F.lit("aarhus"))
    got = by_key(facts.type_distribution(df.union(late), "port"), "date", "vessel_type", "count")
    assert got == [("2026-03-04", "Cargo", 1), ("2026-03-04", "Fishing", 1), ("2026-03-04", "SAR", 1)]


def test_nothing_in_nothing_out(make_pings):
    none = make_pings([]).withColumn("port", F.lit("aarhus"))
    zoned = regions.assign_zones(none)
    assert regions.filter_and_label(none.drop("port")).count() == 0 and zoned.count() == 0
    assert facts.visits(zoned, "zone", False).count() == 0 and facts.zone_speed_stats(zoned).count() == 0
