"""Registered queries of interval joins and region tables of any size."""
from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators import intervals, regions
from quayside.plans import oracle as o
from quayside.plans.q_joins import reg
from quayside.plans.tables import Tables
from quayside.sources.fixture import read_table

# Every event asks for the vessel after its own, at its own time; the trail's length in seconds goes by its type, and is
# without limit for errors.
LENGTHS = {"click": 6 * 3600, "view": 24 * 3600, "signup": 72 * 3600, "purchase": 0}

_SECONDS = "CAST(epoch(date_trunc('second', ts)) AS BIGINT)"
_length = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in LENGTHS.items()) + " END"
o.cte("requests", [], f"""
SELECT event_id AS request, 219000001 + user_id AS mmsi, {_SECONDS} AS "at", {_length} AS length FROM events""")
o.cte("vessel_points", ["raw"], """
SELECT mmsi, CAST(epoch(ts) AS BIGINT) AS t, event_id, CAST(latitude AS DOUBLE) AS lat, CAST(longitude AS DOUBLE) AS lon, sog FROM raw
WHERE ts IS NOT NULL""")
# The newest point by the join of DuckDB itself, equal times reduced to the greatest id first.
o.cte("asof_point", ["requests", "vessel_points"], """
SELECT r.request, r.mmsi, r."at", r.length, p.t, p.event_id, p.lat, p.lon, p.sog FROM requests r ASOF JOIN (
  SELECT * FROM vessel_points QUALIFY row_number() OVER (PARTITION BY mmsi, t ORDER BY event_id DESC) = 1) p
ON r.mmsi = p.mmsi AND r."at" >= p.t""")


def _seconds(c: str):
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})")


def vessel_points(t: Tables):
    return t.raw.where("ts IS NOT NULL").select("mmsi", _seconds("ts").alias("t"), "event_id", F.col("latitude").cast("double").alias("lat"),
                                                F.col("longitude").cast("double").alias("lon"), "sog")


def requests(spark, sf_dir):
    second = "make_timestamp_ntz(year(ts), month(ts), day(ts), hour(ts), minute(ts), floor(second(ts)))"
    length = F.expr(f"CAST({_length} AS BIGINT)")
    return read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request"), F.expr("CAST(219000001 + user_id AS BIGINT)").alias("mmsi"), _seconds(second).alias("at"),
        length.alias("length"))


@reg("asof_requests", 'SELECT request, mmsi, "at", t, event_id, lat, lon, sog FROM asof_point', ["asof_point"])
def q_asof_requests(spark, sf_dir):
    """Where each asked-for vessel was at the instant of its request: thousands of requests, one scan of the points."""
    found = intervals.asof(vessel_points(Tables(spark, sf_dir)), requests(spark, sf_dir)).where("point IS NOT NULL")
    return found.select("request", "mmsi", "at", *[F.col(f"point.{c}").alias(c) for c in ("t", "event_id", "lat", "lon", "sog")])


@reg("trail_requests", """
SELECT r.request, r.mmsi, p.t, p.event_id, p.lat, p.lon, p.event_id = a.event_id AS is_latest
FROM requests r JOIN vessel_points p ON p.mmsi = r.mmsi AND p.t <= r."at" JOIN asof_point a ON a.request = r.request
WHERE r.length IS NULL OR p.t >= r."at" - r.length OR p.event_id = a.event_id""", ["requests", "vessel_points", "asof_point"])
def q_trail_requests(spark, sf_dir):
    """The trail of each asked-for vessel up to its instant, of the length asked for, some without limit."""
    found = intervals.trails(vessel_points(Tables(spark, sf_dir)), requests(spark, sf_dir))
    return found.select("request", "mmsi", "t", "event_id", "lat", "lon", "is_latest")


# Boxes of 0.01 to 100 degrees around places that the suppliers' keys give; some are long and thin.
_side = "CASE CAST({} % 5 AS INTEGER) WHEN 0 THEN 0.01e0 WHEN 1 THEN 0.1e0 WHEN 2 THEN 1e0 WHEN 3 THEN 10e0 ELSE 100e0 END"
_BOX = ["s_suppkey AS region", "54e0 + (s_suppkey * 37 % 80) / 10e0 AS lat0", "7e0 + (s_suppkey * 53 % 100) / 10e0 AS lon0",
        f"{_side.format('s_suppkey')} AS height", f"{_side.format('s_nationkey')} AS width"]
_BOUNDS = ["region", *[f"CAST({c}0 {sign} {size} / 2e0 AS FLOAT) AS {c}_{end}" for c, size in (("lat", "height"), ("lon", "width"))
                       for sign, end in (("-", "min"), ("+", "max"))]]


@reg("region_cover", f"""
SELECT b.region, count(*) AS pings, count(DISTINCT r.mmsi) AS vessels, min(r.event_id) AS first_event, max(r.event_id) AS last_event
FROM (SELECT {', '.join(_BOUNDS)} FROM (SELECT {', '.join(_BOX)} FROM supplier) s) b
JOIN raw r ON r.latitude BETWEEN b.lat_min AND b.lat_max AND r.longitude BETWEEN b.lon_min AND b.lon_max GROUP BY b.region""", ["raw"])
def q_region_cover(spark, sf_dir):
    """Pings and vessels in each of many boxes whose sizes differ by a factor of ten thousand."""
    boxes = read_table(spark, sf_dir, "supplier").selectExpr(*_BOX).selectExpr(*_BOUNDS)
    pings = Tables(spark, sf_dir).raw.select("event_id", "mmsi", "latitude", "longitude")
    return regions.region_counts(pings, boxes)
