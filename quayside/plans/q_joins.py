"""Registered projection/predicate operators (P) and join operators (J)."""
from __future__ import annotations

from pyspark.sql import functions as F

from quayside import config
from quayside.functions import geo, numeric, timeparts, vessel
from quayside.operators import dims, joins, regions
from quayside.plans import oracle as o
from quayside.plans.registry import register
from quayside.plans.tables import Tables

EPOCH = "2024-01-01 00:00:00"                 # month start of the test data
DATE_WINDOW = ("2024-01-08", "2024-01-21")    # the export window used by date_window

isod, isots = o.iso_date, o.iso_ts


def reg(name, sql=None, needs=()):
    def deco(fn):
        register(name, o.build(sql, list(needs)) if sql is not None else None)(fn)
        return fn
    return deco


# ---------------------------------------------------------------------------
# P: projections, predicates, scalar functions
# ---------------------------------------------------------------------------
@reg("bbox_filter", f"SELECT event_id, mmsi, latitude, longitude FROM raw WHERE "
                    f"{' OR '.join(o.box(b) for b in config.PORTS.values())}", ["raw"])
def q_bbox_filter(spark, sf_dir):
    return regions.bbox_filter(Tables(spark, sf_dir).raw).select("event_id", "mmsi", "latitude", "longitude")


_label = "CASE " + " ".join(f"WHEN {o.box(b)} THEN {o.sq(n)}" for n, b in reversed(list(config.PORTS.items()))) \
         + " ELSE '' END"


@reg("port_label", f"SELECT event_id, {_label} AS port FROM raw", ["raw"])
def q_port_label(spark, sf_dir):
    return regions.port_label(Tables(spark, sf_dir).raw).select("event_id", "port")


@reg("assign_zones", "SELECT event_id, zone FROM zoned", ["zoned"])
def q_assign_zones(spark, sf_dir):
    return Tables(spark, sf_dir).zoned.select("event_id", "zone")


@reg("zone_index", f"""
SELECT event_id, lat5, lon5, {o.zone_index_case('lat5', 'lon5')} AS z FROM (
  SELECT event_id, round_even(CAST(latitude AS DOUBLE), 5) AS lat5, round_even(CAST(longitude AS DOUBLE), 5) AS lon5
  FROM pings WHERE port = 'aarhus') p""", ["pings"])
def q_zone_index(spark, sf_dir):
    p = Tables(spark, sf_dir).pings.where(F.col("port") == "aarhus")
    p = p.select("event_id", F.bround(F.col("latitude").cast("double"), 5).alias("lat5"),
                 F.bround(F.col("longitude").cast("double"), 5).alias("lon5"))
    return p.withColumn("z", geo.zone_index(F.col("lat5"), F.col("lon5")))


@reg("normalise_type", f"SELECT ship_type, {o.type_last_wins()} AS vessel_type, count(*) AS pings "
                       "FROM raw GROUP BY ship_type", ["raw"])
def q_normalise_type(spark, sf_dir):
    r = Tables(spark, sf_dir).raw
    return (r.groupBy("ship_type").agg(F.count(F.lit(1)).alias("pings"))
            .transform(vessel.with_vessel_type))


@reg("normalise_type_first", f"SELECT ship_type, {o.type_first_wins()} AS type, count(*) AS pings "
                             "FROM raw GROUP BY ship_type", ["raw"])
def q_normalise_type_first(spark, sf_dir):
    r = Tables(spark, sf_dir).raw
    return (r.groupBy("ship_type").agg(F.count(F.lit(1)).alias("pings"))
            .transform(lambda d: vessel.with_vessel_type(d, out="type", first_wins=True)))


@reg("coverage_filter", f"SELECT event_id, mobile_type FROM raw WHERE {o.box_double(config.COVERAGE_BOX)} "
                        f"AND mobile_type IN {o.in_list(config.MOBILE_TYPES)}", ["raw"])
def q_coverage_filter(spark, sf_dir):
    return regions.coverage_filter(Tables(spark, sf_dir).raw).select("event_id", "mobile_type")


@reg("valid_speed", "SELECT event_id, CASE WHEN sog < 102.3e0 THEN CAST(sog AS DOUBLE) END AS sog_valid FROM pings",
     ["pings"])
def q_valid_speed(spark, sf_dir):
    p = Tables(spark, sf_dir).pings
    return p.select("event_id", vessel.speed_or_null(F.col("sog")).cast("double").alias("sog_valid"))


@reg("time_buckets", f"""
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS minute_of_day,
       CAST(trunc(date_diff('second', TIMESTAMP '{EPOCH}', ts) / 60e0) AS INTEGER) AS minutes_since_epoch,
       CAST(floor((hour(ts) * 60 + minute(ts)) / {config.DAY_MAP_BUCKET_MINUTES}) AS INTEGER) AS bucket_10m
FROM pings""", ["pings"])
def q_time_buckets(spark, sf_dir):
    p = Tables(spark, sf_dir).pings
    mod = timeparts.minute_of_day(F.col("ts"))
    return p.select("event_id", F.hour("ts").alias("hour"), mod.alias("minute_of_day"),
                    timeparts.minutes_since(F.col("ts"), EPOCH).alias("minutes_since_epoch"),
                    timeparts.bucket(mod, config.DAY_MAP_BUCKET_MINUTES).alias("bucket_10m"))


@reg("day_of_week", f"SELECT DISTINCT {isod('date')} AS date, {o.dow_sun0('date')} AS dow_sun0, "
                    f"{o.dow_mon0('date')} AS dow_mon0 FROM pings", ["pings"])
def q_day_of_week(spark, sf_dir):
    d = Tables(spark, sf_dir).pings.select("date").distinct()
    return d.select(timeparts.iso_date(F.col("date")).alias("date"),
                    timeparts.dow_sunday0(F.col("date")).alias("dow_sun0"),
                    timeparts.dow_monday0(F.col("date")).alias("dow_mon0"))


@reg("date_window", f"""
SELECT port, {isod('date')} AS date, CAST(sum(vessel_count) AS BIGINT) AS vessel_count FROM port_hourly
WHERE date BETWEEN DATE '{DATE_WINDOW[0]}' AND DATE '{DATE_WINDOW[1]}' GROUP BY port, date""", ["port_hourly"])
def q_date_window(spark, sf_dir):
    """Export window: the date predicate is applied to the pings, so on a date-partitioned
    ping table only the window's partitions are read."""
    t = Tables(spark, sf_dir, *DATE_WINDOW)
    return (t.port_hourly_stats.groupBy("port", "date").agg(F.sum("vessel_count").alias("vessel_count"))
            .select("port", timeparts.iso_date(F.col("date")).alias("date"), "vessel_count"))


@reg("rounding", f"""
SELECT mmsi, port, {isod('date')} AS date, secs / 60e0 AS dwell_raw,
       {o.round_even('secs / 60e0', 1)} AS dwell_even, {o.round_half_up('secs / 60e0', 1)} AS dwell_half_up
FROM (SELECT mmsi, port, date, date_diff('second', first_seen, last_seen) AS secs FROM port_visits) v""",
     ["port_visits"])
def q_rounding(spark, sf_dir):
    """Both rounding rules side by side on the dwell minutes (3 s = 0.05 min -> 0.0 vs 0.1)."""
    v = Tables(spark, sf_dir).vessel_visits
    raw = timeparts.seconds_between(F.col("first_seen"), F.col("last_seen")) / F.lit(60.0)
    return v.select("mmsi", "port", timeparts.iso_date(F.col("date")).alias("date"), raw.alias("dwell_raw"),
                    numeric.round_even(raw, 1).alias("dwell_even"), numeric.round_half_up(raw, 1).alias("dwell_half_up"))


@reg("port_dimension", f"""
SELECT d.port_order, d.name, d.key, {o.round_even('(d.lat_min + d.lat_max) / 2e0', 4)} AS lat,
       {o.round_even('(d.lon_min + d.lon_max) / 2e0', 4)} AS lon, d.lat_min, d.lat_max, d.lon_min, d.lon_max,
       coalesce(s.pings, 0) AS pings, coalesce(s.vessels, 0) AS vessels
FROM (VALUES {', '.join(f"({i}, {o.sq(n.capitalize())}, {o.sq(n)}, {o.d(b[0])}, {o.d(b[1])}, {o.d(b[2])}, {o.d(b[3])})"
                        for i, (n, b) in enumerate(config.PORTS.items()))})
     d(port_order, name, key, lat_min, lat_max, lon_min, lon_max)
LEFT JOIN (SELECT port, count(*) AS pings, count(DISTINCT mmsi) AS vessels FROM pings GROUP BY port) s
       ON s.port = d.key""", ["pings"])
def q_port_dimension(spark, sf_dir):
    """The region dimension with live coverage: pings and vessels per port box."""
    stats = (Tables(spark, sf_dir).pings.groupBy("port")
             .agg(F.count(F.lit(1)).alias("pings"), F.count_distinct("mmsi").alias("vessels")))
    dim = dims.port_dimension(spark)
    return (dim.join(stats, dim.key == stats.port, "left").drop("port")
            .na.fill(0, ["pings", "vessels"]))


_verts = []
for _order, _name in enumerate(config.ZONE_ORDER):
    _a, _b, _c, _e = config.AARHUS_ZONES[_name]
    (_sl, _so), (_nl, _no) = config.ANCHORAGE_DIAGONAL
    _vs = {"anchorage": [(_a, _c), (_a, _so), (_b, _no), (_b, _c)],
           "south_terminal": [(_a, _so), (_a, _e), (_b, _e), (_b, _no)]}.get(_name, [(_a, _c), (_a, _e), (_b, _e), (_b, _c)])
    for _i, (_la, _lo) in enumerate(_vs):
        _verts.append(f"({_order}, {o.sq(_name)}, {o.sq(config.ZONE_LABELS[_name])}, {_i}, {o.d(_la)}, {o.d(_lo)})")


@reg("zone_polygons", f"""SELECT * FROM (
WITH v AS (SELECT * FROM (VALUES {', '.join(_verts)}) v(zone_order, zone, label, vertex, lat, lon)),
     lp AS (SELECT zone,
                   (((max(CASE WHEN vertex = 0 THEN lat END) + max(CASE WHEN vertex = 1 THEN lat END))
                      + max(CASE WHEN vertex = 2 THEN lat END)) + max(CASE WHEN vertex = 3 THEN lat END)) / 4 AS label_lat,
                   (((max(CASE WHEN vertex = 0 THEN lon END) + max(CASE WHEN vertex = 1 THEN lon END))
                      + max(CASE WHEN vertex = 2 THEN lon END)) + max(CASE WHEN vertex = 3 THEN lon END)) / 4 AS label_lon
            FROM v GROUP BY zone),
     zc AS (SELECT zone, count(*) AS pings FROM zoned GROUP BY zone)
SELECT v.zone_order, v.zone, v.label, v.vertex, v.lat, v.lon, lp.label_lat, lp.label_lon,
       coalesce(zc.pings, 0) AS pings
FROM v JOIN lp ON lp.zone = v.zone LEFT JOIN zc ON zc.zone = v.zone) q""", ["zoned"])
def q_zone_polygons(spark, sf_dir):
    """Zone polygons, their label points and the pings each zone holds."""
    poly = dims.zone_polygons(spark)
    counts = Tables(spark, sf_dir).zoned.groupBy("zone").agg(F.count(F.lit(1)).alias("pings"))
    return (poly.join(dims.zone_label_points(poly), "zone").join(counts, "zone", "left")
            .na.fill(0, ["pings"])
            .select("zone_order", "zone", "label", "vertex", "lat", "lon", "label_lat", "label_lon", "pings"))


# ---------------------------------------------------------------------------
# J: joins
# ---------------------------------------------------------------------------
ALL_REGIONS = {**config.PORTS, **config.AARHUS_ZONES}


@reg("region_join", "SELECT r.event_id, g.region FROM raw r JOIN (VALUES " +
     ", ".join(f"({o.sq(n)}, {o.f32(b[0])}, {o.f32(b[1])}, {o.f32(b[2])}, {o.f32(b[3])})" for n, b in ALL_REGIONS.items()) +
     ") g(region, lat_min, lat_max, lon_min, lon_max) ON r.latitude BETWEEN g.lat_min AND g.lat_max "
     "AND r.longitude BETWEEN g.lon_min AND g.lon_max", ["raw"])
def q_region_join(spark, sf_dir):
    """Every (ping, region) containment over ports and zones (zones overlap ports and each
    other's plain boxes), via the grid-cell equi-join."""
    regs = regions.regions_frame(spark, ALL_REGIONS)
    return regions.region_join(Tables(spark, sf_dir).raw, regs).select("event_id", "region")


o.cte("core", ["pings"], f"SELECT * FROM pings WHERE port = 'aarhus' AND mobile_type IN {o.in_list(config.MOBILE_TYPES)}"
                         " AND ts IS NOT NULL")
o.cte("approach", ["raw"], f"SELECT * FROM raw WHERE {o.box_double(config.APPROACH_BOX)} "
                           f"AND mobile_type IN {o.in_list(config.MOBILE_TYPES)} AND ts IS NOT NULL")


@reg("approach_semi", "SELECT event_id, mmsi FROM approach a WHERE EXISTS (SELECT 1 FROM core c WHERE c.mmsi = a.mmsi)",
     ["approach", "core"])
def q_approach_semi(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return joins.approach_semi(t.raw, joins.core_pings(t.pings)).select("event_id", "mmsi")


@reg("entries_anti", f"""
SELECT v.mmsi, v.port, {isod('v.date')} AS date FROM port_visits v
WHERE NOT EXISTS (SELECT 1 FROM port_visits y WHERE y.mmsi = v.mmsi AND y.port = v.port AND y.date = v.date - 1)""",
     ["port_visits"])
def q_entries_anti(spark, sf_dir):
    v = Tables(spark, sf_dir).vessel_visits.select("mmsi", "port", "date")
    return joins.entries_anti(v).select("mmsi", "port", timeparts.iso_date(F.col("date")).alias("date"))


@reg("exits_anti", f"""
SELECT v.mmsi, v.port, {isod('v.date')} AS date FROM port_visits v
WHERE NOT EXISTS (SELECT 1 FROM port_visits y WHERE y.mmsi = v.mmsi AND y.port = v.port AND y.date = v.date + 1)""",
     ["port_visits"])
def q_exits_anti(spark, sf_dir):
    v = Tables(spark, sf_dir).vessel_visits.select("mmsi", "port", "date")
    return joins.exits_anti(v).select("mmsi", "port", timeparts.iso_date(F.col("date")).alias("date"))
