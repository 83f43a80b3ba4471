"""Registered track, downsampling, metadata and as-of queries (W4, W5, W8, N1, N2, N4,
A11, P19, J9-J11)."""
from __future__ import annotations

from pyspark.sql import functions as F

from quayside import config
from quayside.functions import vessel
from quayside.operators import tracks
from quayside.plans import oracle as o
from quayside.plans import q_joins  # noqa: F401  (core / approach CTEs)
from quayside.plans.q_joins import reg
from quayside.plans.tables import Tables

ASOF_T = 20160            # minute 20,160 of the month = day 15, 00:00
TRAIL_MINUTES = 360       # the 6-hour trail

# A viewport of the harbour, its padding, and filters of the as-of queries.
VIEW, VIEW_PAD = (56.12, 56.19, 10.18, 10.28), 0.1
ASOF_TYPES, ASOF_ZONES = ["Cargo", "Tanker", "Passenger"], [0, 1, None]


def _first(c: str) -> str:
    return f"first({c} ORDER BY ts, event_id) FILTER (WHERE {c} IS NOT NULL)"


def _mode(col: str, keys: str, src: str) -> str:
    return f"""SELECT {keys}, {col} FROM (
  SELECT {keys}, {col}, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {col}) AS rn
  FROM {src} WHERE {col} IS NOT NULL GROUP BY {keys}, {col}) m WHERE rn = 1"""


# ---- day map -------------------------------------------------------------------
o.cte("day_src", ["raw"], f"""
SELECT *, CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS t, {o.type_first_wins()} AS type FROM raw
WHERE {o.box_double(config.COVERAGE_BOX)} AND mobile_type IN {o.in_list(config.MOBILE_TYPES)} AND ts IS NOT NULL""")
o.cte("day_down", ["day_src"], f"""
SELECT date, mmsi, CAST(floor(t / {config.DAY_MAP_BUCKET_MINUTES}) AS INTEGER) AS bucket, first(t ORDER BY ts, event_id) AS t,
       {_first('latitude')} AS latitude, {_first('longitude')} AS longitude, {_first('sog')} AS sog,
       {_first('name')} AS name, {_first('type')} AS type
FROM day_src GROUP BY date, mmsi, bucket""")
o.cte("day_name", ["day_src"], _mode("name", "date, mmsi", "day_src"))
o.cte("day_type", ["day_src"], _mode("type", "date, mmsi", "day_src"))
_day_tracks = f"""
SELECT d.date, d.mmsi, trim(coalesce(n.name, '')) AS name, ty.type, d.n_points, d.first_t, d.last_t, d.track_json
FROM (SELECT date, mmsi, CAST(count(*) AS INTEGER) AS n_points, min(t) AS first_t, max(t) AS last_t,
             '[' || string_agg('{{"t":' || CAST(t AS VARCHAR)
                   || ',"lat":' || CAST(round_even(CAST(latitude AS DOUBLE), 5) AS VARCHAR)
                   || ',"lon":' || CAST(round_even(CAST(longitude AS DOUBLE), 5) AS VARCHAR)
                   || ',"sog":' || coalesce(CAST(round_even(CAST(sog AS DOUBLE), 1) AS VARCHAR), 'null') || '}}',
                   ',' ORDER BY t) || ']' AS track_json
      FROM day_down GROUP BY date, mmsi HAVING count(*) >= {{least}}) d
LEFT JOIN day_name n ON n.date = d.date AND n.mmsi = d.mmsi
JOIN day_type ty ON ty.date = d.date AND ty.mmsi = d.mmsi"""
o.cte("day_tracks", ["day_down", "day_name", "day_type"], _day_tracks.replace("{least}", str(config.DAY_MAP_MIN_POINTS)))
# The same from two points on: vessels of the test data have about two pings a day.
o.cte("day_tracks_short", ["day_down", "day_name", "day_type"], _day_tracks.replace("{least}", "2"))


@reg("downsample_10m", f"SELECT {o.iso_date('date')} AS date, mmsi, bucket, t, latitude, longitude, sog, name, type "
                       "FROM day_down", ["day_down"])
def q_downsample_10m(spark, sf_dir):
    d = tracks.downsample(tracks.day_map_pings(Tables(spark, sf_dir).raw), ["date", "mmsi"],
                          config.DAY_MAP_BUCKET_MINUTES)
    return d.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "mmsi", "bucket", "t", "latitude",
                    "longitude", "sog", "name", "type")


@reg("tracks_day", f"SELECT {o.iso_date('date')} AS date, mmsi, name, type, n_points, track_json FROM day_tracks",
     ["day_tracks"])
def q_tracks_day(spark, sf_dir):
    """Day-map tracks for every day of the data (the reference builds one day per run)."""
    tr = tracks.day_tracks(Tables(spark, sf_dir).raw)
    return tr.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "mmsi", "name", "type", "n_points",
                     tracks.track_json(tr, keep_nulls=True).alias("track_json"))


@reg("track_with_meta", f"SELECT {o.iso_date('date')} AS date, mmsi, name, type, n_points, first_t, last_t "
                        "FROM day_tracks", ["day_tracks"])
def q_track_with_meta(spark, sf_dir):
    tr = tracks.day_tracks(Tables(spark, sf_dir).raw)
    return tr.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "mmsi", "name", "type", "n_points",
                     F.col("track")[0]["t"].alias("first_t"), F.element_at("track", -1)["t"].alias("last_t"))


@reg("tracks_day_short", f"SELECT {o.iso_date('date')} AS date, mmsi, name, type, n_points, first_t, last_t, track_json "
                          "FROM day_tracks_short", ["day_tracks_short"])
def q_tracks_day_short(spark, sf_dir):
    """Day tracks and their vessel data from two points on, so that the test data has some."""
    tr = tracks.day_tracks(Tables(spark, sf_dir).raw, min_points=2)
    return tr.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "mmsi", "name", "type", "n_points",
                     F.col("track")[0]["t"].alias("first_t"), F.element_at("track", -1)["t"].alias("last_t"),
                     tracks.track_json(tr, keep_nulls=True).alias("track_json"))


o.cte("meta_all_name", ["day_src"], _mode("name", "mmsi", "day_src"))
o.cte("meta_all_type", ["day_src"], _mode("type", "mmsi", "day_src"))
o.cte("vessel_meta", ["meta_all_name", "meta_all_type"], """
SELECT t.mmsi, trim(coalesce(n.name, '')) AS name, t.type FROM meta_all_type t
LEFT JOIN meta_all_name n ON n.mmsi = t.mmsi""")


@reg("vessel_meta", "SELECT * FROM vessel_meta", ["vessel_meta"])
def q_vessel_meta(spark, sf_dir):
    """Dominant name and type per vessel over all its coverage pings."""
    return tracks.vessel_meta(tracks.day_map_pings(Tables(spark, sf_dir).raw), ["mmsi"])


@reg("display_name", """
SELECT mmsi, CASE WHEN name IS NOT NULL AND trim(name) <> '' AND name <> 'nan' THEN name
                  ELSE 'MMSI ' || CAST(mmsi AS VARCHAR) END AS display_name FROM vessel_meta""", ["vessel_meta"])
def q_display_name(spark, sf_dir):
    m = tracks.vessel_meta(tracks.day_map_pings(Tables(spark, sf_dir).raw), ["mmsi"])
    return m.select("mmsi", vessel.display_name(F.col("name"), F.col("mmsi")).alias("display_name"))


# ---- month map -----------------------------------------------------------------
o.cte("month_union", ["core", "approach"], f"""
SELECT *, CAST(floor(date_diff('second', date_trunc('month', ts), ts) / 60e0) AS INTEGER) AS t, {o.type_first_wins()} AS type
FROM (SELECT event_id, strftime(ts, '%Y-%m') AS month, mmsi, ts, latitude, longitude, sog, name, ship_type, 0 AS src FROM core
      UNION ALL
      SELECT event_id, strftime(ts, '%Y-%m'), mmsi, ts, latitude, longitude, sog, name, ship_type, 1 AS src FROM approach a
      WHERE EXISTS (SELECT 1 FROM core c WHERE c.mmsi = a.mmsi AND date_trunc('month', c.ts) = date_trunc('month', a.ts))) u""")
o.cte("month_dedup", ["month_union"], """
SELECT * FROM month_union QUALIFY row_number() OVER (PARTITION BY month, mmsi, t ORDER BY src, ts, event_id) = 1""")
o.cte("month_down", ["month_dedup"], f"""
SELECT month, mmsi, CAST(floor(t / {config.MONTH_MAP_BUCKET_MINUTES}) AS INTEGER) AS bucket, first(t ORDER BY ts, event_id) AS t,
       {_first('latitude')} AS latitude, {_first('longitude')} AS longitude, {_first('sog')} AS sog,
       {_first('name')} AS name, {_first('type')} AS type
FROM month_dedup GROUP BY month, mmsi, bucket""")
o.cte("month_pts", ["month_down"], f"""
SELECT *, {o.zone_index_case('lat', 'lon')} AS z FROM (
  SELECT month, mmsi, t, round_even(CAST(latitude AS DOUBLE), 5) AS lat, round_even(CAST(longitude AS DOUBLE), 5) AS lon,
         CASE WHEN sog < 102.3e0 THEN round_even(CAST(sog AS DOUBLE), 1) END AS sog, name, type
  FROM month_down) p""")
o.cte("month_name", ["month_pts"], _mode("name", "month, mmsi", "month_pts"))
o.cte("month_type", ["month_pts"], _mode("type", "month, mmsi", "month_pts"))
o.cte("month_keep", ["month_pts", "month_name", "month_type"], f"""
SELECT k.month, k.mmsi, trim(coalesce(n.name, '')) AS name, ty.type, k.n_points
FROM (SELECT month, mmsi, count(*) AS n_points FROM month_pts GROUP BY month, mmsi HAVING count(*) >= {config.MONTH_MAP_MIN_POINTS}) k
LEFT JOIN month_name n ON n.mmsi = k.mmsi AND n.month = k.month JOIN month_type ty ON ty.mmsi = k.mmsi AND ty.month = k.month""")
o.cte("month_track_pts", ["month_keep", "month_pts"], """
SELECT k.month, k.mmsi, k.name, k.type, CAST(row_number() OVER (PARTITION BY p.month, p.mmsi ORDER BY p.t) - 1 AS INTEGER) AS idx,
       p.t, p.lat, p.lon, p.sog, p.z
FROM month_pts p JOIN month_keep k ON k.mmsi = p.mmsi AND k.month = p.month""")


@reg("core_union_approach", "SELECT src, event_id, month, mmsi, t FROM month_union", ["month_union"])
def q_core_union_approach(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return tracks.core_union_approach(t.raw, t.pings).select("src", "event_id", "month", "mmsi", "t")


@reg("dedupe_minute", "SELECT month, mmsi, t, src, event_id FROM month_dedup", ["month_dedup"])
def q_dedupe_minute(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return tracks.dedupe_minute(tracks.core_union_approach(t.raw, t.pings)).select("month", "mmsi", "t", "src", "event_id")


@reg("downsample_1m", "SELECT month, mmsi, bucket, t, latitude, longitude, sog, name, type FROM month_down", ["month_down"])
def q_downsample_1m(spark, sf_dir):
    t = Tables(spark, sf_dir)
    pts = tracks.dedupe_minute(tracks.core_union_approach(t.raw, t.pings))
    return tracks.downsample(pts, tracks.MONTH_KEYS, config.MONTH_MAP_BUCKET_MINUTES).select(
        "month", "mmsi", "bucket", "t", "latitude", "longitude", "sog", "name", "type")


_pt_json = ("'{\"t\":' || CAST(t AS VARCHAR) || ',\"lat\":' || CAST(lat AS VARCHAR) || ',\"lon\":' || CAST(lon AS VARCHAR)"
            " || coalesce(',\"sog\":' || CAST(sog AS VARCHAR), '') || coalesce(',\"z\":' || CAST(z AS VARCHAR), '') || '}'")


@reg("tracks_month", f"""
SELECT month, mmsi, name, type, CAST(count(*) AS INTEGER) AS n_points, '[' || string_agg({_pt_json}, ',' ORDER BY t) || ']' AS track_json
FROM month_track_pts GROUP BY month, mmsi, name, type""", ["month_track_pts"])
def q_tracks_month(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tr = tracks.month_tracks(t.raw, t.pings)
    return tr.select("month", "mmsi", "name", "type", "n_points", tracks.track_json(tr, keep_nulls=False).alias("track_json"))


@reg("track_points", "SELECT month, mmsi, name, type, idx, t, lat, lon, sog, z FROM month_track_pts", ["month_track_pts"])
def q_track_points(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return tracks.track_points(tracks.month_tracks(t.raw, t.pings))


def _month_points(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return tracks.track_points(tracks.month_tracks(t.raw, t.pings))


@reg("positions_asof", f"""
SELECT month, mmsi, type, t, lat, lon, sog, z FROM month_track_pts WHERE t <= {ASOF_T}
QUALIFY row_number() OVER (PARTITION BY month, mmsi ORDER BY t DESC) = 1""", ["month_track_pts"])
def q_positions_asof(spark, sf_dir):
    return tracks.positions_asof(_month_points(spark, sf_dir), ASOF_T)


_latest = f"""SELECT month, mmsi, type, t, lat, lon, sog, z FROM month_track_pts WHERE t <= {ASOF_T}
QUALIFY row_number() OVER (PARTITION BY month, mmsi ORDER BY t DESC) = 1"""


@reg("positions_asof_filtered", f"""
SELECT * FROM ({_latest}) p WHERE type IN {o.in_list(ASOF_TYPES)}
AND (z IN ({', '.join(str(z) for z in ASOF_ZONES if z is not None)}) OR z IS NULL)""", ["month_track_pts"])
def q_positions_asof_filtered(spark, sf_dir):
    """As-of positions of chosen types in chosen zones (outside any zone included)."""
    return tracks.positions_asof(_month_points(spark, sf_dir), ASOF_T, ASOF_TYPES, ASOF_ZONES)


_dy, _dx = ((VIEW[i + 1] - VIEW[i]) * VIEW_PAD for i in (0, 2))


@reg("positions_in_view", f"""
SELECT month, type, count(*) AS vessels, count(*) FILTER (WHERE lat BETWEEN {o.d(VIEW[0] - _dy)} AND {o.d(VIEW[1] + _dy)}
       AND lon BETWEEN {o.d(VIEW[2] - _dx)} AND {o.d(VIEW[3] + _dx)}) AS visible FROM ({_latest}) p GROUP BY month, type""", ["month_track_pts"])
def q_positions_in_view(spark, sf_dir):
    """Vessels per type at the instant, and how many of them a padded viewport shows."""
    p = tracks.positions_asof(_month_points(spark, sf_dir), ASOF_T)
    shown = tracks.in_view(F.col("lat"), F.col("lon"), VIEW, VIEW_PAD)
    return p.groupBy("month", "type").agg(F.count(F.lit(1)).alias("vessels"), F.count_if(shown).alias("visible"))


@reg("trail_window", f"""
SELECT month, mmsi, t, lat, lon, t = max(t) OVER (PARTITION BY month, mmsi) AS is_latest FROM month_track_pts
WHERE t <= {ASOF_T}
QUALIFY t >= {ASOF_T - TRAIL_MINUTES} OR t = max(t) OVER (PARTITION BY month, mmsi)""", ["month_track_pts"])
def q_trail_window(spark, sf_dir):
    return tracks.trail_window(_month_points(spark, sf_dir), ASOF_T, TRAIL_MINUTES)


ASOF_GRID = [2880 * k for k in range(1, 16)]     # every second day at 00:00 of a month


@reg("positions_asof_many", f"""
SELECT p.month, p.mmsi, g.at_t, p.t, p.lat, p.lon, p.sog, p.z
FROM month_track_pts p JOIN (VALUES {', '.join(f'({x})' for x in ASOF_GRID)}) g(at_t) ON p.t <= g.at_t
QUALIFY row_number() OVER (PARTITION BY p.month, p.mmsi, g.at_t ORDER BY p.t DESC) = 1""", ["month_track_pts"])
def q_positions_asof_many(spark, sf_dir):
    """As-of positions for a grid of instants in one pass: points are assigned to the
    first instant at or after them, the newest per (vessel, instant) is kept, and a
    forward fill carries positions into instants without newer points."""
    return tracks.positions_asof_many(_month_points(spark, sf_dir), ASOF_GRID)
