"""Vessel tracks: dedupe, time-bucket downsampling, track arrays, as-of positions, trails.

Track arrays are bounded by construction: a day track has at most 1440/10 = 144 points,
a month track at most 31 * 1440 = 44,640 (one per minute), whatever the ping volume, so
``collect_list`` per vessel never gathers an unbounded group. Everything before that is
grouped per (vessel, bucket) with map-side partial aggregation. Months are those of the
pings: a vessel has a track in each month that it was seen in, in minutes of that month.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside import config
from quayside.functions import geo, timeparts, vessel
from quayside.operators import joins, regions

MONTH_KEYS = ["month", "mmsi"]
POINT_COLS = ("latitude", "longitude", "sog", "name", "type")


def _first_non_null(c: str, order_key: Column) -> Column:
    """Value of ``c`` from the earliest row (by ``order_key``) where ``c`` is not null."""
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order_key))


def downsample(pings: DataFrame, keys: list[str], bucket_minutes: int) -> DataFrame:
    """One point per (keys, bucket of ``t``): per column the first non-null value in time
    order (ties by event_id); ``t`` is the first ping's minute."""
    order_key = F.struct(F.col("ts"), F.col("event_id"))
    b = pings.withColumn("bucket", timeparts.bucket(F.col("t"), bucket_minutes))
    aggs = [F.min_by(F.col("t"), order_key).alias("t")]
    aggs += [_first_non_null(c, order_key).alias(c) for c in POINT_COLS if c in pings.columns]
    return b.groupBy(*keys, "bucket").agg(*aggs)


def vessel_meta(pings: DataFrame, keys: list[str]) -> DataFrame:
    """Dominant name (non-null names only, "" if none, trimmed) and dominant type; ties go
    to the smallest value."""
    return (pings.groupBy(*keys)
            .agg(F.mode("name", deterministic=True).alias("name"), F.mode("type", deterministic=True).alias("type"))
            .withColumn("name", F.trim(F.coalesce(F.col("name"), F.lit("")))))


# ---------------------------------------------------------------------------
# Day map
# ---------------------------------------------------------------------------
def day_map_pings(raw: DataFrame) -> DataFrame:
    """Coverage box, Class A/B, minute of day and first-match vessel type."""
    return (regions.coverage_filter(raw).where(F.col("ts").isNotNull())
            .withColumn("t", timeparts.minute_of_day(F.col("ts")))
            .transform(lambda d: vessel.with_vessel_type(d, out="type", first_wins=True)))


def day_tracks(raw: DataFrame, min_points: int = config.DAY_MAP_MIN_POINTS,
               bucket_minutes: int = config.DAY_MAP_BUCKET_MINUTES) -> DataFrame:
    """Per (date, vessel): 10-minute track of >= min_points points; name/type from ALL that
    day's pings (not the downsampled ones). Points keep null speeds and the sentinel."""
    p = day_map_pings(raw)
    down = downsample(p, ["date", "mmsi"], bucket_minutes)
    point = F.struct(F.col("t"), F.bround(F.col("latitude").cast("double"), 5).alias("lat"),
                     F.bround(F.col("longitude").cast("double"), 5).alias("lon"),
                     F.bround(F.col("sog").cast("double"), 1).alias("sog"))
    tracks = (down.groupBy("date", "mmsi")
              .agg(F.array_sort(F.collect_list(point)).alias("track"))
              .withColumn("n_points", F.size("track"))
              .where(F.col("n_points") >= min_points))
    meta = vessel_meta(p, ["date", "mmsi"])
    return tracks.join(meta, ["date", "mmsi"], "inner")


# ---------------------------------------------------------------------------
# Month map (core box + approach corridor)
# ---------------------------------------------------------------------------
def core_union_approach(raw: DataFrame, pings: DataFrame, with_approach: bool = True) -> DataFrame:
    """Core pings (src 0) and, unless skipped, corridor pings (src 1) of vessels with core pings in the same month, with
    ``month`` and ``t``, the minutes since its start."""
    cols = ["event_id", "month", "mmsi", "ts", "latitude", "longitude", "sog", "name", "ship_type"]
    month = F.date_format("ts", "yyyy-MM")
    core = joins.core_pings(pings).withColumn("month", month)
    both = core.select(*cols, F.lit(0).alias("src"))
    if with_approach:
        both = both.unionByName(joins.approach_semi(raw.withColumn("month", month), core, MONTH_KEYS).select(*cols, F.lit(1).alias("src")))
    return (both.withColumn("t", timeparts.minute_of_month(F.col("ts")))
            .transform(lambda d: vessel.with_vessel_type(d, out="type", first_wins=True)))


def dedupe_minute(points: DataFrame) -> DataFrame:
    """First row per (month, mmsi, minute): core before corridor, then time, then event_id.

    A grouped minimum, so a task sends one row per vessel-minute, not every ping."""
    order = ["src", "ts", "event_id"]
    rest = [c for c in points.columns if c not in (*MONTH_KEYS, "t", *order)]
    first = points.groupBy(*MONTH_KEYS, "t").agg(F.min(F.struct(*order, *rest)).alias("_p"))
    return first.select(*MONTH_KEYS, "t", "_p.*").select(*points.columns)


def month_points(raw: DataFrame, pings: DataFrame, with_approach: bool = True,
                 bucket_minutes: int = config.MONTH_MAP_BUCKET_MINUTES) -> DataFrame:
    """Deduplicated, 1-minute downsampled month points with rounded coordinates, speed
    only when valid, and the map zone index of the rounded position."""
    pts = dedupe_minute(core_union_approach(raw, pings, with_approach))
    if bucket_minutes == 1:
        # one row per (month, mmsi, minute) already: the downsample would be the identity, so
        # skip its shuffle (the dedupe window has partitioned on the same key)
        down = pts.withColumn("bucket", F.col("t")).select(*MONTH_KEYS, "bucket", "t", *POINT_COLS)
    else:
        down = downsample(pts, MONTH_KEYS, bucket_minutes)
    lat = F.bround(F.col("latitude").cast("double"), 5)
    lon = F.bround(F.col("longitude").cast("double"), 5)
    return (down.withColumn("lat", lat).withColumn("lon", lon)
            .withColumn("sog_v", F.bround(vessel.speed_or_null(F.col("sog")).cast("double"), 1))
            .withColumn("z", geo.zone_index(F.col("lat"), F.col("lon"))))


def month_tracks(raw: DataFrame, pings: DataFrame, with_approach: bool = True,
                 min_points: int = config.MONTH_MAP_MIN_POINTS) -> DataFrame:
    """Per month and vessel: month track (>= min_points points), name/type from the downsampled points."""
    pts = month_points(raw, pings, with_approach)
    point = F.struct(F.col("t"), F.col("lat"), F.col("lon"), F.col("sog_v").alias("sog"), F.col("z"))
    # track, dominant name and dominant type come from the same points: one aggregation
    return (pts.groupBy(*MONTH_KEYS)
            .agg(F.array_sort(F.collect_list(point)).alias("track"),
                 F.mode("name", deterministic=True).alias("name"), F.mode("type", deterministic=True).alias("type"))
            .withColumn("name", F.trim(F.coalesce(F.col("name"), F.lit(""))))
            .withColumn("n_points", F.size("track")).where(F.col("n_points") >= min_points))


def track_json(tracks: DataFrame, keep_nulls: bool) -> Column:
    """The track array as compact JSON; the day map writes ``"sog":null``, the month map
    omits null fields."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.col("track"), opts)


def track_points(tracks: DataFrame) -> DataFrame:
    """Explode tracks back to one row per point (what playback walks)."""
    keys = [c for c in MONTH_KEYS if c in tracks.columns]
    return tracks.select(*keys, "name", "type", F.posexplode("track").alias("idx", "p")) \
                 .select(*keys, "name", "type", "idx", "p.*")


# ---------------------------------------------------------------------------
# As-of positions and trails
# ---------------------------------------------------------------------------
def in_view(lat: Column, lon: Column, box: tuple[float, float, float, float], pad: float) -> Column:
    """Whether a position is in a viewport (lat_min, lat_max, lon_min, lon_max) widened on each side by ``pad`` of its size."""
    dy, dx = (box[1] - box[0]) * pad, (box[3] - box[2]) * pad
    return lat.between(box[0] - dy, box[1] + dy) & lon.between(box[2] - dx, box[3] + dx)


def _keys(points: DataFrame) -> list[str]:
    """What a track belongs to: the vessel, and the month where points have one."""
    return [c for c in MONTH_KEYS if c in points.columns]


def positions_asof(points: DataFrame, at_t: int, types: list[str] | None = None,
                   zones: list[int | None] | None = None) -> DataFrame:
    """Newest point at or before ``at_t`` per vessel (and month), one grouped max_by, no join, then
    the type and zone filters applied to that latest point."""
    keys = _keys(points)
    latest = (points.where(F.col("t") <= at_t).groupBy(*keys, "type")
              .agg(F.max_by(F.struct("t", "lat", "lon", "sog", "z"), F.col("t")).alias("p"))
              .select(*keys, "type", "p.*"))
    if types is not None:
        latest = latest.where(F.col("type").isin(*types))
    if zones is not None:
        named = [z for z in zones if z is not None]
        cond = F.col("z").isin(*named) if named else F.lit(False)
        if None in zones:
            cond = cond | F.col("z").isNull()
        latest = latest.where(cond)
    return latest


def positions_asof_many(points: DataFrame, times: list[int]) -> DataFrame:
    """As-of positions for several instants at once, in one pass over the points: each is assigned to the first instant at
    or after it, the newest per (vessel, instant) is taken, and holds until the vessel's next instant with a point."""
    keys, ts = _keys(points), sorted(times)
    instants = F.array(*[F.lit(t) for t in ts])
    slot = F.size(F.filter(instants, lambda x: x < F.col("t")))   # instants before the point: the place of the next one
    per_slot = (points.withColumn("slot", slot).where(F.col("slot") < len(ts))
                .groupBy(*keys, "slot").agg(F.max_by(F.struct("t", "lat", "lon", "sog", "z"), F.col("t")).alias("p")))
    until = F.coalesce(F.lead("slot").over(Window.partitionBy(*keys).orderBy("slot")), F.lit(len(ts)))
    held = per_slot.withColumn("until", until).withColumn("at", F.explode(F.sequence(F.col("slot"), F.col("until") - 1)))
    return held.select(*keys, F.element_at(instants, F.col("at") + 1).alias("at_t"), "p.*")


def trail_window(points: DataFrame, at_t: int, length: float) -> DataFrame:
    """Trail of each vessel at ``at_t``: its points in [at_t - length, at_t] plus its newest
    point at or before ``at_t`` (length may be infinite)."""
    keys = _keys(points)
    p = points.where(F.col("t") <= at_t)
    latest_t = F.max("t").over(Window.partitionBy(*keys))
    p = p.withColumn("latest_t", latest_t)
    cond = F.col("t") == F.col("latest_t")
    if length != float("inf"):
        cond = cond | (F.col("t") >= F.lit(at_t - length))
    else:
        cond = F.lit(True)
    return p.where(cond).select(*keys, "t", "lat", "lon", (F.col("t") == F.col("latest_t")).alias("is_latest"))
