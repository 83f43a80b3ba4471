"""The ten fact tables, written once and parameterised by the region column.

``region`` is ``port`` for the port tables and ``zone`` for the Aarhus sub-zone tables.
Each function takes labelled pings (``event_id, mmsi, ts, date, sog, nav_status,
ship_type`` plus the region column) and is one aggregation plan: Spark runs a partial
(map-side) aggregate per input partition, shuffles only the partial rows on the group
key, and merges. Group keys always include the day (and usually the hour), so one busy
port or vessel spreads over many shuffle partitions.

pandas ``groupby`` semantics carried over: null group keys are dropped (nav status, an
unparsable timestamp's hour), ``count`` of the timestamp ignores nulls, ``mode`` breaks
ties by the smallest value, and "first row" means earliest ``(ts, event_id)``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quayside.functions import numeric, timeparts, vessel

PERCENTILES = {"sog_p025": 0.025, "sog_median": 0.5, "sog_p95": 0.95, "sog_p975": 0.975}


def with_type_and_hour(pings: DataFrame) -> DataFrame:
    return vessel.with_vessel_type(pings).withColumn("hour", F.hour("ts"))


def hourly_stats(pings: DataFrame, region: str) -> DataFrame:
    """Distinct vessels per region, date, hour and vessel type (``vessel_count``).

    A vessel whose reported type changes inside the hour counts once per type.
    """
    df = with_type_and_hour(pings).where(F.col("hour").isNotNull())
    return (df.groupBy(region, "date", "hour", "vessel_type")
            .agg(F.count_distinct("mmsi").alias("vessel_count")))


def visits(pings: DataFrame, region: str, with_hours: bool = True) -> DataFrame:
    """One row per (mmsi, region, date): first/last ping, modal type, pings and dwell."""
    df = vessel.with_vessel_type(pings)
    out = (df.groupBy("mmsi", region, "date")
           .agg(F.min("ts").alias("first_seen"),
                F.max("ts").alias("last_seen"),
                F.mode("vessel_type", deterministic=True).alias("vessel_type"),
                F.count("ts").alias("ping_count"))
           .withColumn("dwell_minutes",
                       numeric.round_even(timeparts.seconds_between(F.col("first_seen"), F.col("last_seen"))
                                          / F.lit(60.0), 1)))
    if with_hours:
        out = out.withColumn("entry_hour", F.hour("first_seen")).withColumn("exit_hour", F.hour("last_seen"))
    return out


def type_distribution(pings: DataFrame, region: str) -> DataFrame:
    """Vessel types counted once per (mmsi, region, date), taking the type of the first ping."""
    df = vessel.with_vessel_type(pings)
    # (time, id) as one number, missing times last: its minimum per type is a hash aggregate that sends a row per
    # vessel-day and type; the first of these few types is taken in a second step
    place = F.expr("CAST(coalesce(unix_micros(CAST(ts AS TIMESTAMP)), 99999999999999999) AS DECIMAL(18, 0)) * "
                   "CAST(100000000000000000000 AS DECIMAL(21, 0)) + CAST(event_id AS DECIMAL(20, 0)) + 9223372036854775808")
    per_type = df.groupBy("mmsi", region, "date", "vessel_type").agg(F.min(place).alias("place"))
    first = per_type.groupBy("mmsi", region, "date").agg(F.min_by("vessel_type", "place").alias("vessel_type"))
    return first.groupBy(region, "date", "vessel_type").agg(F.count(F.lit(1)).alias("count"))


def navstatus_stats(pings: DataFrame, region: str, by_type: bool) -> DataFrame:
    """Pings per region, date (and type) and navigational status; null status dropped."""
    df = pings.where(F.col("nav_status").isNotNull())
    keys = [region, "date"]
    if by_type:
        df = vessel.with_vessel_type(df)
        keys.append("vessel_type")
    return df.groupBy(*keys, "nav_status").agg(F.count(F.lit(1)).alias("ping_count"))


def _valid_speed_pings(pings: DataFrame) -> DataFrame:
    return (with_type_and_hour(pings)
            .where(vessel.valid_speed(F.col("sog")) & F.col("hour").isNotNull())
            .withColumn("sog_d", F.col("sog").cast("double")))


def port_speed_stats(pings: DataFrame, region: str = "port") -> DataFrame:
    """Speed mean/median/p95 and % stationary per region, date, hour (sentinel excluded).

    Quantiles are exact with linear interpolation; ``percentile`` keeps one value->count
    map per group, bounded by the distinct speeds (0.1 kn resolution) not by the rows.
    """
    df = _valid_speed_pings(pings)
    pcts = F.percentile(F.col("sog_d"), F.array(F.lit(0.5), F.lit(0.95)))
    agg = (df.groupBy(region, "date", "hour")
           .agg(F.avg("sog_d").alias("m"), pcts.alias("p"),
                F.avg(vessel.stationary_flag(F.col("sog")).cast("double")).alias("st")))
    return agg.select(
        region, "date", "hour",
        numeric.round_even(F.col("m"), 2).alias("sog_mean"),
        numeric.round_even(F.col("p")[0], 2).alias("sog_median"),
        numeric.round_even(F.col("p")[1], 2).alias("sog_p95"),
        numeric.round_even(F.col("st") * F.lit(100.0), 1).alias("pct_stationary"),
    )


def zone_speed_stats(pings: DataFrame, region: str = "zone") -> DataFrame:
    """Speed mean and p2.5/median/p95/p97.5 per region, date, hour and vessel type."""
    df = _valid_speed_pings(pings)
    pcts = F.percentile(F.col("sog_d"), F.array(*[F.lit(p) for p in PERCENTILES.values()]))
    agg = (df.groupBy(region, "date", "hour", "vessel_type")
           .agg(F.avg("sog_d").alias("m"), pcts.alias("p")))
    return agg.select(
        region, "date", "hour", "vessel_type",
        numeric.round_even(F.col("m"), 2).alias("sog_mean"),
        numeric.round_even(F.col("p")[1], 2).alias("sog_median"),
        numeric.round_even(F.col("p")[0], 2).alias("sog_p025"),
        numeric.round_even(F.col("p")[2], 2).alias("sog_p95"),
        numeric.round_even(F.col("p")[3], 2).alias("sog_p975"),
    )


def presence_flags(visit_rows: DataFrame, region: str = "port") -> DataFrame:
    """Add ``is_entry`` / ``is_exit``: absent from the same region the day before / after.

    Visits are unique per (mmsi, region, date), so the previous and next visit of the same
    vessel in the same region decide: a gap of anything but one day means absent. This is
    the anti-join "today minus yesterday" as one window over (region, mmsi) partitions,
    i.e. one shuffle instead of two self-joins; the vessel type plays no part.
    """
    w = Window.partitionBy(region, "mmsi").orderBy("date")
    prev_d = F.lag("date").over(w)
    next_d = F.lead("date").over(w)
    return (visit_rows
            .withColumn("is_entry", (prev_d.isNull() | (F.datediff(F.col("date"), prev_d) != 1)).cast("int"))
            .withColumn("is_exit", (next_d.isNull() | (F.datediff(next_d, F.col("date")) != 1)).cast("int")))


def daily_flow(visit_rows: DataFrame, region: str = "port") -> DataFrame:
    """Unique vessels, entries, exits and mean positive dwell per region, date, type.

    Visits are unique per (mmsi, region, date), so a plain count is the distinct-vessel
    count (and avoids the Expand a DISTINCT beside other aggregates would need)."""
    flagged = presence_flags(visit_rows, region)
    dwell_pos = F.when(F.col("dwell_minutes") > 0, F.col("dwell_minutes"))
    return (flagged.groupBy(region, "date", "vessel_type")
            .agg(F.count(F.lit(1)).alias("unique_vessels"),
                 F.sum("is_entry").cast("long").alias("entries"),
                 F.sum("is_exit").cast("long").alias("exits"),
                 numeric.exact_avg(dwell_pos, 1).alias("d"))
            .withColumn("avg_dwell_minutes", numeric.round_even(F.col("d"), 1))
            .drop("d"))
