"""KPI queries over the fact tables (port K1-K17, zone Z1-Z10) as DataFrame plans.

Conventions carried over from the KPI SQL: ``ROUND`` is decimal half-up
(:func:`numeric.round_half_up`); averages of already-rounded measures are exact
(:func:`numeric.exact_avg`) so no summation order can move a rounded digit; day of week
is Sunday=0 in the KPI file and Monday=0 in the dashboard exports. "Vessel count per
day" is the sum of hourly distinct counts (vessel-hours), as in the source.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions import timeparts
from quayside.functions.numeric import exact_avg, round_half_up
from quayside.plans.tables import Tables

iso = timeparts.iso_date

# ORDER BY of each KPI result as the reference's SQL states it: (column, ascending).
# Registered queries return unordered frames (a global sort is an extra job); exports and
# callers that need the order apply it (:func:`ordered`, ``sinks.export_payload``).
ORDER_BY: dict[str, list[tuple[str, bool]]] = {
    "daily_traffic": [("port", True), ("date", True)],
    "peak_hour": [("port", True), ("date", True)],
    "type_share": [("port", True), ("total_vessels", False)],
    "dwell_by_type": [("port", True), ("avg_dwell_minutes", False)],
    "congestion_heatmap_sun": [("port", True), ("day_of_week", True), ("hour", True)],
    "congestion_heatmap": [("port", True), ("dow", True), ("hour", True)],
    "busiest_port": [("total_vessel_hours", False)],
    "type_congestion": [("port", True), ("day_of_week", True), ("hour", True), ("avg_vessel_count", False)],
    "arrival_hours": [("port", True), ("vessel_type", True), ("entry_hour", True)],
    "navstatus_share": [("port", True), ("ping_count", False)],
    "movement_by_port": [("avg_pct_stationary", False)],
    "flow_rates": [("port", True), ("avg_daily_vessels", False)],
    "turnover_rate": [("port", True), ("turnover_rate", False)],
    "movement_by_hour": [("port", True), ("hour", True)],
    "stationary_heatmap": [("port", True), ("dow", True), ("hour", True)],
    "daily_flow_padded": [("port", True), ("date", True)],
    "port_summary": [("total_vessel_hours", False)],
    "hourly_totals": [("port", True), ("date", True), ("hour", True)],
    "zone_daily_traffic": [("date", True), ("zone", True)],
    "zone_daily_traffic_type": [("date", True), ("zone", True), ("vessel_type", True)],
    "zone_congestion": [("zone", True), ("vessel_type", True), ("dow", True), ("hour", True)],
    "zone_dwell": [("zone", True), ("avg_dwell_minutes", False)],
    "zone_navstatus_share": [("zone", True), ("ping_count", False)],
    "zone_navstatus_counts": [("zone", True), ("vessel_type", True), ("ping_count", False)],
    "approach_speed": [("hour", True)],
    "zone_speed_profile": [("zone", True), ("hour", True), ("vessel_type", True)],
    "zone_type_mix": [("zone", True), ("visit_count", False)],
    "zone_overview": [("total_vessel_hours", False)],
}


def ordered(name: str, df: DataFrame) -> DataFrame:
    """Apply the reference's ORDER BY of KPI ``name`` (a global sort: range shuffle)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last()
                        for c, asc in ORDER_BY[name]])


def _date_window(df: DataFrame, date_from: str | None, date_to: str | None) -> DataFrame:
    """Inclusive date window; on a date-partitioned table this prunes partitions."""
    if date_from is not None:
        df = df.where(F.col("date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        df = df.where(F.col("date") <= F.lit(date_to).cast("date"))
    return df


def hourly_totals_df(t: Tables, region: str = "port") -> DataFrame:
    """Sum over vessel types per (region, date, hour) -- the first level of every heatmap."""
    src = t.port_hourly_stats if region == "port" else t.zone_hourly_stats
    return src.groupBy(region, "date", "hour").agg(F.sum("vessel_count").alias("vessel_count"))


# ---------------------------------------------------------------------------
# Port KPIs
# ---------------------------------------------------------------------------
def daily_traffic(t: Tables) -> DataFrame:
    return (t.port_hourly_stats.groupBy("port", "date")
            .agg(F.sum("vessel_count").alias("daily_vessel_count"))
            .select("port", iso(F.col("date")).alias("date"), "daily_vessel_count"))


def peak_hour(t: Tables) -> DataFrame:
    """Hour(s) with the highest total per port-day; ties are all kept (rank, not row_number)."""
    ht = hourly_totals_df(t).withColumnRenamed("vessel_count", "total_vessel_count")
    w = Window.partitionBy("port", "date").orderBy(F.col("total_vessel_count").desc())
    return (ht.withColumn("rk", F.rank().over(w)).where(F.col("rk") == 1)
            .select("port", iso(F.col("date")).alias("date"), "hour", "total_vessel_count"))


def peak_hour_in(t: Tables) -> DataFrame:
    """Same answer as :func:`peak_hour`, as the row-value IN of the source: a left-semi join
    of the hourly totals against the per-day maxima on (port, date, total)."""
    ht = hourly_totals_df(t).withColumnRenamed("vessel_count", "total_vessel_count")
    mx = ht.groupBy("port", "date").agg(F.max("total_vessel_count").alias("mx"))
    cond = [ht.port == mx.port, ht.date == mx.date, ht.total_vessel_count == mx.mx]
    return (ht.join(mx, cond, "left_semi")
            .select("port", iso(F.col("date")).alias("date"), "hour", "total_vessel_count"))


def type_share(t: Tables) -> DataFrame:
    per = t.type_distribution.groupBy("port", "vessel_type").agg(F.sum("count").alias("total_vessels"))
    port_total = F.sum("total_vessels").over(Window.partitionBy("port"))
    return per.withColumn("pct", round_half_up(F.lit(100.0) * F.col("total_vessels") / port_total, 1))


def _dwell_stats(visits: DataFrame, region: str) -> DataFrame:
    m = exact_avg(F.col("dwell_minutes"), 1)
    return (visits.where(F.col("dwell_minutes") > 0).groupBy(region, "vessel_type")
            .agg(F.count(F.lit(1)).alias("visit_count"),
                 round_half_up(m, 1).alias("avg_dwell_minutes"),
                 round_half_up(m / F.lit(60.0), 2).alias("avg_dwell_hours")))


def dwell_by_type(t: Tables) -> DataFrame:
    return _dwell_stats(t.vessel_visits, "port")


def congestion_heatmap_sun(t: Tables) -> DataFrame:
    ht = hourly_totals_df(t)
    return (ht.groupBy("port", timeparts.dow_sunday0(F.col("date")).alias("day_of_week"), "hour")
            .agg(round_half_up(exact_avg(F.col("vessel_count")), 1).alias("avg_vessel_count")))


def congestion_heatmap(t: Tables) -> DataFrame:
    ht = hourly_totals_df(t)
    return (ht.groupBy("port", timeparts.dow_monday0(F.col("date")).alias("dow"), "hour")
            .agg(round_half_up(exact_avg(F.col("vessel_count")), 2).alias("avg_vessel_count")))


def busiest_port(t: Tables) -> DataFrame:
    return t.port_hourly_stats.groupBy("port").agg(F.sum("vessel_count").alias("total_vessel_hours"))


def type_congestion(t: Tables) -> DataFrame:
    return (t.port_hourly_stats
            .groupBy("port", "vessel_type", timeparts.dow_sunday0(F.col("date")).alias("day_of_week"), "hour")
            .agg(round_half_up(exact_avg(F.col("vessel_count")), 1).alias("avg_vessel_count")))


def arrival_hours(t: Tables) -> DataFrame:
    return (t.vessel_visits.groupBy("port", "vessel_type", "entry_hour")
            .agg(F.count(F.lit(1)).alias("arrival_count")))


def _nav_share(nav: DataFrame, region: str) -> DataFrame:
    per = nav.groupBy(region, "nav_status").agg(F.sum("ping_count").alias("ping_count"))
    total = F.sum("ping_count").over(Window.partitionBy(region))
    return per.withColumn("pct", round_half_up(F.lit(100.0) * F.col("ping_count") / total, 1))


def navstatus_share(t: Tables) -> DataFrame:
    return _nav_share(t.port_navstatus_stats, "port")


def movement_by_port(t: Tables) -> DataFrame:
    return (t.port_speed_stats.groupBy("port")
            .agg(round_half_up(exact_avg(F.col("sog_mean"), 2), 2).alias("avg_sog_mean"),
                 round_half_up(exact_avg(F.col("sog_median"), 2), 2).alias("avg_sog_median"),
                 round_half_up(exact_avg(F.col("sog_p95"), 2), 2).alias("avg_sog_p95"),
                 round_half_up(exact_avg(F.col("pct_stationary"), 1), 1).alias("avg_pct_stationary")))


def flow_rates(t: Tables) -> DataFrame:
    return (t.port_daily_flow.groupBy("port", "vessel_type")
            .agg(round_half_up(exact_avg(F.col("entries")), 1).alias("avg_daily_entries"),
                 round_half_up(exact_avg(F.col("exits")), 1).alias("avg_daily_exits"),
                 round_half_up(exact_avg(F.col("unique_vessels")), 1).alias("avg_daily_vessels"),
                 round_half_up(exact_avg(F.col("avg_dwell_minutes"), 1), 1).alias("avg_dwell_minutes")))


def turnover_rate(t: Tables) -> DataFrame:
    ratio = F.col("entries").cast("double") / F.nullif(F.col("unique_vessels"), F.lit(0)).cast("double")
    return (t.port_daily_flow.groupBy("port", "vessel_type")
            .agg(round_half_up(exact_avg(ratio, 12), 2).alias("turnover_rate")))


def movement_by_hour(t: Tables) -> DataFrame:
    return (t.port_speed_stats.groupBy("port", "hour")
            .agg(round_half_up(exact_avg(F.col("sog_mean"), 2), 2).alias("avg_sog"),
                 round_half_up(exact_avg(F.col("pct_stationary"), 1), 1).alias("avg_pct_stationary")))


def stationary_heatmap(t: Tables) -> DataFrame:
    return (t.port_speed_stats
            .groupBy("port", timeparts.dow_monday0(F.col("date")).alias("dow"), "hour")
            .agg(round_half_up(exact_avg(F.col("pct_stationary"), 1), 1).alias("avg_pct_stationary")))


def daily_flow_padded(spark, sf_dir: str, date_from: str, date_to: str, pad_days: int) -> DataFrame:
    """Entries/exits/vessels per port-day for [from, to], computed on [from-pad, to+pad].

    Only the padded range of pings is read (the date predicate reaches the scan), yet the
    first and last day still see a true yesterday/tomorrow. The trim happens after.
    """
    import datetime as dt
    lo = (dt.date.fromisoformat(date_from) - dt.timedelta(days=pad_days)).isoformat()
    hi = (dt.date.fromisoformat(date_to) + dt.timedelta(days=pad_days)).isoformat()
    padded = Tables(spark, sf_dir, lo, hi)
    per_day = (padded.port_daily_flow.groupBy("port", "date")
               .agg(F.sum("entries").alias("entries"), F.sum("exits").alias("exits"),
                    F.sum("unique_vessels").alias("unique_vessels")))
    return (_date_window(per_day, date_from, date_to)
            .select("port", iso(F.col("date")).alias("date"), "entries", "exits", "unique_vessels"))


def port_summary_df(t: Tables) -> DataFrame:
    """One row per port: vessel-hours, peak hour, mean dwell (zero dwell included), entries,
    mean daily arrivals. Three aggregates joined on port; each is one row per port, so AQE
    turns the joins into broadcasts at runtime."""
    ht = hourly_totals_df(t)
    hourly_agg = ht.groupBy("port").agg(F.sum("vessel_count").alias("total_vessel_hours"),
                                        F.max("vessel_count").alias("peak_hourly_count"))
    dwell_agg = t.vessel_visits.groupBy("port").agg(
        round_half_up(exact_avg(F.col("dwell_minutes"), 1), 1).alias("avg_dwell_minutes"))
    flow_agg = t.port_daily_flow.groupBy("port").agg(
        F.sum("entries").alias("total_entries"),
        round_half_up(F.sum("entries").cast("double")
                      / F.nullif(F.count_distinct("date"), F.lit(0)).cast("double"), 1).alias("avg_daily_arrivals"))
    return (hourly_agg.join(dwell_agg, "port", "left").join(flow_agg, "port", "left")
            .select("port", "total_vessel_hours", "peak_hourly_count", "avg_dwell_minutes", "total_entries",
                    "avg_daily_arrivals"))


def hourly_totals(t: Tables) -> DataFrame:
    return hourly_totals_df(t).select("port", iso(F.col("date")).alias("date"), "hour", "vessel_count")


# ---------------------------------------------------------------------------
# Zone KPIs
# ---------------------------------------------------------------------------
def zone_daily_traffic(t: Tables) -> DataFrame:
    return (t.zone_hourly_stats.groupBy("zone", "date").agg(F.sum("vessel_count").alias("vessel_count"))
            .select("zone", iso(F.col("date")).alias("date"), "vessel_count"))


def zone_daily_traffic_type(t: Tables) -> DataFrame:
    return (t.zone_hourly_stats.groupBy("zone", "date", "vessel_type")
            .agg(F.sum("vessel_count").alias("vessel_count"))
            .select("zone", iso(F.col("date")).alias("date"), "vessel_type", "vessel_count"))


def zone_congestion(t: Tables) -> DataFrame:
    """Mean count by zone, type, weekday (Monday=0) and hour over the rows present only."""
    return (t.zone_hourly_stats
            .groupBy("zone", "vessel_type", timeparts.dow_monday0(F.col("date")).alias("dow"), "hour")
            .agg(round_half_up(exact_avg(F.col("vessel_count")), 2).alias("avg_vessel_count")))


def zone_dwell(t: Tables) -> DataFrame:
    return _dwell_stats(t.zone_visits, "zone")


def zone_navstatus_share(t: Tables) -> DataFrame:
    return _nav_share(t.zone_navstatus_stats, "zone")


def zone_navstatus_counts(t: Tables) -> DataFrame:
    return (t.zone_navstatus_stats.groupBy("zone", "vessel_type", "nav_status")
            .agg(F.sum("ping_count").alias("ping_count")))


def approach_speed(t: Tables) -> DataFrame:
    return (t.zone_speed_stats.where(F.col("zone") == "outer_approach").groupBy("hour")
            .agg(*[round_half_up(exact_avg(F.col(c), 2), 2).alias(c) for c in ("sog_mean", "sog_median", "sog_p95")]))


def zone_speed_profile(t: Tables) -> DataFrame:
    cols = ("sog_mean", "sog_median", "sog_p025", "sog_p95", "sog_p975")
    return (t.zone_speed_stats.groupBy("zone", "hour", "vessel_type")
            .agg(*[round_half_up(exact_avg(F.col(c), 2), 2).alias(c) for c in cols]))


def zone_type_mix(t: Tables) -> DataFrame:
    return t.zone_visits.groupBy("zone", "vessel_type").agg(F.count(F.lit(1)).alias("visit_count"))


def zone_overview(t: Tables) -> DataFrame:
    return (t.zone_hourly_stats.groupBy("zone")
            .agg(F.sum("vessel_count").alias("total_vessel_hours"),
                 round_half_up(exact_avg(F.col("vessel_count")), 2).alias("avg_per_hour")))


def zone_totals(t: Tables) -> DataFrame:
    ht = hourly_totals_df(t, "zone")
    return ht.agg(F.sum("vessel_count").alias("total_vessel_hours"),
                  F.max("vessel_count").alias("peak_hourly_count"))


def busiest_zone(t: Tables) -> DataFrame:
    """Top-1 zone by vessel-hours (name breaks a tie); the limit is the feature."""
    return (t.zone_hourly_stats.groupBy("zone").agg(F.sum("vessel_count").alias("total_vessel_hours"))
            .orderBy(F.col("total_vessel_hours").desc(), F.col("zone")).limit(1))


def anchorage_wait(t: Tables) -> DataFrame:
    v = t.zone_visits.where((F.col("zone") == "anchorage") & F.col("vessel_type").isin("Cargo", "Tanker")
                            & (F.col("dwell_minutes") > 0))
    return v.agg(round_half_up(exact_avg(F.col("dwell_minutes"), 1) / F.lit(60.0), 1)
                 .alias("avg_anchorage_dwell_cargo_hours"))


def moored_in_anchorage(t: Tables) -> DataFrame:
    """% of anchorage pings reporting Moored. The source joins a one-row total to the
    filtered rows; one conditional aggregate gives the same ratio in a single pass."""
    a = t.zone_navstatus_stats.where(F.col("zone") == "anchorage")
    moored = F.sum(F.when(F.col("nav_status") == "Moored", F.col("ping_count")))
    return a.agg(round_half_up(F.lit(100.0) * moored / F.sum("ping_count"), 1).alias("pct_moored_in_anchorage"))
