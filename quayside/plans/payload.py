"""The two dashboard documents (S9): ports and Aarhus zones, each one compact JSON.

A document is a handful of result sets bounded by the configuration times days and hours, sorted as the dashboards
expect (ties by the remaining columns, so a document is the same on every run), with the window and what it covers.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside import config
from quayside.functions.numeric import exact_avg, round_half_up
from quayside.functions.timeparts import iso_date
from quayside.plans import kpis
from quayside.plans.tables import Tables
from quayside.sources import sinks

# Set name -> ORDER BY (column, ascending) of each document.
PORT_SETS = {
    "daily_traffic": kpis.ORDER_BY["daily_traffic"],
    "type_distribution": [("port", True), ("count", False)],
    "congestion_heatmap": kpis.ORDER_BY["congestion_heatmap"],
    "stationary_heatmap": kpis.ORDER_BY["stationary_heatmap"],
    "daily_flow": [("port", True), ("date", True)],
    "movement_behaviour": [("port", True), ("hour", True)],
    "summary": kpis.ORDER_BY["port_summary"],
    "hourly_totals": kpis.ORDER_BY["hourly_totals"],
}
ZONE_SETS = {
    "zone_daily_traffic": kpis.ORDER_BY["zone_daily_traffic_type"],
    "zone_type_mix": kpis.ORDER_BY["zone_type_mix"],
    "dwell_by_zone_type": kpis.ORDER_BY["zone_dwell"],
    "navstatus_by_zone": kpis.ORDER_BY["zone_navstatus_counts"],
    "zone_speed_all": kpis.ORDER_BY["zone_speed_profile"],
    "zone_congestion_heatmap": kpis.ORDER_BY["zone_congestion"],
}


def _shifted(day: str | None, by: int) -> str | None:
    return None if day is None else (dt.date.fromisoformat(day) + dt.timedelta(days=by)).isoformat()


def port_sets(t: Tables, date_from: str | None = None, date_to: str | None = None) -> dict[str, DataFrame]:
    """The sets of the port document; the daily flow is computed on a padded window, so that its first and last day
    have a day before and after them."""
    w = t.window(date_from, date_to)
    flow = t.window(_shifted(date_from, -config.FLOW_PAD_DAYS), _shifted(date_to, config.FLOW_PAD_DAYS)).port_daily_flow
    flow = flow.groupBy("port", "date").agg(*[F.sum(c).alias(c) for c in ("entries", "exits", "unique_vessels")])
    return {
        "daily_traffic": kpis.daily_traffic(w),
        "type_distribution": w.type_distribution.groupBy("port", "vessel_type").agg(F.sum("count").alias("count")),
        "congestion_heatmap": kpis.congestion_heatmap(w),
        "stationary_heatmap": kpis.stationary_heatmap(w),
        "daily_flow": kpis._date_window(flow, date_from, date_to).withColumn("date", iso_date(F.col("date"))),
        "movement_behaviour": w.port_speed_stats.groupBy("port", "hour").agg(
            round_half_up(exact_avg(F.col("pct_stationary"), 1), 1).alias("avg_pct_stationary")),
        "summary": kpis.port_summary_df(w),
        "hourly_totals": kpis.hourly_totals(w),
    }


def zone_sets(t: Tables, date_from: str | None = None, date_to: str | None = None) -> dict[str, DataFrame]:
    """The sets of the zone document."""
    w = t.window(date_from, date_to)
    return {
        "zone_daily_traffic": kpis.zone_daily_traffic_type(w),
        "zone_type_mix": kpis.zone_type_mix(w),
        "dwell_by_zone_type": kpis.zone_dwell(w),
        "navstatus_by_zone": kpis.zone_navstatus_counts(w),
        "zone_speed_all": kpis.zone_speed_profile(w),
        "zone_congestion_heatmap": kpis.zone_congestion(w),
    }


def zone_summary(w: Tables) -> DataFrame:
    """Totals, busiest zone, waiting time and share moored: one row with a struct ``summary``."""
    busiest = (w.zone_hourly_stats.groupBy("zone").agg(F.sum("vessel_count").alias("n"))
               .agg(F.min(F.struct((-F.col("n")).alias("rank"), "zone")).alias("b"))
               .select(F.col("b.zone").alias("busiest_zone"), (-F.col("b.rank")).alias("busiest_zone_vessel_hours")))
    parts = [kpis.zone_totals(w), busiest, kpis.anchorage_wait(w), kpis.moored_in_anchorage(w)]
    parts = [p.withColumn("_k", F.lit(1)) for p in parts]   # each is one row, an aggregate without keys
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "_k", "left")
    out = out.drop("_k")
    return out.select(F.struct(*out.columns).alias("summary"))


def _covered(sets: dict[str, DataFrame], days: str, date_from: str | None, date_to: str | None) -> DataFrame:
    """The window of a document: as given, or the days that its daily set has."""
    pick = lambda given, agg: F.lit(given) if given else agg("date")
    return sets[days].agg(pick(date_from, F.min).alias("date_from"), pick(date_to, F.max).alias("date_to"))


def export_ports(t: Tables, path: str, date_from: str | None = None, date_to: str | None = None, generated: str = "") -> None:
    sets = port_sets(t, date_from, date_to)
    ports = sets["daily_traffic"].agg(F.array_sort(F.collect_set("port")).alias("ports"))
    sinks.export_payload(sets, {"generated": generated}, path, PORT_SETS, [_covered(sets, "daily_traffic", date_from, date_to), ports])


def export_zones(t: Tables, path: str, date_from: str | None = None, date_to: str | None = None, generated: str = "") -> None:
    sets = zone_sets(t, date_from, date_to)
    fixed = t.spark.range(1).select(
        F.array(*map(F.lit, config.ZONE_ORDER)).alias("zones"),
        F.struct(*[F.lit(config.ZONE_LABELS[z]).alias(z) for z in config.ZONE_ORDER]).alias("zone_labels"),
        F.struct(*[F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in config.ZONE_VERTICES[z]]).alias(z)
                   for z in config.ZONE_ORDER]).alias("zone_polygons"))
    extra = [_covered(sets, "zone_daily_traffic", date_from, date_to), fixed, zone_summary(t.window(date_from, date_to))]
    sinks.export_payload(sets, {"generated": generated}, path, ZONE_SETS, extra)
