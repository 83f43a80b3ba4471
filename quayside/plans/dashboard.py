"""Dashboard roll-ups (the client-side data operators) as parameterised DataFrame plans.

Each takes a selection (ports / zones / vessel types) and works on the exported KPI rows,
exactly as the dashboards do: sums over the selected ports, unweighted means of per-port
means, dense pivots with zeros, shares of a filtered total, top-k statuses. Means of
rounded inputs are exact (integer units) so the answer is independent of evaluation order.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside import config
from quayside.functions import numeric, timeparts
from quayside.plans import kpis
from quayside.plans.tables import Tables

iso = timeparts.iso_date


def _cents(c: Column, scale: int = 2) -> Column:
    return F.rint(c * F.lit(float(10 ** scale))).cast("long")


def _units_to_double(total_units: Column, scale: int = 2) -> Column:
    return total_units.cast("double") / F.lit(float(10 ** scale))


def combined_peak(t: Tables, ports: Sequence[str]) -> DataFrame:
    """Peak of the hourly totals summed over the selected ports (not the max of maxima)."""
    ht = kpis.hourly_totals_df(t).where(F.col("port").isin(*ports))
    per_hour = ht.groupBy("date", "hour").agg(F.sum("vessel_count").alias("n"))
    return per_hour.agg(F.max("n").alias("peak_hourly_count"))


def kpi_rollup(t: Tables, ports: Sequence[str]) -> DataFrame:
    """Sums over the selected ports' summaries; dwell and arrivals are the unweighted mean
    of the per-port values, skipping ports without one."""
    s = kpis.port_summary_df(t).where(F.col("port").isin(*ports))
    return s.agg(F.sum(F.coalesce(F.col("total_vessel_hours"), F.lit(0))).alias("total_vessel_hours"),
                 numeric.exact_avg(F.col("avg_dwell_minutes"), 1).alias("avg_dwell_minutes"),
                 F.sum("total_entries").alias("total_entries"),
                 numeric.exact_avg(F.col("avg_daily_arrivals"), 1).alias("avg_daily_arrivals"))


def _daily_traffic(t: Tables) -> DataFrame:
    return t.port_hourly_stats.groupBy("port", "date").agg(F.sum("vessel_count").alias("vessel_count"))


def traffic_pivot(t: Tables, ports: Sequence[str]) -> DataFrame:
    """Dates on which any selected port has traffic x one column per selected port, 0 if absent."""
    d = _daily_traffic(t).where(F.col("port").isin(*ports))
    return (d.groupBy("date").pivot("port", list(ports)).agg(F.sum("vessel_count"))
            .na.fill(0).withColumn("date", iso(F.col("date"))))


def traffic_stack(t: Tables, ports: Sequence[str]) -> DataFrame:
    """Long form of the stacked bars: per date and port, the value and its stack offsets
    (y0 = sum of the ports before it in selection order)."""
    d = _daily_traffic(t).where(F.col("port").isin(*ports))
    order = F.array(*[F.struct(F.lit(i).alias("port_order"), F.lit(p).alias("port")) for i, p in enumerate(ports)])
    grid = d.select("date").distinct().select("date", F.inline(order))
    dense = grid.join(d, ["date", "port"], "left").na.fill(0, ["vessel_count"])
    w = Window.partitionBy("date").orderBy("port_order").rowsBetween(Window.unboundedPreceding, 0)
    y1 = F.sum("vessel_count").over(w)
    return dense.select(iso(F.col("date")).alias("date"), "port", "vessel_count",
                        (y1 - F.col("vessel_count")).alias("y0"), y1.alias("y1"))


def type_totals(t: Tables, ports: Sequence[str]) -> DataFrame:
    """Vessel-type totals over the selected ports and each type's % of them."""
    per = (t.type_distribution.where(F.col("port").isin(*ports)).groupBy("vessel_type")
           .agg(F.sum("count").alias("count")))
    # un-partitioned window over the per-type aggregate: at most one row per vessel type
    total = F.sum("count").over(Window.partitionBy())
    return per.withColumn("pct", F.col("count").cast("double") / total.cast("double") * F.lit(100.0))


def heatmap_rollup(t: Tables, ports: Sequence[str], mode: str = "congestion") -> DataFrame:
    """Mean over the selected ports of each port's weekday x hour value."""
    if mode == "congestion":
        src, col, scale = kpis.congestion_heatmap(t), "avg_vessel_count", 2
    else:
        src, col, scale = kpis.stationary_heatmap(t), "avg_pct_stationary", 1
    return (src.where(F.col("port").isin(*ports)).groupBy("dow", "hour")
            .agg(numeric.exact_avg(F.col(col), scale).alias(col)))


def _zone_traffic(t: Tables, zones: Sequence[str], types: Sequence[str]) -> DataFrame:
    return (t.zone_hourly_stats.where(F.col("zone").isin(*zones) & F.col("vessel_type").isin(*types))
            .groupBy("zone", "date", "vessel_type").agg(F.sum("vessel_count").alias("vessel_count")))


def zone_busiest_filtered(t: Tables, zones: Sequence[str], types: Sequence[str]) -> DataFrame:
    """Vessel-hours of the whole selection and the busiest selected zone (top-1)."""
    per_zone = (_zone_traffic(t, zones, types).groupBy("zone")
                .agg(F.sum("vessel_count").alias("zone_vessel_hours")))
    total = F.sum("zone_vessel_hours").over(Window.partitionBy())   # one row per zone
    return (per_zone.withColumn("selection_vessel_hours", total)
            .orderBy(F.col("zone_vessel_hours").desc(), F.col("zone")).limit(1))


def zone_peak_avg(t: Tables, zones: Sequence[str], types: Sequence[str]) -> DataFrame:
    """Largest zone x weekday x hour sum of the per-type mean counts."""
    h = kpis.zone_congestion(t).where(F.col("zone").isin(*zones) & F.col("vessel_type").isin(*types))
    cells = h.groupBy("zone", "dow", "hour").agg(F.sum(_cents(F.col("avg_vessel_count"))).alias("u"))
    return cells.agg(_units_to_double(F.max("u")).alias("peak_avg"))


def weighted_dwell(t: Tables, types: Sequence[str]) -> DataFrame:
    """Visit-weighted anchorage dwell (hours) of Cargo and Tanker within the type filter."""
    wanted = [x for x in ("Cargo", "Tanker") if x in types]
    d = kpis.zone_dwell(t).where((F.col("zone") == "anchorage") & F.col("vessel_type").isin(*wanted))
    num = F.sum(_cents(F.col("avg_dwell_hours")) * F.col("visit_count"))
    den = F.sum("visit_count")
    return d.agg(F.when(den > 0, num.cast("double") / (den * F.lit(100)).cast("double"))
                 .alias("weighted_dwell_hours"))


def pct_moored_filtered(t: Tables, types: Sequence[str]) -> DataFrame:
    n = kpis.zone_navstatus_counts(t).where((F.col("zone") == "anchorage") & F.col("vessel_type").isin(*types))
    moored = F.sum(F.when(F.col("nav_status") == "Moored", F.col("ping_count")).otherwise(0))
    total = F.sum("ping_count")
    return n.agg(F.when(total > 0, numeric.round_half_up(moored.cast("double") / total.cast("double")
                                                         * F.lit(100.0), 1)).alias("pct_moored"))


def zone_traffic_pivot(t: Tables, zones: Sequence[str], types: Sequence[str]) -> DataFrame:
    """Every exported date x every zone: vessel-hours of the selected types, 0 for a zone
    outside the selection or without rows."""
    all_dates = t.zone_hourly_stats.select("date").distinct()
    vals = (_zone_traffic(t, config.ZONE_NAMES, types).where(F.col("zone").isin(*zones))
            .groupBy("date").pivot("zone", config.ZONE_ORDER).agg(F.sum("vessel_count")))
    return (all_dates.join(vals, "date", "left").na.fill(0, config.ZONE_ORDER)
            .select(iso(F.col("date")).alias("date"), *config.ZONE_ORDER))


def zone_speed_by_hour(t: Tables, zones: Sequence[str], types: Sequence[str]) -> DataFrame:
    """Per zone and hour, the unweighted mean over the selected types of each speed stat."""
    cols = ("sog_mean", "sog_median", "sog_p025", "sog_p95", "sog_p975")
    s = kpis.zone_speed_profile(t).where(F.col("zone").isin(*zones) & F.col("vessel_type").isin(*types))
    return s.groupBy("zone", "hour").agg(*[numeric.exact_avg(F.col(c), 2).alias(c) for c in cols])


def navstatus_top6(t: Tables, zones: Sequence[str], types: Sequence[str], k: int = 6) -> DataFrame:
    """The k statuses with most pings in the selection; each one's share of ALL pings of a
    zone (the zone total includes the statuses outside the top k)."""
    n = (kpis.zone_navstatus_counts(t).where(F.col("zone").isin(*zones) & F.col("vessel_type").isin(*types))
         .groupBy("zone", "nav_status").agg(F.sum("ping_count").alias("ping_count")))
    top = (n.groupBy("nav_status").agg(F.sum("ping_count").alias("status_total"))
           .orderBy(F.col("status_total").desc(), F.col("nav_status")).limit(k).select("nav_status"))
    zone_total = F.sum("ping_count").over(Window.partitionBy("zone"))
    shares = n.withColumn("share", F.col("ping_count").cast("double") / zone_total.cast("double"))
    return shares.join(F.broadcast(top), "nav_status", "left_semi")


def zone_heatmap_dense(t: Tables, zones: Sequence[str], types: Sequence[str]) -> DataFrame:
    """Dense 7 x 24 matrix per selected zone: sum over the selected types of the mean
    count, 0 where no row exists. The grid is generated, not joined from a calendar."""
    h = (kpis.zone_congestion(t).where(F.col("zone").isin(*zones) & F.col("vessel_type").isin(*types))
         .groupBy("zone", "dow", "hour").agg(F.sum(_cents(F.col("avg_vessel_count"))).alias("u")))
    grid = (h.sparkSession.range(1)
            .select(F.explode(F.array(*[F.lit(z) for z in zones])).alias("zone"))
            .select("zone", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("dow"))
            .select("zone", "dow", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")))
    return (grid.join(h, ["zone", "dow", "hour"], "left")
            .select("zone", "dow", "hour", _units_to_double(F.coalesce(F.col("u"), F.lit(0))).alias("avg_vessel_count")))


def zone_type_share(t: Tables, zones: Sequence[str], types: Sequence[str]) -> DataFrame:
    """Visit share of each type within a zone under the type filter, plus the global type
    order (dense rank of all-zone visit totals, unfiltered)."""
    mix = kpis.zone_type_mix(t)
    # global ranking over the per-type totals (one row per vessel type)
    order = (mix.groupBy("vessel_type").agg(F.sum("visit_count").alias("all_visits"))
             .withColumn("type_rank", F.dense_rank().over(Window.orderBy(F.col("all_visits").desc())))
             .select("vessel_type", "type_rank"))
    sel = mix.where(F.col("zone").isin(*zones) & F.col("vessel_type").isin(*types))
    total = F.sum("visit_count").over(Window.partitionBy("zone"))
    shares = sel.withColumn("share_pct", F.col("visit_count").cast("double") / total.cast("double") * F.lit(100.0))
    return shares.join(order, "vessel_type", "left")
