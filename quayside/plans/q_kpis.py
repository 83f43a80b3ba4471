"""Registered KPI queries (port K1-K17, zone Z1-Z10) and their SQL oracles."""
from __future__ import annotations

from quayside import config
from quayside.plans import kpis
from quayside.plans import oracle as o
from quayside.plans.registry import register
from quayside.plans.tables import Tables

# Fixed parameters of the parameterised exports.
FLOW_WINDOW = ("2024-01-04", "2024-01-27")

rhu, xavg, isod = o.round_half_up, o.exact_avg, o.iso_date

o.cte("port_ht", ["port_hourly"], "SELECT port, date, hour, CAST(sum(vessel_count) AS BIGINT) AS vessel_count "
                                  "FROM port_hourly GROUP BY port, date, hour")
o.cte("zone_ht", ["zone_hourly"], "SELECT zone, date, hour, CAST(sum(vessel_count) AS BIGINT) AS vessel_count "
                                  "FROM zone_hourly GROUP BY zone, date, hour")


def _reg(name: str, fn, sql: str, needs: list[str]):
    register(name, o.build(sql, needs))(lambda spark, sf_dir: fn(Tables(spark, sf_dir)))


_reg("daily_traffic", kpis.daily_traffic, f"""
SELECT port, {isod('date')} AS date, CAST(sum(vessel_count) AS BIGINT) AS daily_vessel_count
FROM port_hourly GROUP BY port, date""", ["port_hourly"])

_PEAK = f"""
SELECT h.port, {isod('h.date')} AS date, h.hour, h.vessel_count AS total_vessel_count
FROM port_ht h
WHERE (h.port, h.date, h.vessel_count) IN (SELECT port, date, max(vessel_count) FROM port_ht GROUP BY port, date)"""
_reg("peak_hour", kpis.peak_hour, _PEAK, ["port_ht"])
_reg("peak_hour_in", kpis.peak_hour_in, f"""
SELECT port, {isod('date')} AS date, hour, total_vessel_count FROM (
  SELECT port, date, hour, vessel_count AS total_vessel_count,
         max(vessel_count) OVER (PARTITION BY port, date) AS mx FROM port_ht) x
WHERE total_vessel_count = mx""", ["port_ht"])

_reg("type_share", kpis.type_share, f"""
SELECT port, vessel_type, CAST(sum("count") AS BIGINT) AS total_vessels,
       {rhu('100e0 * sum("count") / sum(sum("count")) OVER (PARTITION BY port)', 1)} AS pct
FROM port_types GROUP BY port, vessel_type""", ["port_types"])


def _dwell_sql(src: str, region: str) -> str:
    return f"""
SELECT {region}, vessel_type, count(*) AS visit_count,
       {rhu(xavg('dwell_minutes', 1), 1)} AS avg_dwell_minutes,
       {rhu(xavg('dwell_minutes', 1) + ' / 60e0', 2)} AS avg_dwell_hours
FROM {src} WHERE dwell_minutes > 0 GROUP BY {region}, vessel_type"""


_reg("dwell_by_type", kpis.dwell_by_type, _dwell_sql("port_visits", "port"), ["port_visits"])

_reg("congestion_heatmap_sun", kpis.congestion_heatmap_sun, f"""
SELECT port, {o.dow_sun0('date')} AS day_of_week, hour, {rhu(xavg('vessel_count'), 1)} AS avg_vessel_count
FROM port_ht GROUP BY port, day_of_week, hour""", ["port_ht"])

_reg("congestion_heatmap", kpis.congestion_heatmap, f"""
SELECT port, {o.dow_mon0('date')} AS dow, hour, {rhu(xavg('vessel_count'), 2)} AS avg_vessel_count
FROM port_ht GROUP BY port, dow, hour""", ["port_ht"])

_reg("busiest_port", kpis.busiest_port, """
SELECT port, CAST(sum(vessel_count) AS BIGINT) AS total_vessel_hours FROM port_hourly GROUP BY port""",
     ["port_hourly"])

_reg("type_congestion", kpis.type_congestion, f"""
SELECT port, vessel_type, {o.dow_sun0('date')} AS day_of_week, hour,
       {rhu(xavg('vessel_count'), 1)} AS avg_vessel_count
FROM port_hourly GROUP BY port, vessel_type, day_of_week, hour""", ["port_hourly"])

_reg("arrival_hours", kpis.arrival_hours, """
SELECT port, vessel_type, entry_hour, count(*) AS arrival_count FROM port_visits
GROUP BY port, vessel_type, entry_hour""", ["port_visits"])


def _share_sql(src: str, region: str) -> str:
    share = rhu(f"100e0 * pings / sum(pings) OVER (PARTITION BY {region})", 1)
    return f"""
SELECT {region}, nav_status, pings AS ping_count, {share} AS pct
FROM (SELECT {region}, nav_status, CAST(sum(ping_count) AS BIGINT) AS pings FROM {src} GROUP BY ALL) s"""


def _nested(sql: str) -> str:
    # a WITH inside the final SELECT: wrap so it composes with the outer CTE list
    return f"SELECT * FROM ({sql.strip()}) q"


_reg("navstatus_share", kpis.navstatus_share, _nested(_share_sql("port_nav", "port")), ["port_nav"])

_reg("movement_by_port", kpis.movement_by_port, f"""
SELECT port, {rhu(xavg('sog_mean', 2), 2)} AS avg_sog_mean, {rhu(xavg('sog_median', 2), 2)} AS avg_sog_median,
       {rhu(xavg('sog_p95', 2), 2)} AS avg_sog_p95, {rhu(xavg('pct_stationary', 1), 1)} AS avg_pct_stationary
FROM port_speed GROUP BY port""", ["port_speed"])

_reg("flow_rates", kpis.flow_rates, f"""
SELECT port, vessel_type, {rhu(xavg('entries'), 1)} AS avg_daily_entries, {rhu(xavg('exits'), 1)} AS avg_daily_exits,
       {rhu(xavg('unique_vessels'), 1)} AS avg_daily_vessels,
       {rhu(xavg('avg_dwell_minutes', 1), 1)} AS avg_dwell_minutes
FROM port_flow GROUP BY port, vessel_type""", ["port_flow"])

_reg("turnover_rate", kpis.turnover_rate, f"""
SELECT port, vessel_type,
       {rhu(xavg('CAST(entries AS DOUBLE) / CAST(NULLIF(unique_vessels, 0) AS DOUBLE)', 12), 2)} AS turnover_rate
FROM port_flow GROUP BY port, vessel_type""", ["port_flow"])

_reg("movement_by_hour", kpis.movement_by_hour, f"""
SELECT port, hour, {rhu(xavg('sog_mean', 2), 2)} AS avg_sog, {rhu(xavg('pct_stationary', 1), 1)} AS avg_pct_stationary
FROM port_speed GROUP BY port, hour""", ["port_speed"])

_reg("stationary_heatmap", kpis.stationary_heatmap, f"""
SELECT port, {o.dow_mon0('date')} AS dow, hour, {rhu(xavg('pct_stationary', 1), 1)} AS avg_pct_stationary
FROM port_speed GROUP BY port, dow, hour""", ["port_speed"])

# The padded flow: visits of the padded window only, then trimmed. Recomputed in SQL from
# the pings of that window, so the oracle also checks that padding >= 1 day suffices.
_f, _t = FLOW_WINDOW
o.cte("win_pings", ["pings_t"], f"""
SELECT * FROM pings_t WHERE date BETWEEN DATE '{_f}' - {config.FLOW_PAD_DAYS} AND DATE '{_t}' + {config.FLOW_PAD_DAYS}""")
o.cte("win_visits", ["win_pings"], "SELECT DISTINCT mmsi, port, date FROM win_pings")
o.cte("win_flow", ["win_visits"], """
SELECT v.port, v.date,
       CAST(sum(CASE WHEN NOT EXISTS (SELECT 1 FROM win_visits y WHERE y.mmsi = v.mmsi AND y.port = v.port
                                       AND y.date = v.date - 1) THEN 1 ELSE 0 END) AS BIGINT) AS entries,
       CAST(sum(CASE WHEN NOT EXISTS (SELECT 1 FROM win_visits y WHERE y.mmsi = v.mmsi AND y.port = v.port
                                       AND y.date = v.date + 1) THEN 1 ELSE 0 END) AS BIGINT) AS exits,
       count(*) AS unique_vessels
FROM win_visits v GROUP BY v.port, v.date""")
register("daily_flow_padded", o.build(f"""
SELECT port, {isod('date')} AS date, entries, exits, unique_vessels FROM win_flow
WHERE date BETWEEN DATE '{_f}' AND DATE '{_t}'""", ["win_flow"]))(
    lambda spark, sf_dir: kpis.daily_flow_padded(spark, sf_dir, _f, _t, config.FLOW_PAD_DAYS))

# the rows of all three tables on end, one aggregation: measures of the other tables are null
o.cte("port_summary", ["port_ht", "port_visits", "port_flow"], f"""
SELECT port, CAST(sum(hours) AS BIGINT) AS total_vessel_hours, max(hours) AS peak_hourly_count,
       {rhu(xavg('dwell', 1), 1)} AS avg_dwell_minutes, CAST(sum(entries) AS BIGINT) AS total_entries,
       {rhu('CAST(sum(entries) AS DOUBLE) / NULLIF(count(DISTINCT flow_date), 0)', 1)} AS avg_daily_arrivals
FROM (SELECT port, vessel_count AS hours, NULL::DOUBLE AS dwell, NULL::BIGINT AS entries, NULL::DATE AS flow_date FROM port_ht
      UNION ALL SELECT port, NULL, dwell_minutes, NULL, NULL FROM port_visits
      UNION ALL SELECT port, NULL, NULL, entries, date FROM port_flow) m
GROUP BY port HAVING count(hours) > 0""")
_reg("port_summary", kpis.port_summary_df, "SELECT * FROM port_summary", ["port_summary"])

_reg("hourly_totals", kpis.hourly_totals, f"SELECT port, {isod('date')} AS date, hour, vessel_count FROM port_ht",
     ["port_ht"])

# ---- zone ---------------------------------------------------------------------
_reg("zone_daily_traffic", kpis.zone_daily_traffic, f"""
SELECT zone, {isod('date')} AS date, CAST(sum(vessel_count) AS BIGINT) AS vessel_count
FROM zone_hourly GROUP BY zone, date""", ["zone_hourly"])

_reg("zone_daily_traffic_type", kpis.zone_daily_traffic_type, f"""
SELECT zone, {isod('date')} AS date, vessel_type, CAST(sum(vessel_count) AS BIGINT) AS vessel_count
FROM zone_hourly GROUP BY zone, date, vessel_type""", ["zone_hourly"])

_reg("zone_congestion", kpis.zone_congestion, f"""
SELECT zone, vessel_type, {o.dow_mon0('date')} AS dow, hour, {rhu(xavg('vessel_count'), 2)} AS avg_vessel_count
FROM zone_hourly GROUP BY zone, vessel_type, dow, hour""", ["zone_hourly"])

_reg("zone_dwell", kpis.zone_dwell, _dwell_sql("zone_visits", "zone"), ["zone_visits"])

_reg("zone_navstatus_share", kpis.zone_navstatus_share, _nested(_share_sql("zone_nav", "zone")), ["zone_nav"])

_reg("zone_navstatus_counts", kpis.zone_navstatus_counts, """
SELECT zone, vessel_type, nav_status, CAST(sum(ping_count) AS BIGINT) AS ping_count
FROM zone_nav GROUP BY zone, vessel_type, nav_status""", ["zone_nav"])

_reg("approach_speed", kpis.approach_speed, f"""
SELECT hour, {rhu(xavg('sog_mean', 2), 2)} AS sog_mean, {rhu(xavg('sog_median', 2), 2)} AS sog_median,
       {rhu(xavg('sog_p95', 2), 2)} AS sog_p95
FROM zone_speed WHERE zone = 'outer_approach' GROUP BY hour""", ["zone_speed"])

_reg("zone_speed_profile", kpis.zone_speed_profile, f"""
SELECT zone, hour, vessel_type,
       {', '.join(f"{rhu(xavg(c, 2), 2)} AS {c}" for c in ('sog_mean', 'sog_median', 'sog_p025', 'sog_p95', 'sog_p975'))}
FROM zone_speed GROUP BY zone, hour, vessel_type""", ["zone_speed"])

_reg("zone_type_mix", kpis.zone_type_mix, """
SELECT zone, vessel_type, count(*) AS visit_count FROM zone_visits GROUP BY zone, vessel_type""", ["zone_visits"])

_reg("zone_overview", kpis.zone_overview, f"""
SELECT zone, CAST(sum(vessel_count) AS BIGINT) AS total_vessel_hours, {rhu(xavg('vessel_count'), 2)} AS avg_per_hour
FROM zone_hourly GROUP BY zone""", ["zone_hourly"])

_reg("zone_totals", kpis.zone_totals, """
SELECT CAST(sum(vessel_count) AS BIGINT) AS total_vessel_hours, max(vessel_count) AS peak_hourly_count
FROM zone_ht""", ["zone_ht"])

_reg("busiest_zone", kpis.busiest_zone, """
SELECT zone, CAST(sum(vessel_count) AS BIGINT) AS total_vessel_hours FROM zone_hourly
GROUP BY zone ORDER BY total_vessel_hours DESC, zone LIMIT 1""", ["zone_hourly"])

_reg("anchorage_wait", kpis.anchorage_wait, f"""
SELECT {rhu(xavg('dwell_minutes', 1) + ' / 60e0', 1)} AS avg_anchorage_dwell_cargo_hours
FROM zone_visits WHERE zone = 'anchorage' AND vessel_type IN ('Cargo', 'Tanker') AND dwell_minutes > 0""",
     ["zone_visits"])

_reg("moored_in_anchorage", kpis.moored_in_anchorage, f"""
SELECT {rhu('100e0 * (SELECT sum(ping_count) FROM zone_nav WHERE zone = ' + "'anchorage'" + " AND nav_status = 'Moored') / t.n", 1)}
       AS pct_moored_in_anchorage
FROM (SELECT sum(ping_count) AS n FROM zone_nav WHERE zone = 'anchorage') t""", ["zone_nav"])
