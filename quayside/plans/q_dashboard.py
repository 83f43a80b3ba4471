"""Registered dashboard roll-ups (D1-D14) with their SQL oracles."""
from __future__ import annotations

from quayside import config
from quayside.plans import dashboard as db
from quayside.plans import oracle as o
from quayside.plans import q_kpis  # noqa: F401  (registers the KPI CTEs used below)
from quayside.plans.registry import register
from quayside.plans.tables import Tables

# Fixed selections: a proper subset of each dimension, so every filter matters.
PORT_SELECTION = ["esbjerg", "aarhus", "copenhagen"]
ZONE_SELECTION = ["outer_approach", "anchorage", "north_terminal"]
TYPE_SELECTION = ["Cargo", "Tanker", "Passenger", "Tug", "Other"]

P, Z, TY = o.in_list(PORT_SELECTION), o.in_list(ZONE_SELECTION), o.in_list(TYPE_SELECTION)
rhu, xavg, isod = o.round_half_up, o.exact_avg, o.iso_date


def _cents(x: str, scale: int = 2) -> str:
    return f"CAST(round_even({x} * {o.d(10 ** scale)}, 0) AS BIGINT)"


def _reg(name, fn, sql, needs):
    register(name, o.build(sql, needs))(lambda spark, sf_dir: fn(Tables(spark, sf_dir)))


_reg("combined_peak", lambda t: db.combined_peak(t, PORT_SELECTION), f"""
SELECT CAST(max(n) AS BIGINT) AS peak_hourly_count FROM (
  SELECT date, hour, sum(vessel_count) AS n FROM port_ht WHERE port IN {P} GROUP BY date, hour) x""", ["port_ht"])

_reg("kpi_rollup", lambda t: db.kpi_rollup(t, PORT_SELECTION), f"""
SELECT CAST(sum(coalesce(total_vessel_hours, 0)) AS BIGINT) AS total_vessel_hours,
       {xavg('avg_dwell_minutes', 1)} AS avg_dwell_minutes,
       CAST(sum(total_entries) AS BIGINT) AS total_entries,
       {xavg('avg_daily_arrivals', 1)} AS avg_daily_arrivals
FROM port_summary WHERE port IN {P}""", ["port_summary"])

o.cte("dash_daily", ["port_hourly"], "SELECT port, date, CAST(sum(vessel_count) AS BIGINT) AS vessel_count "
                                      "FROM port_hourly GROUP BY port, date")
_pivot_cols = ", ".join(f"CAST(coalesce(sum(CASE WHEN port = {o.sq(p)} THEN vessel_count END), 0) AS BIGINT) AS {p}"
                        for p in PORT_SELECTION)
_reg("traffic_pivot", lambda t: db.traffic_pivot(t, PORT_SELECTION), f"""
SELECT {isod('date')} AS date, {_pivot_cols} FROM dash_daily WHERE port IN {P} GROUP BY date""", ["dash_daily"])

_order_vals = ", ".join(f"({i}, {o.sq(p)})" for i, p in enumerate(PORT_SELECTION))
_reg("traffic_stack", lambda t: db.traffic_stack(t, PORT_SELECTION), f"""
SELECT {isod('g.date')} AS date, g.port, coalesce(v.vessel_count, 0) AS vessel_count,
       CAST(coalesce((SELECT sum(w.vessel_count) FROM dash_daily w
                      JOIN (VALUES {_order_vals}) ow(port_order, port) ON ow.port = w.port
                      WHERE w.date = g.date AND ow.port_order < g.port_order), 0) AS BIGINT) AS y0,
       CAST(coalesce((SELECT sum(w.vessel_count) FROM dash_daily w
                      JOIN (VALUES {_order_vals}) ow(port_order, port) ON ow.port = w.port
                      WHERE w.date = g.date AND ow.port_order <= g.port_order), 0) AS BIGINT) AS y1
FROM (SELECT DISTINCT d.date, ord.port_order, ord.port FROM dash_daily d, (VALUES {_order_vals}) ord(port_order, port)
      WHERE d.port IN {P}) g
LEFT JOIN dash_daily v ON v.date = g.date AND v.port = g.port""", ["dash_daily"])

_reg("type_totals", lambda t: db.type_totals(t, PORT_SELECTION), f"""
SELECT vessel_type, CAST(sum("count") AS BIGINT) AS "count",
       CAST(sum("count") AS DOUBLE) / CAST(sum(sum("count")) OVER () AS DOUBLE) * 100e0 AS pct
FROM port_types WHERE port IN {P} GROUP BY vessel_type""", ["port_types"])

o.cte("cong_heat", ["port_ht"], f"""
SELECT port, {o.dow_mon0('date')} AS dow, hour, {rhu(xavg('vessel_count'), 2)} AS avg_vessel_count
FROM port_ht GROUP BY port, dow, hour""")
_reg("heatmap_rollup", lambda t: db.heatmap_rollup(t, PORT_SELECTION), f"""
SELECT dow, hour, {xavg('avg_vessel_count', 2)} AS avg_vessel_count FROM cong_heat WHERE port IN {P}
GROUP BY dow, hour""", ["cong_heat"])

o.cte("ztraffic", ["zone_hourly"], f"""
SELECT zone, date, vessel_type, sum(vessel_count) AS vessel_count FROM zone_hourly
WHERE vessel_type IN {TY} GROUP BY zone, date, vessel_type""")
_reg("zone_busiest_filtered", lambda t: db.zone_busiest_filtered(t, ZONE_SELECTION, TYPE_SELECTION), f"""
SELECT zone, CAST(zone_vessel_hours AS BIGINT) AS zone_vessel_hours,
       CAST(sum(zone_vessel_hours) OVER () AS BIGINT) AS selection_vessel_hours
FROM (SELECT zone, sum(vessel_count) AS zone_vessel_hours FROM ztraffic WHERE zone IN {Z} GROUP BY zone) x
QUALIFY row_number() OVER (ORDER BY zone_vessel_hours DESC, zone) = 1""", ["ztraffic"])

o.cte("zcong", ["zone_hourly"], f"""
SELECT zone, vessel_type, {o.dow_mon0('date')} AS dow, hour, {rhu(xavg('vessel_count'), 2)} AS avg_vessel_count
FROM zone_hourly GROUP BY zone, vessel_type, dow, hour""")
_reg("zone_peak_avg", lambda t: db.zone_peak_avg(t, ZONE_SELECTION, TYPE_SELECTION), f"""
SELECT max(u) / 100e0 AS peak_avg FROM (
  SELECT zone, dow, hour, sum({_cents('avg_vessel_count')}) AS u FROM zcong
  WHERE zone IN {Z} AND vessel_type IN {TY} GROUP BY zone, dow, hour) x""", ["zcong"])

o.cte("zdwell", ["zone_visits"], f"""
SELECT zone, vessel_type, count(*) AS visit_count, {rhu(xavg('dwell_minutes', 1) + ' / 60e0', 2)} AS avg_dwell_hours
FROM zone_visits WHERE dwell_minutes > 0 GROUP BY zone, vessel_type""")
_wanted = o.in_list([x for x in ("Cargo", "Tanker") if x in TYPE_SELECTION])
_reg("weighted_dwell", lambda t: db.weighted_dwell(t, TYPE_SELECTION), f"""
SELECT CASE WHEN sum(visit_count) > 0 THEN
         CAST(sum({_cents('avg_dwell_hours')} * visit_count) AS DOUBLE) / CAST(sum(visit_count) * 100 AS DOUBLE)
       END AS weighted_dwell_hours
FROM zdwell WHERE zone = 'anchorage' AND vessel_type IN {_wanted}""", ["zdwell"])

o.cte("znav", ["zone_nav"], "SELECT zone, vessel_type, nav_status, sum(ping_count) AS ping_count FROM zone_nav "
                            "GROUP BY zone, vessel_type, nav_status")
_reg("pct_moored_filtered", lambda t: db.pct_moored_filtered(t, TYPE_SELECTION), f"""
SELECT CASE WHEN sum(ping_count) > 0 THEN
         {rhu("CAST(sum(CASE WHEN nav_status = 'Moored' THEN ping_count ELSE 0 END) AS DOUBLE) / CAST(sum(ping_count) AS DOUBLE) * 100e0", 1)}
       END AS pct_moored
FROM znav WHERE zone = 'anchorage' AND vessel_type IN {TY}""", ["znav"])

_zcols = ", ".join(
    (f"CAST(coalesce((SELECT sum(vessel_count) FROM ztraffic x WHERE x.date = d.date AND x.zone = {o.sq(z)}), 0) "
     f"AS BIGINT) AS {z}") if z in ZONE_SELECTION else f"CAST(0 AS BIGINT) AS {z}"
    for z in config.ZONE_ORDER)
_reg("zone_traffic_pivot", lambda t: db.zone_traffic_pivot(t, ZONE_SELECTION, TYPE_SELECTION), f"""
SELECT {isod('d.date')} AS date, {_zcols} FROM (SELECT DISTINCT date FROM zone_hourly) d""",
     ["ztraffic", "zone_hourly"])

_scols = ("sog_mean", "sog_median", "sog_p025", "sog_p95", "sog_p975")
o.cte("zspeed_all", ["zone_speed"], f"""
SELECT zone, hour, vessel_type, {', '.join(f"{rhu(xavg(c, 2), 2)} AS {c}" for c in _scols)}
FROM zone_speed GROUP BY zone, hour, vessel_type""")
_reg("zone_speed_by_hour", lambda t: db.zone_speed_by_hour(t, ZONE_SELECTION, TYPE_SELECTION), f"""
SELECT zone, hour, {', '.join(f"{xavg(c, 2)} AS {c}" for c in _scols)}
FROM zspeed_all WHERE zone IN {Z} AND vessel_type IN {TY} GROUP BY zone, hour""", ["zspeed_all"])

_reg("navstatus_top6", lambda t: db.navstatus_top6(t, ZONE_SELECTION, TYPE_SELECTION), f"""
SELECT zone, nav_status, CAST(ping_count AS BIGINT) AS ping_count, share FROM (
  SELECT zone, nav_status, ping_count,
         CAST(ping_count AS DOUBLE) / CAST(sum(ping_count) OVER (PARTITION BY zone) AS DOUBLE) AS share
  FROM (SELECT zone, nav_status, sum(ping_count) AS ping_count FROM znav
        WHERE zone IN {Z} AND vessel_type IN {TY} GROUP BY zone, nav_status) a) s
WHERE nav_status IN (
  SELECT nav_status FROM znav WHERE zone IN {Z} AND vessel_type IN {TY}
  GROUP BY nav_status ORDER BY sum(ping_count) DESC, nav_status LIMIT 6)""", ["znav"])

_reg("zone_heatmap_dense", lambda t: db.zone_heatmap_dense(t, ZONE_SELECTION, TYPE_SELECTION), f"""
SELECT g.zone, CAST(g.dow AS INTEGER) AS dow, CAST(g.hour AS INTEGER) AS hour,
       coalesce(c.u, 0) / 100e0 AS avg_vessel_count
FROM (SELECT z.zone, dw.dow, hr.hour FROM (VALUES {', '.join(f"({o.sq(z)})" for z in ZONE_SELECTION)}) z(zone),
             range(0, 7) dw(dow), range(0, 24) hr(hour)) g
LEFT JOIN (SELECT zone, dow, hour, sum({_cents('avg_vessel_count')}) AS u FROM zcong
           WHERE zone IN {Z} AND vessel_type IN {TY} GROUP BY zone, dow, hour) c
       ON c.zone = g.zone AND c.dow = g.dow AND c.hour = g.hour""", ["zcong"])

_reg("zone_type_share", lambda t: db.zone_type_share(t, ZONE_SELECTION, TYPE_SELECTION), f"""
SELECT m.vessel_type, m.zone, m.visit_count,
       CAST(m.visit_count AS DOUBLE) / CAST(sum(m.visit_count) OVER (PARTITION BY m.zone) AS DOUBLE) * 100e0 AS share_pct,
       r.type_rank
FROM (SELECT zone, vessel_type, count(*) AS visit_count FROM zone_visits GROUP BY zone, vessel_type) m
LEFT JOIN (SELECT vessel_type, CAST(dense_rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS type_rank
           FROM zone_visits GROUP BY vessel_type) r ON r.vessel_type = m.vessel_type
WHERE m.zone IN {Z} AND m.vessel_type IN {TY}""", ["zone_visits"])
