"""Registered exploration queries."""
from __future__ import annotations

from quayside import config
from quayside.operators import explore, regions
from quayside.plans import oracle as o
from quayside.plans.q_joins import reg
from quayside.plans.tables import Tables

isod = o.iso_date

o.cte("cov_all", ["raw"], f"SELECT * FROM raw WHERE {o.box_double(config.COVERAGE_BOX)}")


def _cov(spark, sf_dir):
    """Exploration scan: coverage box only (all transponder classes)."""
    return regions.coverage_filter(Tables(spark, sf_dir).raw, real_vessels_only=False)


@reg("hourly_messages", "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS messages FROM cov_all "
                        "WHERE ts IS NOT NULL GROUP BY 1", ["cov_all"])
def q_hourly_messages(spark, sf_dir):
    return explore.hourly_messages(_cov(spark, sf_dir))


@reg("type_frequency", f"SELECT ship_type, count(*) AS messages FROM cov_all WHERE ship_type IS NOT NULL "
                       f"GROUP BY ship_type ORDER BY messages DESC, ship_type LIMIT {config.TYPE_FREQUENCY_TOP}",
     ["cov_all"])
def q_type_frequency(spark, sf_dir):
    return explore.type_frequency(_cov(spark, sf_dir))


@reg("lump_top_n", f"""
SELECT CASE WHEN t.ship_type IS NOT NULL THEN c.ship_type ELSE 'Other' END AS ship_type_label, count(*) AS pings
FROM cov_all c LEFT JOIN (SELECT ship_type FROM cov_all WHERE ship_type IS NOT NULL GROUP BY ship_type
                          ORDER BY count(*) DESC, ship_type LIMIT {config.LUMP_TOP_N}) t ON t.ship_type = c.ship_type
GROUP BY 1""", ["cov_all"])
def q_lump_top_n(spark, sf_dir):
    return explore.lump_top_n(_cov(spark, sf_dir))


@reg("port_overview", "SELECT port, count(*) AS pings, count(DISTINCT mmsi) AS unique_vessels FROM pings "
                      "GROUP BY port", ["pings"])
def q_port_overview(spark, sf_dir):
    return explore.port_overview(Tables(spark, sf_dir).pings)


@reg("daily_distinct_vessels", f"SELECT port, {isod('date')} AS date, count(DISTINCT mmsi) AS vessel_count "
                               "FROM pings GROUP BY port, date", ["pings"])
def q_daily_distinct_vessels(spark, sf_dir):
    return explore.daily_distinct_vessels(Tables(spark, sf_dir).pings)


def _hist_sql(x: str, n: int) -> tuple[str, str]:
    """(edge(i) expression, bin-index expression) over columns mn, mx -- NumPy's rule."""
    def edge(i: str) -> str:
        return f"(CASE WHEN {i} = {n} THEN mx ELSE CAST({i} AS DOUBLE) * ((mx - mn) / {o.d(n)}) + mn END)"
    est0 = f"CAST(trunc(({x} - mn) / (mx - mn) * {o.d(n)}) AS INTEGER)"
    est = f"(CASE WHEN {est0} >= {n} THEN {n - 1} ELSE {est0} END)"
    idx = (f"(CASE WHEN {x} < {edge(est)} THEN {est} - 1 "
           f"WHEN {x} >= {edge(f'({est} + 1)')} AND {est} <> {n - 1} THEN {est} + 1 ELSE {est} END)")
    return edge, idx


_edge, _idx = _hist_sql("x", config.SPEED_HIST_BINS)
_lo, _hi = config.SPEED_HIST_RANGE


@reg("speed_histogram", f"""
WITH v AS (SELECT CAST(sog AS DOUBLE) AS x FROM cov_all WHERE CAST(sog AS DOUBLE) BETWEEN {o.d(_lo)} AND {o.d(_hi)}),
     s0 AS (SELECT min(x) AS mn0, max(x) AS mx0, quantile_cont(x, 0.5) AS med FROM v),
     s AS (SELECT CASE WHEN mn0 = mx0 THEN mn0 - 0.5e0 ELSE mn0 END AS mn,
                  CASE WHEN mn0 = mx0 THEN mx0 + 0.5e0 ELSE mx0 END AS mx, med FROM s0),
     c AS (SELECT {_idx} AS bin, count(*) AS messages FROM v, s GROUP BY 1)
SELECT CAST(b.i AS INTEGER) AS bin, {_edge('b.i')} AS bin_lo, {_edge('(b.i + 1)')} AS bin_hi,
       coalesce(c.messages, 0) AS messages, s.med AS median_sog
FROM range(0, {config.SPEED_HIST_BINS}) b(i) CROSS JOIN s LEFT JOIN c ON c.bin = b.i""".replace(
    "WITH v AS", "SELECT * FROM (WITH v AS") + ") q", ["cov_all"])
def q_speed_histogram(spark, sf_dir):
    return explore.speed_histogram(_cov(spark, sf_dir))


_dedge, _didx = _hist_sql("x", config.DWELL_HIST_BINS)


@reg("dwell_histogram", f"""SELECT * FROM (
WITH h AS (SELECT port, date_diff('second', first_seen, last_seen) / 3600e0 AS x FROM port_visits),
     v AS (SELECT * FROM h WHERE x > 0 AND x <= {o.d(config.DWELL_HIST_MAX_HOURS)}),
     s0 AS (SELECT port, min(x) AS mn0, max(x) AS mx0, quantile_cont(x, 0.5) AS median_hours FROM v GROUP BY port),
     s AS (SELECT port, CASE WHEN mn0 = mx0 THEN mn0 - 0.5e0 ELSE mn0 END AS mn,
                  CASE WHEN mn0 = mx0 THEN mx0 + 0.5e0 ELSE mx0 END AS mx, median_hours FROM s0),
     c AS (SELECT v.port, {_didx} AS bin, count(*) AS visits FROM v JOIN s ON s.port = v.port GROUP BY 1, 2)
SELECT s.port, CAST(b.i AS INTEGER) AS bin, {_dedge('b.i')} AS bin_lo, {_dedge('(b.i + 1)')} AS bin_hi,
       coalesce(c.visits, 0) AS visits, s.median_hours
FROM s CROSS JOIN range(0, {config.DWELL_HIST_BINS}) b(i) LEFT JOIN c ON c.port = s.port AND c.bin = b.i) q""",
     ["port_visits"])
def q_dwell_histogram(spark, sf_dir):
    return explore.dwell_histogram(Tables(spark, sf_dir).vessel_visits)


_sample = "SELECT port, event_id, mmsi, latitude, longitude FROM pings QUALIFY row_number() OVER (PARTITION BY port ORDER BY " \
          f"md5('{config.SAMPLE_SEED}:' || event_id), event_id) <= "


@reg("sample_per_port", _sample + str(config.SAMPLE_PER_PORT), ["pings"])
def q_sample_per_port(spark, sf_dir):
    """Seeded per-port sample of the size that the exploration uses (all pings of a smaller port)."""
    return explore.sample_per_port(Tables(spark, sf_dir).pings).select("port", "event_id", "mmsi", "latitude", "longitude")


@reg("sample_per_port_small", _sample + "25", ["pings"])
def q_sample_per_port_small(spark, sf_dir):
    """The same sample of 25 pings per port, fewer than any port has."""
    return explore.sample_per_port(Tables(spark, sf_dir).pings, 25).select("port", "event_id", "mmsi", "latitude", "longitude")


_hcols = ", ".join(f"max(CASE WHEN hour = {h} THEN v END) AS h{h:02d}" for h in range(24))


@reg("heatmap_pivot", f"""SELECT * FROM (
WITH hc AS (SELECT port, date, CAST(hour(ts) AS INTEGER) AS hour, count(DISTINCT mmsi) AS n FROM pings
            WHERE ts IS NOT NULL GROUP BY port, date, hour),
     m AS (SELECT port, {o.dow_mon0('date')} AS dow, hour, {o.exact_avg('n')} AS v FROM hc GROUP BY port, dow, hour),
     g AS (SELECT p.port, CAST(d.dow AS INTEGER) AS dow FROM (SELECT DISTINCT port FROM m) p, range(0, 7) d(dow))
SELECT g.port, g.dow, {', '.join(f'w.h{h:02d}' for h in range(24))}
FROM g LEFT JOIN (SELECT port, dow, {_hcols} FROM m GROUP BY port, dow) w ON w.port = g.port AND w.dow = g.dow) q""",
     ["pings"])
def q_heatmap_pivot(spark, sf_dir):
    return explore.heatmap_pivot(Tables(spark, sf_dir).pings)
