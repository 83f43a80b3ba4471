"""Independent SQL (DuckDB dialect) for every registered query.

Each oracle string is self-contained: a ``WITH`` list that projects ``events`` to pings,
filters and labels them, builds the fact tables and finally the query. CTEs are declared
once with their dependencies and pulled in on demand.

Written independently of the DataFrame code where it matters: first rows and modal types
through ``row_number``, entries/exits through anti-joins on the day before/after,
quantiles through ``quantile_cont``. Literals carry an exponent (``55.4e0``) so they are
DOUBLE, never DECIMAL; bounds are cast to FLOAT for the float32 box tests.
"""
from __future__ import annotations

from quayside import config
from quayside.sources import fixture

_CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    _CTES[name] = (deps, sql)


def build(final_sql: str, needs: list[str]) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final_sql.strip()
    body = ",\n".join(f"{n} AS (\n{_CTES[n][1].strip()}\n)" for n in order)
    return f"WITH {body}\n{final_sql.strip()}"


# ---------------------------------------------------------------------------
# Literal and expression helpers
# ---------------------------------------------------------------------------
def d(x: float) -> str:
    r = repr(float(x))
    return r if ("e" in r or "inf" in r or "nan" in r) else f"{r}e0"


def f32(x: float) -> str:
    return f"CAST({d(x)} AS FLOAT)"


def box(box_: tuple[float, float, float, float], lat: str = "latitude", lon: str = "longitude") -> str:
    a, b, c, e = box_
    return f"({lat} BETWEEN {f32(a)} AND {f32(b)} AND {lon} BETWEEN {f32(c)} AND {f32(e)})"


def box_double(box_: tuple[float, float, float, float], lat: str = "latitude", lon: str = "longitude") -> str:
    a, b, c, e = box_
    return (f"(CAST({lat} AS DOUBLE) BETWEEN {d(a)} AND {d(b)} AND "
            f"CAST({lon} AS DOUBLE) BETWEEN {d(c)} AND {d(e)})")


def round_even(x: str, digits: int) -> str:
    f = d(10.0 ** digits)
    return f"(round_even(({x}) * {f}, 0) / {f})"


def round_half_up(x: str, digits: int) -> str:
    """Half-up on the shortest decimal representation of the double (what Spark's round
    does): the text form is parsed exactly into a decimal, then rounded."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def exact_avg(x: str, scale: int = 0) -> str:
    f = 10 ** scale
    return (f"(CAST(sum(CAST(round_even(CAST(({x}) AS DOUBLE) * {d(f)}, 0) AS BIGINT)) AS DOUBLE)"
            f" / CAST(count({x}) * {f} AS DOUBLE))")


def iso_date(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def iso_ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(sq(v) for v in values) + ")"


def type_last_wins(col: str = "ship_type") -> str:
    low = f"lower(trim(coalesce({col}, '')))"
    whens = " ".join(f"WHEN contains({low}, {sq(k)}) THEN {sq(lbl)}" for k, lbl in reversed(config.TYPE_KEYS))
    return f"CASE {whens} ELSE 'Other' END"


def type_first_wins(col: str = "ship_type") -> str:
    low = f"lower({col})"
    whens = " ".join(f"WHEN contains({low}, {sq(t.lower())}) THEN {sq(t)}" for t in config.TOP_TYPES)
    return f"CASE {whens} ELSE 'Other' END"


def dow_sun0(x: str) -> str:
    return f"CAST(dayofweek({x}) AS INTEGER)"


def dow_mon0(x: str) -> str:
    return f"CAST(isodow({x}) - 1 AS INTEGER)"


def zone_case(lat: str = "latitude", lon: str = "longitude") -> str:
    z = config.AARHUS_ZONES
    band = (z["anchorage"][0], z["anchorage"][1], z["anchorage"][2], z["south_terminal"][3])
    (la, loa), (lb, lob) = config.ANCHORAGE_DIAGONAL
    step = f"CAST(({lat} - {f32(la)}) * CAST({d(lob)} - {d(loa)} AS FLOAT) AS FLOAT)"
    step = f"CAST({step} / CAST({d(lb)} - {d(la)} AS FLOAT) AS FLOAT)"
    diag = f"CAST({f32(loa)} + {step} AS FLOAT)"
    return (f"CASE WHEN {box(z['outer_approach'], lat, lon)} THEN 'outer_approach' "
            f"WHEN {box(z['north_terminal'], lat, lon)} THEN 'north_terminal' "
            f"WHEN {box(band, lat, lon)} AND {lon} < {diag} THEN 'anchorage' "
            f"WHEN {box(band, lat, lon)} AND {lon} >= {diag} THEN 'south_terminal' END")


def zone_index_case(lat: str, lon: str) -> str:
    z = config.AARHUS_ZONES
    idx = {n: i for i, n in enumerate(config.ZONE_ORDER)}
    band = (z["anchorage"][0], z["anchorage"][1], z["anchorage"][2], z["south_terminal"][3])
    (la, loa), (lb, lob) = config.ANCHORAGE_DIAGONAL
    diag = f"({d(loa)} + ({lat} - {d(la)}) * ({d(lob)} - {d(loa)}) / ({d(lb)} - {d(la)}))"
    return (f"CASE WHEN {box_double(z['outer_approach'], lat, lon)} THEN {idx['outer_approach']} "
            f"WHEN {box_double(z['north_terminal'], lat, lon)} THEN {idx['north_terminal']} "
            f"WHEN {box_double(band, lat, lon)} THEN CASE WHEN {lon} < {diag} THEN {idx['anchorage']} "
            f"ELSE {idx['south_terminal']} END END")


# ---------------------------------------------------------------------------
# Pings
# ---------------------------------------------------------------------------
def _coord(axis: int, frac: str, near: tuple[float, float], far: tuple[float, float]) -> str:
    whens = []
    for i, port in enumerate(fixture.SITE_PORTS):
        lo, hi = config.PORTS[port][axis], config.PORTS[port][axis + 1]
        whens.append(f"WHEN {i} THEN {d(lo)} + ({d(hi)} - {d(lo)}) * {frac}")
    out = (f"CASE WHEN event_id % 2 = 0 THEN {d(near[0])} + {d(near[1])} * {frac} "
           f"ELSE {d(far[0])} + {d(far[1])} * {frac} END")
    return f"CAST(CASE site {' '.join(whens)} ELSE {out} END AS FLOAT)"


def _ship_type_case() -> str:
    whens = " ".join(f"WHEN {i} THEN {'NULL' if t is None else sq(t)}" for i, t in enumerate(fixture.SHIP_TYPES))
    return (f"CASE (user_id + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END) % {len(fixture.SHIP_TYPES)} "
            f"{whens} END")


cte("raw", [], f"""
SELECT event_id,
       CAST(219000000 + user_id AS BIGINT) AS mmsi,
       date_trunc('second', ts) AS ts,
       CAST(date_trunc('second', ts) AS DATE) AS date,
       {_coord(0, 'u', (56.05, 0.20), (58.0, 6.0))} AS latitude,
       {_coord(2, 'v', (10.31, 0.24), (11.0, 8.0))} AS longitude,
       CAST(CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 23 = 0 THEN 102.3e0
                 WHEN event_id % 3 = 0 THEN 0e0 ELSE value / 20e0 END AS FLOAT) AS sog,
       CASE event_type {' '.join(f"WHEN {sq(k)} THEN {sq(v)}" for k, v in fixture.NAV_STATUS.items())} END AS nav_status,
       {_ship_type_case()} AS ship_type,
       CASE WHEN user_id % 17 = 16 THEN 'Base Station' WHEN user_id % 2 = 0 THEN 'Class A' ELSE 'Class B' END
            AS mobile_type,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'VESSEL ' || CAST(user_id AS VARCHAR) END AS name
FROM (SELECT *, (user_id + CAST(floor(day(ts) / 4e0) AS INTEGER)) % 6 AS site,
             ((event_id * 37) % 101) / 100e0 AS u, ((event_id * 53) % 101) / 100e0 AS v
      FROM events) e
""")

_port_case = "CASE " + " ".join(f"WHEN {box(b)} THEN {sq(n)}" for n, b in reversed(list(config.PORTS.items()))) + " ELSE '' END"
_any_port = " OR ".join(box(b) for b in config.PORTS.values())

cte("pings", ["raw"], f"SELECT *, {_port_case} AS port FROM raw WHERE {_any_port}")
cte("pings_t", ["pings"], f"SELECT *, {type_last_wins()} AS vessel_type, CAST(hour(ts) AS INTEGER) AS hour FROM pings")
cte("zoned", ["pings"], f"SELECT * FROM (SELECT *, {zone_case()} AS zone FROM pings WHERE port = 'aarhus') z "
                        "WHERE zone IS NOT NULL")
cte("zoned_t", ["zoned"], f"SELECT *, {type_last_wins()} AS vessel_type, CAST(hour(ts) AS INTEGER) AS hour FROM zoned")


# ---------------------------------------------------------------------------
# Fact tables (region-generic text, instantiated for port and zone)
# ---------------------------------------------------------------------------
def _facts(prefix: str, src: str, region: str, zone: bool) -> None:
    cte(f"{prefix}_hourly", [src], f"""
SELECT {region}, date, hour, vessel_type, count(DISTINCT mmsi) AS vessel_count
FROM {src} WHERE hour IS NOT NULL GROUP BY {region}, date, hour, vessel_type""")

    cte(f"{prefix}_modal", [src], f"""
SELECT mmsi, {region}, date, vessel_type FROM (
  SELECT mmsi, {region}, date, vessel_type,
         row_number() OVER (PARTITION BY mmsi, {region}, date ORDER BY count(*) DESC, vessel_type) AS rn
  FROM {src} GROUP BY mmsi, {region}, date, vessel_type) m WHERE rn = 1""")

    hours = ("" if zone else
             ", CAST(hour(a.first_seen) AS INTEGER) AS entry_hour, CAST(hour(a.last_seen) AS INTEGER) AS exit_hour")
    cte(f"{prefix}_visits", [src, f"{prefix}_modal"], f"""
SELECT a.mmsi, a.{region}, a.date, a.first_seen, a.last_seen, m.vessel_type, a.ping_count,
       {round_even("date_diff('second', a.first_seen, a.last_seen) / 60e0", 1)} AS dwell_minutes{hours}
FROM (SELECT mmsi, {region}, date, min(ts) AS first_seen, max(ts) AS last_seen, count(ts) AS ping_count
      FROM {src} GROUP BY mmsi, {region}, date) a
JOIN {prefix}_modal m ON a.mmsi = m.mmsi AND a.{region} = m.{region} AND a.date = m.date""")

    if zone:
        cte(f"{prefix}_nav", [src], f"""
SELECT {region}, date, vessel_type, nav_status, count(*) AS ping_count
FROM {src} WHERE nav_status IS NOT NULL GROUP BY {region}, date, vessel_type, nav_status""")
        q = {"sog_median": 0.5, "sog_p025": 0.025, "sog_p95": 0.95, "sog_p975": 0.975}
        qs = ",\n       ".join(f"{round_even(f'quantile_cont(sog_d, {p})', 2)} AS {n}" for n, p in q.items())
        cte(f"{prefix}_speed", [src], f"""
SELECT {region}, date, hour, vessel_type, {round_even('avg(sog_d)', 2)} AS sog_mean,
       {qs}
FROM (SELECT *, CAST(sog AS DOUBLE) AS sog_d FROM {src} WHERE sog < 102.3e0 AND hour IS NOT NULL) s
GROUP BY {region}, date, hour, vessel_type""")
    else:
        cte(f"{prefix}_types", [src], f"""
SELECT {region}, date, vessel_type, count(*) AS "count" FROM (
  SELECT *, row_number() OVER (PARTITION BY mmsi, {region}, date ORDER BY ts NULLS LAST, event_id) AS rn
  FROM {src}) f WHERE rn = 1 GROUP BY {region}, date, vessel_type""")
        cte(f"{prefix}_nav", [src], f"""
SELECT {region}, date, nav_status, count(*) AS ping_count
FROM {src} WHERE nav_status IS NOT NULL GROUP BY {region}, date, nav_status""")
        cte(f"{prefix}_speed", [src], f"""
SELECT {region}, date, hour,
       {round_even('avg(sog_d)', 2)} AS sog_mean,
       {round_even('quantile_cont(sog_d, 0.5)', 2)} AS sog_median,
       {round_even('quantile_cont(sog_d, 0.95)', 2)} AS sog_p95,
       {round_even('avg(CASE WHEN sog < 0.5e0 THEN 1e0 ELSE 0e0 END) * 100e0', 1)} AS pct_stationary
FROM (SELECT *, CAST(sog AS DOUBLE) AS sog_d FROM {src} WHERE sog < 102.3e0 AND hour IS NOT NULL) s
GROUP BY {region}, date, hour""")
        cte(f"{prefix}_flow", [f"{prefix}_visits"], f"""
SELECT v.{region}, v.date, v.vessel_type, count(*) AS unique_vessels,
       CAST(sum(CASE WHEN y.mmsi IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS entries,
       CAST(sum(CASE WHEN t.mmsi IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS exits,
       {round_even(exact_avg('CASE WHEN v.dwell_minutes > 0 THEN v.dwell_minutes END', 1), 1)} AS avg_dwell_minutes
FROM {prefix}_visits v
LEFT JOIN {prefix}_visits y ON y.mmsi = v.mmsi AND y.{region} = v.{region} AND y.date = v.date - 1
LEFT JOIN {prefix}_visits t ON t.mmsi = v.mmsi AND t.{region} = v.{region} AND t.date = v.date + 1
GROUP BY v.{region}, v.date, v.vessel_type""")


_facts("port", "pings_t", "port", zone=False)
_facts("zone", "zoned_t", "zone", zone=True)

# Published (stored) form of the ten tables.
PUBLISHED = {
    "port_hourly_stats": ("port_hourly", "port, {date}, hour, vessel_type, vessel_count"),
    "vessel_visits": ("port_visits", "mmsi, port, {date}, {first}, {last}, vessel_type, ping_count, dwell_minutes, "
                                     "entry_hour, exit_hour"),
    "type_distribution": ("port_types", 'port, {date}, vessel_type, "count"'),
    "port_navstatus_stats": ("port_nav", "port, {date}, nav_status, ping_count"),
    "port_speed_stats": ("port_speed", "port, {date}, hour, sog_mean, sog_median, sog_p95, pct_stationary"),
    "port_daily_flow": ("port_flow", "port, {date}, vessel_type, unique_vessels, entries, exits, avg_dwell_minutes"),
    "aarhus_zone_hourly_stats": ("zone_hourly", "zone, {date}, hour, vessel_type, vessel_count"),
    "aarhus_zone_visits": ("zone_visits", "mmsi, zone, {date}, {first}, {last}, vessel_type, ping_count, "
                                          "dwell_minutes"),
    "aarhus_navstatus_stats": ("zone_nav", "zone, {date}, vessel_type, nav_status, ping_count"),
    "aarhus_zone_speed_stats": ("zone_speed", "zone, {date}, hour, vessel_type, sog_mean, sog_median, sog_p025, "
                                              "sog_p95, sog_p975"),
}


def published_sql(table: str) -> str:
    src, cols = PUBLISHED[table]
    cols = cols.format(date=f"{iso_date('date')} AS date", first=f"{iso_ts('first_seen')} AS first_seen",
                       last=f"{iso_ts('last_seen')} AS last_seen")
    return build(f"SELECT {cols} FROM {src}", [src])
