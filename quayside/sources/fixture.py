"""Project the driver's ``events`` table onto the raw-ping schema.

The test data holds no vessel positions; ``events`` (event_id, ts, user_id, event_type,
value, props) is mapped column by column onto AIS pings with integer and double
arithmetic only, so every engine derives bit-identical positions. Sites 0-4 place a
ping inside one of the five port boxes, site 5 outside all of them (half in the Aarhus
approach corridor, half far out at sea).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside import config

# FIXED VALUES of the projection (shared with the SQL oracle).
SITE_PORTS = ["esbjerg", "aarhus", "copenhagen", "aalborg", "fredericia"]
SHIP_TYPES = ["Cargo", "Tanker", "Passenger", "Fishing", "Tug", "Pleasure craft", "HSC", " SAR ",
              "Tug/Cargo", "Undefined", None]
NAV_STATUS = {"click": "Under way using engine", "view": "Moored", "purchase": "At anchor",
              "signup": "Unknown value"}

PING_COLUMNS = ["event_id", "mmsi", "ts", "date", "latitude", "longitude", "sog", "nav_status",
                "ship_type", "mobile_type", "name"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _d(x: float) -> str:
    return f"{float(x)!r}D"


def _coord_sql(frac: str, axis: int, near: tuple[float, float], far: tuple[float, float]) -> str:
    """Sites 0-4: ``lo + (hi - lo) * frac`` inside that port's box; site 5 outside."""
    lows = ", ".join(_d(config.PORTS[p][axis]) for p in SITE_PORTS)
    highs = ", ".join(_d(config.PORTS[p][axis + 1]) for p in SITE_PORTS)
    idx = "CAST(_site + 1 AS INT)"
    lo, hi = f"element_at(array({lows}), {idx})", f"element_at(array({highs}), {idx})"
    outside = (f"CASE WHEN event_id % 2 = 0 THEN {_d(near[0])} + {_d(near[1])} * {frac} "
               f"ELSE {_d(far[0])} + {_d(far[1])} * {frac} END")
    return f"CAST(CASE WHEN _site < {len(SITE_PORTS)} THEN {lo} + ({hi} - {lo}) * {frac} ELSE {outside} END AS FLOAT)"


def pings_from_events(events: DataFrame) -> DataFrame:
    """Raw pings (one per event): the AIS fields the engine uses, engine-native names.

    Written as SQL expressions (one parse each on the JVM side). Step 1 computes the
    intermediates used several times once per event: whole-second time in TIMESTAMP_NTZ
    arithmetic only (no session time zone involved), the site and the two fractions.
    """
    base = events.selectExpr(
        "event_id", "user_id", "value", "event_type",
        "make_timestamp_ntz(year(ts), month(ts), day(ts), hour(ts), minute(ts), second(ts)) AS _ts",
        "(user_id + CAST(floor(day(ts) / 4.0D) AS INT)) % 6 AS _site",
        "((event_id * 37) % 101) / 100.0D AS _u",
        "((event_id * 53) % 101) / 100.0D AS _v",
    )
    nav = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NAV_STATUS.items())
    types = ", ".join("CAST(NULL AS STRING)" if t is None else f"'{t}'" for t in SHIP_TYPES)
    fields = {
        "event_id": "event_id",
        "mmsi": "CAST(219000000 + user_id AS BIGINT)",
        "ts": "_ts",
        "date": "CAST(_ts AS DATE)",
        "latitude": _coord_sql("_u", 0, (56.05, 0.20), (58.0, 6.0)),
        "longitude": _coord_sql("_v", 2, (10.31, 0.24), (11.0, 8.0)),
        "sog": ("CAST(CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 23 = 0 THEN 102.3D "
                "WHEN event_id % 3 = 0 THEN 0.0D ELSE value / 20.0D END AS FLOAT)"),
        "nav_status": f"CASE event_type {nav} END",
        "ship_type": (f"element_at(array({types}), "
                      f"CAST((user_id + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END) % {len(SHIP_TYPES)} + 1 AS INT))"),
        "mobile_type": ("CASE WHEN user_id % 17 = 16 THEN 'Base Station' WHEN user_id % 2 = 0 THEN 'Class A' "
                        "ELSE 'Class B' END"),
        "name": "CASE WHEN event_id % 13 = 0 THEN CAST(NULL AS STRING) ELSE concat('VESSEL ', CAST(user_id AS STRING)) END",
    }
    struct = ", ".join(f"{expr} AS {name}" for name, expr in fields.items())
    # Step 2: a one-element ``inline``. The derived columns become Generate output, so
    # Catalyst cannot substitute their formulas into every downstream box predicate
    # (dozens of copies would overflow codegen limits); each is evaluated once per event.
    # A real scan delivers these as plain Parquet columns and needs no such step.
    return base.selectExpr(f"inline(array(struct({struct})))")


_PLANS: dict[tuple[str, str, str], DataFrame] = {}


def raw_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw pings derived from ``events`` under ``sf_dir``.

    The driver's test tables are read-only, so the projection's logical plan (file
    listing, footers, analysis) is built once per session and directory and reused by
    every query; no data is cached, each query still scans the file."""
    key = (spark.sparkContext.applicationId, spark._jsparkSession.sessionUUID(), sf_dir.rstrip("/"))
    plan = _PLANS.get(key)
    if plan is None:
        plan = pings_from_events(read_table(spark, sf_dir, "events"))
        _PLANS[key] = plan
    return plan
