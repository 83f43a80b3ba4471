"""Data-quality checks for the declared (but unenforced) table constraints (Q1).

Every table gets: primary-key duplicates, nulls in NOT NULL columns, hours outside 0..23
and unknown zone names. Each table is checked with one aggregate pass (conditional
sums, no join) plus one grouped count on its key; results are unioned into one frame of
(table, check, violations).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside import config
from quayside.plans.tables import PRIMARY_KEYS, TABLE_COLUMNS

NULLABLE = {("port_daily_flow", "avg_dwell_minutes")}
HOUR_COLUMNS = ("hour", "entry_hour", "exit_hour")


def table_checks(table: str) -> list[tuple[str, str]]:
    """(check name, SQL predicate that flags a violating row) for one table."""
    checks = []
    for c in TABLE_COLUMNS[table]:
        if (table, c) not in NULLABLE:
            checks.append((f"not_null:{c}", f"`{c}` IS NULL"))
    for c in HOUR_COLUMNS:
        if c in TABLE_COLUMNS[table]:
            checks.append((f"range_0_23:{c}", f"`{c}` < 0 OR `{c}` > 23"))
    if "zone" in TABLE_COLUMNS[table]:
        names = ", ".join(f"'{z}'" for z in config.ZONE_NAMES)
        checks.append(("zone_name", f"zone NOT IN ({names})"))
    return checks


def check_table(df: DataFrame, table: str) -> DataFrame:
    """All checks of one table in a single grouped pass: group by the primary key with
    per-group violation counts (partial aggregation map-side), then one global sum. The
    duplicate count of a key group is its size minus one."""
    checks = table_checks(table)
    key = PRIMARY_KEYS[table]
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.when(F.expr(pred), 1).otherwise(0)).alias(f"c{i}") for i, (_, pred) in enumerate(checks)])
    totals = per_key.agg(
        *[F.sum(f"c{i}").cast("long").alias(f"c{i}") for i in range(len(checks))],
        F.sum(F.col("_n") - 1).cast("long").alias("dups"))
    pairs = ", ".join(f"'{name}', c{i}" for i, (name, _) in enumerate(checks)) + ", 'primary_key', dups"
    return totals.selectExpr(f"'{table}' AS table", f"stack({len(checks) + 1}, {pairs}) AS (check, violations)") \
                 .select("table", "check", F.coalesce(F.col("violations"), F.lit(0)).cast("long").alias("violations"))


def constraint_check(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        part = check_table(df, name)
        out = part if out is None else out.unionByName(part)
    return out
