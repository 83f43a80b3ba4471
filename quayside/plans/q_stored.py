"""Registered queries on stored and maintained tables: incremental fact tables, counts of the filter step, mergeable
sketches of vessels and speeds."""
from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions import numeric
from quayside.operators import quality, sketches
from quayside.plans import oracle as o
from quayside.plans.q_joins import reg
from quayside.plans import dashboard, kpis, q_dashboard, q_kpis, q_sources  # noqa: F401  (their SQL)
from quayside.plans.registry import ORACLES
from quayside.plans.registry import register
from quayside.plans.tables import TABLE_ATTRS, TABLE_COLUMNS, StoredTables, Tables, published
from quayside.session import scratch_path
from quayside.sources import ais_csv
from quayside.streaming import maintain

LATE_DAYS = ("2024-01-09", "2024-01-20")      # days with a file that comes with the second half


def _as_text(table: str) -> str:
    """Oracle rows of a published table as text, columns in order."""
    src, cols = o.PUBLISHED[table]
    cols = cols.format(date=f"{o.iso_date('date')} AS date", first=f"{o.iso_ts('first_seen')} AS first_seen",
                       last=f"{o.iso_ts('last_seen')} AS last_seen")
    fields = ", ".join(f"coalesce(CAST(\"{c}\" AS VARCHAR), '-')" for c in TABLE_COLUMNS[table])
    return f"SELECT '{table}' AS \"table\", concat_ws('|', {fields}) AS content FROM (SELECT {cols} FROM {src}) x"


@reg("incremental_tables", " UNION ALL ".join(_as_text(t) for t in TABLE_ATTRS), [o.PUBLISHED[t][0] for t in TABLE_ATTRS])
def q_incremental_tables(spark, sf_dir):
    """The ten tables as the stream keeps them: the archive comes in two halves, the second with late files for days that were
    complete, and a third run finds nothing new. Every row of every table, as text."""
    raw = Tables(spark, sf_dir).raw.withColumn("period", F.concat(F.lit("aisdk-"), F.date_format("date", "yyyy-MM-dd")))
    src, root, ckpt = (scratch_path(spark, n) for n in ("maintain-src", "maintain", "maintain-ckpt"))
    half = F.col("date") <= F.lit("2024-01-15").cast("date")
    late = F.date_format("date", "yyyy-MM-dd").isin(*LATE_DAYS) & (F.hour("ts") >= 18)
    for part, rows in (("first", raw.where(half & ~late)), ("second", raw.where(~half | late))):
        ais_csv.write_raw_csv(rows, f"{src}/{part}", "period")
        maintain.run_maintenance(spark, f"{src}/*/*/*.csv", root, ckpt)
    maintain.run_maintenance(spark, f"{src}/*/*/*.csv", root, ckpt)
    out = None
    for table in TABLE_ATTRS:
        fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("-")) for c in TABLE_COLUMNS[table]]
        df = maintain.stored_table(spark, root, table).select(F.lit(table).alias("table"), F.concat_ws("|", *fields).alias("content"))
        out = df if out is None else out.unionByName(df)
    return out


def _stored_once(df, name: str):
    """A derived table, written and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@reg("vessel_sketch_rollup", f"""
SELECT port, level, since, vessels, true AS near FROM (
  SELECT port, 'day' AS level, {o.iso_date('date')} AS since, count(DISTINCT mmsi) AS vessels FROM pings WHERE ts IS NOT NULL GROUP BY port, date
  UNION ALL
  SELECT port, 'week', {o.iso_date("date_trunc('week', date)")}, count(DISTINCT mmsi) FROM pings WHERE ts IS NOT NULL GROUP BY port, date_trunc('week', date)
  UNION ALL
  SELECT 'all ports', 'month', {o.iso_date("date_trunc('month', date)")}, count(DISTINCT mmsi) FROM pings WHERE ts IS NOT NULL GROUP BY date_trunc('month', date))
""", ["pings"])
def q_vessel_sketch_rollup(spark, sf_dir):
    """Distinct vessels per port-day, port-week and month of all ports, from stored hourly sketches; beside each the exact
    count, and whether the estimate is within 3 % (four standard errors) of it."""
    pings = Tables(spark, sf_dir).pings
    stored = _stored_once(sketches.vessel_sketches(pings), "vessel-sketches")
    day, week, month = (F.date_format(F.date_trunc(u, "date"), "yyyy-MM-dd") for u in ("day", "week", "month"))
    out = None
    for level, port, since in (("day", F.col("port"), day), ("week", F.col("port"), week), ("month", F.lit("all ports"), month)):
        key = [port.alias("port"), F.lit(level).alias("level"), since.alias("since")]
        # a vessel is counted once per key by grouping on both, then on the key: no task holds all vessels of a key
        exact = pings.where("ts IS NOT NULL").select(*key, "mmsi").groupBy("port", "level", "since", "mmsi").agg(F.lit(1).alias("_"))
        exact = exact.groupBy("port", "level", "since").agg(F.count(F.lit(1)).alias("vessels"))
        guess = sketches.distinct_vessels(stored, *key).withColumnRenamed("vessels", "guess")
        both = (exact.join(guess, ["port", "level", "since"], "left")
                .select("port", "level", "since", "vessels", F.expr("coalesce(abs(guess - vessels) <= 0.03 * vessels, false)").alias("near")))
        out = both if out is None else out.unionByName(both)
    return out


_QUANTILES = {"p025": 0.025, "median": 0.5, "p95": 0.95, "p975": 0.975}


def _speed_sql(keys: dict[str, str], level: str) -> str:
    """Speeds of one level: rounded mean, share of standing pings and quantiles, from the pings themselves."""
    qs = ", ".join(f"{o.round_even(f'quantile_cont(v, {q})', 2)} AS {name}" for name, q in _QUANTILES.items())
    return (f"SELECT '{level}' AS level, {', '.join(f'{v} AS {k}' for k, v in keys.items())}, count(*) AS n, {o.round_even('avg(v)', 2)} AS mean, "
            f"{o.round_even('avg(CASE WHEN sog < 0.5e0 THEN 1e0 ELSE 0e0 END) * 100e0', 1)} AS pct_stationary, {qs} "
            f"FROM (SELECT *, CAST(sog AS DOUBLE) AS v FROM pings_t WHERE sog < 102.3e0 AND hour IS NOT NULL) s GROUP BY {', '.join(keys.values())}")


@reg("speed_count_rollup", " UNION ALL ".join([
    _speed_sql({"port": "port", "since": o.iso_date("date"), "hour": "hour"}, "hour"),
    _speed_sql({"port": "port", "since": o.iso_date("date"), "hour": "NULL::INTEGER"}, "day"),
    _speed_sql({"port": "port", "since": o.iso_date("date_trunc('month', date)"), "hour": "NULL::INTEGER"}, "month")]), ["pings_t"])
def q_speed_count_rollup(spark, sf_dir):
    """Mean, standing share and quantiles of speeds per port-hour, port-day and port-month, all from stored counts of speeds."""
    stored = _stored_once(sketches.speed_counts(Tables(spark, sf_dir).pings), "speed-counts")
    out = None
    for level, unit in (("hour", "day"), ("day", "day"), ("month", "month")):
        rows = stored.select("port", F.date_format(F.date_trunc(unit, "date"), "yyyy-MM-dd").alias("since"),
                             (F.col("hour") if level == "hour" else F.lit(None).cast("int")).alias("hour"), "speed", "n")
        s = sketches.speed_summary(rows, ["port", "since", "hour"], _QUANTILES)
        s = s.select(F.lit(level).alias("level"), "port", "since", "hour", "n", numeric.round_even(F.col("mean"), 2).alias("mean"),
                     numeric.round_even(F.col("share_below") * F.lit(100.0), 1).alias("pct_stationary"),
                     *[numeric.round_even(F.col(q), 2).alias(q) for q in _QUANTILES])
        out = s if out is None else out.unionByName(s)
    return out


def _store(spark, sf_dir) -> StoredTables:
    """The ten tables of the data, written by day, to be read from there."""
    root = scratch_path(spark, "stored")
    maintain.write_tables(Tables(spark, sf_dir).materialized(), root)
    return StoredTables(spark, root)


def _same_sql(name: str):
    """A query on stored tables has the rows of the one that starts from pings, and so its SQL."""
    return register(f"stored_{name}", ORACLES[name])


@_same_sql("port_summary")
def q_stored_port_summary(spark, sf_dir):
    """The port summary from stored tables: no ping is read."""
    return kpis.port_summary_df(_store(spark, sf_dir))


@_same_sql("constraint_check")
def q_stored_constraint_check(spark, sf_dir):
    """Keys and rules checked on the stored tables, one pass over each."""
    t = _store(spark, sf_dir)
    return quality.constraint_check({tb: published(t.table(tb), tb) for tb in TABLE_ATTRS})


@_same_sql("congestion_heatmap")
def q_stored_congestion_heatmap(spark, sf_dir):
    """The weekday-hour heatmap from the stored hourly table."""
    return kpis.congestion_heatmap(_store(spark, sf_dir))
