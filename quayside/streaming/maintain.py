"""Fact tables kept up to date by the ingest stream (S7 + S11).

Each micro-batch of new archive files adds its filtered pings to the stored ones and brings the ten tables up to date by
rewriting only what the batch can have changed:

* the days that got pings, in all tables that describe a day by itself;
* in the daily flow, these days and the days before and after them, since a vessel that is present on a day makes its
  neighbours' arrivals and departures. They are computed from the stored visits of one more day on each side.

All of it is stored by day (``date=...`` folders), and a rewrite replaces whole days. Pings are stored by day and batch, so a
micro-batch that is repeated after a failure replaces what its first attempt wrote, and the tables follow from the stored
pings: a batch may be repeated, and files of an earlier day may come late, any number of times. Days that no new file
touches are neither read nor written. What reaches the driver is the list of days of one batch.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import facts
from quayside.plans.tables import TABLE_ATTRS, TABLE_COLUMNS, Tables, published
from quayside.sources import ais_csv
from quayside.sources.filtered import FILTERED_COLUMNS
from quayside.streaming import ingest

PINGS, FLOW = "pings", "port_daily_flow"
_TYPES = {name: ("timestamp_ntz" if typ == "timestamp" else typ) for name, typ in ais_csv.RAW_FIELDS.values()}
_PING_SCHEMA = ", ".join(f"{c} {({'event_id': 'bigint', 'port': 'string', 'date': 'date'} | _TYPES)[c]}" for c in FILTERED_COLUMNS) + ", batch bigint"


def stored_pings(spark: SparkSession, root: str) -> DataFrame:
    """All filtered pings taken in so far, with the batch that brought them."""
    return spark.read.schema(_PING_SCHEMA).parquet(f"{root.rstrip('/')}/{PINGS}")


def stored_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A maintained table in its published form; a condition on ``date`` prunes folders."""
    df = spark.read.parquet(f"{root.rstrip('/')}/{table}")
    return df.withColumn("date", F.col("date").cast("string")).select(*TABLE_COLUMNS[table])


def _replace(df: DataFrame, path: str, *by: str) -> None:
    """Write by day (and more); of what is there, only the folders that ``df`` has rows for are replaced."""
    (df.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date", *by).parquet(path))


def write_tables(t: Tables, root: str) -> None:
    """All ten tables of a data set, stored by day as the stream stores them."""
    for table in TABLE_ATTRS:
        _replace(published(t.table(table), table), f"{root.rstrip('/')}/{table}")


def _around(days: list[dt.date], reach: int) -> list[dt.date]:
    """The given days and those up to ``reach`` days before and after."""
    return sorted({d + dt.timedelta(k) for d in days for k in range(-reach, reach + 1)})


def rewrite_days(spark: SparkSession, root: str, days: list[dt.date]) -> None:
    """Bring all tables up to date for pings of the given days."""
    root = root.rstrip("/")
    t = Tables(spark, pings=stored_pings(spark, root).where(F.col("date").isin(days)).drop("batch"))
    for table in TABLE_ATTRS:
        if table != FLOW:
            _replace(published(t.table(table), table), f"{root}/{table}")
    changed = _around(days, 1)
    visits = spark.read.parquet(f"{root}/vessel_visits").where(F.col("date").isin(_around(changed, 1)))
    flow = facts.daily_flow(visits, "port").where(F.col("date").isin(changed))
    _replace(published(flow, FLOW), f"{root}/{FLOW}")


def apply_batch(root: str, pings: DataFrame, batch: int) -> list[dt.date]:
    """Store one micro-batch of filtered pings and rewrite what it changes; the days it has pings of."""
    spark = pings.sparkSession
    _replace(pings.select(*FILTERED_COLUMNS, F.lit(batch).cast("long").alias("batch")), f"{root.rstrip('/')}/{PINGS}", "batch")
    found = stored_pings(spark, root).where(F.col("batch") == batch).select("date").distinct().collect()
    days = sorted(r["date"] for r in found if r["date"] is not None)
    if days:
        rewrite_days(spark, root, days)
    return days


def run_maintenance(spark: SparkSession, src_glob: str, root: str, checkpoint_dir: str, max_files: int = 64) -> None:
    """Take in all new files under ``src_glob`` and bring the tables under ``root`` up to date; without new files, nothing is written."""
    raw = ingest.raw_stream(spark, src_glob, ingest.layout_store(checkpoint_dir), max_files)
    if raw is None:
        return
    q = (ingest.filtered_stream(raw).writeStream.foreachBatch(lambda df, batch: apply_batch(root, df, batch) and None)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
