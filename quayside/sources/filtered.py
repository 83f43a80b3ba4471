"""Filtered-ping storage: the filter sink (S3), its scans (S4, S5) and per-port subsets.

Layout: Parquet partitioned by ``date`` (and ``port`` for the subset). Re-running a day
replaces only that day's partition (dynamic partition overwrite), which is the engine's
idempotent "already filtered" rule; readers get partition pruning on ``date`` and
``port`` and Parquet row-group pruning on the pushed lat/lon/port predicates.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.functions import vessel
from quayside.operators import regions
from quayside.sources import ais_csv

# All twelve archive columns (those a source lacks are null), the tie-breaking id, the label and the day.
FILTERED_COLUMNS = ["event_id", *ais_csv.ENGINE_NAMES, "port", "date"]


def write_filtered(raw: DataFrame, path: str) -> int:
    """Box filter + port label, written as one folder per day (S3). Only the days present are overwritten. Returns the rows written.

    They are counted by the write itself, behind the filter, so that this still reaches the scan.

    Rows are rebalanced by day: a day goes to few writers, and a day that holds a large part of all rows to as many as
    its size calls for, since adaptive execution may split what a rebalance deals out."""
    for name, typ in ais_csv.RAW_FIELDS.values():
        if name not in raw.columns:
            raw = raw.withColumn(name, F.lit(None).cast("timestamp_ntz" if typ == "timestamp" else typ))
    written = Observation()
    pings = regions.filter_and_label(raw).select(*FILTERED_COLUMNS).observe(written, F.count(F.lit(1)).alias("rows"))
    (pings.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "snappy").partitionBy("date").parquet(path))
    return written.get["rows"]


def filter_archive(spark: SparkSession, csv_root: str, path: str) -> dict[str, int]:
    """The filter step from archive files to filtered days, and what became of their lines, counted while they are written:
    ``read``, ``too_long`` (more fields than the header), ``no_mmsi``, ``outside`` (of all boxes) and ``written``."""
    seen = Observation()
    bad, nameless = F.col(ais_csv.TOO_LONG), F.col("mmsi").isNull()
    rows = ais_csv.scan_periods(spark, csv_root).observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if(bad).alias("too_long"), F.count_if(~bad & nameless).alias("no_mmsi"))
    written = write_filtered(ais_csv.as_pings(rows), path)
    n = seen.get
    return n | {"outside": n["read"] - n["too_long"] - n["no_mmsi"] - written, "written": written}


def read_filtered(spark: SparkSession, path: str) -> DataFrame:
    """All filtered days (S4); ``date`` comes from the partition folder."""
    return spark.read.parquet(path)


def read_core(spark: SparkSession, path: str, port: str = "aarhus") -> DataFrame:
    """Projected, port-filtered scan (S5): nine columns, one port, Class A/B, valid time."""
    cols = ["event_id", "ts", "mmsi", "latitude", "longitude", "sog", "ship_type", "name", "mobile_type", "port",
            "date"]
    return (read_filtered(spark, path).select(*cols)
            .where((F.col("port") == port) & vessel.is_real_vessel(F.col("mobile_type")) & F.col("ts").isNotNull()))


def write_port_subset(filtered: DataFrame, path: str, ports: list[str] | None = None) -> None:
    """Per-port copies partitioned by (port, date) (S6): reading one port is partition
    pruning instead of a scan of every port's rows."""
    df = filtered if ports is None else filtered.where(F.col("port").isin(*ports))
    (df.hint("rebalance", "port", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("port", "date").parquet(path))


def read_port_subset(spark: SparkSession, path: str, port: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("port") == port)


def size_reduction(out_bytes, in_bytes):
    """Size reduction % = round((1 - out/in) * 100, 1); null when the input size is 0/absent."""
    ratio = out_bytes.cast("double") / F.nullif(in_bytes.cast("double"), F.lit(0.0))
    return F.rint((F.lit(1.0) - ratio) * F.lit(1000.0)) / F.lit(10.0)
