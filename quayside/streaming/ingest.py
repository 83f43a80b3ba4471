"""Incremental ingest with Structured Streaming.

New raw archive files are picked up by a file-source stream of text lines, parsed by the
header of their file exactly as the batch scan does, box-filtered and labelled, and
appended to the date-partitioned filtered table. The checkpoint records which files were
committed, so a re-run processes only new files and adds zero rows for old ones --
file-level exactly-once in place of the reference's mutable status flags.
``trigger(availableNow=True)`` drains everything available (in bounded micro-batches) and
stops, so the same job serves scheduled batch runs. The job is stateless (no aggregation),
so no watermark or state store is involved; a lost executor only re-runs the current
micro-batch, whose output is not committed until the batch is.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import regions
from quayside.sources import ais_csv
from quayside.sources.filtered import FILTERED_COLUMNS


def layout_store(checkpoint_dir: str) -> str:
    """Where the layouts of known files are kept, beside the stream's checkpoint."""
    return checkpoint_dir.rstrip("/") + "-layouts"


def raw_stream(spark: SparkSession, src_glob: str, store: str, max_files: int = 64) -> DataFrame | None:
    """New files as pings; None if there are no files. Each line is parsed with the layout of its file, which is looked up by path
    in the catalogue at ``store``; a file that came after the catalogue was brought up to date fails its micro-batch, which the
    next run repeats with a new one."""
    files = ais_csv.catalogue(spark, src_glob, store)
    headers = sorted(r["header"] for r in files.select("header").distinct().collect())
    if not headers:
        return None
    lines = (spark.readStream.option("maxFilesPerTrigger", max_files).text(src_glob)
             .select("value", F.col("_metadata.file_path").alias("file"))).join(files, "file", "left")
    row = F.lit(None)
    for h in headers:
        row = F.when(F.col("header") == h, ais_csv.parsed(F.col("value"), h)).otherwise(row)
    known = F.when(F.col("header").isNull(), F.raise_error(F.concat(F.lit("no layout for "), F.col("file")))).otherwise(F.lit(True))
    rows = lines.where(known & (F.col("value") != F.col("header")) & (F.trim("value") != "")).select(row.alias("r"), "file")
    return ais_csv.as_pings(ais_csv.with_period(rows, "file").select("r.*", "period", "period_date"))


def filtered_stream(raw: DataFrame) -> DataFrame:
    return regions.filter_and_label(raw).select(*FILTERED_COLUMNS)


def run_ingest(spark: SparkSession, src_glob: str, out_dir: str, checkpoint_dir: str, max_files: int = 64) -> None:
    """Drain all new files once (availableNow) and wait for the stream to finish; nothing to do without files."""
    raw = raw_stream(spark, src_glob, layout_store(checkpoint_dir), max_files)
    if raw is None:
        return
    q = (filtered_stream(raw).writeStream
         .format("parquet").option("checkpointLocation", checkpoint_dir).partitionBy("date")
         .outputMode("append").trigger(availableNow=True).start(out_dir))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
