"""Period calendar (S12), status manifest (S13) and size reduction.

The manifest is a relational rebuild of the reference's status file: the source
calendar left-joined with the artefacts observed on storage (sizes from ``binaryFile``
listings, file contents never read) and with the previous manifest, whose True flags are
sticky. Nothing is rewritten in place; each run produces a new manifest table.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import config
from quayside.sources.filtered import size_reduction


def period_calendar(spark: SparkSession) -> DataFrame:
    """Monthly archives then daily archives, with the archive URL of each period."""
    def seq(a, b, step):
        return spark.range(1).select(F.explode(F.sequence(F.lit(a), F.lit(b), F.expr(f"INTERVAL 1 {step}")))
                                     .alias("d"))
    base = config.SOURCE_BASE_URL
    months = seq(config.MONTHLY_START, config.MONTHLY_END, "MONTH").select(
        F.date_format("d", "yyyy-MM").alias("period"), F.lit("monthly").alias("kind"), "d")
    days = seq(config.DAILY_START, config.DAILY_END, "DAY").select(
        F.date_format("d", "yyyy-MM-dd").alias("period"), F.lit("daily").alias("kind"), "d")
    cal = months.unionByName(days)
    year = F.date_format("d", "yyyy")
    flat = (F.col("kind") == "daily") & (F.col("d") >= F.lit(config.FLAT_ROOT_FROM))
    url = F.when(flat, F.concat(F.lit(base + "/aisdk-"), F.col("period"), F.lit(".zip"))) \
           .otherwise(F.concat(F.lit(base + "/"), year, F.lit("/aisdk-"), F.col("period"), F.lit(".zip")))
    return cal.select("period", "kind", F.col("d").alias("period_start"), url.alias("url"))


def file_sizes(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(path, length) of every file under ``root``; the content column is pruned."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
            .load(root).select("path", "length"))


def observed_raw(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Bytes of the unpacked files of each period."""
    f = file_sizes(spark, root, glob)
    return (f.withColumn("period", F.regexp_extract("path", r"aisdk-(\d{4}-\d{2}(?:-\d{2})?)", 1))
            .groupBy("period").agg(F.sum("length").alias("unzipped_size")))


def observed_archives(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    """Periods whose downloaded archive is there."""
    return file_sizes(spark, root, glob).select(F.regexp_extract("path", r"aisdk-(\d{4}-\d{2}(?:-\d{2})?)", 1).alias("period")).distinct()


def observed_by_date(spark: SparkSession, root: str, name: str, glob: str = "*.parquet") -> DataFrame:
    """Bytes per day and per month of a folder partitioned by date."""
    f = file_sizes(spark, root, glob).withColumn("day", F.regexp_extract("path", r"date=(\d{4}-\d{2}-\d{2})", 1))
    days = f.groupBy(F.col("day").alias("period")).agg(F.sum("length").alias(name))
    months = f.groupBy(F.substring("day", 1, 7).alias("period")).agg(F.sum("length").alias(name))
    return days.unionByName(months)


def period_manifest(calendar: DataFrame, raw_sizes: DataFrame, filtered_sizes: DataFrame,
                    subset_sizes: DataFrame, previous: DataFrame | None = None,
                    archives: DataFrame | None = None) -> DataFrame:
    """One row per calendar period with sticky flags and sizes (fresh size preferred, 0
    counts as missing). Reductions are of the sizes shown, fresh or previous. ``archives``
    (period) are the downloaded archives that are still there: with one, a period is raw."""
    zipped = calendar.select("period").limit(0) if archives is None else archives.select("period").distinct()
    calendar = calendar.join(zipped.withColumn("zipped", F.lit(True)), "period", "left")
    m = (calendar.join(raw_sizes, "period", "left").join(filtered_sizes, "period", "left")
         .join(subset_sizes, "period", "left"))
    if previous is not None:
        prev = previous.select("period", *[F.col(c).alias(f"prev_{c}") for c in previous.columns if c != "period"])
        m = m.join(prev, "period", "left")
    else:
        for c, t in [("raw", "boolean"), ("unzipped", "boolean"), ("filtered", "boolean"), ("unzipped_size", "long"),
                     ("filtered_size", "long"), ("filtered_compression", "double"), ("filtered_aarhus_size", "long"),
                     ("filtered_aarhus_compression", "double")]:
            m = m.withColumn(f"prev_{c}", F.lit(None).cast(t))

    def fresh_or_prev(fresh, prev):
        return F.coalesce(F.nullif(fresh, F.lit(0)), F.nullif(prev, F.lit(0)))

    unzipped = F.col("unzipped_size").isNotNull() | F.coalesce(F.col("prev_unzipped"), F.lit(False))
    raw = unzipped | F.coalesce(F.col("zipped"), F.lit(False)) | F.coalesce(F.col("prev_raw"), F.lit(False))
    filtered = F.col("filtered_size").isNotNull() | F.coalesce(F.col("prev_filtered"), F.lit(False))
    size = fresh_or_prev(F.col("unzipped_size"), F.col("prev_unzipped_size"))
    fsize = fresh_or_prev(F.col("filtered_size"), F.col("prev_filtered_size"))
    asize = fresh_or_prev(F.col("filtered_aarhus_size"), F.col("prev_filtered_aarhus_size"))
    fcomp, acomp = size_reduction(fsize, size), size_reduction(asize, fsize)
    return m.select(
        "period", raw.alias("raw"), unzipped.alias("unzipped"), size.cast("long").alias("unzipped_size"),
        filtered.alias("filtered"), fsize.cast("long").alias("filtered_size"),
        F.coalesce(F.nullif(fcomp, F.lit(0.0)), F.col("prev_filtered_compression")).alias("filtered_compression"),
        asize.cast("long").alias("filtered_aarhus_size"),
        F.coalesce(F.nullif(acomp, F.lit(0.0)), F.col("prev_filtered_aarhus_compression"))
         .alias("filtered_aarhus_compression"))
