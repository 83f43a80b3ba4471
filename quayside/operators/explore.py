"""Exploration aggregates: message profiles, frequency tables, histograms, samples, pivots."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside import config
from quayside.functions import numeric, timeparts


def hourly_messages(pings: DataFrame) -> DataFrame:
    return pings.groupBy(F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("messages")) \
                .where(F.col("hour").isNotNull())


def type_frequency(pings: DataFrame, top: int = config.TYPE_FREQUENCY_TOP) -> DataFrame:
    """The ``top`` most frequent raw ship types (nulls not counted; name breaks ties)."""
    return (pings.where(F.col("ship_type").isNotNull()).groupBy("ship_type")
            .agg(F.count(F.lit(1)).alias("messages"))
            .orderBy(F.col("messages").desc(), F.col("ship_type")).limit(top))


def lump_top_n(pings: DataFrame, n: int = config.LUMP_TOP_N) -> DataFrame:
    """Keep the n most frequent raw types, lump the rest (and nulls) into "Other".

    The top-n list is an aggregate of at most n rows -- a proven size bound -- so it is
    broadcast into a left join with the pings."""
    top = type_frequency(pings, n).select("ship_type", F.lit(True).alias("is_top"))
    labelled = pings.join(F.broadcast(top), "ship_type", "left").withColumn(
        "ship_type_label", F.when(F.col("is_top"), F.col("ship_type")).otherwise(F.lit(config.OTHER_TYPE)))
    return labelled.groupBy("ship_type_label").agg(F.count(F.lit(1)).alias("pings"))


def port_overview(pings: DataFrame) -> DataFrame:
    return pings.groupBy("port").agg(F.count(F.lit(1)).alias("pings"),
                                     F.count_distinct("mmsi").alias("unique_vessels"))


def daily_distinct_vessels(pings: DataFrame) -> DataFrame:
    """True distinct vessels per port-day (not the sum of hourly counts)."""
    return (pings.groupBy("port", "date").agg(F.count_distinct("mmsi").alias("vessel_count"))
            .select("port", timeparts.iso_date(F.col("date")).alias("date"), "vessel_count"))


# ---------------------------------------------------------------------------
# Histograms with NumPy's binning rule (equal bins over [min, max], last bin closed)
# ---------------------------------------------------------------------------
def _edge(i: Column, mn: Column, mx: Column, bins: int) -> Column:
    """Edge i of ``linspace(mn, mx, bins + 1)``: ``i * step + mn``, the last edge exactly mx."""
    step = (mx - mn) / F.lit(float(bins))
    return F.when(i == bins, mx).otherwise(i.cast("double") * step + mn)


def _bin_index(x: Column, mn: Column, mx: Column, bins: int) -> Column:
    """NumPy's histogram bin: an estimate from the scaled value, then corrected against
    the exact edges so ``edge[i] <= x < edge[i+1]`` (the last bin includes the maximum)."""
    est = ((x - mn) / (mx - mn) * F.lit(float(bins))).cast("int")
    est = F.when(est >= bins, F.lit(bins - 1)).otherwise(est)
    lower = F.when(x < _edge(est, mn, mx, bins), est - 1)
    upper = F.when((x >= _edge(est + 1, mn, mx, bins)) & (est != bins - 1), est + 1)
    return F.coalesce(lower, upper, est)


def _histogram(counted: DataFrame, keys: list[str], bins: int, n: str, median: str) -> DataFrame:
    """Histogram per ``keys`` of values that are already counted (keys, x, n): bins over the range of the group, empty
    ones included, and the median. Range, median and bins come from the same counted values, so the source is read once;
    windows hold one group's distinct values."""
    group = Window.partitionBy(*keys) if keys else Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lo, hi = F.min("x").over(group), F.max("x").over(group)
    wide = F.when(lo == hi, F.lit(0.5)).otherwise(F.lit(0.0))    # NumPy widens a zero-width range
    running = (Window.partitionBy(*keys) if keys else Window).orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.select(*keys, "x", "n", (lo - wide).alias("mn"), (hi + wide).alias("mx"),
                            F.sum("n").over(running).alias("upto"), F.sum("n").over(group).alias("all"))
    middle = lambda cond: F.min(F.expr(f"IF({cond}, x, NULL)")).over(group)
    ranged = ranked.select(*keys, "x", "n", "mn", "mx",
                           (F.lit(0.5) * middle("2 * upto >= all") + F.lit(0.5) * middle("2 * upto > all")).alias(median))
    binned = (ranged.withColumn("bin", _bin_index(F.col("x"), F.col("mn"), F.col("mx"), bins))
              .groupBy(*keys, "mn", "mx", median, "bin").agg(F.sum("n").alias("n")))
    # one row per group with its counts by bin: dense without a second branch of the plan
    dense = (binned.groupBy(*keys, "mn", "mx", median).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("by_bin"))
             .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))))
    return dense.select(*keys, "bin", _edge(F.col("bin"), F.col("mn"), F.col("mx"), bins).alias("bin_lo"),
                        _edge(F.col("bin") + 1, F.col("mn"), F.col("mx"), bins).alias("bin_hi"),
                        F.coalesce(F.try_element_at("by_bin", "bin"), F.lit(0)).alias(n), median)


def speed_histogram(raw: DataFrame, bins: int = config.SPEED_HIST_BINS) -> DataFrame:
    """SOG histogram of the coverage pings with 0 <= SOG <= 30 kn over the data's range (no rows without data).

    Speeds come in steps of 0.1 kn, so there are about 300 distinct ones however many pings there are.
    """
    lo_cap, hi_cap = config.SPEED_HIST_RANGE
    sog = raw.select(F.col("sog").cast("double").alias("x")).where(F.col("x").between(lo_cap, hi_cap))
    return _histogram(sog.groupBy("x").agg(F.count(F.lit(1)).alias("n")), [], bins, "messages", "median_sog")


def dwell_histogram(visit_rows: DataFrame, bins: int = config.DWELL_HIST_BINS) -> DataFrame:
    """Per port: histogram of visit dwell in hours (0 < h <= 24), bins over that port's range, plus the port's median.

    Dwell is in whole seconds, so a port has at most 86,400 distinct values however many visits it has.
    """
    h = visit_rows.select(
        "port", (timeparts.seconds_between(F.col("first_seen"), F.col("last_seen")) / F.lit(3600.0)).alias("x")
    ).where((F.col("x") > 0) & (F.col("x") <= config.DWELL_HIST_MAX_HOURS))
    return _histogram(h.groupBy("port", "x").agg(F.count(F.lit(1)).alias("n")), ["port"], bins, "visits", "median_hours")


def sample_per_port(pings: DataFrame, n: int = config.SAMPLE_PER_PORT, seed: int = config.SAMPLE_SEED,
                    salt_buckets: int = 64) -> DataFrame:
    """Exactly min(n, size) pings per port, chosen by a seeded hash (reproducible).

    A plain row_number over ``partition by port`` would sort a whole port -- a third of
    all rows for a hot port -- in one task. Instead: (1) within each (port, salt) group
    keep the n smallest hashes, (2) among those <= n * salt_buckets candidates per port
    keep the n smallest. The result is identical to the global top-n by hash."""
    h = pings.withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("event_id").cast("string"))))
    h = h.withColumn("_salt", F.pmod(F.xxhash64("_h"), F.lit(salt_buckets)))
    w1 = Window.partitionBy("port", "_salt").orderBy("_h", "event_id")
    cand = h.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= n).drop("_r")
    w2 = Window.partitionBy("port").orderBy("_h", "event_id")
    return cand.withColumn("_r", F.row_number().over(w2)).where(F.col("_r") <= n).drop("_r", "_h", "_salt")


def heatmap_pivot(pings: DataFrame) -> DataFrame:
    """Mean true-distinct vessels per hour, pivoted weekday (rows 0..6, Monday=0, every
    weekday present even without data) x hour (columns h00..h23) per port."""
    hourly = (pings.where(F.col("ts").isNotNull())
              .groupBy("port", "date", F.hour("ts").alias("hour"))
              .agg(F.count_distinct("mmsi").alias("n"))
              .withColumn("dow", timeparts.dow_monday0(F.col("date"))))
    mean = hourly.groupBy("port", "dow", "hour").agg(numeric.exact_avg(F.col("n")).alias("v"))
    wide = mean.groupBy("port", "dow").pivot("hour", list(range(24))).agg(F.first("v"))
    wide = wide.select("port", "dow", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])
    grid = (mean.select("port").distinct()
            .select("port", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("dow")))
    return grid.join(wide, ["port", "dow"], "left")
