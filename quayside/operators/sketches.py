"""Aggregates that are stored once per region-hour and merge: distinct vessels by sketch, speeds by counted values.

A stored table of them answers any later roll-up (days, weeks, sets of ports) from its own rows, without the pings.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions import vessel

#: log2 of the sketch's registers: a standard error of some 1.04 / sqrt(2^k), or 0.8 %, in at most 16 KB a cell.
SKETCH_BITS = 14


def vessel_sketches(pings: DataFrame, region: str = "port") -> DataFrame:
    """region, date, hour and ``vessels``: a sketch of the distinct vessels, in which a vessel counts once however it is merged."""
    return (pings.where("ts IS NOT NULL").groupBy(region, "date", F.hour("ts").alias("hour"))
            .agg(F.hll_sketch_agg("mmsi", F.lit(SKETCH_BITS)).alias("vessels")))


def distinct_vessels(sketches: DataFrame, *by) -> DataFrame:
    """Estimated distinct vessels of stored sketches, merged by any columns or expressions."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("vessels")).alias("vessels"))


def speed_counts(pings: DataFrame, region: str = "port", *more: str) -> DataFrame:
    """region, date, hour (and more keys), ``speed`` and ``n``: how often each valid speed occurs.

    Speeds are reported to 0.1 kn, so a key has at most some thousand rows, however many pings it has.
    """
    valid = pings.where(vessel.valid_speed(F.col("sog")) & F.col("ts").isNotNull())
    return (valid.groupBy(region, "date", F.hour("ts").alias("hour"), *more, F.col("sog").cast("double").alias("speed"))
            .agg(F.count(F.lit(1)).alias("n")))


def speed_summary(counts: DataFrame, keys: list, quantiles: dict[str, float], below: float = 0.5) -> DataFrame:
    """Per key: ``n``, ``mean``, ``share_below`` (the speeds under ``below``) and the named quantiles, linearly interpolated.

    ``counts`` has speed and n, at any finer level than ``keys``: counts of equal speeds are added up first. A value stands at
    the ranks from the count of smaller ones on; a quantile lies between two ranks, each read off the running counts.
    """
    names = [k if isinstance(k, str) else f"_k{i}" for i, k in enumerate(keys)]
    named = [F.col(k) if isinstance(k, str) else k.alias(f"_k{i}") for i, k in enumerate(keys)]
    merged = counts.groupBy(*named, "speed").agg(F.sum("n").alias("n"))
    up = Window.partitionBy(*names).orderBy("speed")
    ranked = (merged.withColumn("upto", F.sum("n").over(up.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("next", F.lead("speed").over(up))
              .withColumn("all", F.sum("n").over(Window.partitionBy(*names))))
    aggs = []
    for name, q in quantiles.items():
        place = f"((all - 1) * {q!r}D)"
        low = f"floor({place})"
        # the value at rank floor(place), counted from 0, and the one after it, which is the next speed if this one ends there
        here = f"upto - n <= {low} AND {low} < upto"
        after = f"IF({low} + 1 < upto, speed, coalesce(next, speed))"
        aggs.append(F.max(F.expr(f"IF({here}, speed + ({after} - speed) * ({place} - {low}), NULL)")).alias(name))
    return (ranked.groupBy(*names)
            .agg(F.sum("n").alias("n"), (F.sum(F.expr("speed * n")) / F.sum("n")).alias("mean"),
                 (F.sum(F.expr(f"IF(speed < {below!r}D, n, 0)")) / F.sum("n")).alias("share_below"), *aggs))
