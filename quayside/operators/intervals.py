"""Joins of a vessel's points with a table of instants: where was it then (as-of), and which way did it come (trails).

Both take requests as a table of any size, (request, vessel, instant), and spread one vessel's points over many tasks by
cutting time into blocks or bins: a vessel that holds a third of all points, or of all requests, is not one group.
Points and requests are given on a shared clock, ``t`` and ``at``: any integer, such as seconds.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import ensure_checkpoint_dir

DAY = 86_400


def asof(points: DataFrame, requests: DataFrame, key: str = "mmsi", order: str = "event_id", block: int = DAY) -> DataFrame:
    """Per request, the newest point of its vessel at or before its instant: the request's columns and ``point`` (null if none).

    ``points`` has the key, ``t``, ``order`` (which of equal times is newest) and any more columns; ``requests`` the key, ``at``
    and any more. ``point`` is a struct of all columns of ``points`` but the key.

    Two levels. Within a block of time, points and requests are sorted together and the last point is carried along. What is
    left of a block is one row, its last point; these are carried over a vessel's blocks, and reach the requests that had no
    earlier point in their own. Points are read once: what is kept of them, a row per vessel and block, is checkpointed with
    the requests.
    """
    ensure_checkpoint_dir(points.sparkSession)
    columns = [c for c in points.columns if c != key]
    asked = F.struct(*[F.col(f"`{c}`") for c in requests.columns])
    point = F.struct(F.col("t"), F.col(f"`{order}`"), *[F.col(f"`{c}`") for c in columns if c not in ("t", order)])
    rows = (points.select(F.col(key).alias("_key"), F.col("t").alias("_t"), F.col(order).alias("_o"), point.alias("_point"))
            .unionByName(requests.select(F.col(key).alias("_key"), F.col("at").alias("_t"), asked.alias("_asked")), allowMissingColumns=True)
            .withColumn("_block", F.expr(f"floor(_t / {block})")))
    inner = Window.partitionBy("_key", "_block").orderBy(F.asc("_t"), F.col("_asked").isNotNull(), "_o")
    met = (rows.withColumn("_last", F.last("_point", ignorenulls=True).over(inner))
           .withColumn("_end", F.lead("_key").over(inner).isNull())
           .where("_asked IS NOT NULL OR _end").select("_key", "_block", "_asked", "_last", "_end")
           .checkpoint(eager=True))
    over = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (met.where("_end").select("_key", "_block", F.last("_last", ignorenulls=True).over(over).alias("_before"))
               .where("_before IS NOT NULL"))
    known = met.where("_asked IS NOT NULL AND _last IS NOT NULL").select("_asked", "_last")
    late = (met.where("_asked IS NOT NULL AND _last IS NULL").join(carried, ["_key", "_block"], "left")
            .select("_asked", F.col("_before").alias("_last")))
    return known.unionByName(late).select("_asked.*", F.col("_last").alias("point"))


def within(points: DataFrame, requests: DataFrame, key: str = "mmsi", width: int = DAY // 4) -> DataFrame:
    """Pairs of a request and a point of its vessel in [at - length, at]: the columns of both, the key once.

    ``requests`` has the key, ``at`` and ``length`` (null: without limit); ``points`` the key and ``t``; other names differ.
    Time is cut into bins of ``width``. A request is dealt to the bins that its interval touches, a point to its own, and they
    meet on (vessel, bin), so no pair is formed that is more than a bin apart from the interval. A request without limit
    meets all points of its vessel: up to its instant, all of them are its result.
    """
    binned = points.withColumn("_bin", F.expr(f"floor(t / {width})"))
    limited = (requests.where("length IS NOT NULL AND length >= 0")
               .withColumn("_bin", F.explode(F.expr(f"sequence(floor((at - length) / {width}), floor(at / {width}))"))))
    near = limited.join(binned, [key, "_bin"]).where("t <= at AND t >= at - length").drop("_bin")
    far = requests.where("length IS NULL").join(points, key).where("t <= at")
    return near.unionByName(far)


def trails(points: DataFrame, requests: DataFrame, key: str = "mmsi", order: str = "event_id", width: int = DAY // 4, block: int = DAY) -> DataFrame:
    """Per request, its vessel's points in [at - length, at] and its newest point at or before ``at``: the columns of both and ``is_latest``.

    ``requests`` also has ``request``, which names each row. The newest point is there even where it is older than the trail.
    """
    names = [c for c in points.columns if c != key]
    latest = asof(points, requests, key, order, block).where("point IS NOT NULL")
    newest = latest.select("request", F.col("point.t").alias("_t"), F.col(f"point.{order}").alias("_o"))
    inside = (within(points, requests, key, width).join(newest, "request")
              .withColumn("is_latest", F.expr(f"t = _t AND `{order}` = _o")).drop("_t", "_o"))
    outside = (latest.where("length IS NOT NULL AND (length < 0 OR point.t < at - length)")
               .select(*[F.col(f"`{c}`") for c in requests.columns], *[F.col(f"point.`{c}`") for c in names], F.lit(True).alias("is_latest")))
    return inside.unionByName(outside)
