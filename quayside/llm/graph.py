"""Connected components of a link table, for near-duplicate classes."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import cut


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"]


def components(links: DataFrame) -> DataFrame:
    """Stars ``(u, v)``: each linked node u with the smallest node v that it reaches, where that is not u itself.

    ``links`` has integer columns u and v; direction, repeats and loops don't matter. Large-star and small-star
    steps alternate: every node tells its larger neighbours (then: its smaller ones) the least of its neighbourhood.
    The table never gets more rows than it has links; rounds grow with the logarithm of the longest path. Nodes with
    very many links are aggregated before the shuffle, and joins on them are split by adaptive execution. Each round
    is checkpointed, so a lost executor never costs more than one round.
    """
    e = cut(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct())
    before = _signature(e)
    while before[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least).distinct())
        e = cut(small)
        if (now := _signature(e)) == before:
            break
        before = now
    return e
