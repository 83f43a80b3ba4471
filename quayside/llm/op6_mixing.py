"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Sources by code point (null last) have weights that repeat, and share a budget by weight; no source gets more than a
number of epochs of its own size, and what it can't take is shared anew by weight (water filling, solved at once from
the sources in the order in which they fill up).

Each source's documents stand in shuffled order (by a keyed MD5 of the id, or of the text where it has none), once per epoch. A document's virtual
finish time is the cumulative size of its source up to it, over the source's target. All are served by finish time
until the budget is spent: the longest prefix of that global order whose sizes fit in.

Cumulative sums are made in two levels, so that a source with a third of all rows is spread like any other: blocks of
the shuffled order within each source, and blocks of finish time for the global order. Only the block in which the
budget runs out has to be sorted; its last document gives the cut-off, to which every document is compared.

Defined cases: a null or empty text has size 0 and takes nothing; rows with a null doc_id are
placed by their texts, so that any number of them spreads; equal places (repeated rows) are served together or not at all; a source without words has target 0;
an empty table gives an empty result. Reruns agree: all orders are total up to equal rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import WORD, cut, table
from quayside.llm.registry import register

#: Weights by place of the source, repeating; the budget, as a share of all sizes; the most epochs of a document.
WEIGHTS, BUDGET, EPOCHS = (5, 2, 1), 1.5, 2
#: Blocks of a source's shuffled order, and blocks of a unit of virtual time; they bound what one task sorts.
ORDER_BLOCKS, TIME_BLOCKS = 1024, 8192
SEED = "mix-1"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """Targets of sources: source, source_size, target, from one row per source (source, source_size).

    Let a source be full at the level r = epochs * size / weight. With the sources up to one in the order of r full,
    the level of the others is (budget - what these take) / (weights of the others); the first source that this
    level does not fill gives the level of all that stay below their limit.
    """
    rank = Window.orderBy(F.asc_nulls_last("source"))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = Window.orderBy("r", "place")
    s = (sizes.withColumn("place", F.row_number().over(rank) - 1)
         .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.expr(f"place % {len(weights)} + 1").cast("int")))
         .withColumn("limit", F.expr(f"{epochs} * source_size"))
         .withColumn("r", F.col("limit") / F.col("weight"))
         .withColumn("spent", F.coalesce(F.sum("limit").over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("others", F.sum("weight").over(full.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
         .withColumn("budget", F.lit(float(budget)) * F.sum("source_size").over(whole))
         .withColumn("level", (F.col("budget") - F.col("spent")) / F.col("others")))
    level = F.min_by("level", F.when(F.expr("level <= r"), F.struct("r", "place"))).over(whole)
    return (s.withColumn("level", level)
            .select("source", "source_size",
                    F.expr("IF(level IS NULL, double(limit), LEAST(double(limit), weight * level))").alias("target")))


def word_count(text_col: str) -> Column:
    """Size of a text in words; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long")


def place_key(id_col: str = "doc_id", text_col: str = "text", seed: str = SEED) -> Column:
    """The key of the shuffled order: of the id, or for rows without one, of the text."""
    text = F.concat(F.lit("null:"), F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(f"`{id_col}`").cast("string"), text)))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          seed: str = SEED) -> DataFrame:
    """doc_id, source, size in words, and the key of the shuffled order."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                       word_count(text_col).alias("size"), place_key(id_col, text_col, seed).alias("key"))


def mix(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """Each document with its part in the mix: doc_id, source, size, key, source_size, target, finish, copies, taken.

    ``sizes`` is as of ``sized``. ``finish`` is the virtual finish time of the first copy, ``copies`` how often the
    mix takes the document, ``taken`` its words times that. The later copies finish ``source_size / target`` apart.
    """
    d = cut(sizes.withColumn("block", F.expr(f"conv(substr(key, 1, 4), 16, 10) * {ORDER_BLOCKS} DIV 65536").cast("int")))
    blocks = d.groupBy("source", "block").agg(F.sum("size").alias("s"))
    goal = targets(blocks.groupBy("source").agg(F.sum("s").alias("source_size")), weights, budget, epochs)
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    b = blocks.withColumn("before", F.coalesce(F.sum("s").over(before), F.lit(0))).alias("b")
    b = (b.join(goal.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source")))
         .select("b.source", "b.block", "b.before", "g.source_size", "g.target").alias("b"))
    within = Window.partitionBy("source", "block").orderBy("key", "doc_id", "size")
    d = (d.alias("d").join(b, F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.block") == F.col("b.block")))
         .select("d.*", "b.before", "b.source_size", "b.target")
         .withColumn("cumulative", F.col("before") + F.sum("size").over(within)))
    times = [F.expr(f"(cumulative + {e} * source_size) / target") for e in range(epochs)]
    d = cut(d.select("doc_id", "source", "size", "key", "source_size", "target",
                     F.when(F.expr("size > 0"), F.array(*times)).alias("times")))
    served = (d.where("size > 0").select("size", "key", F.posexplode("times").alias("epoch", "finish"))
              .withColumn("slot", F.expr(f"bigint(LEAST(finish, 2.0D) * {TIME_BLOCKS})")))
    total = float(budget) * (d.agg(F.sum("size")).first()[0] or 0)
    slots = served.groupBy("slot").agg(F.sum("size").alias("s"))
    slots = slots.withColumn("before", F.coalesce(F.sum("s").over(
        Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    edge = slots.where(F.expr("before + s").cast("double") > F.lit(total)).orderBy("slot").first()
    if edge is None:  # all fits in
        taken = [F.expr("size > 0") for _ in times]
    else:
        order = Window.orderBy("finish", "key", "epoch")
        last = (served.where(F.col("slot") == edge["slot"])
                .withColumn("upto", F.sum("size").over(order) + F.lit(edge["before"]))
                .where(F.col("upto").cast("double") <= F.lit(total))
                .orderBy(F.desc("finish"), F.desc("key"), F.desc("epoch")).first())
        taken = []
        for e in range(epochs):
            finish = F.expr(f"times[{e}]")
            slot = F.expr(f"bigint(LEAST(times[{e}], 2.0D) * {TIME_BLOCKS})")
            fits = slot < F.lit(edge["slot"])
            if last is not None:
                fits |= (finish < F.lit(last["finish"])) | (
                    (finish == F.lit(last["finish"])) & ((F.col("key") < F.lit(last["key"]))
                                                         | ((F.col("key") == F.lit(last["key"])) & F.lit(e <= last["epoch"]))))
            taken.append(fits)
    copies = sum((F.when(t, 1).otherwise(0) for t in taken), F.lit(0))
    return (d.withColumn("copies", F.when(F.expr("size > 0"), copies).otherwise(0))
            .select("doc_id", "source", "size", "key", "source_size", "target", F.expr("times[0]").alias("finish"),
                    "copies", (F.col("size") * F.col("copies")).cast("long").alias("taken")))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')))) AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][place % 3 + 1] AS weight, 2 * source_size AS lim FROM s
), r AS (
  SELECT *, lim / weight AS r, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM w
), l AS (
  SELECT *, (budget - coalesce(sum(lim) OVER (ORDER BY r, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / (sum(weight) OVER (ORDER BY r, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM r
), lv AS (
  SELECT level AS lv FROM l WHERE level <= r ORDER BY r, place LIMIT 1
), t AS (
  SELECT source, source_size, budget, least(lim::DOUBLE, weight * lv) AS target FROM l, lv
), c AS (
  SELECT d.doc_id, d.size, d.key, t.source_size, t.target, t.budget,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size))::BIGINT AS cum
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), q AS (
  SELECT *, sum(size) OVER (ORDER BY finish, key, epoch) AS upto FROM (
    SELECT doc_id, size, key, epoch, budget, (cum + epoch * source_size)::DOUBLE / target AS finish
    FROM c, (VALUES (0), (1)) AS e(epoch) WHERE size > 0)
), k AS (
  SELECT doc_id, key, size, sum(size) AS taken FROM q WHERE upto <= budget GROUP BY doc_id, key, size
)
SELECT c.doc_id, c.size, c.source_size, c.target, coalesce(k.taken, 0)::BIGINT AS taken
FROM c LEFT JOIN k ON c.doc_id IS NOT DISTINCT FROM k.doc_id AND c.key = k.key AND c.size = k.size
"""


@register("op6_mixing", ORACLE)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: 150 % of all words, weights 5, 2, 1 by source, at most two copies each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(sized(docs)).select("doc_id", "size", "source_size", "target", "taken")
