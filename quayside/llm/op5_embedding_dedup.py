"""Embedding near-duplicates: a subspace pigeonhole join of rotated unit vectors.

Two unit vectors of cosine c are at squared distance 2 - 2c. A rotation keeps that and spreads it over all directions.
The rotated vectors are split into blocks of ``BLOCK`` dimensions; if each block of a pair differed by more than its
share of the allowed squared distance, in proportion to its dimensions, the pair would differ by more than all of it.
So every pair is found in at least one block, by a range join of that block alone: a vector is dealt to the grid cell
of its first ``GRID`` coordinates in the block, and as a query to each cell that its radius touches; in a cell, own
vectors and queries join where the block's squared distance is within its share. The union of what the blocks find is
verified with the whole vectors.

Equal vectors are one point of the join, however many rows have them; hot cells and hot links are left to the skew
handling of Spark's sort-merge joins, which hold no group in memory.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components, and vectors with a null
label, link with nothing; only vectors of equal label and length are compared; repeated rows are different vectors that
are linked; a null vec_id is no candidate for the smallest id of a component (null if there is no other); an empty table
gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import cut, table
from quayside.llm.graph import components
from quayside.llm.registry import register

#: Dimensions of a block, and how many of them the grid uses.
BLOCK, GRID = 8, 2
#: Room for rounding in squared distances; the verification is exact.
ROOM = 1e-9


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix, the same for every task."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


_POINT = T.StructType([T.StructField("key", T.StringType()), T.StructField("rotated", T.ArrayType(T.DoubleType()))])


@F.arrow_udf(_POINT)
def unit_rotated(vectors: pa.Array) -> pa.Array:
    """A key of the exact vector, and the rotated unit vector; null for vectors that link with nothing."""
    out, turns = [], {}
    for v in vectors:
        v = np.array(v.as_py() if v.is_valid else [], object)
        if not len(v) or any(x is None for x in v):
            out.append(None)
            continue
        v = v.astype(float) + 0.0  # -0.0 is 0.0
        if not np.isfinite(v).all() or not v.any():
            out.append(None)
            continue
        turn = turns.setdefault(len(v), None)
        if turn is None:
            turn = turns[len(v)] = rotation(len(v))
        unit = v / np.abs(v).max()
        unit /= np.sqrt(unit @ unit)
        out.append({"key": hashlib.md5(v.tobytes()).hexdigest(), "rotated": unit @ turn})
    return pa.array(out, pa.struct([("key", pa.string()), ("rotated", pa.list_(pa.float64()))]))


@F.arrow_udf(T.DoubleType())
def cosine(a: pa.Array, b: pa.Array) -> pa.Array:
    """Cosines of pairs of vectors of equal length, in double precision."""
    n = [len(x) for x in a]
    x, y = (np.asarray(v.flatten().to_numpy(zero_copy_only=False), float) for v in (a, b))
    at = np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
    big = [np.maximum.reduceat(np.abs(v), at) for v in (x, y)]
    x, y = x / np.repeat(big[0], n), y / np.repeat(big[1], n)
    xy, xx, yy = (np.add.reduceat(v, at) for v in (x * y, x * x, y * y))
    return pa.array(xy / (np.sqrt(xx) * np.sqrt(yy)))


def candidates(points: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a < b) of points that some block can't tell apart: a union of one range join per block.

    ``points`` has id, label and rotated (unit vectors).
    """
    budget = 2 - 2 * threshold
    share = F.expr(f"{budget!r}D * least({BLOCK}, dim - {BLOCK} * block) / dim + {ROOM!r}D")
    coords = [F.coalesce(F.expr(f"get(rotated, {BLOCK} * block + {i})"), F.lit(0.0)).alias(f"c{i}") for i in range(BLOCK)]
    blocks = (points.withColumn("dim", F.size("rotated"))
              .withColumn("block", F.explode(F.expr(f"sequence(0, (dim - 1) DIV {BLOCK})")))
              .select("id", "label", "dim", "block", share.alias("share"), *coords)
              .withColumn("radius", F.sqrt("share")))
    cell = lambda x: f"int(floor(({x}) / (2 * radius)))"  # noqa: E731  cells are as wide as a ball
    keys = ["label", "dim", "block", *(f"g{i}" for i in range(GRID))]
    own, asked = blocks, blocks
    for i in range(GRID):
        own = own.withColumn(f"g{i}", F.expr(cell(f"c{i}")))
        asked = asked.withColumn(f"g{i}", F.explode(F.expr(f"sequence({cell(f'c{i} - radius')}, {cell(f'c{i} + radius')})")))
    x = own.select(*keys, F.col("id").alias("a"), "share", *[F.col(f"c{i}").alias(f"x{i}") for i in range(BLOCK)])
    y = asked.select(*keys, F.col("id").alias("b"), *[F.col(f"c{i}").alias(f"y{i}") for i in range(BLOCK)])
    near = F.expr(" + ".join(f"(x{i} - y{i}) * (x{i} - y{i})" for i in range(BLOCK)) + " <= share")
    return (x.hint("merge").join(y, [x[k] == y[k] for k in keys] + [F.col("a") < F.col("b"), near])
            .select("a", "b").distinct())


def link(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept.

    ``vectors`` has vec_id, embedding (array of float or double) and label.
    """
    v = cut(vectors.select("vec_id", "label", "embedding", unit_rotated("embedding").alias("p"))
            .select("vec_id", "label", "embedding", F.when(F.col("label").isNotNull(), F.col("p.key")).alias("key"), "p.rotated"))
    points = cut(v.where("key IS NOT NULL").groupBy("label", "key")
                 .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"),
                      F.any_value("embedding").alias("embedding"), F.any_value("rotated").alias("rotated"))
                 .withColumn("id", F.monotonically_increasing_id()))  # fixed by the cut
    pairs = candidates(points.select("id", "label", "rotated"), threshold)
    vector = lambda name: points.select(F.col("id").alias(name), F.col("embedding").alias(f"v{name}"), F.col("n").alias(f"n{name}"))
    links = cut(pairs.join(vector("a"), "a").join(vector("b"), "b")
                .where(cosine("va", "vb") >= F.lit(threshold)).select("a", "b", "na", "nb"))
    counts = (links.select(F.col("a").alias("id"), F.col("nb").alias("others"))
              .union(links.select(F.col("b").alias("id"), F.col("na").alias("others")))
              .groupBy("id").agg(F.sum("others").alias("others")))
    stars = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    rooted = (points.select("id", "label", "key", "least", "n").join(stars.select(F.col("u").alias("id"), F.col("v").alias("root")), "id", "left")
              .join(counts, "id", "left").withColumn("root", F.coalesce("root", "id")))
    named = (rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component")), "root")
             .select("label", "key", F.expr("n - 1 + coalesce(others, 0)").alias("links"), "component"))
    return (v.select("vec_id", "label", "key").join(named, ["label", "key"], "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("component")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
), ok AS (
  SELECT * FROM v WHERE list_aggregate(list_transform(e, lambda x: isfinite(x)), 'bool_and')
                    AND list_aggregate(list_transform(e, lambda x: x <> 0), 'bool_or')
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach(u, w) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.u, l.w FROM reach r JOIN links l ON l.u = r.w
), c AS (
  SELECT u, min(w) AS component_id FROM reach GROUP BY u
), n AS (
  SELECT u, count(*) AS n FROM links GROUP BY u
)
SELECT m.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, m.vec_id = c.component_id AS kept
FROM embeddings m JOIN c ON c.u = m.vec_id LEFT JOIN n ON n.u = m.vec_id
"""


@register("op5_embedding_dedup", ORACLE)
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all embeddings: cosine of at least 0.98 within a label."""
    return link(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), 0.98)
