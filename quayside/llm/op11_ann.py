"""Approximate nearest neighbours by inner product: a robust-pruned directed graph per shard, searched by beam.

1. Equal vectors are one point, whatever the number of their rows; as at most ``k`` + 1 rows of a point can be in a result, the
   rows of smallest ids stand for it (ties go to smaller ids, so no other row can appear).
2. Points are dealt to shards of about ``SHARD`` by hash. In each, a graph is built: points get random neighbours, then, batch by
   batch, a greedy search for the point itself proposes neighbours, of which robust pruning keeps diverse ones: a candidate goes
   if a nearer kept one is ``RELAX`` times closer to it than the point is. Kept edges are entered backwards too, and lists that
   grow beyond ``DEGREE`` are pruned again. The largest inner product becomes the smallest distance by one more coordinate,
   which brings all points of a shard to the same length and is 0 for queries.
3. Each shard is searched for all query points, in blocks: a beam of ``BEAM`` nodes is widened by the neighbours of its best
   unopened nodes until none is left. What the beam ends with is scored by the original vectors in double precision.
4. The best points of all shards give the best rows, from which each query takes its own out.

Index and search are tasks of bounded size: a shard, and a block of queries with a shard. Recall is that of a shard, as all are
searched, so it doesn't fall with their number.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part; vectors of different
lengths don't meet; repeated rows are rows of their own, each a candidate of the other; rows with a null id are no queries and
come after all ids at ties; a query id that occurs twice is answered twice; with fewer than ``k`` candidates, all found are
returned; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import cut, spool, table
from quayside.llm.registry import register

#: Points of a shard, edges of a node, width of the beams when building and searching, nodes opened at once, relaxation.
SHARD, DEGREE, BUILD_BEAM, BEAM, OPEN, RELAX = 4096, 32, 64, 128, 4, 1.2
#: Points that are entered at once, query points of a block that a shard is searched for, most lengths that are broadcast, most tasks
#: that shards are dealt to (fewer bytes make no task cheaper here, so they are not merged by size).
BATCH, BLOCK, LENGTHS, TASKS = 512, 4096, 100_000, 20_000
_POINT = T.StructType([T.StructField("key", T.StringType()), T.StructField("vector", T.BinaryType()), T.StructField("dim", T.IntegerType())])


@F.arrow_udf(_POINT)
def point_of(vectors: pa.Array) -> pa.Array:
    """A key of the exact vector, its doubles as bytes, and its length; null for vectors that take no part."""
    flat = np.asarray(vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), float) + 0.0  # -0.0 is 0.0
    at, out = 0, []
    for v in vectors:
        n = len(v) if v.is_valid else 0
        x, at = flat[at: at + n], at + n  # null components are not finite here
        if not n or not np.isfinite(x).all() or not x.any():
            out.append(None)
            continue
        raw = x.astype("<f8").tobytes()
        out.append({"key": hashlib.md5(raw).hexdigest(), "vector": raw, "dim": n})
    return pa.array(out, pa.struct([("key", pa.string()), ("vector", pa.binary()), ("dim", pa.int32())]))


def level(x: np.ndarray) -> np.ndarray:
    """Points for the graph (float32): scaled to at most length 1, with a coordinate that makes it 1 for all."""
    x = x / np.abs(x).max()
    norms = np.sqrt((x * x).sum(axis=1))
    x, norms = x / norms.max(), norms / norms.max()
    return np.concatenate([x, np.sqrt(np.maximum(0, 1 - norms * norms))[:, None]], axis=1).astype(np.float32)


def unit(q: np.ndarray) -> np.ndarray:
    """Queries for the graph (float32): of length 1, as only their direction decides, and 0 in the added coordinate."""
    q = q / np.abs(q).max(axis=1, keepdims=True)
    q = q / np.sqrt((q * q).sum(axis=1, keepdims=True))
    return np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype(np.float32)


def beam_search(x: np.ndarray, graph: np.ndarray, start: int, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query the nodes of its final beam and their distances (ascending; -1 and infinity if there are fewer), and all opened nodes.

    All queries are searched side by side: in each round, each opens its ``OPEN`` best unopened nodes and meets their
    neighbours. Distances are 1 less the inner product: points and queries have length 1.
    """
    n, m = len(x), len(q)
    width = min(width, n)
    beam = np.full((m, width), -1, np.int64)
    far = np.full((m, width), np.inf, np.float32)
    done = np.zeros((m, width), bool)
    seen = np.zeros((m, n + 1), bool)
    seen[:, n] = True  # the place of -1, of missing neighbours
    beam[:, 0], far[:, 0], seen[:, start] = start, 1 - q @ x[start], True
    opened = []
    active = np.arange(m)
    while len(active):
        waiting = np.where(done[active], np.inf, far[active])
        take = min(OPEN, width)
        best = np.argpartition(waiting, take - 1, axis=1)[:, :take]
        ok = np.isfinite(np.take_along_axis(waiting, best, 1))
        go = ok.any(axis=1)
        active, best, ok = active[go], best[go], ok[go]
        if not len(active):
            break
        rows = active[:, None]
        done[rows, best] |= ok
        nodes = np.where(ok, beam[rows, best], n)
        log = np.full((m, take), -1, np.int64)
        log[active] = np.where(ok, nodes, -1)
        opened.append(log)
        near = np.where(ok[:, :, None], graph[np.where(ok, nodes, 0)], -1).reshape(len(active), -1)
        near = np.sort(near, axis=1)  # two opened nodes can have a neighbour in common
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        fresh = ~seen[rows, near]
        seen[rows, near] = True
        near = np.where(fresh, near, -1)
        d = np.where(fresh, 1 - np.einsum("mrd,md->mr", x[near], q[active], optimize=True), np.inf).astype(np.float32)
        ids, dist = np.concatenate([beam[active], near], 1), np.concatenate([far[active], d], 1)
        was = np.concatenate([done[active], np.zeros(near.shape, bool)], 1)
        order = np.argsort(dist, axis=1, kind="stable")[:, :width]
        beam[active], far[active] = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        done[active] = np.take_along_axis(was, order, 1)
    beam[~np.isfinite(far)] = -1
    return beam, far, np.concatenate(opened, 1) if opened else np.empty((m, 0), np.int64)


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, relax: float) -> np.ndarray:
    """Of each point's candidates (-1: none), at most ``DEGREE``: the nearest, then the nearest of those that no kept one covers.

    A kept node covers a candidate if ``relax`` times their distance is no more than the candidate's to the point.
    """
    c = np.sort(candidates, axis=1)
    c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
    c[c == points[:, None]] = -1
    to = np.where(c >= 0, 1 - np.einsum("mcd,md->mc", x[c], x[points], optimize=True), np.inf)
    order = np.argsort(to, axis=1, kind="stable")
    c, to = np.take_along_axis(c, order, 1), np.take_along_axis(to, order, 1)
    filled = max(1, int(np.isfinite(to).sum(axis=1).max(initial=0)))
    c, to = c[:, :filled], to[:, :filled]
    vectors = x[c]
    open_ = np.isfinite(to)
    kept = np.full((len(points), DEGREE), -1, np.int64)
    rows = np.arange(len(points))
    for i in range(min(DEGREE, filled)):
        first = open_.argmax(axis=1)
        some = open_[rows, first]
        if not some.any():
            break
        kept[some, i] = c[rows, first][some]
        between = 1 - np.einsum("mcd,md->mc", vectors, vectors[rows, first], optimize=True)
        open_ &= ~(some[:, None] & (relax * relax * between <= to))  # these are squared distances, halved
        open_[rows, first] = False
    return kept


def build_graph(x: np.ndarray, seed: int = 7) -> tuple[np.ndarray, int]:
    """The graph of some points (rows of length 1): neighbours of each (-1: none), and the node to start from."""
    n = len(x)
    rng = np.random.default_rng([seed, n])
    start = int(np.argmax(x @ x.mean(axis=0)))
    if n <= DEGREE + 1:
        every = np.tile(np.arange(n), (n, 1))
        return np.where(every == np.arange(n)[:, None], -1, every), start
    graph = rng.integers(0, n, (n, DEGREE))
    graph[graph == np.arange(n)[:, None]] = start
    order = rng.permutation(n)
    for at in range(0, n, BATCH):
        points = order[at: at + BATCH]
        beam, _, opened = beam_search(x, graph, start, x[points], BUILD_BEAM)
        graph[points] = robust_prune(x, points, np.concatenate([beam, opened, graph[points]], 1), RELAX)
        # the same edges backwards, by the node that gets them
        source, target = np.repeat(points, DEGREE), graph[points].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        for low in range(0, len(nodes), BATCH):
            part = slice(low, low + BATCH)
            rank = np.arange(count[part].max())
            new = np.where(rank < count[part][:, None], source[np.minimum(first[part][:, None] + rank, len(source) - 1)], -1)
            graph[nodes[part]] = _entered(x, nodes[part], np.concatenate([graph[nodes[part]], new], 1))
    return graph, start


def _entered(x: np.ndarray, nodes: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """Neighbour lists without repeats: as they are where they fit, else pruned."""
    lists = np.sort(lists, axis=1)
    lists[:, 1:][lists[:, 1:] == lists[:, :-1]] = -1
    lists = -np.sort(-lists, axis=1)  # what is missing goes to the end
    many = (lists >= 0).sum(axis=1) > DEGREE
    out = lists[:, :DEGREE].copy()
    if many.any():
        out[many] = robust_prune(x, nodes[many], lists[many], RELAX)
    return out


def index(points: DataFrame) -> DataFrame:
    """One row per shard: dim, shard, ids and least (arrays), vectors (doubles), graph (int32, by node), start.

    ``points`` has id, dim, vector (bytes), shard, and least: what decides ties.
    """
    def build(shard: pa.Table) -> pa.Table:
        dim = shard.column("dim")[0].as_py()
        ids, least = shard.column("id").to_numpy(), shard.column("least").to_numpy()
        order = np.lexsort((ids, least))  # nodes are in the order of ties, and the graph is the same in a second attempt
        x = np.frombuffer(b"".join(shard.column("vector").to_pylist()), "<f8").reshape(-1, dim)[order]
        graph, start = build_graph(level(x))
        longs = lambda v: pa.array([v[order]], pa.list_(pa.int64()))
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard.column("shard")[0].as_py()], pa.int32()),
                         "ids": longs(ids), "least": longs(least), "vectors": pa.array([x.tobytes()], pa.binary()),
                         "graph": pa.array([graph.astype("<i4").tobytes()], pa.binary()), "start": pa.array([start], pa.int32())})

    return (points.select("id", "least", "dim", "vector", "shard").groupBy("dim", "shard")
            .applyInArrow(build, "dim int, shard int, ids array<long>, least array<long>, vectors binary, graph binary, start int"))


_FOUND = {"query": pa.int64(), "id": pa.int64(), "least": pa.int64(), "score": pa.float64()}


def search(shards: DataFrame, queries: DataFrame, k: int, width: int = BEAM) -> DataFrame:
    """Per query point and shard, the ``k`` best points found: query, id, least, score.

    ``queries`` has id, dim, vector (bytes), and shards and blocks: how many there are for this length.
    """
    def find(shard: pa.Table, asked: pa.Table) -> pa.Table:
        out = [[] for _ in _FOUND]
        if shard.num_rows and asked.num_rows:
            dim = shard.column("dim")[0].as_py()
            ids, least = (shard.column(c).combine_chunks().flatten().to_numpy() for c in ("ids", "least"))
            x = np.frombuffer(shard.column("vectors")[0].as_py(), "<f8").reshape(-1, dim)
            graph = np.frombuffer(shard.column("graph")[0].as_py(), "<i4").reshape(len(x), -1).astype(np.int64)
            names, flat = asked.column("id").to_numpy(), level(x)
            q = np.frombuffer(b"".join(asked.column("vector").to_pylist()), "<f8").reshape(-1, dim)
            for at in range(0, len(q), BATCH):
                some = q[at: at + BATCH]
                beam, _, _ = beam_search(flat, graph, shard.column("start")[0].as_py(), unit(some), max(width, k))
                score = np.where(beam >= 0, np.einsum("mbd,md->mb", x[beam], some, optimize=True), -np.inf)
                best = np.lexsort((beam, -score), axis=1)[:, :k]
                node = np.take_along_axis(beam, best, 1)
                ok = node >= 0
                asker = np.broadcast_to(names[at: at + BATCH, None], node.shape)
                for column, values in zip(out, (asker[ok], ids[node[ok]], least[node[ok]], np.take_along_axis(score, best, 1)[ok])):
                    column.append(values)
        return pa.table({name: pa.array(np.concatenate(c) if c else [], kind) for (name, kind), c in zip(_FOUND.items(), out)})

    # each shard meets each block of queries of its length: both are dealt out by (shard, block)
    blocks = _small(queries.groupBy("dim").agg(F.max("blocks").alias("blocks")))
    tasks = shards.join(blocks, "dim").agg(F.sum("blocks")).first()[0] or 1
    left = shards.join(blocks, "dim").withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    right = (queries.withColumn("block", F.expr("int(pmod(xxhash64(id), blocks))"))
             .withColumn("shard", F.explode(F.expr("sequence(0, shards - 1)"))))
    keys = ["dim", "shard", "block"]
    deal = lambda rows: rows.repartition(min(TASKS, tasks), *keys).groupBy(*keys)
    return (deal(left).cogroup(deal(right))
            .applyInArrow(find, "query long, id long, least long, score double"))


def _small(lengths: DataFrame) -> DataFrame:
    """A table with one row per length of vectors: broadcast if its rows, which are counted, are few."""
    lengths = cut(lengths)
    return F.broadcast(lengths) if lengths.count() <= LENGTHS else lengths


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, width: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id and score: of each row whose id is divisible by ``every``, its ``k`` nearest other rows.

    ``vectors`` has vec_id and embedding (array of float or double).
    """
    rows = spool(vectors.select("vec_id", point_of("embedding").alias("p")).where("p IS NOT NULL")
                 .select("vec_id", "p.key", "p.vector", "p.dim").withColumn("row", F.monotonically_increasing_id()), "vectors")
    points = cut(rows.groupBy("key").agg(F.min("row").alias("id"), F.min("dim").alias("dim"),
                                         F.coalesce(F.min("vec_id"), F.lit((1 << 63) - 1)).alias("least"),
                                         F.max(F.expr(f"vec_id % {every} = 0")).alias("asked")))
    sizes = _small(points.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / SHARD).cast("int").alias("shards"),
                                             F.greatest(F.lit(1), F.ceil(F.count_if("asked") / BLOCK)).cast("int").alias("blocks")))
    dealt = (points.join(sizes, "dim").withColumn("shard", F.expr("int(pmod(xxhash64(key), shards))"))
             .join(rows.select(F.col("row").alias("id"), "vector"), "id"))
    tasks = min(TASKS, sizes.agg(F.sum("shards")).first()[0] or 1)
    shards = spool(index(dealt.repartition(tasks, "dim", "shard")), "graph")
    queries = dealt.where("asked").select("id", "dim", "vector", "shards", "blocks")
    found = search(shards, queries, k + 1, width)

    # The best points of each query point, then the best rows: k + 1 of each at most, for points are in the order of their
    # smallest id where scores are equal, and the row of the query itself is the only one that goes.
    best = Window.partitionBy("query").orderBy(F.desc("score"), "least", "id")
    short = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    least = Window.partitionBy("key").orderBy(F.asc_nulls_last("vec_id"), "row")
    named = points.select("id", "key")
    members = (rows.select("key", "vec_id", "row").withColumn("r", F.row_number().over(least)).where(F.col("r") <= k + 1).drop("r")
               .join(named, "key").select("id", "vec_id", "row"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    listed = cut(short.select("query", "id", "score").join(members, "id").withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
                 .select("query", "score", "vec_id", "row", "r"))
    asking = (rows.where(F.expr(f"vec_id % {every} = 0")).select("key", F.col("vec_id").alias("query_id"), F.col("row").alias("own"))
              .join(named, "key").select(F.col("id").alias("query"), "query_id", "own"))
    place = listed.select("query", F.col("row").alias("own"), F.col("r").alias("mine"))
    return (asking.join(place, ["query", "own"], "left").join(listed, "query").where("row <> own")
            .withColumn("rank", F.expr("r - IF(mine < r, 1, 0)")).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


@register("op11_ann")
def op11_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every embedding whose id is divisible by 20, of all embeddings, by inner product."""
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 20, 20)
