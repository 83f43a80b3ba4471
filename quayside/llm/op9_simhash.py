"""SimHash near-duplicates: fingerprints, and their links by a partitioned vantage-point tree.

1. Each whole text gets a 64-bit fingerprint: the majority, bit by bit, of the hashes of its word shingles.
2. Equal fingerprints are one point of the search, however many documents have it.
3. A vantage-point tree over the points says which shard a point belongs to: at each node, points within a median
   distance of a vantage point go one way and the others the other way. Its nodes are fitted on a bounded sample
   (``SAMPLE`` points by hash order); any vantage points and medians give right results, they only decide how even
   the shards are. By the triangle inequality, a point's partners within ``max_bits`` can be in the other branch only
   if its distance is within ``max_bits`` of the median: there, the point is sent both ways, to the other side as a
   query only. So every pair meets in the shard of either point. A sample makes so many shards only; those that are still
   large are split again in the same way, each by a tree that a task fits on a sample of its own points, until none is
   (``split_large``). What is left large is what no vantage point divides: points within a few bits of each other.
4. Within a shard, a vantage-point tree over its own points is joined with all points that came, branch by branch,
   with the same bound. Linked points are united in place, so a shard gives one row per linked point at most, not a
   row per pair, however dense a group is.
5. Components over the shards' unions (``graph``), and back to the documents by fingerprint.

Defined cases: a null or empty text has no word and the fingerprint zero, which is linked like any other; a text with
fewer words than a shingle is one shingle; rows are neither merged nor dropped, repeated rows are each returned; a
null doc_id is no candidate for the smallest id of its component (null if there is no other); other columns of the
input are ignored, an empty table gives an empty result.
"""
from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import cut, table
from quayside.llm.graph import components
from quayside.llm.registry import register

#: Points that the tree over the shards is fitted on, at most; points that a shard should have; points of a leaf.
SAMPLE, SHARD, LEAF = 8192, 4096, 64
#: A shard of more rows than this many times ``SHARD`` is split again, if it has less than ``SHRUNK`` of the rows of the one it
#: was split from; its rows are dealt in pieces of ``PIECE``.
ROOM, SHRUNK, PIECE = 16, 0.9, 1 << 17
#: Distances that are held at once when leaves are compared.
TILE = 1 << 22


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The fingerprint of one text, unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = len(words) - shingle + 1
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, seed) for g in grams), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # of long texts, 4 MB of bits at a time
        some = hashes[at: at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text_col: str = "text", out_col: str = "fp") -> DataFrame:
    """``docs`` with a column ``out_col`` (long): the fingerprint's 64 bits."""
    @F.arrow_udf(T.LongType())
    def fp(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(out_col, fp(F.col(f"`{text_col}`")))


@dataclass
class Node:
    """A vantage point, the greatest distance that goes to ``near``, and the branches: nodes or shard numbers."""
    point: int
    median: int
    near: Node | int
    far: Node | int


def _spread(points: np.ndarray, tries: int = 8) -> tuple[int, np.ndarray]:
    """Of some points, the one whose distances to all differ most, and these distances."""
    best = None
    for p in points[:: max(1, len(points) // tries)][:tries]:
        d = np.bitwise_count(points ^ p)
        if best is None or d.std() > best[1].std():
            best = (int(p), d)
    return best


def fit_tree(sample: np.ndarray, depth: int) -> Node | int:
    """A tree of at most 2 ** depth shards, numbered from 0, over a sample of points (uint64)."""
    count = iter(range(1 << 30))

    def node(points: np.ndarray, depth: int) -> Node | int:
        if depth <= 0 or len(points) < 16:
            return next(count)
        point, d = _spread(points)
        median = int(np.median(d))
        if (d <= median).all():
            median = int(d.max()) - 1
        near = d <= median
        if not near.any():
            return next(count)
        return Node(point, median, node(points[near], depth - 1), node(points[~near], depth - 1))

    return node(np.sort(sample), depth)


def route(tree: Node | int, points: np.ndarray, max_bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each shard that gets any: its number, the places of its points, and whether they belong to it."""
    todo = [(tree, np.arange(len(points)), np.ones(len(points), bool))]
    while todo:
        node, at, home = todo.pop()
        if not len(at):
            continue
        if isinstance(node, int):
            yield node, at, home
            continue
        d = np.bitwise_count(points[at] ^ np.uint64(node.point)).astype(np.int16)
        near = d <= node.median
        to_near, to_far = d <= node.median + max_bits, d > node.median - max_bits
        todo.append((node.near, at[to_near], (home & near)[to_near]))
        todo.append((node.far, at[to_far], (home & ~near)[to_far]))


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i]; ``parent`` is a forest in which the least place of a set is its root."""
    while len(a):
        for side in (a, b):
            while not np.array_equal(up := parent[side], side):
                side[:] = up
        differ = a != b
        a, b = a[differ], b[differ]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def link_shard(points: np.ndarray, home: np.ndarray, max_bits: int) -> np.ndarray:
    """Sets of the links between a shard's own points and all that came to it: for each point its root's place."""
    parent = np.arange(len(points))
    todo = [(np.flatnonzero(home), np.arange(len(points)))]
    while todo:
        own, asked = todo.pop()
        if not len(own) or not len(asked):
            continue
        if len(own) > LEAF:
            point, d = _spread(points[own], 4)
            median = int(np.median(d))
            if (d <= median).all():
                median = int(d.max()) - 1
            near = d <= median
            if near.any():
                d = np.bitwise_count(points[asked] ^ np.uint64(point)).astype(np.int16)
                todo.append((own[near], asked[d <= median + max_bits]))
                todo.append((own[~near], asked[d > median - max_bits]))
                continue
        step = max(1, TILE // len(own))
        for at in range(0, len(asked), step):
            some = asked[at: at + step]
            x, y = np.nonzero(np.bitwise_count(points[own][:, None] ^ points[some][None, :]) <= max_bits)
            unite(parent, own[x], some[y])
    while not np.array_equal(up := parent[parent], parent):
        parent = up
    return parent


_DEALT = "shard string, fp long, home boolean, whole long"


def _routed(tree: Node | int, fp: np.ndarray, home: np.ndarray, max_bits: int, name: str, whole: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``_DEALT`` for some points of one shard; who came to it as a query only stays one."""
    for shard, at, own in route(tree, fp.view(np.uint64), max_bits):
        yield pa.RecordBatch.from_arrays([pa.array([f"{name}/{shard}"] * len(at)), pa.array(fp[at]), pa.array(own & home[at]),
                                          pa.array(np.full(len(at), whole))], ["shard", "fp", "home", "whole"])


def split_large(dealt: DataFrame, max_bits: int) -> DataFrame:
    """``dealt`` (rows of ``_DEALT``) with large shards split again, round by round, by trees of their own.

    A tree is fitted in a task, on a bounded sample of a shard's own points by hash order, and meets the shard's rows in pieces
    of bounded size. Rounds grow with the logarithm of the number of points over ``SAMPLE``.
    """
    while True:
        sizes = dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("whole").alias("from"))
        large = cut(sizes.where((F.col("n") > ROOM * SHARD) & (F.col("n") < SHRUNK * F.col("from")))
                    .select("shard", "n", F.expr(f"1 + n DIV {PIECE}").alias("pieces")))
        if large.isEmpty():
            return dealt

        def fit(pdf: pd.DataFrame) -> pd.DataFrame:
            n = int(pdf["n"].iloc[0])
            tree = fit_tree(pdf["fp"].to_numpy().view(np.uint64), max(1, (n // SHARD).bit_length()))
            return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "n": [n], "pieces": pdf["pieces"].iloc[:1], "tree": [pickle.dumps(tree)]})

        def deal(rows: pa.Table, trees: pa.Table) -> pa.Table:
            out = []
            if rows.num_rows and trees.num_rows:
                fp, home = rows.column("fp").to_numpy(), rows.column("home").to_numpy(zero_copy_only=False)
                out = list(_routed(pickle.loads(trees.column("tree")[0].as_py()), fp, home, max_bits, trees.column("shard")[0].as_py(), trees.column("n")[0].as_py()))
            return pa.Table.from_batches(out, pa.schema([("shard", pa.string()), ("fp", pa.int64()), ("home", pa.bool_()), ("whole", pa.int64())]))

        rows = dealt.join(large, "shard")
        by_hash = Window.partitionBy("shard").orderBy(F.xxhash64("fp"), "fp")
        trees = (rows.where("home").withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= SAMPLE).select("shard", "fp", "n", "pieces")
                 .groupBy("shard").applyInPandas(fit, "shard string, n long, pieces long, tree binary"))
        trees = trees.withColumn("piece", F.explode(F.expr("sequence(0L, pieces - 1)"))).select("shard", "piece", "n", "tree")
        pieces = rows.withColumn("piece", F.expr("pmod(xxhash64(fp), pieces)")).select("shard", "piece", "fp", "home")
        parts = pieces.groupBy("shard", "piece").cogroup(trees.groupBy("shard", "piece")).applyInArrow(deal, _DEALT)
        # a large shard without points of its own has no tree, and no pairs to find
        dealt = cut(dealt.join(large.select("shard"), "shard", "left_anti").unionByName(parts))


def link_points(points: DataFrame, max_bits: int = 2) -> DataFrame:
    """Components of distinct fingerprints: stars ``(u, v)`` as of ``graph.components``.

    ``points`` has one long column ``fp`` without repeats or nulls, and is read several times.
    """
    n = points.count()
    sample = points.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect() if n > SHARD else []
    tree = fit_tree(np.array([r[0] for r in sample], np.int64).view(np.uint64), max(0, (n // SHARD).bit_length()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = b.column(0).to_numpy(zero_copy_only=False)
            yield from _routed(tree, p, np.ones(len(p), bool), max_bits, "", n + 1 if n > SHARD else 0)

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("fp")
        p = pdf["fp"].to_numpy()
        root = link_shard(p.view(np.uint64), pdf["home"].to_numpy(), max_bits)
        linked = root != np.arange(len(p))
        return pd.DataFrame({"u": p[linked], "v": p[root[linked]]})

    dealt = split_large(points.mapInArrow(deal, _DEALT), max_bits)
    return components(dealt.groupBy("shard").applyInPandas(link, "u long, v long"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable."""
    d = cut(fingerprints(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), shingle)
            .select("id", "fp"))
    points = cut(d.groupBy("fp").agg(F.min("id").alias("least")))
    stars = link_points(points.select("fp"), max_bits)
    rooted = (points.join(stars.withColumnsRenamed({"u": "fp", "v": "root"}), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    named = (rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root")
             .select("fp", "component_id"))
    return d.join(named, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                      "component_id")


@register("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: shingles of 3 words, at most 2 differing bits."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
