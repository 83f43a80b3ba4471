"""Conversation prefix trie: which openings conversations share, by fixed-length block hashing.

A node is a distinct sequence of first turns (role, text); the conversations that start with it are its members.

1. Turns are numbered within their conversation by one global range sort and the offsets of its pieces, so a conversation
   that spans many tasks is numbered by many tasks.
2. A turn is two 64-bit hashes that include its place, so the digest of any run of turns is the exclusive or of its turns.
   Turns are cut into blocks of ``BLOCK``; the digest of a conversation up to a block is a running sum over its blocks, in
   two levels of ``SPAN`` blocks.
3. Conversations are grouped by the digests up to each block. From here on there is one row per distinct block below a
   distinct opening, with the number of its conversations, not one per conversation.
4. Where a block has no siblings, all conversations that go on go through it: its nodes are read off. Only blocks with
   siblings are refined: their turns are grouped by the digest up to each turn.
5. Sums over a subtree are sums over members: a node's subtree is what its members go through below it. Each node counts
   for its smallest member only (its owner), so a conversation carries the sum of its later turns, less those that it owns;
   a childless node's smallest member carries one leaf. No level of the trie is visited after another.
6. The ids of conversations that end at a node are joined to text in pieces of a range sort, and the pieces hashed in order,
   streaming: no task holds the ids of a node.

Defined cases: a null role or text counts as empty; turns of equal number are ordered by role, then text, and repeated rows
are all turns; null turn numbers come first; rows with a null conv_id belong to no conversation and are left out; a
conversation without turns is a member of the root; the root alone is its own leaf; an empty table gives an empty result;
other columns are ignored. Two sequences are taken as one if 128 bits of hash agree.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import WORD, cut, numbered, table
from quayside.llm.registry import register

#: Turns of a block, and blocks of a span of the two-level sums.
BLOCK, SPAN = 4, 1024
#: Conversations that borrow their opening from one, and the most turns that they borrow, plus one.
FAMILY, HEADS = 20, 4
#: Ids that are joined to one piece of text.
PIECE = 1 << 14
_GROUP = ["k", "p1", "p2"]
_NODE = ["depth", "d1", "d2"]


def in_order(conversations: DataFrame) -> DataFrame:
    """Turns in their order: conv_id, pos (from 0), a and b (hashes of role and text), words."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    slim = [F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit("second"), "text", "role").alias("b"),
            F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")]
    return numbered(rows, ["conv_id"], order, "pos", slim)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that open with the first turns of the head of their family: their turns, and (conv_id, n turns) of all."""
    convs = (turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
             .withColumn("h", F.expr(f"crc32(CAST(conv_id AS STRING)) % {HEADS}")).withColumn("base", F.expr(f"conv_id - conv_id % {FAMILY}")))
    heads = turns.where(F.col("pos") < HEADS - 1).select(F.col("conv_id").alias("base"), "pos", "a", "b", "words")
    sizes = heads.groupBy("base").agg(F.count(F.lit(1)).alias("most"))
    convs = cut(convs.join(sizes, "base", "left").withColumn("taken", F.expr("least(h, coalesce(most, 0))"))
                .select("conv_id", "base", "h", "taken", F.expr("taken + greatest(own - h, 0)").alias("n")))
    borrowed = convs.where("taken > 0").join(heads, "base").where("pos < taken").select("conv_id", "n", "pos", "a", "b", "words")
    own = (turns.join(convs, "conv_id").where("pos >= h")
           .select("conv_id", "n", F.expr("taken + pos - h").alias("pos"), "a", "b", "words"))
    return borrowed.union(own), convs.select("conv_id", "n")


def _xor(columns: list[Column]) -> Column:
    """Exclusive or of columns, null counting as 0."""
    out = F.lit(0).cast("long")
    for c in columns:
        out = out.bitwiseXOR(F.coalesce(c, F.lit(0)))
    return out


def _running(rows: DataFrame, key: str, place: str, sums: dict[str, tuple[str, str]], down: bool = False) -> DataFrame:
    """Running totals over all rows of a key, including the row: name -> (aggregate, column).

    Two levels: within spans of ``SPAN`` places, and over the spans of a key, of which few keys have several.
    """
    order = (lambda c: F.desc(c)) if down else (lambda c: F.asc(c))
    rows = rows.withColumn("_span", F.expr(f"{place} DIV {SPAN}"))
    inner = Window.partitionBy(key, "_span").orderBy(order(place)).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(key).orderBy(order("_span")).rowsBetween(Window.unboundedPreceding, -1)
    call = lambda kind, c: getattr(F, kind)(c)
    before = rows.groupBy(key, "_span").agg(*[call(kind, c).alias(f"_{name}") for name, (kind, c) in sums.items()])
    before = (before.select(key, "_span", *[call(kind, f"_{name}").over(outer).alias(f"_{name}") for name, (kind, _) in sums.items()])
              .where(f"_{next(iter(sums))} IS NOT NULL"))
    joined = rows.join(before, [key, "_span"], "left")
    for name, (kind, c) in sums.items():
        total, rest = call(kind, c).over(inner), F.coalesce(F.col(f"_{name}"), F.lit(0))
        joined = joined.withColumn(f"__{name}", total.bitwiseXOR(rest) if kind == "bit_xor" else total + rest)
    return joined.drop("_span", *[f"_{name}" for name in sums]).withColumnsRenamed({f"__{name}": name for name in sums})


def blocks(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, k) of the k-th block: n, hashes x and y and words w of its turns, digests before (q) and after it (p)."""
    place = F.expr(f"pos % {BLOCK}")
    hashed = turns.select("conv_id", "n", F.expr(f"pos DIV {BLOCK}").alias("k"), place.alias("t"), F.xxhash64("a", "b", "pos").alias("x"),
                          F.xxhash64("pos", "b", "a").alias("y"), F.col("words").alias("w"))
    wide = hashed.groupBy("conv_id", "k").agg(
        F.max("n").alias("n"), *[F.max(F.when(F.col("t") == i, F.col(c))).alias(f"{c}{i}") for i in range(BLOCK) for c in "xyw"])
    wide = (wide.withColumn("bx", _xor([F.col(f"x{i}") for i in range(BLOCK)]))
            .withColumn("by", _xor([F.col(f"y{i}") for i in range(BLOCK)])))
    done = _running(wide, "conv_id", "k", {"p1": ("bit_xor", "bx"), "p2": ("bit_xor", "by")})
    return (done.withColumn("q1", F.col("p1").bitwiseXOR(F.col("bx"))).withColumn("q2", F.col("p2").bitwiseXOR(F.col("by")))
            .withColumn("last", F.expr(f"k = (n - 1) DIV {BLOCK}")).drop("bx", "by"))


def _steps(groups: DataFrame, *carried: str) -> DataFrame:
    """A row per turn t of each block: depth, digests up to it (d) and before it (e), its words w, and of it and later ones."""
    def turn(i: int) -> str:
        xor = lambda c, q, upto: " ^ ".join([q, *[f"{c}{j}" for j in range(upto)]])
        later = " + ".join(f"coalesce(w{j}, 0L)" for j in range(i, BLOCK))
        final = "true" if i == BLOCK - 1 else f"x{i + 1} IS NULL"
        return (f"named_struct('t', {i}, 'depth', {BLOCK} * k + {i + 1}, 'd1', {xor('x', 'q1', i + 1)}, 'd2', {xor('y', 'q2', i + 1)}, "
                f"'e1', {xor('x', 'q1', i)}, 'e2', {xor('y', 'q2', i)}, 'w', w{i}, 'later', {later}, 'final', {final})")
    return (groups.selectExpr(*_GROUP, *carried, f"inline(array({', '.join(map(turn, range(BLOCK)))}))").where("d1 IS NOT NULL"))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of all conversations.

    ``turns`` has conv_id, n (turns of the conversation), pos (from 0), a, b (hashes of the turn) and words; ``convs`` has
    conv_id and n of every conversation, also those without turns. Columns: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (words of the subtree that members have in common), ends_sha256.
    """
    rows = cut(blocks(turns))
    shape = [f"{c}{i}" for i in range(BLOCK) for c in "xyw"]
    groups = rows.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("c"), F.min("conv_id").alias("m"), F.count_if("last").alias("ends"),
                                       *[F.max(x).alias(x) for x in ("q1", "q2", *shape)])
    siblings = groups.groupBy("k", "q1", "q2").agg((F.count(F.lit(1)) > 1).alias("split"))
    groups = cut(groups.join(siblings, ["k", "q1", "q2"]))

    steps = _steps(groups, "c", "m", "ends", "split").withColumn("ends", F.expr("IF(final, ends, 0L)"))
    node_columns = [*_NODE, "e1", "e2", "w", "c", "m", "ends"]
    refined = steps.where("split").groupBy(*_NODE).agg(
        *[F.max(x).alias(x) for x in ("e1", "e2", "w")], F.sum("c").alias("c"), F.min("m").alias("m"), F.sum("ends").alias("ends"))
    nodes = cut(refined.select(*node_columns, F.lit(True).alias("split"))
                .union(steps.where("NOT split").select(*node_columns, F.lit(False).alias("split"))))

    # from which turn of its block on a block's smallest member owns the nodes, and whether the last one is childless
    met = (steps.where("split").select(*_GROUP, *_NODE, "t", "final", F.col("m").alias("least"))
           .join(nodes.where("split").select(*_NODE, "m", "c", "ends"), _NODE))
    owned = (met.groupBy(*_GROUP).agg(F.min(F.expr("IF(m = least, t, NULL)")).alias("first"),
                                      F.max(F.expr("final AND c = ends")).alias("leaf"))
             .withColumn("first", F.coalesce("first", F.lit(BLOCK))))
    later = F.expr("CASE first " + " ".join(f"WHEN {i} THEN {' + '.join(f'coalesce(w{j}, 0L)' for j in range(i, BLOCK))}" for i in range(BLOCK))
                   + " ELSE 0L END")
    # words: of the block; own: of the turns that the smallest member owns
    known = cut(groups.join(owned, _GROUP, "left")
                .withColumn("first", F.coalesce("first", F.lit(0))).withColumn("leaf", F.coalesce("leaf", F.expr("c = ends")))
                .withColumn("own", later).withColumn("words", F.expr(" + ".join(f"coalesce(w{j}, 0L)" for j in range(BLOCK)))))

    shares = (rows.select("conv_id", "last", *_GROUP).join(known.select(*_GROUP, "m", "words", "own", "leaf"), _GROUP)
              .select("conv_id", *_GROUP, F.expr("words - IF(conv_id = m, own, 0L)").alias("share"),
                      F.expr("IF(last AND leaf AND conv_id = m, 1L, 0L)").alias("is_leaf")))
    below = (_running(shares, "conv_id", "k", {"rest": ("sum", "share"), "leaves": ("sum", "is_leaf")}, down=True)
             .groupBy(*_GROUP).agg(F.sum(F.expr("rest - share")).alias("below"), F.sum("leaves").alias("leaves")))
    # of members in a block: words of this and later turns, less what the owner has of them, and what comes below the block
    part = _steps(known.join(below, _GROUP), "c", "first", "own", "below", "leaves", "split")
    part = part.withColumn("saved", F.expr("c * later - IF(t >= first, later, own) + below"))
    sums = (part.where("split").groupBy(*_NODE).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
            .union(part.where("NOT split").select(*_NODE, "saved", "leaves")))

    inner = nodes.join(sums, _NODE).select(*_NODE, "e1", "e2", "c", "m", "saved", "leaves")
    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    root = (convs.agg(F.count(F.lit(1)).alias("c"), F.min("conv_id").alias("m")).select("c", "m", none.alias("saved"), none.alias("leaves"))
            .union(sums.where("depth = 1").agg(F.sum("saved"), F.sum("leaves")).select(none, none, "sum(saved)", "sum(leaves)"))
            .agg(*[F.max(x).alias(x) for x in ("c", "m", "saved", "leaves")]).where("c > 0")
            .select(zero.alias("depth"), zero.alias("d1"), zero.alias("d2"), zero.alias("e1"), zero.alias("e2"), "c", "m",
                    F.coalesce("saved", zero).alias("saved"), F.coalesce("leaves", F.lit(1)).alias("leaves")))
    all_nodes = cut(inner.union(root))
    children = (all_nodes.where("depth > 0").groupBy(F.expr("depth - 1").alias("depth"), F.col("e1").alias("d1"), F.col("e2").alias("d2"))
                .agg(F.count(F.lit(1)).alias("children")))
    parents = all_nodes.select(F.expr("depth + 1").alias("depth"), F.col("d1").alias("e1"), F.col("d2").alias("e2"), F.col("m").alias("parent"))
    ended = (rows.where("last").select("conv_id", F.col("n").alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2"))
             .union(convs.where("n = 0").select("conv_id", zero, zero, zero)))
    return (all_nodes.join(children, _NODE, "left")
            .join(parents.where("depth > 0"), ["depth", "e1", "e2"], "left")
            .join(digests(ended), _NODE, "left")
            .select(F.col("m").alias("conv_id"), F.col("depth").cast("long").alias("depth"),
                    F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"), F.col("c").alias("n_convs"),
                    F.coalesce("children", zero).alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                    F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))


def digests(ended: DataFrame) -> DataFrame:
    """SHA-256 of the ids of each node, ascending and joined by commas: depth, d1, d2, digest.

    ``ended`` has a row per conversation: conv_id and its node. Pieces of a range sort become texts, in their order; a
    node's texts are hashed one after the other.
    """
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = {name: b.column(name).to_pylist() for name in b.schema.names}
            keys = list(zip(*(c[x] for x in _NODE)))
            starts = [i for i, key in enumerate(keys) if not i or key != keys[i - 1]]
            out = [(*keys[i], c["conv_id"][at], ",".join(map(str, c["conv_id"][at: min(to, at + PIECE)])))
                   for i, to in zip(starts, [*starts[1:], len(keys)]) for at in range(i, to, PIECE)]
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in list(zip(*out))[:4]), pa.array([r[4] for r in out], pa.string())],
                                             [*_NODE, "least", "ids"]) if out else _none(["least"], pa.string(), "ids")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        for b in batches:
            found = []
            for key in zip(*(b.column(x).to_pylist() for x in (*_NODE, "ids"))):
                if key[:3] != node:
                    if node is not None:
                        found.append((*node, running.hexdigest()))
                    node, running = key[:3], hashlib.sha256(key[3].encode())
                else:
                    running.update(b"," + key[3].encode())
            if found:
                yield rows(found)
        if node is not None:
            yield rows([(*node, running.hexdigest())])

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in list(zip(*found))[:3]), pa.array([r[3] for r in found], pa.string())],
                                          [*_NODE, "digest"])

    order = [*_NODE, "conv_id"]
    texts = (ended.select(*[F.col(x).cast("long").alias(x) for x in order]).repartitionByRange(*order).sortWithinPartitions(*order)
             .mapInArrow(join, "depth long, d1 long, d2 long, least long, ids string"))
    return (texts.repartition(*_NODE).sortWithinPartitions(*_NODE, "least")
            .mapInArrow(digest, "depth long, d1 long, d2 long, digest string"))


def _none(longs: list[str], kind: pa.DataType, name: str) -> pa.RecordBatch:
    """An empty batch with a node's columns, some more longs, and one other column."""
    return pa.RecordBatch.from_arrays([*(pa.array([], pa.int64()) for _ in [*_NODE, *longs]), pa.array([], kind)], [*_NODE, *longs, name])


ORACLE = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, xor(4294967295::BIGINT, list_reduce(
    list_transform(range(1, len(conv_id::VARCHAR) + 1), lambda i: ascii((conv_id::VARCHAR)[i])::BIGINT),
    lambda a, b: list_reduce(range(0, 8), lambda u, i: xor(u // 2, CASE WHEN u % 2 = 1 THEN 3988292384 ELSE 0 END), xor(a, b)),
    4294967295::BIGINT)) % {HEADS} AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), heads AS (
  SELECT c.conv_id, t.pos, t.r, t.x FROM c JOIN t ON t.conv_id = c.base WHERE t.pos < c.h
), taken AS (
  SELECT c.conv_id, c.h, count(heads.pos) AS k FROM c LEFT JOIN heads ON heads.conv_id = c.conv_id GROUP BY c.conv_id, c.h
), rebuilt AS (
  SELECT conv_id, pos, r, x FROM heads
  UNION ALL
  SELECT t.conv_id, k + t.pos - h, t.r, t.x FROM t JOIN taken ON taken.conv_id = t.conv_id WHERE t.pos >= h
), path AS (
  SELECT conv_id, pos + 1 AS depth, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS w,
         string_agg(sha256(r) || sha256(x), '') OVER (PARTITION BY conv_id ORDER BY pos) AS key FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM c
), fin AS (
  SELECT conv_id, max(depth) AS depth FROM path GROUP BY conv_id
), node AS (
  SELECT p.depth, p.key, any_value(p.w) AS w, min(p.conv_id) AS m, count(*) AS n,
         sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (WHERE p.depth = f.depth), '')) AS ends
  FROM path p JOIN fin f ON f.conv_id = p.conv_id GROUP BY p.depth, p.key
), kids AS (
  SELECT a.depth, a.key, count(b.key) AS n_children FROM node a
  LEFT JOIN node b ON b.depth = a.depth + 1 AND b.key[1:128 * a.depth] = a.key GROUP BY a.depth, a.key
), pairs AS (
  SELECT DISTINCT a.depth, a.key, b.depth AS d, b.key AS k FROM path a JOIN path b ON a.conv_id = b.conv_id AND b.depth >= a.depth
), sums AS (
  SELECT pairs.depth, pairs.key, count(*) FILTER (WHERE kids.n_children = 0) AS n_leaves, sum((node.n - 1) * node.w) AS saved
  FROM pairs JOIN node ON node.depth = pairs.d AND node.key = pairs.k JOIN kids ON kids.depth = pairs.d AND kids.key = pairs.k
  GROUP BY pairs.depth, pairs.key
)
SELECT node.m::BIGINT AS conv_id, node.depth::BIGINT AS depth, up.m::BIGINT AS parent_conv_id, node.n::BIGINT AS n_convs,
       kids.n_children::BIGINT AS n_children, sums.n_leaves::BIGINT AS n_leaves, sums.saved::BIGINT AS saved_tokens, node.ends AS ends_sha256
FROM node JOIN kids ON kids.depth = node.depth AND kids.key = node.key JOIN sums ON sums.depth = node.depth AND sums.key = node.key
LEFT JOIN node up ON up.depth = node.depth - 1 AND up.key = node.key[1:128 * (node.depth - 1)]
"""


@register("op13_prefix_trie", ORACLE)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each opening with the first turns of the head of its family of twenty."""
    turns, convs = rebuilt(in_order(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))
    return prefix_trie(turns, convs)
