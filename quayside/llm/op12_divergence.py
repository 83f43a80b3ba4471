"""Source divergence audit: how the sources of a language differ in their terms, by hash-consed segment trees.

A group is a (language, source). Per language, terms of at least ``LEAST_DOCS`` documents are kept and numbered by falling
count, so that rare terms, whose counts repeat, stand together. With V kept terms and N occurrences of them in a group, a term
of count c has the smoothed share p = 1 + floor(10^9 * (c + 2) / (N + 2V)), and two shares p and q are (p - q)^2 / (p + q) apart,
rounded down. All of it is integer arithmetic.

1. Terms are counted in each task as far as its memory allows, then by (language, source, term).
2. Numbers are cut into segments of a fixed number of terms: over these stands, for every group, a segment tree with counts as
   its leaves. One task gets a segment with all groups of the language; equal subtrees, of any group and anywhere in the segment,
   are one node.
3. Two groups are compared by going down both trees at once. What is met is a pair of nodes and how often it was met: equal
   pairs are taken together on each level, so each is opened, and at the leaves priced, once. The difference is symmetric, so a
   pair of groups is walked once. The sums of the segments are added up by Spark, as the tree above the segments.
4. For its own terms, a group is compared with its language: subtrees without counts are left out on the way down.

A segment's length falls with the number of groups, so that groups times terms, which a task holds, is bounded.

Defined cases: a null text, language or source counts as the empty string, which is a group like any other; a text without
terms still makes its group occur; a language without kept terms has pairs of value 0 and no terms; repeated rows are
documents of their own, and doc_id plays no part; an empty table gives an empty result; other columns are ignored. Texts are
taken whole, long ones in pieces cut between terms.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import cut, numbered, spool, table
from quayside.llm.registry import register

#: Documents that a kept term has at least; terms listed for a group; shares are parts of this.
LEAST_DOCS, TOP, UNIT = 10, 10, 1_000_000_000
#: Most terms of a segment, and most cells (groups times terms) of one, both powers of 2.
SEGMENT, CELLS = 1 << 12, 1 << 22
#: Terms that a task counts before it hands them on; bytes of a text that are cut into terms at once.
HELD, STEP = 200_000, 1 << 20
_TERM, _GAP = re.compile(rb"[A-Za-z\x80-\xff]+"), re.compile(rb"[^A-Za-z\x80-\xff]")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, lower-cased (A-Z only), in lists of a bounded size."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + STEP) if at + STEP < len(text) else None
        to = gap.start() if gap else len(text)
        yield _TERM.findall(text[at:to].translate(_LOWER))
        at = to


def term_counts(docs: DataFrame) -> DataFrame:
    """One row per (lang, source, term): n occurrences and docs with it. The term '' stands for the group itself."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary())):
                n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
                seen = {b""}
                for terms in terms_of(text.as_py()):
                    n.update(terms)
                    seen.update(terms)
                docs.update(seen)
                if len(seen) > HELD:
                    yield from flush(groups)
            if sum(len(d) for _, d in groups.values()) > HELD:
                yield from flush(groups)
        yield from flush(groups)

    def flush(groups: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            terms = list(docs)
            for at in range(0, len(terms), HELD):
                some = terms[at: at + HELD]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some)), pa.array([source] * len(some)), pa.array(some, pa.binary()).cast(pa.string()),
                     pa.array([n[t] for t in some], pa.int64()), pa.array([docs[t] for t in some], pa.int64())],
                    ["lang", "source", "term", "n", "docs"])
        groups.clear()

    clean = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return (clean.mapInArrow(count, "lang string, source string, term string, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(UNIT * (counts + 2) / total), exact for totals up to 9 * 10^15: a long division by thousands."""
    rest, out = counts + 2, 0
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are below 2^30, so squares fit."""
    return (p - q) * (p - q) // (p + q)


class Forest:
    """Segment trees over rows of counts (groups by terms); equal subtrees are one node.

    ``root[g]`` is the root of row g; ``levels[i]`` holds left and right child of the nodes that are i + 1 above the leaves;
    ``leaf`` the count of each leaf node, -1 where a row is filled up to a power of 2.
    """

    def __init__(self, counts: np.ndarray):
        rows, width = counts.shape
        full = np.full((rows, 1 << max(0, width - 1).bit_length()), -1, np.int64)
        full[:, :width] = counts
        self.leaf, nodes = np.unique(full, return_inverse=True)
        nodes = nodes.reshape(full.shape)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        while nodes.shape[1] > 1:
            size = nodes.max() + 1
            pairs, at = np.unique(nodes[:, 0::2] * size + nodes[:, 1::2], return_inverse=True)
            self.levels.append((pairs // size, pairs % size))
            nodes = at.reshape(rows, -1)
        self.root = nodes[:, 0]

    def meet(self, a: int, others: np.ndarray) -> tuple[np.ndarray, ...]:
        """Pairs of leaves that row ``a`` and each of some rows have at the same places: (place in others, count of a, count
        of the other, how often). Equal pairs of nodes are taken together on the way down."""
        which, x, y = np.arange(len(others)), np.full(len(others), self.root[a]), self.root[others]
        times = np.ones(len(others), np.int64)
        for left, right in reversed(self.levels):
            which, times = np.tile(which, 2), np.tile(times, 2)
            x, y = np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]])
            size = max(int(x.max()), int(y.max())) + 1
            key, at = np.unique((which * size + x) * size + y, return_inverse=True)
            times = np.bincount(at, times, len(key)).astype(np.int64)
            which, x, y = key // (size * size), key // size % size, key % size
        return which, self.leaf[x], self.leaf[y], times

    def places(self, a: int, b: int) -> tuple[np.ndarray, ...]:
        """Places at which row ``a`` has a count over 0, its count there and that of row ``b``; empty subtrees are not entered."""
        empty = [self.leaf <= 0]
        for left, right in self.levels:
            empty.append(empty[-1][left] & empty[-1][right])
        at, x, y = np.zeros(1, np.int64), self.root[[a]], self.root[[b]]
        for (left, right), none in zip(reversed(self.levels), reversed(empty[1:])):
            go = ~none[x]
            at, x, y = at[go] * 2, x[go], y[go]
            at, x, y = np.concatenate([at, at + 1]), np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]])
        go = ~empty[0][x]
        return at[go], self.leaf[x[go]], self.leaf[y[go]]


def compare(segment: pa.Table) -> pa.Table:
    """One segment of one language: differences of its groups two by two (source < item), and the best terms of each group.

    Rows: of a group (total, and no place), of a term (its place, term and count n in the language, whose total is the same in
    all; no source), and of a cell (source, place, n).
    """
    lang = segment.column("lang")[0].as_py()
    at, n, total = (segment.column(c).to_numpy() for c in ("at", "n", "total"))
    source = segment.column("source").to_numpy(zero_copy_only=False)
    is_group = at < 0
    order = np.argsort(source[is_group].astype(object))
    names, totals = source[is_group][order], total[is_group][order]
    number = {s: i for i, s in enumerate(names)}
    is_term = np.array([s is None for s in source], bool)
    width = int(is_term.sum())
    out = []
    if width:
        counts = np.zeros((len(names) + 1, width), np.int64)
        cell = ~is_group & ~is_term
        counts[[number[s] for s in source[cell]], at[cell]] = n[cell]
        counts[-1, at[is_term]] = n[is_term]
        terms = dict(zip(at[is_term].tolist(), segment.column("term").filter(pa.array(is_term)).to_pylist()))
        whole = int(total[is_term][0])
        forest = Forest(counts)
    for g, name in enumerate(names):
        others = np.arange(g + 1, len(names))
        sums = np.zeros(len(others), np.int64)
        if width and len(others):
            which, x, y, times = forest.meet(g, others)
            real = x >= 0
            which, x, y, times = which[real], x[real], y[real], times[real]
            value = apart(share(x, totals[g]), share(y, totals[others][which])) * times
            np.add.at(sums, which, value)
        out += [("pair", name, names[o], int(s)) for o, s in zip(others, sums)]
        if width:
            where, x, y = forest.places(g, len(names))
            p, q = share(x, totals[g]), share(y, whole)
            value = apart(p, q)
            where, value = where[p > q], value[p > q]
            if len(value) > TOP:
                enough = value >= np.partition(value, -TOP)[-TOP]
                where, value = where[enough], value[enough]
            best = sorted((-int(v), terms[int(w)].encode()) for v, w in zip(value, where))[:TOP]
            out += [("term", name, t.decode(), -v) for v, t in best]
    part, a, b, value = zip(*out) if out else ((), (), (), ())
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "part": pa.array(part, pa.string()), "source": pa.array(a, pa.string()),
                     "item": pa.array(b, pa.string()), "value": pa.array(value, pa.int64())})


def divergence(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value and rank: all pairs of sources of a language, and the terms that mark a source most.

    ``docs`` has lang, source and text.
    """
    counts = spool(term_counts(docs), "term-counts")
    kept = (counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
            .where(F.col("docs") >= LEAST_DOCS).select("lang", "term", "n"))
    kept = cut(numbered(kept, ["lang"], [F.desc("n"), F.col("term")], "id", [F.col("term"), F.col("n")]))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n"))
    cells = cut(counts.where("term <> ''").select("lang", "source", "term", "n").join(kept.select("lang", "term", "id"), ["lang", "term"])
                .select("lang", "source", "id", "n"))
    groups = (counts.where("term = ''").select("lang", "source")
              .join(cells.groupBy("lang", "source").agg(F.sum("n").alias("own")), ["lang", "source"], "left")
              .join(langs.select("lang", "v"), "lang", "left")
              .select("lang", "source", F.expr("coalesce(own, 0) + 2 * coalesce(v, 0)").alias("total")))
    groups = cut(groups)
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    width = min(SEGMENT, max(16, 1 << ((CELLS // most).bit_length() - 1))) if most < CELLS else 16

    place = [F.expr(f"id DIV {width}").alias("segment"), F.expr(f"int(id % {width})").alias("at")]
    null, none = F.lit(None).cast("string"), F.lit(0).cast("long")
    # every group is in every segment of its language, with or without counts there; also where no term is kept
    segments = (kept.select("lang", place[0]).union(groups.select("lang", none.alias("segment"))).distinct())
    rows = (groups.join(segments, "lang").select("lang", "segment", "source", F.lit(-1).alias("at"), none.alias("n"), "total", null.alias("term"))
            .union(cells.select("lang", place[0], "source", place[1], "n", none, null))
            .union(kept.join(langs.select("lang", F.expr("n + 2 * v").alias("total")), "lang")
                   .select("lang", place[0], null, place[1], "n", "total", "term")))
    found = cut(rows.groupBy("lang", "segment").applyInArrow(compare, "lang string, part string, source string, item string, value long"))
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = (pairs.select("lang", "source", "item", "value")
             .union(pairs.select("lang", F.col("item"), F.col("source"), "value")))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = found.where("part = 'term'").select("lang", "source", "item", "value", F.row_number().over(ranked).alias("rank")).where(F.col("rank") <= TOP)
    columns = lambda part: ["lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank")]
    return (pairs.withColumn("rank", F.row_number().over(ranked)).select(*columns("pair"))
            .union(terms.select(*columns("term"))))


ORACLE = f"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents
), g AS (
  SELECT DISTINCT lang, source FROM d
), k AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(ts)) AS term FROM d) GROUP BY lang, term HAVING count(*) >= {LEAST_DOCS}
), c AS (
  SELECT x.lang, x.source, x.term, count(*) AS n FROM (SELECT lang, source, unnest(ts) AS term FROM d) x
  JOIN k ON k.lang = x.lang AND k.term = x.term GROUP BY x.lang, x.source, x.term
), v AS (
  SELECT lang, count(*) AS v FROM k GROUP BY lang
), gn AS (
  SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + ({UNIT}::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(gn.n, 0) + 2 * v.v)::HUGEINT AS p
  FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN gn ON gn.lang = g.lang AND gn.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), l AS (
  SELECT t.lang, t.term, 1 + ({UNIT}::HUGEINT * (t.n + 2)) // (w.n + 2 * v.v)::HUGEINT AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term) t
  JOIN (SELECT lang, sum(n) AS n FROM c GROUP BY lang) w ON w.lang = t.lang JOIN v ON v.lang = t.lang
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), terms AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p.p - l.q) * (p.p - l.q) // (p.p + l.q) AS value
  FROM p JOIN l ON l.lang = p.lang AND l.term = p.term WHERE p.n > 0 AND p.p > l.q
), r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM r WHERE part = 'pair' OR rank <= {TOP}
"""


@register("op12_divergence", ORACLE)
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of all documents, two by two within a language, and the terms that mark each."""
    return divergence(table(spark, sf_dir, "documents").select("lang", "source", "text"))
