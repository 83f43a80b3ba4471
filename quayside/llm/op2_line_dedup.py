"""Line de-duplication: an exact set-similarity self-join of lines, after which later matches are removed.

A line is the set of its words. Lines of at least ``least`` words (all that have a word, by default) whose sets have a Jaccard similarity of ``SIMILAR``
or more match; a line is removed if an earlier line (by document, then line number) matches it, be that one removed or
not. Everything else of a text stays as it is.

1. Words are ordered by rarity. Counts of all words are kept in a table of fixed size by hash (``SKETCH`` bits), which
   is the same for all tasks, so the order is too; hash collisions only make it a little less sharp.
2. Equal sets are one class, of which the earliest line is compared; its other lines are removed.
3. Sets of n words that match share one of their first n - ceil(SIMILAR * n) + 1 words in this order. These prefixes
   are the index: rows are dealt by word and sorted by place, and each class meets the earliest class with its word and
   the ``BEFORE`` right before it, many pairs at once in numpy. Sets of fewer than ``ALONE`` words match equal sets only, so
   these are not indexed.
4. Pairs that sizes (length filter) or the places of the shared word (positional filter) rule out are dropped there, and those
   whose bit maps differ too much: a bit is the parity of the words that fall on it, so each bit that differs is a word
   that only one of them has. Long lines differ in more words than a short map can show, so they have maps of more bits
   (64, and 128 and 192 of more than ``WIDE`` words). Of what is left, the ``NEAREST`` by the maps are kept per class and word.
   A pair must share two words that pass, where the prefixes reach that far.
5. These pairs are verified by their exact words: each line against its nearest first, then those without a match
   against the others. A line without a match that had earlier classes out of reach in 3, or more than 4 keeps, meets
   all earlier ones in a join on the words. So a large group of variants costs some pairs per variant and word, not a
   pair per two variants, and no pair is lost.

Defined cases: a null text has no lines and stays null; an empty one is one empty line; lines with fewer than ``least``
distinct words are always kept; rows without a doc_id are documents of their own and come before all others, by a hash of
their text (of copies, any one stays); rows of the same doc_id are one document: equal
lines at an equal number are not later than each other; all rows are returned, a text that loses all lines is empty; an
empty table gives an empty result; other columns are carried along.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import cut, numbered, spool, table
from quayside.llm.linetokens import Lines, line_sets
from quayside.llm.registry import register

#: Least similarity, least words of a line, bits of the table of word counts, bits of the tables of wanted places.
SIMILAR, LEAST, SKETCH, WANTED = 0.8, 1, 22, 23
#: Sets of more words than these have a second and a third part of their bit maps.
WIDE = (48, 144)
#: Classes before it that a class meets at once, and how many of them are kept, per word. Index rows and pairs of classes worked on at once.
BEFORE, NEAREST, ROWS, PAIRS = 1024, 16, 1 << 16, 1 << 20
#: Fewest words of a set that a different set (of one word more) can match.
ALONE = math.ceil(SIMILAR / (1 - SIMILAR) - 1e-9)
_PART = 1 << 16
_WORD = np.uint64((1 << 40) - 1)
_PLACE = ["doc", "line"]
_MAPS = ["bits", "more", "most"]


def with_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with the document each row is, as a number in order (_key): the id, or a number of its own before all ids.

    Only rows without an id are numbered, by a range sort, and written, so that all scans see the same numbers. Where there
    is no room before the least id, ids are replaced by their places.
    """
    key = F.col("doc_id").cast("long")
    least, without = docs.agg(F.min(key), F.count_if(key.isNull())).first()
    if not without:
        return docs.withColumn("_key", key)
    rows = docs.where(key.isNull()).select(F.lit(0).alias("_all"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = numbered(rows, ["_all"], [F.xxhash64("_row.text")], "_number", [F.col("_row")])
    first = (least or 0) - without
    named = docs.where(key.isNotNull()).withColumn("_key", key)
    if first < -(1 << 63):
        ids = named.select(F.lit(0).alias("_all"), "_key").distinct()
        ids = cut(numbered(ids, ["_all"], [F.col("_key")], "_place", [F.col("_key")]).select(F.col("_key").alias("_id"), "_place"))
        named = named.join(ids, F.col("_key") == F.col("_id")).withColumn("_key", F.col("_place")).drop("_id", "_place")
        first = -without
    own = spool(rows.select("_row", (F.col("_number") + F.lit(first)).alias("_key")), "without-id")
    return named.unionByName(own.select("_row.*", "_key"))


def _keyed(docs: DataFrame) -> DataFrame:
    """doc (its number) and text of the documents that have a text, from rows as of ``with_keys``."""
    return docs.where("text IS NOT NULL").select(F.col("_key").alias("doc"), "text")


def _scan(each):
    """A function of batches for mapInArrow from one of a batch; unused Arrow memory is given back at the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from each(b)
        pa.default_memory_pool().release_unused()
    return run


def _lines(b: pa.RecordBatch) -> tuple[np.ndarray, Lines]:
    texts = [t.as_py() for t in b.column("text").cast(pa.binary())]
    return b.column("doc").to_numpy(zero_copy_only=False), Lines(texts)


def word_codes(docs: DataFrame) -> np.ndarray:
    """How common words are, by the leading ``SKETCH`` bits of their hash: a logarithmic code of their count.

    Each task counts in a table of its own and sends what isn't 0, by parts of the table; parts are added up in tasks.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(1 << SKETCH, np.uint32)
        for b in batches:
            for _, h in _lines(b)[1].tokens():
                np.add.at(n, (h >> np.uint64(64 - SKETCH)).astype(np.int64), np.uint32(1))  # without casts it is ten times as fast
        parts = n.reshape(-1, _PART)
        places = [np.flatnonzero(p) for p in parts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([at.astype(np.uint16).tobytes() for at in places], pa.binary()),
             pa.array([p[at].tobytes() for p, at in zip(parts, places)], pa.binary())], ["part", "places", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for r in b.to_pylist():
                sums = total.setdefault(r["part"], np.zeros(_PART, np.int64))
                sums[np.frombuffer(r["places"], np.uint16)] += np.frombuffer(r["counts"], np.uint32)
        codes = [np.minimum(255, 12 * np.log2(1 + x)).astype(np.uint8).tobytes() for x in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(codes, pa.binary())], ["part", "codes"])

    counts = docs.mapInArrow(count, "part int, places binary, counts binary")
    codes = np.zeros(1 << SKETCH, np.uint8)
    for r in counts.repartition("part").mapInArrow(add, "part int, codes binary").collect():
        codes[r["part"] * _PART: (r["part"] + 1) * _PART] = np.frombuffer(bytes(r["codes"]), np.uint8)
    return codes


def word_sets(docs: DataFrame, codes, least: int = LEAST) -> DataFrame:
    """A row per line of at least ``least`` words: two hashes of its set, doc, line, n words, their bit maps, and its prefix (array).

    Words of a prefix are 40 bits of their hash; words that share them only make some more candidates. Sets that only
    equal ones match have an empty prefix.
    """
    def emit(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        doc, lines = _lines(b)
        for line, n, k1, k2, rank in line_sets(lines, codes.value):
            ok = n >= least
            size = np.where(ok & (n >= ALONE), n - np.ceil(SIMILAR * n - 1e-9).astype(np.int64) + 1, 0)
            start = np.cumsum(n) - n
            inner = np.arange(len(rank)) - np.repeat(start, n) < np.repeat(size, n)
            offsets = np.concatenate([[0], np.cumsum(size[ok])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[ok].view(np.int64)), pa.array(k2[ok].view(np.int64)), pa.array(doc[lines.doc[line[ok]]]),
                 pa.array(lines.number[line[ok]].astype(np.int32)), pa.array(n[ok].astype(np.int32)),
                 *_maps(n, rank, start, ok),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array((rank[inner] & _WORD).view(np.int64)))],
                ["k1", "k2", "doc", "line", "n", *_MAPS, "prefix"])

    return docs.mapInArrow(_scan(emit), "k1 long, k2 long, doc long, line int, n int, bits long, more long, most long, prefix array<long>")


def classes(sets: DataFrame) -> DataFrame:
    """One row per distinct word set that others can match, that of its earliest line: doc, line, n, bit maps, prefix."""
    return (sets.where("size(prefix) > 0").groupBy("k1", "k2").agg(F.min(F.struct("doc", "line", "n", *_MAPS, "prefix")).alias("m"))
            .select("m.*"))


def _maps(n: np.ndarray, rank: np.ndarray, start: np.ndarray, ok: np.ndarray) -> list[pa.Array]:
    """Bit maps of sets: ``bits`` of all words; ``more`` of half of them and ``most`` of a quarter in the other half, for long sets.

    So the words of a set of more than ``WIDE[1]`` words are in three maps, ``more``, ``most`` and what is left of ``bits``.
    """
    bit = np.uint64(1) << (rank & np.uint64(63))
    half, quarter = (rank >> np.uint64(6)) & np.uint64(1) == 1, (rank >> np.uint64(7)) & np.uint64(1) == 1
    out = [pa.array(np.bitwise_xor.reduceat(bit, start)[ok].view(np.int64))]
    for least, of in zip(WIDE, (half, ~half & quarter)):
        part = np.bitwise_xor.reduceat(np.where(of, bit, np.uint64(0)), start)[ok]
        out.append(pa.array(part.view(np.int64), mask=n[ok] <= least))
    return out


def repeats(sets: DataFrame) -> DataFrame:
    """Lines of classes that have an earlier line: doc, line, k1."""
    all_lines = sets.select("k1", "k2", "doc", "line")
    first = (all_lines.groupBy("k1", "k2").agg(F.min(F.struct("doc", "line")).alias("first"), F.count(F.lit(1)).alias("m"))
             .where("m > 1").select(F.col("k1").alias("f1"), F.col("k2").alias("f2"), "first"))
    return (all_lines.join(first, (F.col("k1") == F.col("f1")) & (F.col("k2") == F.col("f2")))
            .where(F.struct("doc", "line") > F.col("first")).select("doc", "line", "k1"))


def index(sets: DataFrame) -> DataFrame:
    """A row per word of a prefix: word, doc, line, n, i (its place), bit maps."""
    return sets.select(F.posexplode("prefix").alias("i", "word"), *_PLACE, "n", *_MAPS)


class Met:
    """Index rows of some words, in order of word and place, and the pairs of them that pass.

    ``known`` rows are at the front, of the first word only: its earliest class and the last ones of those met before.
    ``gone``: whether others were met between these, which are not here any more. ``before`` and ``nearest``: as ``BEFORE``, ``NEAREST``.
    """

    def __init__(self, rows: dict[str, np.ndarray], known: int, gone: bool, before: int, nearest: int):
        self.rows, self.known, self.before, self.nearest = rows, known, before, nearest
        word = rows["word"]
        new = np.concatenate([[True], word[1:] != word[:-1]])
        self.first = np.maximum.accumulate(np.where(new, np.arange(len(word)), 0))
        self.gone = (self.first == 0) & gone

    def pairs(self) -> Iterator[pa.RecordBatch]:
        """Rows as of ``near``."""
        y = np.arange(self.known, len(self.first))
        back = y - self.first[y]
        out = self.gone[y] | (back > self.before + 1)  # some earlier ones are out of reach
        reach = np.minimum(back, self.before)
        far_off = back > self.before  # beside those in reach, it meets the earliest
        count = reach + far_off
        ends = np.cumsum(count)
        at = 0
        while at < len(y):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS)))
            yield self._passing(y[at:to], reach[at:to], count[at:to], out[at:to])
            at = to

    def _passing(self, y: np.ndarray, reach: np.ndarray, count: np.ndarray, out: np.ndarray) -> pa.RecordBatch:
        of = np.repeat(np.arange(len(y)), count)
        step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        a = y[of]
        b = np.where(step < reach[of], a - 1 - step, self.first[a])
        n, i = self.rows["n"], self.rows["i"]
        na, nb = n[a], n[b]
        least, most = np.minimum(na, nb), np.maximum(na, nb)
        keep = np.flatnonzero((least >= SIMILAR * most - 1e-9) & (most > ALONE))
        of, a, b, na, nb = of[keep], a[keep], b[keep], na[keep], nb[keep]
        share = np.ceil(SIMILAR / (1 + SIMILAR) * (na + nb) - 1e-9)
        keep = np.flatnonzero(np.minimum(na - i[a], nb - i[b]) >= share - 1)
        of, a, b, na, nb, share = of[keep], a[keep], b[keep], na[keep], nb[keep], share[keep]
        bits, more, most = ((self.rows[c][a] ^ self.rows[c][b]).view(np.uint64) for c in _MAPS)
        both = np.minimum(na, nb)
        more[both <= WIDE[0]] = 0
        most[both <= WIDE[1]] = 0
        differ = sum(np.bitwise_count(x).astype(np.int64) for x in (bits ^ more ^ most, more, most))
        doc, line = self.rows["doc"], self.rows["line"]
        keep = np.flatnonzero((na + nb - differ >= 2 * share) & ((doc[a] != doc[b]) | (line[a] != line[b])))
        far = differ[keep] / (na[keep] + nb[keep])
        keep = keep[order := np.lexsort((far, of[keep]))]
        of, far = of[keep], far[order]
        place = np.arange(len(of)) - np.searchsorted(of, of)
        out = out.copy()
        out[of[place >= self.nearest]] = True
        keep, far = keep[place < self.nearest], far[place < self.nearest]
        a, b, na, nb = a[keep], b[keep], na[keep], nb[keep]
        asks = y[out]
        null = np.repeat([False, True], [len(a), len(asks)])
        column = lambda x, t, m=None: pa.array(np.concatenate([x, np.zeros(len(asks), x.dtype)]).astype(t), mask=m)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([doc[a], doc[asks]])), pa.array(np.concatenate([line[a], line[asks]]).astype(np.int32)),
             column(na, np.int32), column(doc[b], np.int64, null), column(line[b], np.int32, null), column(nb, np.int32), column(far, np.float64)],
            ["doc", "line", "n", "doc0", "line0", "n0", "far"])

    def last(self) -> tuple[dict[str, np.ndarray], bool]:
        """What a class with the last word still to come meets, and ``gone`` for it."""
        first, end = self.first[-1], len(self.first)
        begin = max(first + 1, end - self.before)
        at = np.concatenate([[first], np.arange(begin, end)])
        return {c: x[at] for c, x in self.rows.items()}, bool(self.gone[-1]) or begin > first + 1


def near(rows: DataFrame) -> DataFrame:
    """Of an index, the nearest pairs that pass: doc, line, n, doc0, line0, n0, far (as of ``verified``), a row per shared word.

    A class that has more earlier ones with a word than these tell of has a row without doc0 and line0.
    """
    cols = ["word", *_PLACE, "n", "i", *_MAPS]
    before, nearest, at_once = BEFORE, NEAREST, ROWS

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        known, gone, some = 0, False, 0

        def met() -> Met:
            return Met({c: np.concatenate([h[c] for h in held]) for c in cols}, known, gone, before, nearest)

        for b in batches:
            held.append({c: b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in cols})
            some += b.num_rows
            if some >= at_once:
                yield from (m := met()).pairs()
                rows, gone = m.last()
                held, known, some = [rows], len(rows["word"]), 0
        if some:
            yield from met().pairs()
        pa.default_memory_pool().release_unused()

    maps = [F.coalesce(c, F.lit(0)).alias(c) for c in _MAPS]
    return (rows.select("word", *_PLACE, "n", "i", *maps).repartition("word").sortWithinPartitions("word", *_PLACE)
            .mapInArrow(meet, "doc long, line int, n int, doc0 long, line0 int, n0 int, far double"))


def _overlap(n: str, n0: str) -> str:
    """Words that two sets of n and n0 must share to match; SQL."""
    return f"ceil({SIMILAR / (1 + SIMILAR)!r} * ({n} + {n0}) - 1e-9)"


def _differ(y: str, x: str) -> str:
    """Words that only one of two classes has, as far as the bit maps of both show; SQL."""
    bits, more, most = (f"({y}{c} ^ {x}{c})" for c in _MAPS)
    return (f"coalesce(bit_count({bits} ^ {more} ^ {most}) + bit_count({most}) + bit_count({more}), "
            f"bit_count({bits} ^ {more}) + bit_count({more}), bit_count({bits}))")


def _passes(y: str, x: str) -> str:
    """Length and positional filter for two classes that share the word at places i, and that on the bits of their words; SQL.

    ``y`` and ``x`` are put before the columns.

    Of the words that a match shares, all but one come at or after its first two; so either of these two has at least
    all but one of them left in both sets. Two different sets of ``ALONE`` words don't match.
    """
    n, n0 = f"{y}n", f"{x}n"
    return (f"greatest({n}, {n0}) > {ALONE} AND least({n}, {n0}) >= {SIMILAR} * greatest({n}, {n0}) - 1e-9 AND "
            f"least({n} - {y}i, {n0} - {x}i) >= {_overlap(n, n0)} - 1 AND {n} + {n0} - {_differ(y, x)} >= 2 * {_overlap(n, n0)}")


def _pairs(rows: DataFrame) -> DataFrame:
    """Candidates (doc, line, doc0, line0, far) from a row per shared word that passes, with sizes n and n0 and ``far``.

    A match shares two such words, if both prefixes reach as far as the second can be; else at least one.
    """
    reach = lambda n: f"{n} - {_overlap('n', 'n0')} + 2 <= {n} - ceil({SIMILAR} * {n} - 1e-9) + 1"
    return (rows.groupBy(*_PLACE, "doc0", "line0").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n"), F.max("n0").alias("n0"), F.max("far").alias("far"))
            .where(F.expr(f"c >= 2 OR NOT ({reach('n')} AND {reach('n0')})")).select(*_PLACE, "doc0", "line0", "far"))


def _bit_sql(columns: list[str]) -> str:
    """The bit of a place, for ``wanted``: columns are a document and possibly a line."""
    line = f" + {columns[1]}" if len(columns) > 1 else ""
    return f"pmod(pmod({columns[0]}, {1 << WANTED}L) * 1009{line}, {1 << WANTED}L)"


def _bits_of(bits: np.ndarray, doc: np.ndarray, line: np.ndarray | int = 0) -> np.ndarray:
    """Whether the bits of some places are set."""
    b = ((doc % (1 << WANTED)) * 1009 + line) % (1 << WANTED)
    return (bits[b >> 3] >> (b & 7).astype(np.uint8)) & 1 == 1


def wanted(places: DataFrame, columns: list[str]) -> np.ndarray:
    """A table of ``2 ** WANTED`` bits (packed, lowest first) with those of some places set: what to look for in a scan.

    Built as bitmaps in the tasks; its size does not depend on the number of places. Other places can share a bit, so a
    join with the places themselves has to follow.
    """
    maps = (places.select(F.expr(f"{_bit_sql(columns)} + 1").alias("b"))
            .groupBy(F.expr("bitmap_bucket_number(b)").alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(b))").alias("bits")).collect())
    out = np.zeros((1 << WANTED) // 8, np.uint8)
    for r in maps:  # buckets are numbered from 1
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[(r["bucket"] - 1) * len(part): r["bucket"] * len(part)] = part
    return out


@F.arrow_udf(T.DoubleType())
def jaccard(a: pa.Array, b: pa.Array) -> pa.Array:
    """Similarity of the word sets of two lines each."""
    out = []
    for x, y in zip(a, b):
        x, y = set(x.as_py().split()), set(y.as_py().split())
        both = len(x & y)
        out.append(both / (len(x) + len(y) - both))
    return pa.array(out, pa.float64())


def verified(docs: DataFrame, pairs: DataFrame, nearest_first: bool = False) -> DataFrame:
    """Of pairs (doc, line) and (doc0, line0), the former where the lines match: doc, line, k1.

    One match will do for a line: with ``nearest_first``, each is held against its nearest by ``far`` (the share of words that
    the bits show to be in one set only), and those without a match against all.
    """
    pairs = cut(pairs)
    places = pairs.select(*_PLACE).union(pairs.select("doc0", "line0")).distinct()
    bits = docs.sparkSession.sparkContext.broadcast(wanted(places, _PLACE))

    def emit(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        doc, lines = _lines(b)
        ask = np.flatnonzero(_bits_of(bits.value, doc[lines.doc], lines.number))
        texts = [lines.text(i) for i in ask]
        k1_of = np.zeros(len(ask), np.uint64)
        for line, _, k1, _, _ in line_sets(Lines(texts)):
            k1_of[line] = k1
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[lines.doc[ask]]), pa.array(lines.number[ask].astype(np.int32)),
             pa.array(k1_of.view(np.int64)), pa.array(texts, pa.binary())], ["doc", "line", "k1", "words"])

    found = docs.mapInArrow(_scan(emit), "doc long, line int, k1 long, words binary")
    found = spool(found, "candidate-lines")
    earlier = found.select(F.col("doc").alias("doc0"), F.col("line").alias("line0"), F.col("words").alias("words0"))

    def matching(some: DataFrame) -> DataFrame:
        return (some.join(found, _PLACE).join(earlier, ["doc0", "line0"])
                .where(jaccard("words", "words0") >= F.lit(SIMILAR)).select("doc", "line", "k1").distinct())

    if not nearest_first:
        return matching(pairs)
    nearest = pairs.groupBy(*_PLACE).agg(F.min(F.struct("far", "doc0", "line0")).alias("m"), F.count(F.lit(1)).alias("pairs"))
    matched = cut(matching(nearest.select(*_PLACE, "m.doc0", "m.line0")))
    others = (nearest.where("pairs > 1").select(*_PLACE, F.col("m.doc0").alias("d0"), F.col("m.line0").alias("l0"))
              .join(matched, _PLACE, "left_anti"))
    others = pairs.join(others, _PLACE).where("doc0 <> d0 OR line0 <> l0").select(*_PLACE, "doc0", "line0")
    return matched.union(matching(others))


def later_matches(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Lines to remove: doc, line, k1 (a hash of its words). ``docs`` is as of ``_keyed``, and is scanned several times."""
    codes = docs.sparkSession.sparkContext.broadcast(word_codes(docs))
    sets = spool(word_sets(docs, codes, least), "word-sets")
    met = spool(near(index(classes(sets))), "near-classes")
    found = cut(verified(docs, _pairs(met.where("doc0 IS NOT NULL")), nearest_first=True))
    asks = cut(met.where("doc0 IS NULL").select(*_PLACE).distinct().join(found, _PLACE, "left_anti"))
    if not asks.isEmpty():
        found = found.union(verified(docs, _pairs(all_earlier(sets, asks)), nearest_first=True))
    return cut(found.union(repeats(sets)).distinct())


def all_earlier(sets: DataFrame, asks: DataFrame) -> DataFrame:
    """Rows as of ``_pairs`` of the classes ``asks`` (doc, line) with all earlier ones, by the words of their prefixes.

    Only index rows of the words that these have are dealt out, a table of bits tells which.
    """
    words = sets.join(asks, _PLACE, "left_semi").select(F.explode("prefix").alias("word"))
    bits = sets.sparkSession.sparkContext.broadcast(wanted(words, ["word"]))
    cols = ["k1", "k2", *_PLACE, "n", *_MAPS]

    def emit(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        prefix = b.column("prefix")
        word, n = prefix.flatten().to_numpy(zero_copy_only=False), prefix.value_lengths().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(n)), n)
        i = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
        ok = np.flatnonzero(_bits_of(bits.value, word))
        yield pa.RecordBatch.from_arrays([pa.array(word[ok]), pa.array(i[ok].astype(np.int32)), *[b.column(c).take(pa.array(row[ok])) for c in cols]],
                                         ["word", "i", *cols])

    rows = sets.select(*cols, "prefix").mapInArrow(_scan(emit), "word long, i int, k1 long, k2 long, doc long, line int, n int, bits long, more long, most long")
    x = cut(rows.groupBy("word", "k1", "k2").agg(F.min(F.struct(*_PLACE, "n", "i", *_MAPS)).alias("m")).select("word", "m.*"))
    earlier = "(x.doc < y.doc OR (x.doc = y.doc AND x.line < y.line))"
    return (x.join(asks, _PLACE, "left_semi").alias("y")
            .join(x.alias("x"), F.expr(f"x.word = y.word AND {earlier} AND {_passes('y.', 'x.')}"))
            .select("y.doc", "y.line", "y.n", F.col("x.doc").alias("doc0"), F.col("x.line").alias("line0"), F.col("x.n").alias("n0"),
                    F.expr(f"{_differ('y.', 'x.')} / (y.n + x.n)").alias("far")))


_CUT = T.StructType([T.StructField("text", T.StringType()), T.StructField("removed", T.LongType())])


@F.arrow_udf(_CUT)
def without_lines(texts: pa.Array, removed: pa.Array) -> pa.Array:
    """Texts without the lines (line, k1) listed for each, and how many these were."""
    raw = [t.as_py() for t in texts.cast(pa.binary())]
    split = [(t or b"").split(b"\n") for t in raw]
    listed = [(i, r["line"], r["k1"]) for i, gone in enumerate(removed.to_pylist()) for r in gone or [] if r["line"] < len(split[i])]
    k1_of = np.zeros(len(listed), np.uint64)
    for line, _, k1, _, _ in line_sets(Lines([split[i][j] for i, j, _ in listed])):
        k1_of[line] = k1
    drops = [set() for _ in raw]
    for (i, j, k1), found in zip(listed, k1_of.view(np.int64).tolist()):
        if k1 == found:
            drops[i].add(j)
    out = []
    for t, kept, drop in zip(raw, split, drops):
        text = b"\n".join(x for j, x in enumerate(kept) if j not in drop).decode("utf-8", "surrogatepass")
        out.append({"text": None if t is None else text, "removed": len(drop)})
    return pa.array(out, pa.struct([("text", pa.string()), ("removed", pa.int64())]))


def dedup_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` with texts without later matches, and columns n_lines (before) and n_removed.

    Lines of at least ``least`` words are compared: by default, all that have a word.

    Documents that no removed line can belong to are passed through; only the others are shuffled, to meet their list.
    """
    aside = {c: f"_own_{i}_{c}" for i, c in enumerate(docs.columns) if c.lower() in ("_key", "_touched", "_doc", "_lines", "_new")}
    docs = with_keys(docs.withColumnsRenamed(aside))
    removed = later_matches(_keyed(docs), least)
    bits = docs.sparkSession.sparkContext.broadcast(wanted(removed, ["doc"]))

    @F.arrow_udf(T.BooleanType())
    def touched(doc: pa.Array) -> pa.Array:
        return pa.array(_bits_of(bits.value, doc.to_numpy(zero_copy_only=False)))

    rest = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed", "_key")]
    n_lines = F.coalesce(F.when(F.col("text").isNotNull(), F.size(F.split("text", "\n"))), F.lit(0)).cast("long")
    d = docs.select(*[F.col(f"`{c}`") for c in rest], "text", n_lines.alias("n_lines"), "_key", touched("_key").alias("_touched"))
    same = d.where("NOT _touched").drop("_key", "_touched").withColumn("n_removed", F.lit(0).cast("long"))
    lists = removed.groupBy(F.col("doc").alias("_doc")).agg(F.collect_set(F.struct("line", "k1")).alias("_lines"))
    met = (d.where("_touched").join(lists, F.col("_key") == F.col("_doc"), "left")
           .withColumn("_new", without_lines("text", "_lines")))
    changed = met.select(*[F.col(f"`{c}`") for c in rest], F.col("_new.text").alias("text"), "n_lines",
                         F.col("_new.removed").alias("n_removed"))
    return same.unionByName(changed).withColumnsRenamed({v: k for k, v in aside.items()})


ORACLE = f"""
WITH l AS (
  SELECT doc_id, i - 1 AS line, txt[i] AS words FROM (
    SELECT doc_id, string_split(text, chr(10)) AS txt, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
    FROM documents WHERE text IS NOT NULL)
), s AS (
  SELECT doc_id, line, words AS raw, list_sort(list_distinct(regexp_extract_all(words, '[^\x20\x09-\x0D]+'))) AS ws FROM l
), c AS (
  SELECT row_number() OVER (ORDER BY min(struct_pack(d := doc_id, l := line))) AS id, ws, len(ws) AS n,
         min(struct_pack(d := doc_id, l := line)) AS first
  FROM s WHERE len(ws) >= {LEAST} GROUP BY ws
), p AS (
  SELECT id, n, ws, unnest(ws[1 : n - ceil({SIMILAR} * n - 1e-9)::INT + 1]) AS w FROM c
), q AS (
  SELECT DISTINCT y.id AS y, x.id AS x FROM p y JOIN p x ON x.w = y.w AND x.id < y.id
  WHERE least(x.n, y.n) >= {SIMILAR} * greatest(x.n, y.n) - 1e-9
), m AS (
  SELECT DISTINCT q.y FROM q JOIN c a ON a.id = q.y JOIN c b ON b.id = q.x
  WHERE len(list_intersect(a.ws, b.ws))::DOUBLE / (a.n + b.n - len(list_intersect(a.ws, b.ws))) >= {SIMILAR}
), r AS (
  SELECT s.doc_id, s.line FROM s JOIN c ON c.ws = s.ws LEFT JOIN m ON m.y = c.id
  WHERE m.y IS NOT NULL OR struct_pack(d := s.doc_id, l := s.line) > c.first
), k AS (
  SELECT l.doc_id, count(*) AS n_lines, count(r.line) AS n_removed,
         coalesce(string_agg(l.words, chr(10) ORDER BY l.line) FILTER (WHERE r.line IS NULL), '') AS text
  FROM l LEFT JOIN r ON r.doc_id = l.doc_id AND r.line = l.line GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       sha256(k.text) AS text_sha256
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id
"""


@register("op2_line_dedup", ORACLE)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents compared with all; counts and a digest of each text that is left."""
    d = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))
