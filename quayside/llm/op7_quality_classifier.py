"""Quality classifier: Bradley-Terry ranking of documents, cut at a quantile of the scores.

Features are statistics of the whole text. All labelled documents are compared in preference pairs (a good one, a bad one),
and weights are fitted by logistic loss on the differences of their features, so that the probability that a document
is preferred is the logistic function of the difference of the scores. The cut is the quantile of all labelled scores
that leaves below it the share of bad labels; scores are shifted so that the cut comes to 0.3, and mapped to (0, 1).

Labelled documents are dealt out, in hash order of the id, to blocks of about ``BLOCK`` documents, each with its share of
either label (of a label with fewer documents than there are blocks, a document is in several). A block draws ``PAIRS`` pairs,
and one more for each document that no draw took, so every labelled document is compared. Newton's method sums gradients
and Hessians over the blocks, which come to the driver as some hundred numbers a block; features, the places of documents
and of the cut are found in the tasks.

Defined cases: a null text counts as empty and is scored like any other; labels that are null, and labels without a
document, are ignored; with labels of one kind only, or none, every score is 0.5; repeated rows are each scored (and,
if labelled, each drawn); the score depends on nothing but the text; an empty table gives an empty result.
"""
from __future__ import annotations

import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import cut, numbered, spool, table
from quayside.llm.registry import register

#: Labelled documents of a block, about, and pairs that it draws; the score from which a document counts as good.
BLOCK, PAIRS, GOOD = 20_000, 100_000, 0.3
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>"
FEATURES = ("log_words", "word_length", "symbols", "exclaims", "upper", "digits", "dup_lines", "doubled", "unique", "line_length")


def text_features(text: str | None) -> list[float]:
    """The features of one text, in the order of ``FEATURES``; all 0 without words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    size = len(raw) - count(b" \t\n\x0b\x0c\r")
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [np.log1p(n), min(size / n, 20.0), min(count(_SYMBOLS) / n, 1.0), min(raw.count(b"!") / n, 1.0),
            count(_UPPER) / size, count(_DIGITS) / size, 1 - len(set(lines)) / len(lines),
            sum(map(operator.eq, words, words[1:])) / n, len(set(words)) / n, np.log1p(n / len(lines))]


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def features(texts: pa.Array) -> pa.Array:
    """Features of each text of a column."""
    return pa.array([text_features(t.as_py()) for t in texts], pa.list_(pa.float64()))


@dataclass
class Model:
    """A linear score of the features, as log odds of a good document against one at the cut."""
    weights: list[float]
    bias: float

    def score(self, x: Column) -> Column:
        total = F.lit(self.bias)
        for i, w in enumerate(self.weights):
            total = total + F.lit(w) * F.get(x, F.lit(i))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def moments(own: np.ndarray) -> np.ndarray:
    """Count, means and sums of squared deviations of some rows."""
    mean = own.mean(axis=0) if len(own) else np.zeros(len(FEATURES))
    return np.concatenate([[len(own)], mean, ((own - mean) ** 2).sum(axis=0)])


def _merged(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of all rows from the moments of their parts."""
    n, mean, squares = 0.0, np.zeros(len(FEATURES)), np.zeros(len(FEATURES))
    for p in parts:
        more, m, sq = p[0], *np.split(p[1:], 2)
        if more:
            squares += sq + (m - mean) ** 2 * n * more / (n + more)
            mean, n = mean + (m - mean) * more / (n + more), n + more
    return mean, np.sqrt(squares / n)


def drawn(good: int, bad: int, pairs: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places among the good and the bad: ``pairs`` draws, and one more for each place that no draw took."""
    rng = np.random.default_rng(seed)
    a, b = rng.choice(good, pairs), rng.choice(bad, pairs)
    more_a, more_b = np.setdiff1d(np.arange(good), a), np.setdiff1d(np.arange(bad), b)
    return np.concatenate([a, more_a, rng.choice(good, len(more_b))]), np.concatenate([b, rng.choice(bad, len(more_a)), more_b])


def slopes(good: np.ndarray, bad: np.ndarray, w: np.ndarray, pairs: int, seed: int) -> np.ndarray:
    """Number of pairs, gradient and Hessian of the loss at ``w``, summed over the pairs of a block."""
    a, b = drawn(len(good), len(bad), pairs, seed)
    d = good[a] - bad[b]
    p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))  # probability of the wrong order
    return np.concatenate([[len(d)], -(p @ d), ((d * (p * (1 - p))[:, None]).T @ d).ravel()])


#: What runs a function of a block (its number, features of the good, of the bad, and of those that count here) on all blocks.
EachBlock = Callable[[Callable[[int, np.ndarray, np.ndarray, np.ndarray], np.ndarray]], list[np.ndarray]]


def _weights(each: EachBlock, pairs: int, ridge: float, seed: int) -> np.ndarray:
    """Bradley-Terry weights of the features from all blocks."""
    center, scale = _merged(each(lambda _, good, bad, own: moments(own)))
    scale = np.maximum(scale, 1e-6)
    w = np.zeros(len(FEATURES))
    for _ in range(50):  # Newton's method
        at = w
        total = sum(each(lambda i, good, bad, own: slopes((good - center) / scale, (bad - center) / scale, at, pairs, seed + i)))
        n, slope, curve = total[0], total[1:1 + len(w)], total[1 + len(w):].reshape(len(w), len(w))
        step = np.linalg.solve(curve / n + ridge * np.eye(len(w)), slope / n + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def _model(weights: np.ndarray, at: float) -> Model:
    """The model whose score is ``GOOD`` where the weighted features come to ``at``."""
    return Model(weights.tolist(), float(-at + np.log(GOOD / (1 - GOOD))))


def fit(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3, seed: int = 7) -> Model:
    """The model of one block of labelled features (rows of ``x``)."""
    if not good.any() or good.all():
        return Model([0.0] * len(FEATURES), 0.0)
    weights = _weights(lambda f: [f(0, x[good], x[~good], x)], pairs, ridge, seed)
    s = np.sort(x @ weights)
    k = int((~good).sum())  # the quantile of the share of bad labels, halfway to the next score
    return _model(weights, (s[k - 1] + s[k]) / 2)


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is for testing: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and features (x) of all documents, written."""
    return spool(docs.select("doc_id", features("text").alias("x")), "features")


def _blocks(placed: DataFrame, goods: int, bads: int, size: int) -> EachBlock:
    """Blocks of rows good, p (place among those of the same label) and x: one written row each, read by all passes."""
    blocks = -(-(goods + bads) // size)
    n = F.when(F.col("good"), F.lit(goods)).otherwise(F.lit(bads))
    # place p of n goes to block p * blocks / n, or to all blocks from there to before that of p + 1
    first = F.expr(f"p * {blocks}L div _n")
    last = F.when(n >= blocks, F.col("_first")).otherwise(F.expr(f"(p + 1) * {blocks}L div _n - 1"))
    dealt = placed.withColumn("_n", n).withColumn("_first", first).withColumn("block", F.explode(F.sequence("_first", last)))
    rows = F.sort_array(F.collect_list(F.struct("good", "p", (F.col("block") == F.col("_first")).alias("own"), "x")))
    packed = cut(dealt.groupBy("block").agg(rows.alias("rows")))

    def each(f):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for block, rows in zip(b.column("block").to_pylist(), b.column("rows")):
                    good, _, own, x = rows.values.flatten()
                    x = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
                    good, own = (c.to_numpy(zero_copy_only=False) for c in (good, own))
                    out = f(block, x[good], x[~good], x[own])
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([out.tolist()], pa.list_(pa.float64()))], ["block", "out"])

        found = packed.mapInArrow(run, "block long, out array<double>").collect()
        return [np.array(r["out"]) for r in sorted(found, key=lambda r: r["block"])]

    return each


def learn(x: DataFrame, labels: DataFrame, block: int = BLOCK) -> Model:
    """A model from features (as of ``measured``) and labels (doc_id, quality) of all documents that aren't held out."""
    known = labels.where("quality IN (0, 1)").where(~held_out(F.col("doc_id"))).select("doc_id", (F.col("quality") == 1).alias("good"))
    rows = x.join(known, "doc_id").select("doc_id", "good", "x")
    placed = cut(numbered(rows, ["good"], [F.xxhash64("doc_id"), F.col("doc_id"), F.col("x")], "p", [F.col("x")]))
    count = {r["good"]: r["count"] for r in placed.groupBy("good").count().collect()}
    goods, bads = count.get(True, 0), count.get(False, 0)
    if not goods or not bads:
        return Model([0.0] * len(FEATURES), 0.0)
    weights = _weights(_blocks(placed, goods, bads, block), PAIRS, 1e-3, 7)
    total = sum((F.lit(float(w)) * F.get("x", F.lit(i)) for i, w in enumerate(weights)), F.lit(0.0))
    ranked = numbered(placed.select(F.lit(0).alias("_all"), total.alias("s")), ["_all"], [F.col("s")], "at", [F.col("s")])
    # the quantile of the share of bad labels, halfway to the next score
    around = [r["s"] for r in ranked.where(F.col("at").isin(bads - 1, bads)).collect()]
    return _model(weights, sum(around) / 2)


def train(docs: DataFrame, labels: DataFrame, block: int = BLOCK) -> Model:
    """A model from documents (doc_id, text) and labels (doc_id, quality) of documents that aren't held out."""
    return learn(measured(docs), labels, block)


def with_score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``score``, which an existing one of that name gives way to."""
    return (docs.withColumn("_features", features("text")).withColumn("score", model.score(F.col("_features")))
            .drop("_features"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    x = measured(docs)
    return x.withColumn("score", learn(x, labels).score(F.col("x"))).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= GOOD, 1).otherwise(0).alias("predicted"))


@register("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
