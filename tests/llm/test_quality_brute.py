"""The quality classifier against a plain version: features by characters, weights by descent, the cut by counting."""
from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow.dataset as ds
import pytest

from quayside.llm import op7_quality_classifier as op7

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def slow_features(text):
    words, lines = [], []
    for line in (text or "").split("\n"):
        found, word = [], ""
        for c in line + " ":
            if c in SPACE:
                found += [word] if word else []
                word = ""
            else:
                word += c
        words += found
        # a line counts if it holds anything but white space, and is compared as it stands
        lines += [line] if found else []
    n = len(words)
    if not n:
        return [0.0] * 10
    size = sum(len(w.encode()) for w in words)
    share = lambda chars: sum(c in chars for w in words for c in w)
    return [math.log(1 + n), min(size / n, 20.0), min(share("#*$%&|<>") / n, 1.0), min(share("!") / n, 1.0),
            share("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / size, share("0123456789") / size, (len(lines) - len(set(lines))) / len(lines),
            sum(a == b for a, b in zip(words, words[1:])) / n, len(set(words)) / n, math.log(1 + n / len(lines))]


def slow_weights(z, good, pairs, ridge=1e-3, seed=7):
    """The minimum of the mean logistic loss of the drawn pairs and the ridge, by plain descent; equal pairs are counted."""
    rng = np.random.default_rng(seed)
    drawn = np.stack([rng.choice(np.flatnonzero(good), pairs), rng.choice(np.flatnonzero(~good), pairs)])
    (a, b), times = np.unique(drawn, axis=1, return_counts=True)
    d, share = z[a] - z[b], times / pairs
    w = momentum = np.zeros(z.shape[1])
    rate = 1 / (ridge + np.linalg.eigvalsh((d * share[:, None]).T @ d).max() / 4)
    for k in range(200_000):
        wrong = 1 / (1 + np.exp(np.clip(d @ momentum, -500, 500)))
        gradient = ridge * momentum - (share * wrong) @ d
        new = momentum - rate * gradient
        if gradient @ (new - w) > 0:  # restart, the momentum went too far
            momentum = w
            continue
        momentum, w = new + k / (k + 3) * (new - w), new
        if np.abs(gradient).max() < 1e-11:
            break
    return w


def slow_scores(texts, labels):
    """doc -> score; ``labels`` are (doc, quality) pairs, of documents that aren't held out."""
    known = [(doc, q) for doc, q in labels if q in (0, 1) and doc in texts and zlib.crc32(str(doc).encode()) % 5]
    x = {doc: np.array(slow_features(t)) for doc, t in texts.items()}
    rows = op7_order(known)
    features = np.array([x[doc] for doc, _ in rows])
    good = np.array([q == 1 for _, q in rows])
    center, scale = features.mean(axis=0), np.maximum(features.std(axis=0), 1e-6)
    w = slow_weights((features - center) / scale, good, op7.PAIRS)
    value = {doc: float((v - center) / scale @ w) for doc, v in x.items()}
    ranked = sorted(value[doc] for doc, _ in rows)
    bad = sum(not g for g in good)
    cut = (ranked[bad - 1] + ranked[bad]) / 2
    odds = math.log(0.3 / 0.7)
    return {doc: 1 / (1 + math.exp(-(v - cut + odds))) for doc, v in value.items()}, known, value, cut


def op7_order(known):
    """The labelled documents in the order of the draw: by the session's hash of the id, which the caller provides."""
    return sorted(known, key=lambda r: (HASH[r[0]], r[0], r[1]))


HASH: dict[int, int] = {}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a a  b!\n\nA1 #x\na a  b!\n", "Ärger! 漢字\x0bx|y $5", "w " * 3000, "\x0c\n \nq\r\nq\r"])
def test_features(text):
    assert op7.text_features(text) == pytest.approx(slow_features(text), abs=1e-12)


def test_query_against_the_plain_version(spark):
    docs = ds.dataset(f"{SF}/documents.parquet").to_table(columns=["doc_id", "text"]).to_pydict()
    labels = ds.dataset(f"{SF}/labels.parquet").to_table(columns=["doc_id", "quality"]).to_pydict()
    texts = dict(zip(docs["doc_id"], docs["text"]))
    HASH.update({r[0]: r[1] for r in spark.createDataFrame([(d,) for d in texts], "doc_id long").selectExpr("doc_id", "xxhash64(doc_id)").collect()})
    want, known, value, cut = slow_scores(texts, list(zip(labels["doc_id"], labels["quality"])))
    got = {r["doc_id"]: r for r in op7.op7_quality_classifier(spark, SF).collect()}
    assert set(got) == set(want) and len(known) > 10
    for doc, r in got.items():
        assert r["score"] == pytest.approx(want[doc], abs=1e-6)
        assert r["held_out"] == (zlib.crc32(str(doc).encode()) % 5 == 0)
        assert r["predicted"] == (r["score"] >= 0.3)
    # the cut leaves as many labelled documents below it as there are bad ones
    assert sum(got[doc]["score"] < 0.3 for doc, _ in known) == sum(q == 0 for _, q in known)


def test_all_labelled_documents_teach(spark):
    """The first 20,000 in hash order all have label 1: only the others tell what a bad text is."""
    ids = spark.range(24_000).selectExpr("id AS doc_id").orderBy("doc_id")
    rank = {r["doc_id"]: i for i, r in enumerate(ids.where(~op7.held_out(ids.doc_id)).selectExpr("doc_id", "xxhash64(doc_id) AS h").orderBy("h").collect())}
    more = spark.range(24_000, 27_000).selectExpr("id AS doc_id")
    late = {r["doc_id"] for r in more.where(~op7.held_out(more.doc_id)).collect()}
    biggest = max(rank, key=rank.get)
    h = {r["doc_id"]: r["h"] for r in ids.union(more).selectExpr("doc_id", "xxhash64(doc_id) AS h").collect()}
    order = sorted([*rank, *late], key=h.get)
    assert len(order) > 21_000 and biggest in rank
    quality = {d: int(i < 20_500) for i, d in enumerate(order)}
    docs = spark.createDataFrame([(d, "plain words in a row" if q else "LOUD! #1 $$ WORDS!!") for d, q in quality.items()], "doc_id long, text string")
    got = op7.classify(docs, spark.createDataFrame(list(quality.items()), "doc_id long, quality int")).collect()
    assert all(r["predicted"] == quality[r["doc_id"]] for r in got) and len(got) == len(quality)


def test_blocks_together_are_one_fit(spark):
    """Many small blocks, more than there are bad labels: nearly the model of one block, and the same cut."""
    rng = np.random.default_rng(3)
    quality = {i: int(rng.random() < 0.9) for i in range(400)}
    word = lambda i: " ".join(rng.choice(["alpha", "BETA", "x1", "y!", "# z"], 30, p=[0.6, 0.1, 0.1, 0.1, 0.1] if quality[i] else [0.3, 0.3, 0.1, 0.2, 0.1]))
    docs = spark.createDataFrame([(i, word(i)) for i in quality], "doc_id long, text string").cache()
    labels = spark.createDataFrame(list(quality.items()), "doc_id long, quality int")
    one, many = op7.train(docs, labels), op7.train(docs, labels, block=5)
    used = {i: q for i, q in quality.items() if zlib.crc32(str(i).encode()) % 5}
    assert len(used) / 5 > sum(q == 0 for q in used.values())
    score = {r["doc_id"]: (r["a"], r["b"]) for r in docs.select("doc_id", one.score(op7.features("text")).alias("a"), many.score(op7.features("text")).alias("b")).collect()}
    for k in (0, 1):
        assert sum(score[i][k] < 0.3 for i in used) == sum(q == 0 for q in used.values())
    assert np.corrcoef(*np.array(list(score.values())).T)[0, 1] > 0.9
    good, bad = op7.drawn(50, 20_000, 1000, 1)
    assert set(good) == set(range(50)) and set(bad) == set(range(20_000)) and len(good) == len(bad)
