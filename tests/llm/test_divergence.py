"""Divergence of sources against brute force, and the trees on their own."""
from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import op12_divergence as audit

SCHEMA = "doc_id long, text string, lang string, source string"


def terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(rows):
    groups, counts, docs = defaultdict(set), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        groups[lang or ""].add(source or "")
        counts[lang or "", source or ""].update(terms(text))
        docs[lang or ""].update(set(terms(text)))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= 10]
        of = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        of[None] = {t: sum(of[s][t] for s in sources) for t in kept}
        total = {s: sum(c.values()) + 2 * len(kept) for s, c in of.items()}
        p = {s: {t: 1 + floor(Fraction(10**9 * (c[t] + 2), total[s])) for t in kept} for s, c in of.items()}
        far = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = sorted((-sum(far(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            own = sorted((-far(p[s][t], p[None][t]), t.encode()) for t in kept if of[s][t] and p[s][t] > p[None][t])[:10]
            for part, found in (("pair", pairs), ("term", own)):
                out += [(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)]
    return sorted(out)


def found(spark, rows, extra=()):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in extra:
        df = df.withColumn(c, F.lit("x"))
    return sorted(tuple(r) for r in audit.divergence(df).select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(seed, n=260, words=60):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("re", "tion", "É", "漢", "x", "Ab") for b in ("a", "en", "ü", "字", "OR", "s", "lo", "i", "ing", "u")]
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "fr", None, ""]), rng.choice(["s1", "s1", "s1", "s2", "s3", None])
        some = vocabulary[: rng.choice([20, 60])]
        rows.append((i, rng.choice([" ", "\n", ", ", "-7_"]).join(rng.choices(some, k=rng.randrange(words))) if rng.random() < 0.95 else None, lang, source))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    got = found(spark, rows, ("term", "n", "at", "id"))
    assert got == brute(rows) and any(r[2] == "term" for r in got)


def test_many_segments_and_early_hand_over(spark, monkeypatch):
    monkeypatch.setattr(audit, "SEGMENT", 16)
    monkeypatch.setattr(audit, "HELD", 7)
    monkeypatch.setattr(audit, "STEP", 11)
    rows = corpus(5)
    assert found(spark, rows) == brute(rows)


def test_defined_cases(spark):
    rows = [(i, "same words here same", "en", "a") for i in range(10)]  # repeated rows are documents of their own
    rows += [(1, None, "en", "no text"), (2, "12 34 !", "en", "no terms"), (3, "rare", "xx", "b"), (4, "rare", "xx", "c"), (None, "here " * 300_000, "en", "long"),
             (5, "", None, None)]
    got = found(spark, rows)
    assert got == brute(rows)
    assert ("xx", "b", "pair", "c", 0, 1) in got and not any(r[0] == "xx" and r[2] == "term" for r in got)
    assert found(spark, []) == []


def test_shares_are_exact():
    rng = random.Random(1)
    for _ in range(300):
        total = rng.randrange(1, 9 * 10**15)
        c = rng.randrange(0, max(1, total - 1))
        assert int(audit.share(np.array([c]), total)[0]) == 1 + 10**9 * (c + 2) // total


@pytest.mark.parametrize("width", [1, 2, 5, 16, 33])
def test_forest(width):
    rng = np.random.default_rng(width)
    counts = rng.choice([0, 0, 0, 0, 1, 2, 7], size=(5, width))
    counts[3] = counts[1]
    forest = audit.Forest(counts)
    assert forest.root[1] == forest.root[3]
    others = np.array([1, 3, 4])
    which, x, y, times = forest.meet(0, others)
    got = Counter({(int(w), int(a), int(b)): int(t) for w, a, b, t in zip(which, x, y, times) if a >= 0})
    assert got == Counter((w, int(a), int(b)) for w, o in enumerate(others) for a, b in zip(counts[0], counts[o]))
    at, x, y = forest.places(2, 4)
    assert sorted(zip(at, x, y)) == [(i, counts[2, i], counts[4, i]) for i in range(width) if counts[2, i]]


def test_equal_subtrees_are_one_node():
    forest = audit.Forest(np.tile([0, 1, 0, 1, 5, 0, 0, 1], (4, 64)))
    assert len(forest.leaf) == 3 and all(len(left) <= 4 for left, _ in forest.levels) and len(set(forest.root)) == 1
    assert len(forest.meet(0, np.array([1, 2]))[0]) == 6  # three pairs of counts with each, however wide the rows
