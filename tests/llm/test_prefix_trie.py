"""The trie of conversation openings against brute force."""
from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quayside.llm import op13_prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def paths(rows):
    """conv_id -> its rebuilt turns, by the rules of the query."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def brute(rows):
    members = defaultdict(list)
    convs = paths(rows)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * words(node[-1][1]) if node else 0
        kids = children[node]
        below[node] = (sum(below[k][0] for k in kids) or 1, own + sum(below[k][1] for k in kids))
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), *below[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def built(spark, rows, extra=()):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in extra:
        df = df.withColumn(c, F.lit("x"))
    turns, convs = trie.rebuilt(trie.in_order(df))
    return sorted(map(tuple, trie.prefix_trie(turns, convs).select(*COLUMNS).collect()), key=repr)


def random_rows(seed, n=130):
    rng = random.Random(seed)
    texts = ["yes", "no way", "a b  c", "", None, "long answer of six words here"]
    rows = []
    for c in range(n):
        if rng.random() < 0.1:
            continue
        for turn in range(rng.randrange(1, 14)):
            rows.append((c * rng.choice([1, 1, 1, -1]), turn, rng.choice(["user", "user", "user", None]), rng.choice(texts[: rng.choice([1, 2, 6])])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rows = random_rows(seed)
    assert built(spark, rows) == brute(rows)


def test_two_levels_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "SPAN", 2)
    monkeypatch.setattr(trie, "PIECE", 3)
    rows = [(c, t, "user", f"word {t}" if t < 70 else f"own {c % 3}") for c in range(12) for t in range(40 + 7 * (c % 6))]
    assert built(spark, rows) == brute(rows)


def test_defined_cases(spark):
    rows = [(None, 1, "user", "no conversation"), (0, None, "user", "null first"), (0, 1, "b", "tie"), (0, 1, "a", "tie"), (0, 1, "a", "tie"),
            (1, 2, None, None), (2, 5, "user", "repeat"), (2, 5, "user", "repeat"), (45, 1, "user", "its head is absent"),
            (-7, 1, "user", "negative"), (46, 0, "", ""), (63, 1, "ab", "c"), (64, 1, "a", "bc"), (3, 1, "user", "\x00 é 漢字 " * 30_000)]
    assert built(spark, rows, ("pos", "a", "_part", "TURN_", "n")) == brute(rows)
    assert any(not ts for ts in paths(rows).values())  # a conversation whose own turns are replaced by none


def test_all_conversations_equal(spark):
    rows = [(c, t, "user", "same words") for c in range(0, 4000, 20) for t in range(5)]
    got = built(spark, rows)
    assert got == brute(rows) and len(got) == 6
    assert got[-1][3] == 200


def test_turnless_and_empty(spark):
    assert built(spark, []) == []
    turnless = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)  # its only turn goes, and there is no head
    rows = [(turnless, 0, "user", "goes")]
    assert built(spark, rows) == brute(rows) == [(turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())]


def test_a_group_over_many_partitions_is_numbered_whole(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(5, t, "r", f"t{t}") for t in range(5000)] + [(6, 0, "r", "one")] + [(7, t, "r", "x") for t in range(20)]
        df = trie.in_order(spark.createDataFrame(rows, SCHEMA).repartition(5))
        got = {(r["conv_id"], r["pos"]) for r in df.collect()}
        assert got == {(c, t) for c, t, _, _ in rows}
        want = {(r["conv_id"], r["turn"]): r["a"] for r in spark.createDataFrame(rows, SCHEMA).select("conv_id", "turn", F.xxhash64("role", "text").alias("a")).collect()}
        assert {(r["conv_id"], r["pos"]): r["a"] for r in df.collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
