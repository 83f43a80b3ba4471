"""Near-duplicates of documents, lines and embeddings against brute force."""
from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
import xxhash

from quayside.llm import graph, op2_line_dedup, op5_embedding_dedup, op9_simhash
from quayside.llm.linetokens import Lines, _order


def classes(n, linked):
    """Smallest member of the class of each of 0..n-1."""
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
    return root


# --- components -------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(1, 2), (2, 1), (1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)],
    [(59, i) for i in range(59)], [(5, 9), (9, 7), (1, 2), (3, 2), (2**62, -(2**62))]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["u"]: r["v"] for r in graph.components(df).collect()}
    nodes = sorted({x for e in edges for x in e})
    root = classes(len(nodes), [(nodes.index(a), nodes.index(b)) for a, b in edges])
    assert got == {x: nodes[root[i]] for i, x in enumerate(nodes) if root[i] != i}


# --- SimHash ----------------------------------------------------------------------------------------------------

def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    grams = [" ".join(words[i: i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "Ärger İst ÀB", "a b c d e f a b c", "x\x0by\x0cz w q", "w " * 70_000])
def test_fingerprint(text):
    want = slow_fingerprint(text)
    assert op9_simhash.fingerprint(text) == want


def near_points(rng, groups):
    out = set()
    for _ in range(groups):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 5, 40])):
            x = base
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("shard", [10**6, 40])
def test_links_of_points(spark, monkeypatch, shard):
    monkeypatch.setattr(op9_simhash, "SHARD", shard)
    monkeypatch.setattr(op9_simhash, "LEAF", 8)
    points = near_points(random.Random(5), 60)
    signed = [x - (1 << 64) if x >> 63 else x for x in points]
    order = sorted(range(len(points)), key=lambda i: signed[i])
    linked = [(a, b) for a, b in itertools.combinations(range(len(order)), 2)
              if bin(points[order[a]] ^ points[order[b]]).count("1") <= 2]
    root = classes(len(order), linked)
    want = {signed[order[i]]: signed[order[r]] for i, r in enumerate(root) if i != r}
    got = {r["u"]: r["v"] for r in op9_simhash.link_points(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    assert got == want and want


def test_every_pair_meets_in_a_shard_of_either():
    points = np.array(near_points(random.Random(9), 80), np.uint64)
    tree = op9_simhash.fit_tree(points[::3], 5)
    home, seen = {}, {}
    for shard, at, own in op9_simhash.route(tree, points, 2):
        for i, o in zip(at, own):
            seen.setdefault(i, set()).add(shard)
            if o:
                assert i not in home
                home[i] = shard
    assert len(home) == len(points) and len(set(home.values())) > 4
    for a, b in itertools.combinations(range(len(points)), 2):
        if bin(int(points[a]) ^ int(points[b])).count("1") <= 2:
            assert home[a] in seen[b] and home[b] in seen[a]


def test_large_shards_are_split_again(spark, monkeypatch):
    """With a sample that makes few shards, the others come from splitting: all of bounded size, and no pair is lost."""
    for name, value in (("SAMPLE", 64), ("SHARD", 40), ("ROOM", 4), ("PIECE", 100), ("LEAF", 8)):
        monkeypatch.setattr(op9_simhash, name, value)
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 900, dtype=np.uint64) * np.uint64(2)
    near = base[:300] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    points = np.unique(np.concatenate([base, near]))
    df = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    seen = []
    split = op9_simhash.split_large

    def watched(dealt, bits):
        seen.append((dealt, out := split(dealt, bits)))
        return out

    monkeypatch.setattr(op9_simhash, "split_large", watched)
    got = {r["u"]: r["v"] for r in op9_simhash.link_points(df).collect()}
    pairs = [(a, b) for a, b in itertools.combinations(range(len(points)), 2) if bin(int(points[a]) ^ int(points[b])).count("1") <= 2]
    signed = [int(p) for p in points.view(np.int64)]
    order = sorted(range(len(points)), key=lambda i: signed[i])
    place = {i: k for k, i in enumerate(order)}
    root = classes(len(points), [(place[a], place[b]) for a, b in pairs])
    want = {signed[i]: signed[order[root[place[i]]]] for i in range(len(points)) if order[root[place[i]]] != i}
    assert got == want and len(pairs) >= 200
    (before, after), = seen
    largest = lambda d: max(r["count"] for r in d.groupBy("shard").count().collect())
    assert largest(before) > 400 and largest(after) < largest(before) / 2
    homes = after.where("home").groupBy("fp").count()
    assert homes.count() == len(points) and homes.where("count <> 1").count() == 0


def test_simhash_cases(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(5, text, 1), (3, text, 2), (3, text, 3), (9, text + " tail", 4), (None, text, 5), (7, "other words here", 6),
            (2, None, 7), (1, "", 8), (8, " \n ", 9), (None, "alone " * 4, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["fingerprint"], r["component_id"])
                 for r in op9_simhash.near_duplicates(docs).collect())
    fps = [slow_fingerprint(t) for _, t, _ in rows]
    root = classes(len(rows), [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if bin(fps[a] ^ fps[b]).count("1") <= 2])
    least = {}
    for (i, _, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted((i if i is not None else -1, f"{f:016x}", least.get(r)) for (i, _, _), f, r in zip(rows, fps, root))
    assert got == want
    assert op9_simhash.near_duplicates(docs.limit(0)).count() == 0


def test_simhash_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    fps = [slow_fingerprint(t) for _, t in rows]
    root = classes(len(rows), [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if bin(fps[a] ^ fps[b]).count("1") <= 2])
    want = sorted((i, f"{f:016x}", rows[r][0]) for (i, _), f, r in zip(rows, fps, root))
    assert sorted(tuple(r) for r in op9_simhash.near_duplicates(docs).collect()) == want


# --- lines ------------------------------------------------------------------------------------------------------

def slow_line_dedup(rows):
    """(id, text) -> sorted (id, n_lines, n_removed, text); ids are distinct."""
    places = sorted((i if i is not None else -math.inf, n, frozenset(x.encode().split()), x)
                    for i, t in rows if t is not None for n, x in enumerate(t.split("\n")))
    gone = set()
    for b, (i, n, ws, _) in enumerate(places):
        if ws and any(o and len(ws & o) / len(ws | o) >= 0.8 and (j, m) < (i, n) for j, m, o, _ in places[:b]):
            gone.add((i, n))
    out = []
    for i, t in rows:
        lines = t.split("\n") if t is not None else []
        kept = [x for n, x in enumerate(lines) if (i if i is not None else -math.inf, n) not in gone]
        out.append((i, len(lines), len(lines) - len(kept), None if t is None else "\n".join(kept)))
    return sorted(out, key=repr)


def line_result(spark, rows, schema="doc_id long, text string"):
    d = op2_line_dedup.dedup_lines(spark.createDataFrame(rows, schema))
    return sorted(((r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in d.collect()), key=repr)


def test_lines_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "x|y", "W1"]
    base = [rng.sample(vocabulary, rng.choice([3, 5, 6, 10, 20, 40])) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(6)):
            words = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rng.shuffle(words)
            lines.append(rng.choice([" ", "\t", "  "]).join(words) + rng.choice(["", " ", "\r"]))
        rows.append((i * 3 - 50, "\n".join(lines)))
    rows += [(1000, None), (1001, ""), (1002, "\n\n"), (None, " ".join(base[3])), (1003, " ".join(base[3]) + "\n" + " ".join(base[3]))]
    got, want = line_result(spark, rows), slow_line_dedup(rows)
    assert got == want and sum(r[2] for r in want) > 30


def test_similarity_at_the_threshold(spark):
    a = [f"a{i}" for i in range(9)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:8] + ["b"])),  # 8 of 10: equal to the threshold
            (3, " ".join(f"c{i}" for i in range(8))), (4, " ".join([f"c{i}" for i in range(7)] + ["d"]))]  # 7 of 9
    assert [r[2] for r in line_result(spark, rows)] == [0, 1, 0, 0]


def test_repeated_rows_are_one_document(spark):
    line = "one two three four five six"
    got = line_result(spark, [(1, line), (1, line), (2, line), (3, "seven\n" + line)])
    assert got == sorted([(1, 1, 0, line), (1, 1, 0, line), (2, 1, 1, ""), (3, 2, 1, "seven")], key=repr)
    # two texts of one id: a line is removed from the text that has it, not from the other
    got = line_result(spark, [(0, line), (5, line), (5, "quite another line with enough words")])
    assert (5, 1, 0, "quite another line with enough words") in got and (5, 1, 1, "") in got


@pytest.mark.parametrize("least", [-(1 << 63), -3, 0])
def test_rows_without_an_id_are_documents_of_their_own(spark, least):
    """They come first, by the hash of their texts; of full copies one stays, wherever ids leave room for numbers."""
    rng = random.Random(least)
    base = [[f"u{g}-{i}" for i in range(12)] for g in range(6)]
    texts = ["\n".join(" ".join(rng.sample(b, rng.choice([10, 12, 12]))) for b in rng.sample(base, 3)) for _ in range(20)]
    texts += [texts[0]] * 5 + ["", "\n", None, None]
    rows = [(None, t) for t in texts] + [(least, texts[0]), (least + 1, "quite new words here"), (7, texts[1])]
    order = sorted((t for t in texts if t is not None), key=lambda t: (xxhash.xxh64(t.encode(), seed=42).intdigest() ^ 1 << 63))
    numbers = [(n - len(order) - 1, t) for n, t in enumerate(order)]
    place = {least: 0, least + 1: 1, 7: 2}
    want = slow_line_dedup(numbers + [(place[i], t) for i, t in rows if i is not None])
    back = {v: k for k, v in place.items()}
    want = sorted([(back.get(i), *r) for i, *r in want] + [(None, 0, 0, None)] * 2, key=repr)
    got = line_result(spark, rows)
    assert got == want
    assert sum(i is None and n == gone == 3 for i, n, gone, _ in got) >= 5  # all but one of the copies lost all lines


def test_group_of_variants(spark):
    """A large group in which only some variants match the earliest: the rest must meet the others."""
    rng = random.Random(6)
    base = [f"v{i}" for i in range(30)]
    rows = []
    for i in range(80):
        words = list(base)
        for j in rng.sample(range(30), rng.choice([1, 2, 3, 4, 5])):
            words[j] = f"n{i}-{j}"
        rows.append((i, " ".join(words)))
    assert line_result(spark, rows) == slow_line_dedup(rows)


def candidates(monkeypatch):
    """The numbers of pairs that are verified, filled in as lines are compared."""
    found, verified = [], op2_line_dedup.verified

    def counted(docs, pairs, **options):
        found.append(pairs.count())
        return verified(docs, pairs, **options)

    monkeypatch.setattr(op2_line_dedup, "verified", counted)
    return found


def test_long_lines_that_only_share_words_are_no_candidates(spark, monkeypatch):
    """Of some 180 words, which fill 64 bits: pairs must not grow with the square of the lines that share words."""
    rng = random.Random(11)
    vocabulary = [f"l{i}" for i in range(700)]
    lines = [" ".join(rng.sample(vocabulary, rng.randrange(170, 190))) for _ in range(60)]
    words = lines[0].split()
    lines += [" ".join(words[:-12] + [f"new{i}" for i in range(12)]), " ".join(words[10:])]  # both match the first
    rows = list(enumerate(lines))
    found = candidates(monkeypatch)
    assert line_result(spark, rows) == slow_line_dedup(rows)
    assert 2 <= sum(found) <= 60


def test_variants_that_drift_meet_the_line_before(spark, monkeypatch):
    """Each matches the one before, few the earliest: they need not meet all earlier ones, of which there are 7,140."""
    rng = random.Random(12)
    words, rows = [f"d{i}" for i in range(60)], []
    for i in range(120):
        for j in rng.sample(range(60), 3):
            words[j] = f"x{i}-{j}"
        rows.append((i, " ".join(words)))
    found = candidates(monkeypatch)
    got = line_result(spark, rows)
    assert got == slow_line_dedup(rows) and sum(r[2] for r in got) == 119
    assert sum(found[1:]) == 0 and found[0] <= 3 * 120


@pytest.mark.parametrize("before, nearest, rows", [(1, 1, 4), (2, 3, 7), (3, 1, 1 << 16)])
def test_what_is_out_of_reach_is_met_later(spark, monkeypatch, before, nearest, rows):
    """Few classes met at once, few of them kept, words over several runs of rows: the others are met in the second join."""
    for name, value in (("BEFORE", before), ("NEAREST", nearest), ("ROWS", rows)):
        monkeypatch.setattr(op2_line_dedup, name, value)
    rng = random.Random(before)
    vocabulary = [f"r{i}" for i in range(14)]
    base = [vocabulary[a:] + [f"b{a}-{i}" for i in range(14 + a)] for a in range(6)]
    docs = []
    for i in range(90):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5])):
            words[rng.randrange(len(words))] = f"n{i}-{rng.randrange(3)}"
        docs.append((i, " ".join(words) + rng.choice(["", "\n" + " ".join(rng.choice(base))])))
    found = candidates(monkeypatch)
    assert line_result(spark, docs) == slow_line_dedup(docs)
    assert len(found) == 2 and found[1] > 0


def test_texts_are_scanned_three_times(spark, monkeypatch):
    """For the counts of words, the sets and the lines to verify: repeats and second candidates need no scan of their own."""
    kind = type(spark.range(1))
    scans, scan = [], kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda d, *a, **k: (scans.append(d.columns), scan(d, *a, **k))[1])
    rng = random.Random(3)
    base = [f"v{i}" for i in range(30)]
    rows = []
    for i in range(40):
        words = list(base)
        for j in rng.sample(range(30), rng.choice([0, 1, 3, 5])):
            words[j] = f"n{i}-{j}"
        rows.append((i, " ".join(words)))
    assert line_result(spark, rows) == slow_line_dedup(rows)
    assert scans.count(["doc", "text"]) == 3


def test_words_cut_in_pieces_hash_alike():
    """A word's hash does not depend on its place, nor the order of a set on how it is sorted."""
    rng = np.random.default_rng(5)
    words = ["é", "a", "b|c", "z" * 70_000, *(f"w{i}" for i in range(3000))]
    mixed = words * 20
    random.Random(5).shuffle(mixed)
    text = "\t".join(mixed)
    lines = Lines([text.encode(), b"", b" \n\n b|c\x0bz a\r", "\n".join(words).encode()])
    hashes, at = {}, np.concatenate([h for _, h in lines.tokens()])
    for word, h in zip(text.split() + ["b|c", "z", "a"] + words, at):
        assert hashes.setdefault(word, h) == h
    assert len(set(hashes.values())) == len(hashes)
    line = np.sort(rng.integers(0, 50, 4000))
    rank = rng.integers(0, 1 << 17, 4000).astype(np.uint64)  # alike in the leading bits
    order = _order(line, rank)
    assert (line[order] == line).all() and (rank[order] == rank[np.lexsort((rank, line))]).all()


def test_line_dedup_of_nothing_and_other_columns(spark):
    d = spark.createDataFrame([(1, "a b c d e", "keep", 7, 5), (2, "a b c d e", None, 8, 6)], "doc_id long, text string, doc string, line int, _key int")
    out = op2_line_dedup.dedup_lines(d)
    assert out.columns == ["doc_id", "doc", "line", "_key", "text", "n_lines", "n_removed"]
    assert sorted(map(tuple, out.collect())) == [(1, "keep", 7, 5, "a b c d e", 1, 0), (2, None, 8, 6, "", 1, 1)]
    assert op2_line_dedup.dedup_lines(d.limit(0)).count() == 0


def test_a_very_long_line(spark):
    long = " ".join(f"t{i}" for i in range(150_000))
    got = line_result(spark, [(1, long), (2, long + " more"), (3, "z" * 3_000_000)])
    assert [(r[0], r[2]) for r in got] == [(1, 0), (2, 1), (3, 0)]


# --- embeddings -------------------------------------------------------------------------------------------------

def slow_links(rows, threshold=0.98):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float) / np.abs(np.array(v, float)).max()
        return v / np.sqrt(v @ v)

    units = [unit(v) if label is not None else None for _, v, label in rows]
    return [(a, b) for a, b in itertools.combinations(range(len(rows)), 2)
            if units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b])
            and units[a] @ units[b] >= threshold]


def check_embeddings(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((tuple(r) for r in op5_embedding_dedup.link(df).collect()), key=repr)
    linked = slow_links(rows)
    root = classes(len(rows), linked)
    least = {}
    for (i, _, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    count = [sum(k in p for p in linked) for k in range(len(rows))]
    want = sorted(((i, c, least.get(r), i == least.get(r)) for (i, _, _), r, c in zip(rows, root, count)), key=repr)
    assert got == want
    return linked


@pytest.mark.parametrize("dim", [3, 8, 20, 64])
def test_embeddings_against_brute_force(spark, dim):
    rng = np.random.default_rng(dim)
    rows = []
    for g in range(25):
        base = rng.standard_normal(dim)
        for _ in range(rng.integers(1, 7)):
            v = base + rng.standard_normal(dim) * np.linalg.norm(base) / np.sqrt(dim) * rng.choice([0, 0.05, 0.12, 0.2])
            rows.append((len(rows), (v * rng.choice([1.0, 3.0])).tolist(), int(g % 3)))
    assert len(check_embeddings(spark, rows)) > 20


def test_embedding_cases(spark):
    v, w = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]
    rows = [(9, v, 1), (4, v, 1), (4, v, 1), (6, w, 1), (1, v, 2), (2, v, None), (3, w, None), (None, v, 1), (10, None, 1),
            (11, [], 1), (12, [0.0, 0.0, 0.0], 1), (13, [0.0, 0.0, 0.0], 1), (14, [1.0, None, 3.0], 1), (15, [1.0, math.nan, 3.0], 1),
            (16, [math.inf, 2.0, 3.0], 1), (17, [-1.0, -2.0, -3.0], 1), (18, [1.0, 2.0], 1), (19, [0.5, 1.0], 1),
            (20, [1e300, 2e300, 3e300], 1), (21, [1e-300, 2e-300, 3e-300], 1), (22, [-0.0, 5.0], 3), (23, [0.0, 5.0], 3)]
    check_embeddings(spark, rows)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert op5_embedding_dedup.link(empty).count() == 0
