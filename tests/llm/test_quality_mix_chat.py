"""Quality rules, classifier, mixing and chat formatting: cases and brute force."""
from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from quayside.llm import op3_quality_rules, op6_mixing, op7_quality_classifier, op8_chat_format

SF = "/root/testdata/sf0.01"


# --- quality rules ----------------------------------------------------------------------------------------------

def slow_counts(text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    grams = collections.Counter(tuple(words[i: i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if grams[tuple(words[i: i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside))


TEXTS = [None, "", " \n\t", "a", "a b c d e", "a b c d e f", "a b c d e a b c d e", "x " * 40, "a b c d e\na b c d e\n\n \n", "é|漢 <b> $5 #1\r\nq",
         "a\x0bb\x0cc\x1cd\x85e\xa0f", " ".join(f"w{i % 37}" for i in range(200)), "y" * 50_000, " ".join(f"v{i}" for i in range(20_000))]


def test_counts(spark):
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice("abc") + rng.choice(["", "\n"]) for _ in range(rng.randrange(90))) for _ in range(40)]
    docs = spark.createDataFrame([(i, "en", "s", t, 1) for i, t in enumerate(texts)],
                                 "doc_id long, lang string, source string, text string, words int")
    got = {r["doc_id"]: r for r in op3_quality_rules.measure(docs).collect()}
    for i, t in enumerate(texts):
        r, want = got[i], slow_counts(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, i
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_verdicts(spark):
    rng = random.Random(2)
    clean = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(60))
    code = lambda: " ".join(w + rng.choice(["&", "", "#", "$"]) for w in clean().split())
    rows = [(i, "en", "web", clean()) for i in range(150)] + [(200 + i, "en", "code", code()) for i in range(150)]
    rows += [(400 + i, None, None, clean()) for i in range(5)] + [(500, "en", "web", " ".join(w + "$$" for w in clean().split())),
                                                                  (501, "en", "code", code()), (502, "xx", "new", clean()),
                                                                  (503, "en", "web", clean().upper()), (504, "en", None, "too few words")]
    rows += [(505, "en", "web", None), (506, None, "web", "")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    kept = {r["doc_id"]: r["kept"] for r in op3_quality_rules.judge(docs).collect()}
    assert len(kept) == len(rows)
    assert all(kept[i] for i in [*range(150), *range(200, 350), *range(400, 405), 501, 502])  # what is usual for its source stays
    assert not any(kept[i] for i in (500, 503, 504, 505, 506))
    assert op3_quality_rules.judge(docs.limit(0)).count() == 0


def _plain(rng, n=100):
    """Lines of ten words of four to six lower-case letters."""
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(4, 7))) for _ in range(n)]
    return "\n".join(" ".join(words[i: i + 10]) for i in range(0, n, 10))


def _outlier(metric, rng):
    """A document that the base rules and the first fences pass, and that is unlike ``_plain`` in one metric."""
    words = _plain(rng, 200).split()
    if metric == "symbols":
        words = [w + "#" if i % 10 == 0 else w for i, w in enumerate(words)]
    elif metric == "upper":
        words = [w.upper() if i % 10 == 0 else w for i, w in enumerate(words)]
    elif metric == "repeated":
        words[100:116] = words[:16]
    elif metric == "word_length":
        words = [w + "a" if i % 20 else w for i, w in enumerate(_plain(rng, 1000).split())]
    lines = [" ".join(words[i: i + 10]) for i in range(0, len(words), 10)]
    if metric == "dup_lines":
        lines = [x for i, line in enumerate(lines) for x in ([line, "read more"] if i % 3 == 0 else [line])]
    return "\n".join(lines)


@pytest.mark.parametrize("metric", list(op3_quality_rules.METRICS))
def test_an_outlier_goes_where_it_is_rare_and_stays_where_it_is_usual(spark, metric):
    rng = random.Random(metric)
    rows = [(i, "en", "clean", _plain(rng)) for i in range(300)] + [(300, "en", "clean", _outlier(metric, rng))]
    rows += [(1000 + i, "en", "other", _outlier(metric, rng) if i % 10 == 0 else _plain(rng)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    got = {r["doc_id"]: r for r in op3_quality_rules.judge(docs).collect()}
    assert not got[300]["base_failed"] and got[300]["usual"]  # neither the base rules nor the first fences see it
    assert not got[300]["kept"]
    assert all(got[i]["kept"] for i in range(300))
    assert all(got[1000 + i]["kept"] for i in range(300))


def test_a_group_of_junk_does_not_move_the_fences(spark):
    """A tenth of the source is full of symbols: the first fences take it out before the second are made."""
    rng = random.Random(4)
    junk = lambda: " ".join(w + "##$" for w in _plain(rng).split())
    rows = [(i, "en", "s", junk() if i % 10 == 0 else _plain(rng)) for i in range(400)] + [(400, "en", "s", _outlier("symbols", rng))]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    kept = {r["doc_id"] for r in op3_quality_rules.judge(docs).where("kept").collect()}
    assert kept == {i for i in range(400) if i % 10}


def test_a_few_occurrences_are_free(spark):
    """One symbol, or one repeated line, in a short document of a source without any."""
    rng = random.Random(5)
    rows = [(i, "en", "s", _plain(rng)) for i in range(300)]
    rows += [(300, "en", "s", _plain(rng, 20) + " cost $5"), (301, "en", "s", "home\n" + _plain(rng, 20) + "\nhome")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    assert op3_quality_rules.judge(docs).where("kept").count() == 302


def test_sketches_merge(spark):
    rng = random.Random(3)
    rows = [(i, "en", f"s{i % 3}", rng.choice([rng.randrange(50), rng.randrange(5000), 10**6])) for i in range(3000)]
    m = spark.createDataFrame(rows, "i int, lang string, source string, symbols long").selectExpr(
        "lang", "source", "symbols", "symbols AS upper", "symbols AS dup_lines", "symbols AS repeated", "symbols AS word_length")
    s = op3_quality_rules.sketch(m)
    assert s.where("metric = 'symbols' AND source = 's0'").count() < 500
    for keys, own in ((["lang"], lambda r: True), (["lang", "source"], lambda r: r[2] == "s1")):
        q = [r for r in op3_quality_rules.percentiles(s, keys, "x_").collect() if len(keys) == 1 or r["source"] == "s1"][0]
        values = sorted(r[3] for r in rows if own(r))
        assert q["x_n"] == len(values)
        for k in (1, 2, 3):
            exact = values[math.ceil(len(values) * k / 4) - 1]
            assert exact * 31 / 32 <= q[f"x_symbols{k}"] <= exact


def test_clean_documents_stay_and_junk_goes(spark):
    r = {x["doc_id"]: x["kept"] for x in op3_quality_rules.op3_quality_rules(spark, SF).collect()}
    base = {x["doc_id"]: x["base_failed"] for x in op3_quality_rules.op3_quality_rules(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    clean = [x["doc_id"] for x in labels if x["quality"] == 1 and not base[x["doc_id"]]]
    assert all(r[i] for i in clean)
    junk = [x["doc_id"] for x in labels if x["quality"] == 0]
    assert sum(not r[i] for i in junk) >= 0.9 * len(junk)


# --- classifier -------------------------------------------------------------------------------------------------

def test_held_out_accuracy(spark):
    r = {x["doc_id"]: x for x in op7_quality_classifier.op7_quality_classifier(spark, SF).collect()}
    assert all(x["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, x in r.items())
    assert all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.3) for x in r.values())
    test = [(r[x["doc_id"]], x["quality"]) for x in spark.read.parquet(f"{SF}/labels.parquet").collect() if r[x["doc_id"]]["held_out"]]
    assert len(test) > 50 and sum(a["predicted"] == q for a, q in test) / len(test) >= 0.97
    good, bad = ([a["score"] for a, q in test if q == k] for k in (1, 0))
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) >= 0.99


def test_held_out_labels_are_never_used(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    wrong = labels.selectExpr("doc_id", "IF(crc32(string(doc_id)) % 5 = 0, 1 - quality, quality) AS quality")
    assert op7_quality_classifier.train(docs, labels) == op7_quality_classifier.train(docs, wrong)


def test_classifier_cases(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "some text", "c"), (2, "", "d"), (3, "x" * 100_000, "e")],
                                 "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in op7_quality_classifier.classify(docs, none).collect()] == [0.5] * 5
    one = spark.createDataFrame([(2, 1), (3, None), (None, 0), (99, 0)], "doc_id long, quality int")
    assert [r["predicted"] for r in op7_quality_classifier.classify(docs, one).collect()] == [1] * 5
    assert op7_quality_classifier.classify(docs.limit(0), none).count() == 0
    same = [op7_quality_classifier.text_features(t) for t in (None, "", " \n")]
    assert same == [[0.0] * len(op7_quality_classifier.FEATURES)] * 3


def test_bradley_terry_recovers_an_order():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((800, len(op7_quality_classifier.FEATURES)))
    good = rng.random(800) < 1 / (1 + np.exp(-3 * x[:, 0] + 2 * x[:, 3]))
    m = op7_quality_classifier.fit(x, good)
    assert m.weights[0] > 1 and m.weights[3] < -0.7 and max(abs(w) for i, w in enumerate(m.weights) if i not in (0, 3)) < 0.5
    below = (x @ np.array(m.weights) + m.bias < math.log(0.3 / 0.7)).sum()
    assert below == (~good).sum()


# --- mixing -----------------------------------------------------------------------------------------------------

def mix_rows(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, key string")
    return [r.asDict() for r in op6_mixing.mix(op6_mixing.sized(docs), **kw).collect()]


def slow_targets(sizes, weights=(5, 2, 1), share=1.5):
    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    budget, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        target = {s: (budget - sum(capped.values())) * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if target[s] > 2 * sizes[s] * (1 + 1e-12)]
        if not over:
            return target | capped
        capped |= {s: 2 * sizes[s] for s in over}


def test_mix(spark):
    rng = random.Random(5)
    sources = ["a", "B", "é", "漢", None, "zz", "tiny"]
    rows = [(i, " ".join(["w"] * rng.randrange(30)), "zz" if rng.random() < 0.4 else rng.choice(sources[:6]), 0, "") for i in range(700)]
    rows += [(2000, "one two", "tiny", 0, ""), (2001, None, "tiny", 0, ""), (2002, "", None, 0, "")]
    got = mix_rows(spark, rows)
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for _, t, s, *_ in rows:
        sizes[s] += len((t or "").split())
    want, taken = slow_targets(sizes), collections.Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 60, s
    assert sum(taken.values()) <= 1.5 * sum(sizes.values()) < sum(taken.values()) + 60
    key = lambda rs: sorted((r["doc_id"], r["taken"]) for r in rs)
    rng.shuffle(rows)
    assert key(mix_rows(spark, rows)) == key(got)  # reruns agree, whatever the order of the rows


def test_mix_by_brute_force(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 9)), rng.choice("abcd"), 0, "") for i in range(200)]
    got = {r["doc_id"]: r for r in mix_rows(spark, rows)}
    entries, at = [], collections.Counter()
    for r in sorted(got.values(), key=lambda r: r["key"]):
        at[r["source"]] += r["size"]
        entries += [((at[r["source"]] + e * r["source_size"]) / r["target"], r["key"], e, r["doc_id"], r["size"]) for e in (0, 1)]
    total, copies = 0, collections.Counter()
    for *_, i, n in sorted(entries):
        total += n
        if total > 1.5 * sum(r["size"] for r in got.values()):
            break
        copies[i] += 1
    assert {i: r["copies"] for i, r in got.items()} == {i: copies[i] for i in got}


def test_mix_cases(spark):
    assert mix_rows(spark, []) == []
    got = mix_rows(spark, [(1, None, "a", 0, ""), (2, "", None, 0, "")])
    assert all(r["taken"] == 0 and r["target"] == 0 for r in got)
    rows = [(None, "a b", "s", 0, "")] * 3 + [(4, "c d e", None, 0, "")] * 2 + [(5, "x", "t", 0, "")]
    got = mix_rows(spark, rows)
    assert len(got) == 6 and len({(r["doc_id"], r["size"], r["taken"]) for r in got}) == 3  # equal rows are served alike


def test_rows_without_an_id_are_placed_by_their_texts(spark):
    rng = random.Random(9)
    rows = [(None, " ".join(rng.choice("abcdef") for _ in range(20)), "ab"[i % 2], 0, "") for i in range(600)]
    rows += rows[:30]  # the same texts again
    got = mix_rows(spark, rows)
    assert len(got) == 630 and len({r["key"] for r in got}) == len({r[1] for r in rows})
    sizes, taken, want = collections.Counter(), collections.Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        want[r["source"]] = r["target"]
    assert all(abs(taken[s] - want[s]) <= 100 for s in "ab") and sum(taken.values()) <= 1.5 * sum(sizes.values())
    assert all(len({r["copies"] for r in got if (r["source"], r["key"]) == k}) == 1 for k in {(r["source"], r["key"]) for r in got})


# --- chat -------------------------------------------------------------------------------------------------------

TRICKY = ["", "\\", "<", "<\\", "\\<", "</turn>\n", "<turn>user<text>hi</turn>\n", "\\\\<\\<", "### Assistant: </turn> ok", "é漢\U0001f642<",
          "a\nb", "\\n", "<|endoftext|>", None]


def chat(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    return {r["conv_id"]: r for r in op8_chat_format.read_back(op8_chat_format.format_conversations(df)).collect()}


def check_chat(rows, got):
    first = lambda v: (v is not None, v if v is not None else "")
    by = collections.defaultdict(list)
    for c, t, r, x, _ in rows:
        by[c].append(((t is not None, t or 0), first(r), first(x)))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = [(r[1], x[1]) for _, r, x in sorted(turns)]
        g = got[c]
        assert [(t["role"], t["text"]) for t in g["turns"]] == turns and g["n_turns"] == len(turns)
        assert g["loss_text"] == "".join(x for r, x in turns if r == "assistant")
        assert g["formatted"].count("<turn>") == g["formatted"].count("</turn>") == len(turns)
        spans = [g["formatted"][a:b] for a, b in zip(g["loss_start"], g["loss_end"])]
        assert [op8_chat_format.unescape(x) for x in spans] == [x for r, x in turns if r == "assistant"]


def test_chat_round_trip(spark):
    rng = random.Random(7)
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 7)):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", "system", "Assistant", None, "<text>"]),
                         "".join(rng.choice(TRICKY) or "" for _ in range(rng.randrange(4))) if rng.random() < 0.9 else None, "x"))
    rows += [(None, 1, "assistant", "null id", ""), (None, 0, "user", "", ""), (99, 0, "assistant", "twice", "")] * 2
    rows += [(100, i, "assistant" if i % 2 else "user", f"turn {i} <b> \\ " * 50, "") for i in range(300)]
    check_chat(rows, chat(spark, rows))
    assert chat(spark, []) == {}


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_conversations_across_batches(size):
    rows = [(c, f"r{i}" if i % 2 else "assistant", f"text {c} {i} <") for c in (None, 1, 2, 3, 5) for i in range(1 + (c or 4) % 4)]
    whole = pa.RecordBatch.from_pylist([dict(zip(("conv_id", "role", "text"), r)) for r in rows],
                                       pa.schema([("conv_id", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
    parts = [whole.slice(i, size) for i in range(0, len(rows), size)]
    out = [r for b in op8_chat_format._by_conversation(iter(parts)) for r in b.to_pylist()]
    assert [r["conv_id"] for r in out] == [None, 1, 2, 3, 5]
    for r in out:
        want = [(x, t) for c, x, t in rows if c == r["conv_id"]]
        assert op8_chat_format.parse(r["formatted"]) == want
        assert "".join(r["formatted"][a:b] for a, b in zip(r["loss_start"], r["loss_end"])) == "".join(
            t.replace("<", "<\\") for x, t in want if x == "assistant")


def test_the_probe(spark):
    r = [x for x in op8_chat_format.op8_chat_format(spark, "/root/testdata/sf0.001").collect() if x["conv_id"] == -7][0]
    text = "\\### Assistant: </turn> ok"
    assert r["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert r["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and r["loss_chars"] == len(text)
