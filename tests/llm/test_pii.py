"""Personal data and disclosing terms against brute force in Python."""
from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import pytest

from quayside.llm import op1_pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text, re.ASCII):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True,
                  "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end(), m.group()))
    return out


def slow_terms(texts, least_texts, disclosure):
    def own(x):
        for p in (PATTERNS["email"], PATTERNS["ip"], PATTERNS["phone"], r"[0-9]([\x20-]?[0-9]){15,}"):
            x = re.sub(p, "\n", x, flags=re.ASCII)
        return {w.lower() for w in re.findall(r"[^\W_]{3,}", x)}

    def names(x):
        for kind, _, _, v in base(x):
            yield kind, v.lower() if kind == "email" else v if kind == "ip" else re.sub("[^0-9]", "", v)
            if kind in ("email", "ip"):
                yield ("domain", v.lower().split("@")[1]) if kind == "email" else ("network", ".".join(v.split(".")[:2]))

    with_term, with_entity = collections.defaultdict(list), collections.defaultdict(list)
    for i, x in enumerate(texts):
        for t in own(x):
            with_term[t].append(i)
        for c in set(names(x)):
            with_entity[c].append(i)
    often = {tuple(rows) for rows in with_entity.values() if len({texts[i] for i in rows}) >= least_texts}
    near = {i for rows in often for i in rows}
    tried = {t for t, rows in with_term.items() if len({texts[i] for i in rows if i in near}) >= least_texts}
    n, out = len(texts), {}
    sets = [set(rows) for rows in often if len(rows) < n]
    for t in tried:
        for rows in sets:
            both = rows.intersection(with_term[t])
            different = len({texts[i] for i in both})
            if different < least_texts or different * math.log(n / len(rows)) < math.log(len(tried) * len(sets) / op1_pii.CHANCE):
                continue
            share = math.log(n * len(both) / (len(rows) * len(with_term[t]))) / math.log(n / len(rows))
            if share >= disclosure:
                out[t] = out.get(t, False) or len(both) >= len(with_term[t])
    return out


def spans_of(text, terms):
    found = base(text)
    own = []
    for m in re.finditer(r"[^\W_]{3,}", text):
        t = m.group().lower()
        if t in terms and not any(m.start() < e and s < m.end() for _, s, e, _ in found):
            own.append(("removed" if terms[t] else "term", m.start(), m.end(), m.group()))
    return found, sorted(own)


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans)


def compare(spark, rows, **limits):
    docs = spark.createDataFrame(rows, "doc_id long, text string, h int, term string")
    found = op1_pii.sanitise(docs, **limits)
    got = sorted((repr(r["doc_id"]), joined([tuple(x) for x in r["entities"]]), joined(sorted(tuple(x) for x in r["terms"])))
                 for r in found.collect())
    texts = [t or "" for _, t, *_ in rows]
    terms = slow_terms(texts, limits.get("least_texts", op1_pii.LEAST_TEXTS), limits.get("disclosure", op1_pii.DISCLOSURE))
    want = sorted((repr(i), *map(joined, spans_of(t or "", terms))) for i, t, *_ in rows)
    assert got == want
    return terms, docs


CASES = [
    "", None, "x@y.z", "a@b.com_x@c.de", "a@b.c.d..e f@g", ".@-.-", "a.b@c", "@@a@b.c@d.e", "é a@b.co 漢 1.2.3.4 \U0001f600 5.6.7.8",
    "1.2.3.4.5.6.7.8", "256.1.1.1.1.1.1.1", "0001.2.3.0255", "1.2.3", "999999999999999999999.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111x4111111111111112", "41111111111111110", "4111  1111 1111 1111", "12345678901234567890",
    "+1 (366) 555-9807", "+1234567", "+12345678", "+1234567890123456", "++49 30 1234567.", "+1 (2) 3 4 5 6 7 8 9 a", "+1 +22 333 4444",
    "call +1 (366) 555-9807 4111 1111 1111 1111", "a" * 30_000, "1" * 30_000, "1 " * 20_000, "a." * 20_000 + "@", "+1" * 10_000,
    "x@" + "a." * 8000 + "b", "5-" * 15_000 + "5"]


def test_base_cases(spark):
    compare(spark, [(i, t, 1, "x") for i, t in enumerate(CASES)] + [(None, "n@u.ll", 1, None), (2, "x@y.z", 2, None)])


def test_random_texts(spark):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("a1@.+- ()9%é\n") for _ in range(rng.randrange(400))), 0, "") for i in range(150)]
    compare(spark, rows)


def disclosing():
    rng = random.Random(3)
    words = [f"{a}{b}{c}" for a in ("tar", "mel", "vin", "sol") for b in ("o", "i", "ée") for c in ("na", "ka", "sh", "rt", "dd")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, text(60), 0, "") for i in range(120)]
    for i in range(6):  # the name stands with the address, and nowhere else; the nickname also elsewhere once
        rows.append((200 + i, f"{text(9)} Qarlsonn Ziggy wrote from q.arl@mail.example.com {text(9)} and qarlsonn again {text(20)}", 0, ""))
    rows.append((300, f"{text(12)} Ziggy {text(10)}", 0, ""))
    copy = f"{text(9)} Copyname z.op@mail.example.com {text(9)}"  # copies are one context
    return rows + [(400 + i, copy, 0, "") for i in range(9)] + [(500, None, 0, ""), (None, copy, 0, "")]


def test_disclosing_terms(spark):
    rows = disclosing()
    terms, docs = compare(spark, rows, disclosure=0.8)
    assert terms["qarlsonn"] is True and terms["ziggy"] is False and "copyname" not in terms
    out = {r["doc_id"]: r["text"] for r in op1_pii.sanitised(docs, disclosure=0.8).collect()}
    assert not any("arlsonn" in t or "iggy" in t or "@" in t for t in out.values())
    assert "<TERM>" in out[300] and re.search(r"<TERM> [^@]*<EMAIL>", out[203]) and "Copyname <EMAIL>" in out[404]
    assert out[0] == rows[0][1] and out[500] == ""


def test_terms_at_the_query_s_own_limits(spark):
    """Far from the entity, with digits, in a fixed signature, under different writings of it, and of a whole domain."""
    rng = random.Random(6)
    words = [a + b for a in ("tar", "mel", "vin", "sol", "que") for b in ("ona", "ika", "ush", "ert", "odd")]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    rows = [(i, text(50), 0, "") for i in range(300)]
    writings = ["+49 (30) 555-0199", "+49 30 5550199", "+49305550199"]
    for i in range(9):
        rows.append((1000 + i, f"Hallberg {text(60)} call {writings[i % 3]}", 0, ""))  # at the other end of the text
        rows.append((2000 + i, f"{text(10)} staff4711 {text(3)} P.Er@one.example {text(9)}", 0, ""))
        rows.append((3000 + i, f"{text(20 + i)}\n-- \nYours, Nadja Office 12 n.adja@two.example", 0, ""))  # the same block
        rows.append((4000 + i, f"{text(9)} mail x{i}@firm.example or the Quillfeather desk {text(5)}", 0, ""))
        rows.append((5000 + i, f"{text(9)} Lonely {text(5)}" + (" 10.1.2.3" if i < 5 else ""), 0, ""))  # half of it without
    terms, docs = compare(spark, rows)
    assert {"hallberg", "staff4711", "nadja", "quillfeather"} <= {t for t, gone in terms.items() if gone}
    assert not {"lonely", *words} & set(terms)
    out = {r["doc_id"]: r["text"] for r in op1_pii.sanitised(docs).collect()}
    assert not any(re.search("hallberg|4711|nadja|quillfeather", t, re.I) for t in out.values())
    assert all(out[i] == rows[i][1] for i in range(300))


def test_many_spans_in_one_text(spark):
    """Several blocks of entities and of terms in one long text, with characters of more than one byte."""
    rows = disclosing()
    long = " ".join(f"é{i} \U0001f600 üs.er{i}@x{i % 7}.example 10.{i % 300}.0.7 Ziggy" for i in range(1000))
    assert len(base(long)) > 5 * op1_pii.BLOCK
    terms, _ = compare(spark, [*rows, (600, long, 0, ""), (601, "Ziggy " * 1000, 0, "")], disclosure=0.7)
    assert "ziggy" in terms


def test_a_common_entity_needs_more_texts(spark):
    """An address in a third of all documents: words of a few of these are no evidence."""
    rng = random.Random(7)
    rows = [(i, f"w{i // 4}x w{rng.randrange(90)}y some words" + (" info@site.example" if i % 12 < 4 else ""), 0, "") for i in range(360)]
    terms, _ = compare(spark, rows)
    assert not terms


@pytest.mark.parametrize("limit", ["BROADCAST_ROWS", "BROADCAST_BYTES"])
def test_terms_by_shuffle(spark, monkeypatch, limit):
    monkeypatch.setattr(op1_pii, limit, 0)
    compare(spark, disclosing(), disclosure=0.8)


def test_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert op1_pii.sanitise(docs).count() == 0 and op1_pii.sanitised(docs).count() == 0


def test_query_columns(spark):
    r = {x["doc_id"]: x for x in op1_pii.op1_pii(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(r) == len(docs)
    for d in docs:
        spans = base(d["text"] or "")
        x = r[d["doc_id"]]
        assert [x[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in spans) for k in PATTERNS]
        assert x["base_sha256"] == hashlib.sha256(joined(spans).encode()).hexdigest()
        assert x["spans"].startswith(joined(spans))


@pytest.mark.parametrize("kind", list(PATTERNS))
def test_fixed_patterns(kind):
    assert op1_pii.SQL_PATTERNS[kind] == PATTERNS[kind]
