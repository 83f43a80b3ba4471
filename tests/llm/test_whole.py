"""Results that hold the whole of what they are about: cases that shorter ways would lose."""
from __future__ import annotations

import random

import pytest

import corpus_pipeline
from quayside.llm import op2_line_dedup

SF = "/root/testdata/sf0.001"


def test_line_dedup_stage_keeps_documents_with_words_left(spark):
    shared = "a line of more than five words that comes again"
    own = {2: "apples\npears and plums\nnuts", 3: "漢字仮名交じり文" * 40}
    texts = {1: shared, **{i: f"{shared}\n{t}" for i, t in own.items()}, 4: shared, 5: f" \n{shared}\n\t"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, SF).collect()}
    assert got == {1: shared, **own}  # 4 and 5 have no word left


def matches(rows, least):
    """Places (id, line) of lines that match an earlier one."""
    places = sorted((i, n, frozenset(x.split())) for i, t in rows for n, x in enumerate(t.split("\n")))
    places = [p for p in places if len(p[2]) >= least]
    return {(i, n) for b, (i, n, ws) in enumerate(places) if any(5 * len(ws & o) >= 4 * len(ws | o) for _, _, o in places[:b])}


@pytest.mark.parametrize("least", [1, 3, 5])
def test_short_lines_against_brute_force(spark, least):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(9)]
    rows = [(i, "\n".join(" ".join(rng.choices(words, k=rng.randrange(8))) for _ in range(rng.randrange(1, 5)))) for i in range(90)]
    rows += [(100, "漢字仮名" * 90), (101, "漢字仮名" * 90), (102, "a b c d"), (103, "a b c d e"), (104, "p q r s t"), (105, "s r q p")]
    gone = matches(rows, least)
    assert ((101, 0) in gone, (103, 0) in gone, (105, 0) in gone) == (least == 1, least < 5, least < 5)
    want = sorted((i, "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)) for i, t in rows)
    d = op2_line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), least)
    assert sorted((r["doc_id"], r["text"]) for r in d.collect()) == want


def test_line_dedup_stage_removes_repeated_short_lines(spark):
    rows = [(1, "home news\nsome words of its own that stand here"), (2, "home news\nquite another text stands in this one"),
            (3, "news home"), (4, "漢字仮名交じり文" * 40), (5, "漢字仮名交じり文" * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, SF).collect()}
    assert got == {1: rows[0][1], 2: "quite another text stands in this one", 4: rows[3][1]}
