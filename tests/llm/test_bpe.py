"""Encoding, decoding and token counts against the tokenizers library."""
from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quayside.llm import bpe, op4_token_counts, op10_bpe

PATH = op10_bpe.default_vocabulary()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.load_spec(PATH))


def ids(codec, text):
    return np.frombuffer(codec.encode(text), np.uint32).tolist()


@pytest.mark.parametrize("text", [
    "", " ", "a", "\n\n  x", "don't'll we'RE 'S", "a" * 5000, "ab" * 3000, "!?" * 999, "0123456789" * 99, " " * 3000 + "x",
    "<|endoftext|>x<|endoftext|><|endoftext|>", "< |endoftext|>", "é" * 300, "\U0001f600" * 99, "日本語テキスト", "a\x85b\xa0c d\x1ce",
    "İıŞß", "́̀e", "tab\tand\x0bvt\x0cff\r\nend"])
def test_cases(codec, library, text):
    assert ids(codec, text) == library.encode(text, add_special_tokens=False).ids


def test_random_texts(codec, library):
    rng = random.Random(1)
    alphabet = "aAbeEé  \n\t'!.,0123ß漢\U0001f642thinger"
    for n in list(range(40)) + [500, 5000]:
        text = "".join(rng.choice(alphabet) for _ in range(n))
        assert ids(codec, text) == library.encode(text, add_special_tokens=False).ids


def test_every_code_point_is_classed_as_the_library_does(codec, library):
    points = [i for i in range(0x30000) if not 0xD800 <= i <= 0xDFFF]
    for at in range(0, len(points), 20_000):
        text = "".join(f"a{chr(i)}1{chr(i)} {chr(i)}\n" for i in points[at: at + 20_000])
        assert ids(codec, text) == library.encode(text, add_special_tokens=False).ids


def test_every_token_encodes_to_itself(codec):
    assert all(codec.encode_piece(t) == [i] for i, t in enumerate(codec.tokens))


def test_decoding_of_any_ids(library):
    offset, blob = bpe.decoding_table(bpe.load_spec(PATH))
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 50, 1000):
        x = rng.integers(0, 50257, n)
        assert bpe.decode(x, offset, blob).decode("utf-8", "replace") == library.decode(x.tolist(), skip_special_tokens=False)


def test_caches_that_overflow_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 3)
    c = bpe.Codec(bpe.load_spec(PATH))
    text = "the quick brown foxes jumped over lazier dogs " * 3
    assert ids(c, text) == library.encode(text, add_special_tokens=False).ids


def test_query_cases(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Hello <|endoftext|> wörld", "x"), (3, "Hello <|endoftext|> wörld", "x"),
            (None, "null id", "x"), (5, "long " * 20_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    got = sorted(map(repr, op10_bpe.digests(docs, PATH).collect()))
    want = []
    for i, t, _ in rows:
        x = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(x, skip_special_tokens=False)
        want.append(repr(type(op10_bpe.digests(docs, PATH).first())(
            doc_id=i, n_tokens=len(x), ids_sha256=hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(),
            decoded_sha256=hashlib.sha256(back.encode()).hexdigest())))
    assert got == sorted(want)
    coded = op10_bpe.encode(docs, PATH)
    assert coded.columns == ["doc_id", "text", "token_ids"] and dict(coded.dtypes)["token_ids"] == "array<int>"
    assert op10_bpe.digests(docs.limit(0), PATH).count() == 0


def test_histogram_against_brute_force(spark):
    rng = random.Random(2)
    lengths = [rng.choice([0, 0, 1, 5, 1023, 1024, 1025, 5000, rng.randrange(9000)]) for _ in range(400)]
    df = spark.createDataFrame([(x,) for x in lengths], "n_tokens long")
    hist = op4_token_counts.histogram(df)
    rows = {r["n_tokens"]: r for r in hist.collect()}
    assert set(rows) == set(lengths)
    for k, r in rows.items():
        assert r["n_docs"] == lengths.count(k)
        assert r["docs_longer"] == sum(x > k for x in lengths) and r["docs_fitting"] == sum(x <= k for x in lengths)
        assert r["kept_tokens"] == sum(min(x, k) for x in lengths) and r["total_tokens"] == sum(lengths)
        assert r["lost_tokens"] == sum(lengths) - r["kept_tokens"]
        assert r["share_fitting"] == pytest.approx(r["docs_fitting"] / len(lengths))
    for r in op4_token_counts.at_limits(hist, [0, 7, 1024, 10**6]).collect():
        assert r["kept_tokens"] == sum(min(x, r["context_limit"]) for x in lengths)
        assert r["docs_longer"] == sum(x > r["context_limit"] for x in lengths)
    got = {r["share"]: r["n_tokens"] for r in op4_token_counts.quantiles(hist, [0.1, 0.5, 1.0]).collect()}
    assert got == {q: min(k for k in lengths if sum(x <= k for x in lengths) >= q * len(lengths)) for q in (0.1, 0.5, 1.0)}


def test_counts_of_given_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r["text"] or "" for r in docs.collect()]
    want = sum(len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False))
    hist = op4_token_counts.histogram(op4_token_counts.encoded_length(docs, PATH))
    assert hist.first()["total_tokens"] == want


def test_histogram_of_nothing(spark):
    empty = op4_token_counts.histogram(spark.createDataFrame([], "n_tokens long"))
    assert empty.count() == 0
    assert [tuple(r) for r in op4_token_counts.at_limits(empty, [5]).collect()] == [(5, 0, 0, 0, 0)]
    assert op4_token_counts.quantiles(empty, [0.5]).first()["n_tokens"] is None


def test_documents_are_encoded_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def length(i):
        calls.add(1)
        return i % 3 if i else None

    rows = spark.range(30).withColumn("n_tokens", length("id"))
    assert sorted((r["n_tokens"], r["n_docs"]) for r in op4_token_counts.histogram(rows).collect()) == [(0, 9), (1, 10), (2, 10)]
    assert calls.value == 30
