"""The pipeline: stages against plain versions of what they decide, and its cases."""
from __future__ import annotations

import collections
import itertools

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quayside.llm import op7_quality_classifier, op9_simhash, op10_bpe

SF = "/root/testdata/sf0.001"


def stage(spark, name, docs):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, SF)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "SimHash near-dedup", "mixing sources", "BPE"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_equals_its_stages(spark, docs):
    d = docs
    for name, f in corpus_pipeline.STAGES:
        before, d = d, f(spark, d, SF)
        if name != "BPE":
            assert d.columns == before.columns and d.dtypes == before.dtypes
        d = spark.createDataFrame(d.collect(), d.schema)
    key = lambda rows: sorted((r["doc_id"], r["n_tokens"], tuple(r["token_ids"]), r["round_trip"]) for r in rows)
    got = key(corpus_pipeline.run(spark, SF).collect())
    assert got == key(d.collect()) and got and all(r[3] for r in got)


def test_classifier_stage_keeps_clean_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.quality_classifier(spark, d, "/root/testdata/sf0.01").select("doc_id").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    assert all(x["doc_id"] in kept for x in labels if x["quality"] == 1)
    assert not any(x["doc_id"] in kept for x in labels if x["quality"] == 0)


def test_simhash_stage_keeps_one_of_each_group(spark, docs):
    rows = docs.collect()
    kept = {r["doc_id"] for r in stage(spark, "SimHash near-dedup", docs).collect()}
    fp = {r["doc_id"]: op9_simhash.fingerprint(r["text"]) for r in rows}
    near = collections.defaultdict(set)
    for a, b in itertools.combinations(sorted(fp), 2):
        if bin(fp[a] ^ fp[b]).count("1") <= 2:
            near[a].add(b)
            near[b].add(a)
    seen, groups = set(), []
    for i in sorted(fp):
        if i not in seen:
            group, todo = set(), [i]
            while todo:
                x = todo.pop()
                if x not in group:
                    group.add(x)
                    todo += near[x]
            seen |= group
            groups.append(group)
    assert kept == {min(g) for g in groups}


def test_mix_stage_repeats_rows(spark, docs):
    out = collections.Counter(r["doc_id"] for r in stage(spark, "mixing sources", docs).collect())
    words = {r["doc_id"]: len((r["text"] or "").split()) for r in docs.collect()}
    assert max(out.values()) == 2 and all(words[i] for i in out)
    total = sum(words[i] * n for i, n in out.items())
    assert 1.5 * sum(words.values()) >= total > 1.5 * sum(words.values()) - max(words.values())


def test_mix_stage_without_ids(spark, docs):
    """Rows without ids are taken by their texts, and each as often as the mix says."""
    out = collections.Counter(r["text"] for r in stage(spark, "mixing sources", docs.withColumn("doc_id", F.lit(None).cast("long"))).collect())
    texts = collections.Counter(r["text"] for r in docs.collect())
    words = {t: len((t or "").split()) for t in texts}
    assert all(n <= 2 * texts[t] and words[t] for t, n in out.items())
    total, most = sum(words[t] * n for t, n in texts.items()), max(words[t] * n for t, n in texts.items())
    assert 1.5 * total >= sum(words[t] * n for t, n in out.items()) > 1.5 * total - 2 * most


NAMES = ("score long, text string, lang string, source string, n_chars long, doc_id long, size string, key string, copies int, "
         "n_lines int, n_removed string, h int, fp string, id string, component_id int, token_ids string, _h int, _id string, Quality int, words string")


def test_cases_go_through_all_stages(spark):
    line = "a line of more than five words that comes again"
    texts = [line, line, f"{line}\nand then some other words of its own here", None, "", " \n ", "one two three", "x" * 200_000,
             " ".join(f"w{i}" for i in range(30_000)), line]
    ids = [3, 1, 2, 4, 5, 6, None, 8, 9, 3]
    rows = [(7, t, None if i == 2 else "en", None if i in (1, 8) else "s", None if i is None else 1, i, "S", None, 1, 2, "r", 3, "f", "i", 4, "t",
             5, None, 6, "w") for t, i in zip(texts, ids)]
    d = spark.createDataFrame(rows, NAMES)
    for name, f in corpus_pipeline.STAGES:
        if name == "quality classifier":
            assert f(spark, d, SF).columns == d.columns  # these texts needn't be good ones
            continue
        before, d = d, f(spark, d, SF)
        if name != "BPE":
            assert d.columns == before.columns
            assert all(r["score"] == 7 and r["size"] == "S" and r["n_removed"] == "r" and r["Quality"] == 6 for r in d.collect())
        if name == "line dedup":
            left = collections.Counter((r["doc_id"], r["text"]) for r in d.collect())
            assert left[1, line] == 1 and (3, "") not in left and left[2, "and then some other words of its own here"] == 1
            assert left[4, None] == 1 and left[5, ""] == 1 and left[None, "one two three"] == 1
        if name == "SimHash near-dedup":
            # null, empty and blank texts are one group: the smallest id stays
            assert {r["doc_id"] for r in d.collect()} == {1, 2, 4, None, 8, 9}
    got = collections.Counter(r["doc_id"] for r in d.collect())
    assert set(got) <= {1, 2, None, 8, 9} and all(r["round_trip"] for r in d.collect())


def test_empty_table(spark, docs):
    d = docs.limit(0)
    for name, f in corpus_pipeline.STAGES:
        d = f(spark, d, SF)
        assert d.count() == 0
        if name != "BPE":
            assert d.columns == docs.columns


def test_bpe_stage_keeps_columns_of_its_contract(spark, docs):
    out = stage(spark, "BPE", docs)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "token_ids", "round_trip"]
    r = out.first()
    assert r["n_tokens"] == len(r["token_ids"]) and op10_bpe.default_vocabulary().endswith(".json")
    assert op7_quality_classifier.GOOD == 0.3
