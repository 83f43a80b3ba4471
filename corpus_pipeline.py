"""A corpus from documents to tokens: five stages, each one operator of ``quayside.llm``.

Every stage takes all that the one before kept, as written to Parquet and read again, and returns documents with the
columns of the table (the last one: tokens). ``run`` writes the stages under the session's ``spark.checkpoint.dir``.

Rows with nulls, empty texts and repeated rows go through all stages; what becomes of them is stated with each stage
and in its operator.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import op2_line_dedup, op6_mixing, op7_quality_classifier, op9_simhash, op10_bpe
from quayside.llm.common import prepare, table
from quayside.session import configure_session, scratch_path


def _aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns of the given names (in any case) renamed, and how to name them back."""
    away = {c: f"_own_{i}_{c}" for i, c in enumerate(docs.columns) if c.lower() in names}
    return docs.withColumnsRenamed(away), {v: k for k, v in away.items()}


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is that of a good one; the others go. Empty texts are scored like any other."""
    prepare(spark)
    docs, back = _aside(docs, "score", "quality", "_features")
    model = op7_quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    scored = op7_quality_classifier.with_score(docs, model)
    return scored.where(F.col("score") >= op7_quality_classifier.GOOD).drop("score").withColumnsRenamed(back)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that match an earlier one, and n_chars of what is left. All lines with a word are compared.

    A document that lost lines and has no word left is a copy, and goes; one with words left stays, however few a line.
    """
    prepare(spark)
    docs, back = _aside(docs, "n_lines", "n_removed", "_key", "_touched", "_doc", "_lines", "_new")
    d = op2_line_dedup.dedup_lines(docs, least=1)
    left = d.where(F.expr(r"n_removed = 0 OR text RLIKE r'[^\x20\x09-\x0D]'"))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return left.select(*[f"`{c}`" for c in docs.columns]).withColumnsRenamed(back)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that of the smallest id (null before all, then by text).

    Shingles of 3 words, at most 2 differing bits. Of repeated rows, one stays.
    """
    prepare(spark)
    docs, back = _aside(docs, "_id", "_kept", "_h")
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    named = docs.select(F.struct(F.col("doc_id"), text_hash.alias("h")).alias("doc_id"), "text")
    kept = (op9_simhash.near_duplicates(named, shingle=3, max_bits=2).where(F.col("doc_id") == F.col("component_id"))
            .select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id.h").alias("_kept")).distinct())
    d = docs.withColumn("_h", text_hash)
    return (d.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_kept")), "left_semi")
            .dropDuplicates(["doc_id", "_h"]).drop("_h").withColumnsRenamed(back))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a document occurs as often as it is taken, so twice, once or not at all.

    Documents without words take nothing and go.
    """
    prepare(spark)
    docs, back = _aside(docs, "_id", "_source", "_n", "_place", "_copies", "_size", "_key", "_copy")
    mixed = (op6_mixing.mix(op6_mixing.sized(docs)).where("copies > 0")
             .select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_n"),
                     F.col("key").alias("_place"), F.col("copies").alias("_copies"))
             .distinct())  # repeated rows are taken alike
    d = docs.withColumns({"_size": op6_mixing.word_count("text"), "_key": op6_mixing.place_key()})
    on = ((F.col("_key") == F.col("_place")) & F.col("doc_id").eqNullSafe(F.col("_id"))
          & F.col("source").eqNullSafe(F.col("_source")) & (F.col("_size") == F.col("_n")))
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return d.join(mixed, on).withColumn("_copy", copies).select(*[f"`{c}`" for c in docs.columns]).withColumnsRenamed(back)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document: doc_id, lang, source, n_tokens, token_ids, and whether decoding gives the text back."""
    prepare(spark)
    vocabulary = op10_bpe.default_vocabulary()
    coded = op10_bpe.decode(op10_bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary), vocabulary)
    return coded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
                        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("mixing sources", mix_sources),
    ("BPE", bpe),
]

#: SQL can't express the classifier, the fingerprints and the encoding; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    configure_session(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(path := scratch_path(spark, f"stage{i + 1}"))
            docs = spark.read.parquet(path)
    return docs
