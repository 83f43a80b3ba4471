"""Token counts: an exact histogram of encoded lengths, and what its suffix sums answer.

Documents are first aggregated by encoded length, so all that follows works on one row per distinct length,
however many documents there are. With suffix sums over the lengths, the row of length L says for a context limit
of L: how many documents are longer than it, how many tokens survive truncation to L, and how many are lost; and
the share of documents up to L, from which every quantile can be read. Limits between two lengths follow from the
row below (``at_limits``), so the table answers every context limit.

Defined cases: a null or empty text has length 0 and is counted; repeated rows count as often as they occur; an empty
table gives an empty histogram, and limits over it get zeros (quantiles: null).
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import cut, table
from quayside.llm.op10_bpe import _codec, default_vocabulary
from quayside.llm.registry import register

#: Lengths per block of the two-level sums.
BLOCK = 1024


def encoded_length(docs: DataFrame, vocabulary: str, text_col: str = "text", out_col: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of the whole text."""
    codec = _codec(docs.sparkSession, vocabulary)

    @F.arrow_udf(T.LongType())
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec()
        for texts in batches:
            yield pa.array([len(c.encode(t.as_py() or "")) // 4 for t in texts], pa.int64())

    return docs.withColumn(out_col, lengths(F.col(f"`{text_col}`")))


def histogram(lengths: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """One row per distinct length: n_tokens, n_docs, and the sums for a context limit of that length.

    Columns: docs_longer, docs_fitting (of at most this length), total_tokens (of all documents), kept_tokens (when
    each document is cut at this length), lost_tokens, share_fitting (quantile of the length).

    The sums are made in two levels, blocks of lengths and lengths within a block, so that no task gets more than a
    block or the list of blocks.
    """
    # a row per length, used twice below: computed once. Rows without a length are dropped from it only then, as the
    # optimizer would move that filter below the aggregate and have the length computed for it and for the rows.
    h = cut(lengths.groupBy(F.col(length_col).alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs"))
            .withColumn("block", F.expr(f"n_tokens DIV {BLOCK}"))).where("n_tokens IS NOT NULL")
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = (h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(F.expr("n_docs * n_tokens")).alias("t"))
              .select("block", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
                      F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
                      F.sum("d").over(whole).alias("all_docs"), F.sum("t").over(whole).alias("total_tokens")))
    longer = (Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1))
    return (h.join(blocks, "block")
            .withColumn("docs_longer", F.expr("docs_above") + F.coalesce(F.sum("n_docs").over(longer), F.lit(0)))
            .withColumn("tokens_longer", F.expr("tokens_above")
                        + F.coalesce(F.sum(F.expr("n_docs * n_tokens")).over(longer), F.lit(0)))
            .withColumn("kept_tokens", F.expr("total_tokens - tokens_longer + docs_longer * n_tokens"))
            .select("n_tokens", "n_docs", "docs_longer", F.expr("all_docs - docs_longer").alias("docs_fitting"),
                    "total_tokens", "kept_tokens", F.expr("total_tokens - kept_tokens").alias("lost_tokens"),
                    F.expr("(all_docs - docs_longer) / all_docs").alias("share_fitting")))


def at_limits(hist: DataFrame, limits: Iterable[int]) -> DataFrame:
    """Documents and tokens for given context limits, from a histogram: one row per limit.

    Columns: context_limit, docs_longer, total_tokens, kept_tokens, lost_tokens.
    """
    aggs = []
    for k in (limits := [int(x) for x in limits]):
        aggs += [F.coalesce(F.sum(F.expr(f"IF(n_tokens > {k}, n_docs, 0)")), F.lit(0)).alias(f"l{k}"),
                 F.coalesce(F.sum(F.expr(f"LEAST(n_tokens, {k}) * n_docs")), F.lit(0)).alias(f"k{k}")]
    total = F.coalesce(F.sum(F.expr("n_tokens * n_docs")), F.lit(0)).alias("total_tokens")
    rows = ", ".join(f"named_struct('context_limit', {k}L, 'docs_longer', l{k}, 'kept_tokens', k{k})" for k in limits)
    return (hist.agg(total, *aggs).selectExpr("total_tokens", f"inline(array({rows}))")
            .selectExpr("context_limit", "docs_longer", "total_tokens", "kept_tokens",
                        "total_tokens - kept_tokens AS lost_tokens"))


def quantiles(hist: DataFrame, shares: Iterable[float]) -> DataFrame:
    """The least length at which at least a given share of the documents fits: one row per share."""
    shares = [float(x) for x in shares]
    rows = ", ".join(f"named_struct('share', {s!r}D, 'n_tokens', q{i})" for i, s in enumerate(shares))
    return (hist.agg(*[F.min(F.expr(f"IF(share_fitting >= {s!r}D, n_tokens, NULL)")).alias(f"q{i}")
                       for i, s in enumerate(shares)]).selectExpr(f"inline(array({rows}))"))


@register("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length histogram of all documents with its sums for every context limit."""
    docs = table(spark, sf_dir, "documents").select("text")
    return histogram(encoded_length(docs, default_vocabulary()))
