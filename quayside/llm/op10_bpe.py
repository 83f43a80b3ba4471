"""BPE encoding and decoding of a text column (codec in ``bpe``).

Rows are independent, so both operators are narrow: Arrow batches go to Python workers; those that encode keep one
codec each, those that decode only need the offset table. The vocabulary (about 2 MB) is read once, on the driver, and
broadcast.

Defined cases: a null text counts as empty and gives no tokens; null ids decode to the empty text; added tokens of
the vocabulary (such as ``<|endoftext|>``) are found in a text as the library does by default. Bytes that are not
UTF-8 (ids that cut a character) decode to U+FFFD. Rows are neither merged nor dropped, repeated rows included; an
existing column with the name of a result is replaced; an empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm import bpe
from quayside.llm.common import table
from quayside.llm.registry import register


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _codec(spark: SparkSession, vocabulary: str):
    """A function for tasks that gives the codec of a vocabulary file."""
    shared = spark.sparkContext.broadcast(bpe.load_spec(vocabulary))
    key = uuid.uuid4().hex
    return lambda: bpe.codec_of(key, shared.value)


def ids_of(lists: pa.Array) -> Iterator[np.ndarray]:
    """The ids of each row of a list<int32> array; none for null."""
    values = lists.values.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    for i, ok in enumerate(lists.is_valid().to_pylist()):
        yield values[offsets[i]: offsets[i + 1]] if ok else values[:0]


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", out_col: str = "token_ids") -> DataFrame:
    """``docs`` with a column ``out_col`` (array of int): the token ids of the whole text."""
    codec = _codec(docs.sparkSession, vocabulary)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec()
        for texts in batches:
            packed = [c.encode(t.as_py() or "") for t in texts]
            ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))

    return docs.withColumn(out_col, ids(F.col(f"`{text_col}`")))


def decode(docs: DataFrame, vocabulary: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with a column ``out_col``: the text of the tokens in ``ids_col``."""
    tokens = docs.sparkSession.sparkContext.broadcast(bpe.decoding_table(bpe.load_spec(vocabulary)))

    @F.arrow_udf(T.StringType())
    def texts(lists: pa.Array) -> pa.Array:
        offset, blob = tokens.value
        return pa.array([bpe.decode(x, offset, blob).decode("utf-8", "replace") for x in ids_of(lists)], pa.string())

    return docs.withColumn(out_col, texts(F.col(f"`{ids_col}`")))


@F.arrow_udf(T.StringType())
def ids_sha256(lists: pa.Array) -> pa.Array:
    """Hex digest of the ids as little-endian unsigned 32-bit integers."""
    return pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids_of(lists)], pa.string())


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document."""
    coded = decode(encode(docs.select("doc_id", "text"), vocabulary), vocabulary)
    return coded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                        ids_sha256("token_ids").alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every whole text and decode it again."""
    return digests(table(spark, sf_dir, "documents"), default_vocabulary())
