"""Chat formatting: conversations as training text, assembled column-wise into one buffer.

Template of a turn: ``<turn>`` role ``<text>`` text ``</turn>`` and a line feed. Inside roles and texts, ``<`` becomes
``<\\`` and ``\\`` becomes ``\\\\``, so a marker can't occur in them, not even as part of a word, and the way back is
unique. Under the loss mask is the text of each assistant turn, without markers.

Rows are dealt out by conversation, sorted by turn, and formatted by Arrow batch: lengths of all segments, their
cumulative offsets, and the target index of every byte are computed in numpy, and headers and contents are scattered
into one preallocated Arrow buffer. Conversations go on from batch to batch; what a task holds is a batch and the
conversation that it has begun. A conversation becomes one cell, which Arrow limits to 2 GB.

Defined cases: a null role or text counts as empty; rows of equal turn are ordered by role, then text, nulls first,
and repeated rows are all kept; null turns come first; rows with a null conv_id form one conversation; only the role
``assistant`` as it stands is under the mask; a conversation without it has no spans and an empty loss text; an empty
table gives an empty result, and other columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import table
from quayside.llm.registry import register

OPEN, MIDDLE, CLOSE = b"<turn>", b"<text>", b"</turn>\n"
LT, BACKSLASH = 0x3C, 0x5C
_ESCAPED = re.compile(r"([<\\])\\")
ASSISTANT = "assistant"


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings on end, and the length of each; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]: offsets[-1]], np.diff(offsets)


def _sums(lengths: np.ndarray) -> np.ndarray:
    """Offsets from lengths: 0, then the cumulative sums."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def escape(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings on end with a backslash after each ``<`` and each backslash, and their new lengths."""
    special = (data == LT) | (data == BACKSLASH)
    before = _sums(special)
    out = np.full(len(data) + int(before[-1]), BACKSLASH, np.uint8)
    out[np.arange(len(data)) + before[:-1]] = data
    ends = _sums(lengths)
    return out, lengths + before[ends[1:]] - before[ends[:-1]]


def unescape(text: str) -> str:
    return text if "\\" not in text else _ESCAPED.sub(r"\1", text)


def _scatter(out: np.ndarray, data: np.ndarray, lengths: np.ndarray, starts: np.ndarray) -> None:
    """Copy strings on end to where each of them starts."""
    out[np.arange(len(data)) + np.repeat(starts - _sums(lengths)[:-1], lengths)] = data


def assemble(rows: pa.Table, first: np.ndarray) -> pa.RecordBatch:
    """Format whole conversations: ``rows`` in order, ``first`` the row at which each conversation begins."""
    roles, texts = rows.column("role").combine_chunks(), rows.column("text").combine_chunks()
    role, role_n = escape(*_bytes_of(roles))
    text, text_n = escape(*_bytes_of(texts))
    fixed = len(OPEN) + len(MIDDLE) + len(CLOSE)
    row = _sums(role_n + text_n + fixed)
    role_at = row[:-1] + len(OPEN)
    middle = role_at + role_n
    text_at = middle + len(MIDDLE)
    close = text_at + text_n
    if row[-1] >= 1 << 31:
        raise ValueError("conversations of over 2 GB in one batch")
    buffer = pa.allocate_buffer(int(row[-1]))
    out = np.frombuffer(buffer, np.uint8)
    for marker, at in ((OPEN, row[:-1]), (MIDDLE, middle), (CLOSE, close)):
        out[at[:, None] + np.arange(len(marker))] = np.frombuffer(marker, np.uint8)
    _scatter(out, role, role_n, role_at)
    _scatter(out, text, text_n, text_at)
    bounds = np.append(first, len(rows))
    turns = np.diff(bounds)
    chars = _sums((out & 0xC0) != 0x80)  # code points before each byte
    begin = chars[row[first]]
    masked = pc.fill_null(pc.equal(roles, ASSISTANT), False).to_numpy(zero_copy_only=False)
    conv = np.repeat(np.arange(len(first)), turns)[masked]
    lists = pa.array(_sums(np.bincount(conv, minlength=len(first))).astype(np.int32))
    spans = [pa.ListArray.from_arrays(lists, pa.array((chars[x[masked]] - begin[conv]).astype(np.int32)))
             for x in (text_at, close)]
    formatted = pa.StringArray.from_buffers(len(first), pa.py_buffer(row[bounds].astype(np.int32)), buffer)
    return pa.RecordBatch.from_arrays(
        [rows.column("conv_id").combine_chunks().take(pa.array(first)), pa.array(turns.astype(np.int64)), formatted, *spans],
        ["conv_id", "n_turns", "formatted", "loss_start", "loss_end"])


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Assemble sorted batches; the last conversation of a batch may go on in the next."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        ids = b.column("conv_id")
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        value = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        new = np.flatnonzero((value[1:] != value[:-1]) | (known[1:] != known[:-1])) + 1
        goes_on = bool(held) and held[-1].column("conv_id")[-1].equals(ids[0])
        if held and not goes_on:
            yield assemble(pa.Table.from_batches(held), np.zeros(1, np.int64))
            held = []
        if len(new):
            start = 0
            if held:
                held.append(b.slice(0, int(new[0])))
                yield assemble(pa.Table.from_batches(held), np.zeros(1, np.int64))
                start, new = int(new[0]), new[1:]
            if len(new):
                last = int(new[-1])
                yield assemble(pa.Table.from_batches([b.slice(start, last - start)]),
                               np.append(start, new[:-1]).astype(np.int64) - start)
                start = last
            held = [b.slice(start)]
        else:
            held.append(b)
    if held:
        yield assemble(pa.Table.from_batches(held), np.zeros(1, np.int64))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, and loss_start / loss_end.

    ``turns`` has columns conv_id, turn, role and text. The arrays are the spans under the loss mask, as code points
    of ``formatted`` with exclusive ends, in order.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.drop("turn").mapInArrow(
        _by_conversation, "conv_id long, n_turns long, formatted string, loss_start array<int>, loss_end array<int>")


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    out = []
    for turn in formatted.split(CLOSE.decode())[:-1]:
        role, _, text = turn[len(OPEN):].partition(MIDDLE.decode())
        out.append((unescape(role), unescape(text)))
    return out


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])))
def parsed_turns(formatted: pa.Array) -> pa.Array:
    """The turns of each formatted conversation, read back."""
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    return pa.array([[{"role": r, "text": t} for r, t in parse(f.as_py() or "")] for f in formatted], kind)


@F.arrow_udf(T.StringType())
def loss_text(formatted: pa.Array, start: pa.Array, end: pa.Array) -> pa.Array:
    """All text under the loss mask, unescaped, with nothing between the spans."""
    return pa.array(["".join(unescape(f[a:b]) for a, b in zip(s, e))
                     for f, s, e in zip(formatted.to_pylist(), start.to_pylist(), end.to_pylist())], pa.string())


def read_back(conversations: DataFrame) -> DataFrame:
    """Formatted conversations with ``turns`` (array of role and text) and ``loss_text`` read from them."""
    return (conversations.withColumn("turns", parsed_turns("formatted"))
            .withColumn("loss_text", loss_text("formatted", "loss_start", "loss_end")))


#: The conversation that the query adds: its texts look like control strings.
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"

_ESC = "length({0}) + length({0}) - length(replace({0}, '<', '')) + length({0}) - length(replace({0}, '\\', ''))"

ORACLE = f"""
WITH c AS (
  SELECT conv_id, turn, role AS r0, text AS t0, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT {PROBE_ID}, i, r, '{PROBE_TEXT}', r, '{PROBE_TEXT}' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(i, r)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(20 + {_ESC.format('role')} + {_ESC.format('text')}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


@register("op8_chat_format", ORACLE)
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and the probe, and digest what is read back from the output."""
    probe = spark.createDataFrame([(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    back = read_back(format_conversations(turns))
    on_end = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(on_end, 256).alias("turns_sha256"),
                       F.char_length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))
