"""Byte-level BPE by backtracking over Aho-Corasick matches, and decoding through an offset table.

The vocabulary is that of a ``tokenizers`` JSON file (model BPE, pre-tokenizer and decoder ByteLevel). Greedy
merging of a piece has exactly one result, and a sequence of tokens is that result if and only if each two
neighbours are compatible: merging their joined bytes gives back the same two tokens. So a piece is encoded left
to right with the longest token that matches (one pass of an Aho-Corasick automaton finds all matches), falling
back to the next shorter one, and to the token before, where a neighbour is not compatible. A position that led
nowhere is never entered again, which bounds the steps by the length of the piece.
"""
from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import regex

#: Pieces up to so many characters are remembered, and so many of them at most.
CACHED_CHARS, CACHED_PIECES = 48, 150_000
#: Compatible pairs that are remembered.
CACHED_PAIRS = 200_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _classes(pre_tokenizer) -> dict[str, str]:
    """Bodies of regular expression classes for letters, numbers and white space.

    ``unicodedata`` decides, except for code points which it does not know: the tables of the tokenizer can be
    newer, so those that ``regex`` knows as letters or numbers are asked of ``pre_tokenizer`` itself (a letter
    joins an ``a`` before it, a number a ``1``).
    """
    kinds: dict[str, list[int]] = {"L": [], "N": []}
    unknown, newer = [], regex.compile(r"[\p{L}\p{N}]").match
    for i in range(0x110000):
        k = unicodedata.category(chr(i))
        if k[0] in kinds:
            kinds[k[0]].append(i)
        elif k == "Cn" and newer(chr(i)):
            unknown.append(i)
    if pre_tokenizer is not None:
        for kind, lead in (("L", "a"), ("N", "1")):
            for at in range(0, len(unknown), 4096):
                some = unknown[at: at + 4096]
                cut = pre_tokenizer.pre_tokenize_str("".join(f"\n{lead}{chr(i)}" for i in some))
                joined = {3 * k for k in range(len(some))}  # where the k-th triple begins
                for _, (start, end) in cut:
                    if end - start == 2 and start - 1 in joined:
                        kinds[kind].append(some[(start - 1) // 3])
    out = {}
    for kind, points in kinds.items():
        points.sort()
        for name, some in ((kind, points), (f"{kind} low", [p for p in points if p <= 0xFFFF])):
            runs, first = [], None
            for i, p in enumerate(some):
                first = p if first is None else first
                if i + 1 == len(some) or some[i + 1] != p + 1:
                    runs.append(f"\\U{first:08x}-\\U{p:08x}" if p > first else f"\\U{p:08x}")
                    first = None
            out[name] = "".join(runs)
    spaces = [i for i in range(0x3001) if chr(i).isspace() and not 0x1C <= i <= 0x1F]
    out["W"] = "".join(f"\\U{i:08x}" for i in spaces)
    return out


@lru_cache(maxsize=8)
def load_spec(path: str) -> dict:
    """What the tasks need of a vocabulary file; plain data of the file's size, for a broadcast.

    Raises ValueError for files that are not byte-level BPE as described at the top of this module.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        j = json.load(f)
    model, pre = j["model"], j.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or j.get("normalizer"):
        raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
    alphabet, vocab = byte_alphabet(), model["vocab"]
    tokens: list[bytes] = [bytes([b]) for b in range(256)]
    ids = [vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])]
    index = {t: i for i, t in enumerate(tokens)}
    left, right = list(range(256)), list(range(256))
    for merge in model["merges"]:
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        x, y = (bytes(alphabet[c] for c in s) for s in (a, b))
        if x + y in index:
            raise ValueError(f"{path}: two merges give the same token")
        index[x + y] = len(tokens)
        left.append(index[x])
        right.append(index[y])
        tokens.append(x + y)
        ids.append(vocab[a + b])
    added = {x["content"]: x["id"] for x in j.get("added_tokens", [])}
    if any(x.get(k) for x in j.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path}: added tokens that strip or normalise are not supported")
    return {"tokens": tokens, "ids": ids, "left": left, "right": right, "added": added,
            "classes": _classes(Tokenizer.from_file(path).pre_tokenizer)}


class Codec:
    """Encoder of one vocabulary."""

    def __init__(self, spec: dict):
        self.tokens, self.ids = spec["tokens"], spec["ids"]
        self.left, self.right = spec["left"], spec["right"]
        self.size = [len(t) for t in self.tokens]
        self.merged = {(a << 20) | b: i for i, (a, b) in enumerate(zip(self.left, self.right)) if i >= 256}
        self.index = {t: i for i, t in enumerate(self.tokens)}
        self.shorter = [self._prefix(t) for t in self.tokens]
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(self.tokens):
            self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        c = spec["classes"]
        self.all_pieces = self._pattern(c["L"], c["N"], c["W"])
        self.low_pieces = self._pattern(c["L low"], c["N low"], c["W"])  # re has fast tables for these alone
        added = sorted(spec["added"], key=len, reverse=True)
        self.added = {t: array("I", [spec["added"][t]]).tobytes() for t in added}
        self.split_added = re.compile("(" + "|".join(map(re.escape, added)) + ")").split if added else None
        self.cache = _Pieces(self)

    @staticmethod
    def _pattern(letters: str, numbers: str, spaces: str):
        return re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
            f"|[{spaces}]+(?![^{spaces}])|[{spaces}]+").findall

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text, which are encoded one by one."""
        low = len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
        return (self.low_pieces if low else self.all_pieces)(text)

    def _prefix(self, t: bytes) -> int:
        """The longest token that is a proper prefix of ``t``, or -1."""
        return next((self.index[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.index), -1)

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of ``a`` and ``b`` ends in just these two tokens.

        Undo the merges at the border from the latest to the earliest: had two tokens that met there been a
        merge that comes before the merge which was undone last, it would have been made first.
        """
        key = (a << 20) | b
        x, y, bound, good = a, b, 1 << 30, True
        while True:
            if self.merged.get((x << 20) | y, 1 << 30) < bound:
                good = False
                break
            if x > y:  # x was made later than y
                if x < 256:
                    break
                bound, x = x, self.right[x]
            else:
                if y < 256:
                    break
                bound, y = y + 1, self.left[y]
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        self.pairs[key] = good
        return good

    def encode_piece(self, b: bytes) -> list[int]:
        """The tokens (by place in the merge order) of one piece."""
        if (whole := self.index.get(b)) is not None:
            return [whole]
        text, pairs, compatible, size = b.decode("latin-1"), self.pairs, self.compatible, self.size
        # the longest match at the start and after each match: most often these are compatible as they are
        first = [t for _, t in self.automaton.iter_long(text)]
        out, at = [first[0]], size[first[0]]
        for t in first[1:]:
            good = pairs.get((out[-1] << 20) | t)
            if not (compatible(out[-1], t) if good is None else good):
                break
            out.append(t)
            at += size[t]
        else:
            return out
        n, shorter = len(b), self.shorter
        longest = [0] * n
        for end, m in self.automaton.iter(text):  # of one start, the longest comes last
            longest[end + 1 - size[m]] = m
        dead = bytearray(n + 1)
        while True:
            end = at + size[t]
            if not dead[end]:
                good = not out or pairs.get((out[-1] << 20) | t)
                if compatible(out[-1], t) if good is None else good:
                    out.append(t)
                    if end == n:
                        return out
                    at, t = end, longest[end]
                    continue
            if shorter[t] >= 0:
                t = shorter[t]
            else:
                dead[at] = 1
                t = out.pop()
                at -= size[t]

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.split_added is None:
            return b"".join(map(self.cache.__getitem__, self.pieces(text)))
        parts = self.split_added(text)
        return b"".join(self.added[p] if i % 2 else b"".join(map(self.cache.__getitem__, self.pieces(p)))
                        for i, p in enumerate(parts) if p)


def decoding_table(spec: dict) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of all tokens by id: those of id i are ``blob[offset[i]:offset[i + 1]]``."""
    by_id = dict(zip(spec["ids"], spec["tokens"])) | {i: t.encode() for t, i in spec["added"].items()}
    parts = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    return (np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64),
            np.frombuffer(b"".join(parts), np.uint8))


def decode(ids: np.ndarray, offset: np.ndarray, blob: np.ndarray) -> bytes:
    """The bytes of the tokens ``ids``, gathered through the offset table."""
    if not len(ids):
        return b""
    start = offset[ids]
    size = offset[np.asarray(ids, np.int64) + 1] - start
    ends = np.cumsum(size)
    return blob[np.arange(int(ends[-1])) + np.repeat(start - (ends - size), size)].tobytes()


class _Pieces(dict):
    """Packed ids by piece; forgets all when full, so that it stays bounded."""

    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        ids = self.codec.ids
        out = array("I", [ids[t] for t in self.codec.encode_piece(piece.encode("utf-8", "surrogatepass"))]).tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = out
        return out


_CODECS: dict[str, Codec] = {}


def codec_of(key: str, spec: dict) -> Codec:
    """The codec of a broadcast ``spec``, built once for each worker process."""
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(spec)
    return _CODECS[key]
