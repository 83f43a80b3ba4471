"""Word tokens of lines, hashed and ordered in numpy for many lines at once."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes that are worked on at once; a longer line is taken whole. Bytes whose words are hashed at once.
STEP = 1 << 18
_PIECE = 1 << 16
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: What a byte counts in the hash of its word; white space: nothing.
_VALUE = np.where(_SPACE, 0, np.arange(1, 257)).astype(np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """At least ``n`` powers of an odd base, modulo 2 ** 64."""
    if len(_powers.get(base, ())) < n:
        steps = np.full(max(n, _PIECE), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base]


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on all."""
    h = h ^ np.uint64(salt)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Lines:
    """The lines of some texts (bytes), cut at line feeds: ``doc`` (place of the text) and ``number`` of each."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n" if texts else b"", np.uint8)
        self.feeds = np.flatnonzero(self.data == 10)
        ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) - 1
        self.doc = np.searchsorted(ends, self.feeds)
        first = np.searchsorted(self.doc, np.arange(len(texts)))
        self.number = np.arange(len(self.feeds)) - first[self.doc]
        self.start = np.concatenate([[0], self.feeds[:-1] + 1]) if len(self.feeds) else self.feeds

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]: self.feeds[i]].tobytes()

    def tokens(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of lines of about ``STEP`` bytes: the line and the hash of each word, in order."""
        at = 0
        while at < len(self.feeds):
            begin = self.start[at]
            to = max(at + 1, int(np.searchsorted(self.feeds, begin + STEP)))
            part = self.data[begin: self.feeds[to - 1] + 1]
            space = (part == 32) | (part - np.uint8(9) < 5)
            before = np.concatenate([[True], space[:-1]])
            starts, ends = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
            if len(starts):
                upto = np.searchsorted(starts, self.feeds[at:to] - begin)  # words up to the end of each line
                line = np.repeat(np.arange(at, to), np.diff(upto, prepend=0))
                yield line, mixed(self._hashes(part, starts, ends))
            at = to

    @staticmethod
    def _hashes(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Sums of (byte + 1) * base ** (its place in the word): powers by the place in a piece, brought back to each word's start."""
        out, at = [], 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + _PIECE)))
            low, high = starts[at], ends[to - 1]
            first = starts[at:to] - low
            value = _VALUE[part[low:high]]
            value *= _power(_BASE, high - low)[:high - low]
            out.append(np.add.reduceat(value, first) * _power(pow(_BASE, -1, 1 << 64), int(first[-1]) + 1)[first])
            at = to
        return np.concatenate(out)


def _order(line: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The order by line, then rank: by one number of 64 bits, unless what it leaves out matters."""
    near = line - line[0]
    if near[-1] < 1 << 16:
        key = (near.astype(np.uint64) << np.uint64(48)) | (rank >> np.uint64(16))
        order = np.argsort(key)
        key, rank = key[order], rank[order]
        if not ((key[1:] == key[:-1]) & (rank[1:] != rank[:-1])).any():
            return order
        rank = rank[np.argsort(order)]
    return np.lexsort((rank, line))


def line_sets(lines: Lines, codes: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """Sets of distinct words, for runs of lines: line, size, two hashes of the set, and its words in order.

    Words are numbers: a code of how common a word is (from ``codes``, by the leading bits of its hash), then bits of
    its hash; their order is the same everywhere. They come as one array, sorted within each line.
    """
    bits = 64 - (len(codes).bit_length() - 1) if codes is not None else 64
    for line, h in lines.tokens():
        code = codes[h >> np.uint64(bits)].astype(np.uint64) if codes is not None else np.uint64(0)
        rank = (code << np.uint64(56)) | (h >> np.uint64(8))
        order = _order(line, rank)
        line, rank = line[order], rank[order]
        new_line = np.concatenate([[True], line[1:] != line[:-1]])
        keep = new_line | np.concatenate([[True], rank[1:] != rank[:-1]])
        line, rank, new_line = line[keep], rank[keep], new_line[keep]
        first = np.flatnonzero(new_line)
        hashed = rank << np.uint64(8)  # without the code: the same with any table
        k1, k2 = (np.add.reduceat(mixed(hashed, salt), first) for salt in (0x5BD1E995, 0x27D4EB2F165667C5))
        yield line[first], np.diff(np.append(first, len(line))), k1, k2, rank
