"""Vectorised word splitting and hashing over Arrow string columns.

Works on the UTF-8 bytes of a whole column slice at once: word boundaries come
from a 256-entry byte table, word hashes from one polynomial prefix sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .state import kept_small

U64 = np.uint64
_B = U64(0x9E3779B97F4A7C15)
_Q = U64(0xC2B2AE3D27D4EB4F)
_Q2 = U64(0x165667B19E3779F9)
SLICE_BYTES = 1 << 18


def _table(word: list[tuple[int, int]], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(is a word byte, byte value after lower-casing A-Z) for each byte."""
    is_word = np.zeros(256, bool)
    for a, b in word:
        is_word[a : b + 1] = True
    value = np.arange(256, dtype=np.uint8)
    if lower:
        value[0x41:0x5B] += 0x20
    return is_word, value


#: [^\x20\x09-\x0D]+ unchanged
SPACED = _table([(0, 8), (14, 31), (33, 255)], False)
#: the same runs, A-Z lower-cased
SPACED_LOWER = _table([(0, 8), (14, 31), (33, 255)], True)
#: A-Z lower-cased, then [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
PLAIN = _table([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)], True)

_powers: dict[int, np.ndarray] = kept_small({})


def _pow(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept between calls, grown by doubling."""
    kept = _powers.get(int(base))
    if kept is None or len(kept) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        kept = np.ones(size, U64)
        with np.errstate(over="ignore"):
            kept[1:] = np.cumprod(np.full(size - 1, base, U64), dtype=U64)
        if size <= 1 << 22:
            _powers[int(base)] = kept
    return kept[:n]


def _inverse(base: np.uint64) -> np.uint64:
    return U64(pow(int(base), -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over 64 bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
        return h ^ (h >> U64(31))


def ngrams(h: np.ndarray, n: int, base: np.uint64 = _Q) -> np.ndarray:
    """Hash of each n consecutive word hashes (len(h) - n + 1 of them)."""
    if len(h) < n:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        c = np.zeros(len(h) + 1, U64)
        np.cumsum(h * _pow(base, len(h)), out=c[1:])
        return mix((c[n:] - c[:-n]) * _pow(_inverse(base), len(h) - n + 1))


def ngrams2(h: np.ndarray, n: int) -> np.ndarray:
    """A second, independent hash of the same windows."""
    return ngrams(h, n, _Q2)


class Slice:
    """Words of consecutive texts.

    start, end: byte positions in ``data``; ``first[i]:first[i+1]`` are the
    words of text i; ``hashes``: one 64-bit hash a word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: tuple[np.ndarray, np.ndarray]):
        self.table, self.data, self.offsets, self.value = table, data, offsets, table[1]

    def __getattr__(self, name: str):
        if name not in ("start", "end", "first"):
            raise AttributeError(name)
        self._split()
        return self.__dict__[name]

    def _split(self) -> None:
        data, offsets, is_word = self.data, self.offsets, self.table[0]
        n = len(data)
        w = is_word[data]
        step = np.zeros(n + 1, np.int8)
        if n:
            step[1:n] = w[1:].view(np.int8) - w[:-1].view(np.int8)
            step[0] = w[0]
        begins = step[:n] == 1
        cut = offsets[(offsets > 0) & (offsets < n)]
        begins[cut] = w[cut]
        ends = np.zeros(n + 1, bool)
        ends[:n] = step[:n] == -1
        if n:
            ends[n] = w[n - 1]
        ends[cut] = w[cut - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends)
        self.first = np.searchsorted(self.start, offsets)

    @property
    def hashes(self) -> np.ndarray:
        with np.errstate(over="ignore"):
            c = np.zeros(len(self.data) + 1, U64)
            np.cumsum((self.value[self.data].astype(U64) + U64(1)) * _pow(_B, len(self.data)), out=c[1:])
            h = (c[self.end] - c[self.start]) * _pow(_inverse(_B), len(self.data) + 1)[self.start]
        return mix(h + (self.end - self.start).astype(U64))

    def words(self, a: int, b: int) -> list[bytes]:
        """The words a..b-1 as bytes, after lower-casing if the table has it."""
        d = self.value[self.data[self.start[a] : self.end[b - 1]]].tobytes() if b > a else b""
        at = self.start[a] if b > a else 0
        return [d[s - at : e - at] for s, e in zip(self.start[a:b], self.end[a:b], strict=True)]


def slices(column: pa.Array, table: tuple[np.ndarray, np.ndarray], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Slice]]:
    """(from, to, words) for runs of texts of about ``limit`` bytes; null texts
    are empty.  A longer text is a run of its own, whole."""
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, b, Slice(data[off[a] : off[b]], (off[a : b + 1] - off[a]).astype(np.int64), table)
        a = b
