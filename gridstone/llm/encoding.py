"""Byte-level BPE ids of whole texts through the ``tokenizers`` library.

A text is cut where the pre-tokeniser provably cuts too, each distinct piece
is encoded once by the library, and the ids of a text are gathered from its
pieces.  Provable cuts, for the pattern of byte-level BPE vocabularies:

* before a space that a non-space character follows: a run of white space
  gives up its last space to the word behind it, wherever the run began;
* around a line feed between two solid characters: it is a token of its own;
* between an ASCII letter and ASCII punctuation that neither starts a
  contraction (``'``) nor occurs in a special token (``<|>``).

They hold for the GPT-2 pattern and for added tokens without such a cut inside;
a vocabulary file with anything else is refused.  A piece is looked up by 96
bits of two hashes of its bytes and its length.
"""

from __future__ import annotations

import json
import os

import numpy as np

from .state import held
from .textcore import U64, _B, _Q2, _inverse, _pow, mix

_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True
_SOLID[0xC3:0xE1] = True
_SOLID[0xE4:0xF5] = True
_PRINT = np.zeros(256, bool)
_PRINT[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_POINT = np.zeros(256, bool)
for _c in b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~":
    _POINT[_c] = True
SLOTS = 1 << 21
MOST_IDS = 8_000_000


def library(path: str):
    """The library's tokenizer, single-threaded, without truncation or padding."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def _cuts(data: np.ndarray) -> np.ndarray:
    """Before which bytes of one text the pre-tokeniser provably cuts; a space
    at the text's end is no cut."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n:
        solid = _SOLID[data]
        cut[: n - 1] = (data[:-1] == 0x20) & solid[1:]
        feed = np.flatnonzero((data[1:-1] == 0x0A) & _PRINT[data[:-2]] & solid[2:]) + 1 if n > 2 else np.zeros(0, np.int64)
        cut[feed] = cut[feed + 1] = True
        cut[1:n] |= _LETTER[data[:-1]] & _POINT[data[1:]]
    return cut


def supported(path: str) -> None:
    """Raise ValueError unless the provable cuts hold for this vocabulary."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    before = made.get("pre_tokenizer") or {}
    if made.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        raise ValueError(f"{path}: only byte-level pre-tokenisers without prefix space and normaliser")
    for token in made.get("added_tokens") or ():
        own = np.frombuffer(token["content"].encode(), np.uint8)
        if token.get("lstrip") or token.get("rstrip") or token.get("single_word") or 0x20 in own or 0x0A in own or _cuts(own)[1 : len(own)].any():
            raise ValueError(f"{path}: added token {token['content']!r} may hold a cut")


class PieceEncoder:
    """Ids by piece, kept in a table of fixed size (two places a piece, the
    older entry gives way); a pool of more than MOST_IDS ids starts anew."""

    def __init__(self, path: str):
        supported(path)
        self.tokenizer = library(path)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self._clear()

    def _clear(self) -> None:
        self.keys, self.check, self.place = np.zeros(SLOTS, U64), np.zeros(SLOTS, np.uint32), np.zeros(SLOTS, np.int64)
        self.pool, self.used = np.zeros(1 << 16, self.kind), 0

    def _learn(self, keys: np.ndarray, check: np.ndarray, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encode distinct pieces and keep them: (start in the pool, size) of each."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        total = int(size.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), self.kind)])
        self.pool[self.used : self.used + total] = np.fromiter((i for ids in got for i in ids), self.kind, total)
        begin = self.used + np.cumsum(size) - size
        self.used += total
        small = size < 1 << 20  # a longer piece is not kept
        one, two = (keys & U64(SLOTS - 1)).astype(np.int64), (keys >> U64(40) & U64(SLOTS - 1)).astype(np.int64)
        slot = np.where(self.keys[one] == 0, one, two)[small]
        slot, last = np.unique(slot[::-1], return_index=True)  # of two new pieces for one place the last stays
        self.keys[slot] = keys[small][::-1][last]
        self.check[slot] = check[small][::-1][last]
        self.place[slot] = (begin << 20 | size)[small][::-1][last]
        return begin, size

    def _known(self, h: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one = (h & U64(SLOTS - 1)).astype(np.int64)
        hit = (self.keys[one] == h) & (self.check[one] == check)
        place = self.place[one]
        rest = np.flatnonzero(~hit)
        two = (h[rest] >> U64(40) & U64(SLOTS - 1)).astype(np.int64)
        also = (self.keys[two] == h[rest]) & (self.check[two] == check[rest])
        place[rest[also]] = self.place[two[also]]
        hit[rest[also]] = True
        return hit, place

    @staticmethod
    def _hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64) -> np.ndarray:
        n = len(data)
        with np.errstate(over="ignore"):
            c = np.zeros(n + 1, U64)
            np.cumsum((data.astype(U64) + U64(1)) * _pow(base, n), out=c[1:])
            return (c[end] - c[start]) * _pow(_inverse(base), n + 1)[start] + (end - start).astype(U64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, how many each text has); text i is the
        UTF-8 bytes ``data[offsets[i]:offsets[i+1]]``."""
        ids, start, upto = self._pieces(data, offsets)
        return ids, np.diff(upto[np.searchsorted(start, offsets)])

    def offsets(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of ``text``, places in it where a token provably begins, the
        numbers of those tokens); places in code points."""
        data = np.frombuffer(text.encode(), np.uint8)
        ids, start, upto = self._pieces(data, np.array([0, len(data)], np.int64))
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        return ids, chars[start], upto[:-1]

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first byte of each piece, number of ids before each piece and
        before the end)."""
        n = len(data)
        if n == 0:
            return np.zeros(0, self.kind), np.zeros(0, np.int64), np.zeros(1, np.int64)
        cut = _cuts(data)
        edge = offsets[1:-1]
        edge = edge[(edge > 0) & (edge < n)]
        # around a line feed at the edge of two texts nothing is proven
        for at in (edge, edge[edge > 1] - 1):
            near = at[(data[at] == 0x0A) & (at + 1 < n)]
            cut[near] = cut[near + 1] = False
        cut[1:n] |= _LETTER[data[:-1]] & _POINT[data[1:]]
        last = offsets[1:][offsets[1:] > 0] - 1
        cut[last] &= data[last] != 0x20  # the space that ends a text has nothing behind it
        cut[offsets] = True
        cut[n] = False
        start = np.flatnonzero(cut)
        end = np.append(start[1:], n)
        h = mix(self._hash(data, start, end, _B))
        check = (mix(self._hash(data, start, end, _Q2)) >> U64(32)).astype(np.uint32)
        if self.used > MOST_IDS:
            self._clear()
        hit, place = self._known(h, check)
        size = place & 0xFFFFF
        begin = place >> 20
        miss = np.flatnonzero(~hit)
        if len(miss):
            both = np.lexsort((check[miss], h[miss]))
            fresh = np.append(True, (h[miss][both][1:] != h[miss][both][:-1]) | (check[miss][both][1:] != check[miss][both][:-1]))
            inverse = np.empty(len(miss), np.int64)
            inverse[both] = np.cumsum(fresh) - 1
            new = miss[both[fresh]]
            raw = data.tobytes()
            begins, sizes = self._learn(h[new], check[new], [raw[a:b].decode("utf-8") for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)])
            size[miss] = sizes[inverse]
            begin[miss] = begins[inverse]
        past = np.cumsum(size)
        ids = self.pool[np.repeat(begin - (past - size), size) + np.arange(past[-1])]
        return ids, start, np.concatenate([[0], past])


def encoder(path: str) -> PieceEncoder:
    """One a worker process and vocabulary file."""
    return held(("encoder", path), lambda: PieceEncoder(path))
