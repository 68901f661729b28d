"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Only lengths matter to a packing, and there are at most ``capacity`` of them.
So the driver packs a histogram: it fixes sets that provably dominate every
alternative, then packs the shrunk instance by best fit decreasing, many equal
bins at a time.  Rows learn their place from their number among the rows of
their length; rows never meet in one task.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoding import encoder
from .sharding import gapless
from .state import bounded_batches, n_parts, written
from .textcore import SPACED, slices

Bins = list[tuple[tuple[int, ...], int]]


def dominance(counts: dict[int, int], capacity: int) -> tuple[Bins, dict[int, int]]:
    """(bins fixed for good, what is left), by Martello and Toth's criterion:
    an item is fixed with the set that dominates all it could stand with.

    What makes a set dominate only gets stronger as items go, so as many equal
    bins are fixed at once as the items last: each step uses up a size, and
    there are as many steps as sizes, not as items.
    """
    left = {s: n for s, n in counts.items() if n}
    fixed: Bins = []
    changed = True
    while changed:
        changed = False
        for s in sorted(left, reverse=True):
            while left.get(s) and (chosen := _dominating(s, left, capacity)):
                need = Counter(chosen)
                n = min(left[t] // m for t, m in need.items())
                fixed.append((chosen, n))
                for t, m in need.items():
                    left[t] -= n * m
                changed = True
        left = {t: n for t, n in left.items() if n}
    return fixed, left


def _dominating(s: int, left: dict[int, int], capacity: int) -> tuple[int, ...] | None:
    """The items of the bin that dominates all bins with an item of size s.

    k: the most further items that fit beside it; first: the largest that does.
    k = 0: s alone.  s and first, if they fill the bin, if k = 1, or if k = 2
    and first is as large as any two that fit.  s, first and second, if k = 2,
    second is the largest that fits beside both, and no two that are larger
    than second fit: then of any two one is at most first, the other at most
    second.
    """
    room = capacity - s
    own = [(t, left[t] - (t == s)) for t in sorted(left) if left[t] > (t == s) and t <= room]
    if not own:
        return (s,)
    first = own[-1][0]
    k, used = 0, 0
    for t, n in own:
        take = min(n, (room - used) // t)
        k, used = k + take, used + take * t
        if take < n or k > 2:
            break
    if first == room or k == 1:
        return s, first
    if k > 2:
        return None
    if first >= _best_pair(own, room):
        return s, first
    rest = [(t, n - (t == first)) for t, n in own if n > (t == first)]
    second = max((t for t, _ in rest if t <= room - first), default=None)
    if second is None:
        return None
    larger = [t for t, n in rest if t > second for _ in range(min(n, 2))][:2]
    return (s, first, second) if len(larger) < 2 or sum(larger) > room else None


def _best_pair(own: list[tuple[int, int]], room: int) -> int:
    """The largest sum of two of the items within ``room``; 0 if none fits."""
    best, have = 0, dict(own)
    for t, n in own:
        for u in range(min(room - t, own[-1][0]), t - 1, -1):
            if have.get(u, 0) > (u == t):
                best = max(best, t + u)
                break
    return best


def best_fit(counts: dict[int, int], capacity: int) -> Bins:
    """Best fit decreasing over a histogram; equal bins are handled together."""
    open_bins: dict[int, list[list]] = {}  # room: [contents, how many]
    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            room = min((r for r in open_bins if r >= s), default=None)
            if room is None:
                each = min(capacity // s, n)
                bins = n // each
                open_bins.setdefault(capacity - each * s, []).append([(s,) * each, bins])
                n -= each * bins
                continue
            contents, have = open_bins[room].pop()
            each = min(room // s, n)
            bins = min(have, n // each)
            if have > bins:
                open_bins[room].append([contents, have - bins])
            if not open_bins[room]:
                del open_bins[room]
            open_bins.setdefault(room - each * s, []).append([contents + (s,) * each, bins])
            n -= each * bins
    return [(tuple(c), n) for bins in open_bins.values() for c, n in bins]


def plan(counts: dict[int, int], capacity: int) -> Bins:
    fixed, left = dominance(counts, capacity)
    return fixed + best_fit(left, capacity)


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, key: str, text: str, with_ids: bool) -> DataFrame:
    """key, piece, start, length, ids_crc32 (and ids) of each row's pieces."""
    kind = docs.select(key).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for x, y, s in slices(batch.column(1), SPACED):
                ids, n = enc.encode(s.data, s.offsets)
                ids = np.insert(ids.astype("<u4"), np.cumsum(n), end_id)
                n = n + 1
                pieces = -(-n // capacity)
                doc = np.repeat(np.arange(y - x), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = (n - (pieces - 1) * capacity)[doc]
                start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
                length = np.where(piece == 0, head, capacity)
                at = (np.cumsum(n) - n)[doc] + start
                raw = ids.tobytes()
                cuts = [raw[4 * a : 4 * (a + m)] for a, m in zip(at.tolist(), length.tolist(), strict=True)]
                columns = [batch.column(0)[x:y].take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array([zlib.crc32(c) for c in cuts], pa.int64())]
                names = [key, "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(cuts, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """key, piece, start, length, ids_crc32, sequence_id, offset of each piece
    (with ``ids``, little-endian unsigned 32-bit, if asked for).

    A document is the ids of its text and then ``end_id``.  One of more than
    ``capacity`` ids is cut into pieces of ``capacity``, the first one shorter
    where they don't divide.  Pieces share sequences of at most ``capacity``
    ids, placed at ``offset`` without gaps from 0.

    A null text is empty: its document is ``end_id`` alone.  A null key stays
    null and rows repeated whole are packed each.  An empty table gives no
    rows; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    pieces = written(cut_pieces(docs, tokenizer, capacity, end_id, key, text, with_ids), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    lanes = n_parts(docs.sparkSession, pieces)
    numbered = gapless(pieces, "length", [key, "piece", "ids_crc32"], "rank", lanes)
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    base = 0
    for contents, bins in plan(counts, capacity):
        at = 0
        for s in contents:
            slots.setdefault(s, []).append((used.get(s, 0), bins, base, at))
            used[s] = used.get(s, 0) + bins
            at += s
        base += bins
    sent = docs.sparkSession.sparkContext.broadcast({s: np.array(x, np.int64) for s, x in slots.items()})
    at_length, at_rank = numbered.columns.index("length"), numbered.columns.index("rank")
    names = [c for c in numbered.columns if c != "rank"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema if f.name != "rank") + ", sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            length, rank = batch.column(at_length).to_numpy(), batch.column(at_rank).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            begin = np.flatnonzero(np.diff(length[order], prepend=-1))
            for a, b in zip(begin, np.append(begin[1:], len(order)), strict=True):
                rows = order[a:b]
                x = table[int(length[rows[0]])]
                slot = np.searchsorted(x[:, 0], rank[rows], "right") - 1
                sequence[rows] = x[slot, 2] + rank[rows] - x[slot, 0]
                offset[rows] = x[slot, 3]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns) if i != at_rank), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return numbered.mapInArrow(place, schema)
