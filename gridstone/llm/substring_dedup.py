"""Substring dedup by prefix-partitioned suffix trees.

A suffix is one word position with the words behind it.  A suffix tree node at
depth ``length`` (in words) or more with two leaves is a repeat; nodes of
neighbouring positions together make up the maximal ones.

Suffixes are dealt into groups by a prefix of variable length: it runs from
the suffix's first word to the end of its *anchor*, the ``K`` consecutive
words with the least hash among those in the first ``length`` words.  Equal
suffixes have equal prefixes, and neighbouring suffixes mostly share their
anchor, so a run of them travels as one string of words.  A prefix that is too
frequent for a group (its anchor occurs ``GROUP`` times or more) is lengthened
to ``length`` words, where a group is a single node of the tree.

1. Anchors of all documents are counted.  A suffix whose anchor occurs once is
   a leaf by itself and goes no further.
2. Each part gets the strings of its groups and builds the subtree: prefixes
   of 1, 2, 4, ... words are named by the rank of their pair of shorter names
   (Karp, Miller and Rosenberg), so equal names are one node, and names at
   depth ``length`` put the leaves in order.  All but the first leaf, by
   (document, position), below a deep node repeat an earlier start.
3. Words covered by repeats are cut out of the documents.

A map task joins equal suffixes of its own documents first and sends on the
earliest, so a passage in a third of all documents reaches its part once from
each task.  Strings are compared word by word, by 32 bits of each word's hash
and 32 bits of a second hash of the whole string; where a prefix has the whole
depth, by 128 bits of two hashes of the string.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .state import bounded_batches, n_parts, ordered_ids, release, written
from .textcore import SPACED, U64, Slice, mix, ngrams, ngrams2, slices

K = 6
CHUNK_WORDS = 1_000_000
PART_BYTES = 6 << 20
#: An anchor that occurs so often has its prefixes lengthened; at most so many do, the most frequent of each part.
GROUP, MOST_LONG = 1024, 2_000_000
TREE, WHOLE, KNOWN = 0, 1, 2
_ROWS = "part int, kind int, a binary, b binary, c binary, d binary, p binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("kind", pa.int32()), *((c, pa.binary()) for c in "abcdp")])
_FOUND = pa.schema([("part", pa.int32()), ("d", pa.binary()), ("p", pa.binary())])
_LONG = -1  # in place of a part: anchors to lengthen


def _anchored(s: Slice, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, hash of each K words, first word of each suffix of full
    depth, its anchor's first word), the latter two as indices into the slice."""
    h = s.hashes
    a = ngrams(h, K)
    if len(h) < length:
        none = np.zeros(0, np.int64)
        return h, a, none, none
    least, where, size, width = a, np.arange(len(a)), 1, length - K + 1
    while size < width:
        step = min(size, width - size)
        right = least[step:] < least[:-step]
        where = np.where(right, where[step:], where[:-step])
        least = np.minimum(least[step:], least[:-step])
        size += step
    words = np.diff(s.first)
    upto = np.repeat(s.first[1:], words)  # where the document of a word ends
    full = np.flatnonzero(np.arange(len(where)) + length <= upto[: len(where)])
    return h, a, full, where[full]


def _parts(hashes: np.ndarray, n: int) -> np.ndarray:
    """Equal shares of evenly spread hashes; those of anchors are least ones of
    many, and want mixing first."""
    return ((hashes >> U64(32)) * U64(n) >> U64(32)).astype(np.int32)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... sizes[0] of them, then those of the next."""
    past = np.cumsum(sizes)
    return np.repeat(starts - (past - sizes), sizes) + np.arange(past[-1] if len(past) else 0)


def _send(kind: int, parts: np.ndarray, columns: list[np.ndarray | None], sizes: dict[int, np.ndarray] | None = None) -> Iterator[pa.RecordBatch]:
    """One row a part of the columns' arrays; ``parts`` is sorted.  sizes: how
    many elements of a column belong to each of ``parts``, where not one."""
    if len(parts):
        at = np.flatnonzero(np.diff(parts, prepend=-1))
        ends = np.append(at[1:], len(parts))
        rows = []
        for i, c in enumerate(columns):
            x, y = at, ends
            if sizes and i in sizes:
                upto = np.concatenate([[0], np.cumsum(sizes[i])])
                x, y = upto[at], upto[ends]
            rows.append([None if c is None else c[m:n].tobytes() for m, n in zip(x, y, strict=True)])
        yield pa.RecordBatch.from_arrays([pa.array(parts[at].astype(np.int32)), pa.array(np.full(len(at), kind, np.int32)), *(pa.array(r, pa.binary()) for r in rows)], schema=_SCHEMA)


def _by_doc(docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, part in that order) of documents."""
    parts = _parts(mix(docs.astype(U64)), n)
    order = np.argsort(parts, kind="stable")
    return order, parts[order]


def _known(docs: np.ndarray, pos: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    """What a task knows already goes through the parts by document."""
    order, parts = _by_doc(docs, n)
    yield from _send(KNOWN, parts, [None, None, None, docs[order].astype(np.int64), pos[order].astype(np.int32)])


def _told(docs: np.ndarray, pos: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    """Positions found, as one row a part of documents."""
    order, parts = _by_doc(docs, n)
    for batch in _send(KNOWN, parts, [None, None, None, docs[order].astype(np.int64), pos[order].astype(np.int32)]):
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(5), batch.column(6)], schema=_FOUND)


_NONE = (np.uint8,) * 3
_POSITIONS = (np.int64, np.int32)


def _gathered(batches: Iterator[pa.RecordBatch], kinds: dict[int, tuple]) -> Iterator[dict[int, list[np.ndarray]]]:
    """{kind: its columns}, by the element types of each kind, part by part of
    rows that are sorted by part."""
    for _, rows in groupby((r for batch in batches for r in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)), key=lambda r: r[0]):
        raw: dict[int, list[list[bytes]]] = {k: [[] for _ in types] for k, types in kinds.items()}
        for _, k, *cells in rows:
            for into, x in zip(raw[k], cells, strict=True):
                into.append(x or b"")
        yield {k: [np.frombuffer(b"".join(x), t) for x, t in zip(raw[k], types, strict=True)] for k, types in kinds.items()}


def _later(same: np.ndarray, d: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Of leaves sorted by (node, document, position), same[i] telling that i
    is below the node of i-1: which start later than the first one.  Equal
    starts, of a row that occurs twice, aren't later."""
    begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
    return same & ((d != d[begin]) | (p != p[begin]))


def _anchor_pass(length: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        kept: list[tuple[np.ndarray, ...]] = []
        words = 0

        def flush() -> Iterator[pa.RecordBatch]:
            a, d, p = (np.concatenate(x) for x in zip(*kept, strict=True))
            order = np.argsort(a, kind="stable")
            a, d, p = a[order], d[order], p[order]
            first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
            often = np.diff(np.append(first, len(a)))
            local = np.repeat(often > 1, often)
            yield from _known(d[local], p[local], n)
            parts = _parts(mix(a[first]), n)
            order = np.argsort(parts, kind="stable")
            first, often = first[order], often[order]
            yield from _send(TREE, parts[order], [a[first], often.astype(np.uint32), None, d[first], p[first]])

        for batch in batches:
            ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            there = np.asarray(batch.column(0).is_valid())
            for x, y, s in slices(batch.column(1), SPACED):
                h, a, _, anchor = _anchored(s, length)
                anchor = anchor[np.append(True, anchor[1:] != anchor[:-1])] if len(anchor) else anchor
                doc = np.searchsorted(s.first, anchor, "right") - 1
                ok = there[x:y][doc]
                anchor, doc = anchor[ok], doc[ok]
                kept.append((a[anchor], ids[x:y][doc].astype(np.int64), (anchor - s.first[doc]).astype(np.int32)))
                words += len(h)
                if words > 2 * CHUNK_WORDS:
                    yield from flush()
                    kept, words = [], 0
        if kept:
            yield from flush()

    return run


def _repeated_anchors(n: int):
    most = max(1, MOST_LONG // n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in _gathered(batches, {TREE: (np.uint64, np.uint32, np.uint8, *_POSITIONS), KNOWN: (*_NONE, *_POSITIONS)}):
            a, often, _, d, p = got[TREE]
            order = np.argsort(a, kind="stable")
            a, often, d, p = a[order], often[order], d[order], p[order]
            first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
            total = np.add.reduceat(often.astype(np.int64), first) if len(a) else first
            hit = np.repeat(total > 1, np.diff(np.append(first, len(a))))
            yield from _told(np.concatenate([d[hit], got[KNOWN][3]]), np.concatenate([p[hit], got[KNOWN][4]]), n)
            long = np.flatnonzero(total >= GROUP)
            long = long[np.argsort(-total[long], kind="stable")][:most]
            if len(long):
                yield pa.RecordBatch.from_arrays([pa.array([_LONG], pa.int32()), pa.array([a[first][long].tobytes()]), pa.array([b""])], schema=_FOUND)

    return run


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, p: one row a document of all its positions, from rows by part."""
    docs, pos = [], []
    for batch in batches:
        docs += [x.as_py() for x in batch.column(1)]
        pos += [x.as_py() for x in batch.column(2)]
    d, p = np.frombuffer(b"".join(docs), np.int64), np.frombuffer(b"".join(pos), np.int32)
    order = np.argsort(d, kind="stable")
    ids, at = np.unique(d[order], return_index=True)
    p = np.ascontiguousarray(p[order].astype("<i4"))
    packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(np.append(at, len(d)).astype(np.int64) * 4), pa.py_buffer(p)])
    yield pa.RecordBatch.from_arrays([pa.array(ids), packed.cast(pa.binary())], ["doc", "p"])


def _positions(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all 32-bit integers of a binary column, how many each row has)."""
    size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0)).astype(np.int64) // 4
    return np.frombuffer(b"".join(x or b"" for x in column.to_pylist()), "<i4"), size


def _suffix_pass(length: int, n: int, long):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        kept: list[tuple[np.ndarray, ...]] = []
        have = base = 0

        def flush() -> Iterator[pa.RecordBatch]:
            h, start, anchor, value, d, p, w, c = (np.concatenate(x) for x in zip(*kept, strict=True))
            order = np.lexsort((p, d, c, w))
            same = np.append(False, (w[order][1:] == w[order][:-1]) & (c[order][1:] == c[order][:-1]))[: len(w)]
            later = order[_later(same, d[order], p[order])]
            yield from _known(d[later], p[later], n)
            new = np.ones(len(w), bool)
            new[order[same]] = False
            place = np.minimum(np.searchsorted(long.value, value), max(0, len(long.value) - 1))
            whole = long.value[place] == value if len(long.value) else np.zeros(len(value), bool)

            i = np.flatnonzero(new & whole)
            parts = _parts(w[i], n)
            order = np.argsort(parts, kind="stable")
            i = i[order]
            yield from _send(WHOLE, parts[order], [w[i], None, c[i], d[i], p[i]])

            i = np.flatnonzero(new & ~whole)  # in the order of the texts: runs of one anchor are strings
            if len(i):
                first = np.flatnonzero(np.append(True, (start[i][1:] != start[i][:-1] + 1) | (anchor[i][1:] != anchor[i][:-1])))
                often = np.diff(np.append(first, len(i)))
                parts = _parts(mix(value[i[first]]), n)
                order = np.argsort(parts, kind="stable")
                first, often = first[order], often[order]
                check = (c[i[_ranges(first, often)]] >> U64(32)).astype(np.uint32)
                i, sizes = i[first], often + length - 1
                word = (h[_ranges(start[i], sizes)] >> U64(32)).astype(np.uint32)
                yield from _send(TREE, parts[order], [word, often.astype(np.uint32), check, d[i], p[i]], {0: sizes, 2: often})

        for batch in batches:
            pos, counts = _positions(batch.column(2))
            rows = np.flatnonzero(counts)
            if not len(rows):
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)[rows].astype(np.int64)
            upto = np.concatenate([[0], np.cumsum(counts[rows])])
            texts = batch.column(1).take(pa.array(rows))
            for x, y, s in slices(texts, SPACED):
                h, a, first, anchor = _anchored(s, length)
                marked = np.zeros(len(h) + 1, bool)
                own = pos[upto[x] : upto[y]]
                marked[np.minimum(np.repeat(s.first[:-1], counts[rows][x:y]) + own, len(h))] = True
                marked[len(h)] = False
                hit = marked[anchor]
                first, anchor = first[hit], anchor[hit]
                doc = np.searchsorted(s.first, first, "right") - 1
                kept.append((h, first + base, anchor + base, a[anchor], ids[x:y][doc], (first - s.first[doc]).astype(np.int32), ngrams(h, length)[first], ngrams2(h, length)[first]))
                base += len(h)
                have += len(first) + len(h) // 8
                if have > CHUNK_WORDS // 2:
                    yield from flush()
                    kept, have, base = [], 0, 0
        if kept:
            yield from flush()

    return run


def tree_names(words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Names of the ``length`` words from each of ``starts`` on: equal names
    are one tree node, and they rise in the order of the strings."""
    name = np.unique(words, return_inverse=True)[1]
    size = 1
    while 2 * size <= length:
        name = np.unique(name[:-size] * (int(name.max()) + 1) + name[size:], return_inverse=True)[1]
        size *= 2
    # the last step overlaps: length words are those from the start and those up to the end
    return np.unique(name[starts] * (int(name.max()) + 1) + name[starts + length - size], return_inverse=True)[1]


def _subtrees(length: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for got in _gathered(batches, {TREE: (np.uint32, np.uint32, np.uint32, *_POSITIONS), WHOLE: (np.uint64, np.uint8, np.uint64, *_POSITIONS), KNOWN: (*_NONE, *_POSITIONS)}):
            docs, pos = [got[KNOWN][3]], [got[KNOWN][4]]
            words, often, check, d, p = got.pop(TREE)
            if len(often):
                often = often.astype(np.int64)
                sizes = often + length - 1
                starts = _ranges(np.cumsum(sizes) - sizes, often)
                d, p = np.repeat(d, often), _ranges(p.astype(np.int64), often).astype(np.int32)
                name = tree_names(words, starts, length)
                order = np.lexsort((p, d, check, name))
                name, check, d, p = name[order], check[order], d[order], p[order]
                later = _later(np.append(False, (name[1:] == name[:-1]) & (check[1:] == check[:-1])), d, p)
                docs.append(d[later])
                pos.append(p[later])
            w, _, c, d, p = got[WHOLE]
            if len(w):
                order = np.lexsort((p, d, c, w))
                w, c, d, p = w[order], c[order], d[order], p[order]
                later = _later(np.append(False, (w[1:] == w[:-1]) & (c[1:] == c[:-1])), d, p)
                docs.append(d[later])
                pos.append(p[later])
            yield from _told(np.concatenate(docs), np.concatenate(pos), n)

    return run


def _cut_pass(length: int):
    out = pa.schema([("doc", pa.int64()), ("kept_text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            pos, counts = _positions(batch.column(2))
            upto = np.concatenate([[0], np.cumsum(counts)])
            for x, y, s in slices(batch.column(1), SPACED):
                n = len(s.start)
                cover = np.zeros(n + length + 1, np.int32)
                at = np.repeat(s.first[:-1], counts[x:y]) + pos[upto[x] : upto[y]]
                # rows that share an id but not a text: a start beyond this text does nothing
                at = at[at + length <= np.repeat(s.first[1:], counts[x:y])]
                np.add.at(cover, at, 1)
                np.add.at(cover, at + length, -1)
                keep = np.cumsum(cover)[:n] == 0
                kept = np.concatenate([[0], np.cumsum(keep)])[s.first]
                start, end = s.start[keep], s.end[keep]
                size = end - start + 1
                last = kept[1:][kept[1:] > kept[:-1]] - 1
                size[last] -= 1
                past = np.cumsum(size)
                raw = np.append(s.data, np.uint8(0x20))[np.minimum(_ranges(start, size), len(s.data))]
                gap = np.ones(len(size), bool)
                gap[last] = False
                raw[past[gap] - 1] = 0x20
                off = np.concatenate([[0], past])[kept]
                text = pa.LargeStringArray.from_buffers(y - x, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw)))
                words = np.diff(s.first)
                yield pa.RecordBatch.from_arrays([batch.column(0)[x:y], text.cast(pa.string()), pa.array(words), pa.array(words - np.diff(kept))], schema=out)

    return run


def remove_repeats(docs: DataFrame, length: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, kept_text, n_words, n_removed of each row.

    A word goes if a window of ``length`` (``K`` at least) consecutive words of
    its document covers it whose words also start earlier: in a document of
    smaller key, or further up in the same one.  Windows are judged on the
    input.  kept_text: the other words, joined by one space.

    A key may be of any type that has an order.  A null text is empty.  A row
    with a null key keeps its whole text and is no earlier start for others.
    Rows repeated whole are one document: each gets that document's result.
    Rows that share a key but not the text count as one position space.  Texts
    of fewer than ``length`` words stay whole.  An empty table gives no rows;
    other columns are not read.
    """
    if length < K:
        raise ValueError(f"length must be {K} at least")
    spark = docs.sparkSession
    bounded_batches(spark)
    rows, names = ordered_ids(docs.select(F.col(key).alias("key"), F.col(text).alias("body")), "key", "doc")
    rows = rows.select("doc", "body")
    n = n_parts(spark, docs.select(text), PART_BYTES)
    dealt = lambda df: df.repartition(n, "part").sortWithinPartitions("part")
    found = "part int, d binary, p binary"
    by_doc = lambda df: df.repartition(n, "part").mapInArrow(_documents, "doc long, p binary")

    anchors = written(dealt(rows.mapInArrow(_anchor_pass(length, n), _ROWS)).mapInArrow(_repeated_anchors(n), found), "anchors")
    long = [np.frombuffer(r["d"], np.uint64) for r in anchors.where(F.col("part") == _LONG).select("d").collect()]  # at most MOST_LONG
    long = spark.sparkContext.broadcast(np.sort(np.concatenate([np.zeros(0, np.uint64), *long])))
    keyed = rows.where("doc is not null")  # alike on both joins, so that it is dealt by document once
    suffixes = keyed.join(by_doc(anchors.where(F.col("part") != _LONG)), "doc").select("doc", "body", "p")
    repeats = by_doc(dealt(suffixes.mapInArrow(_suffix_pass(length, n, long), _ROWS)).mapInArrow(_subtrees(length, n), found))
    cut = keyed.join(repeats, "doc", "left").select("doc", "body", "p").unionByName(rows.where("doc is null").withColumn("p", F.lit(None).cast("binary")))
    out = cut.mapInArrow(_cut_pass(length), "doc long, kept_text string, n_words long, n_removed long")
    if names is not None:
        out = out.join(names, "doc", "left").select("key", "kept_text", "n_words", "n_removed")
        return out.withColumnRenamed("key", key)
    return out.withColumnRenamed("doc", key).withColumn(key, F.col(key).cast(docs.schema[key].dataType))
