"""Benchmark decontamination with a broadcast hash set of test n-grams.

The windows of the benchmark are hashed and broadcast; each task rolls the
same hash over its documents, looks every window up, and compares the words of
each hit before it counts.  No shuffle of documents.  Items are cut into
segments, so that a long one is in several blocks, and repeated ones are taken
once; a benchmark above ``block_bytes`` goes in blocks of about that size, each
one further pass in the same stage.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .state import bounded_batches, in_turn, release, written
from .textcore import PLAIN, U64, Slice, ngrams, slices

_HITS = "hit_spans array<struct<start:int,end:int>>, hit_items array<string>"


class Windows:
    """All windows of some items: {length: (sorted hashes, {words: items})}."""

    def __init__(self, items: list[tuple[str | None, str]], n: int):
        lengths: dict[int, dict[bytes, set]] = defaultdict(lambda: defaultdict(set))
        hashes: dict[int, list[np.ndarray]] = defaultdict(list)
        at = 0
        for x, y, s in slices(pa.array([t for _, t in items], pa.string()), PLAIN):
            h = s.hashes
            for i in range(y - x):
                a, b = int(s.first[i]), int(s.first[i + 1])
                if b > a:
                    size = min(n, b - a)
                    words = s.words(a, b)
                    for j in range(b - a - size + 1):
                        lengths[size][b" ".join(words[j : j + size])].add(items[at + i][0])
                    hashes[size].append(ngrams(h[a:b], size))
            at += y - x
        self.by_length = {}
        for size, found in hashes.items():
            known = np.unique(np.concatenate(found))
            bits = max(16, int(len(known) * 32).bit_length())
            filled = np.zeros(1 << bits, bool)
            filled[(known >> U64(64 - bits)).astype(np.int64)] = True
            self.by_length[size] = (known, bits, filled, {w: sorted(x for x in i if x is not None) for w, i in lengths[size].items()})

    def find(self, s: Slice) -> Iterator[tuple[int, int, int, list[str]]]:
        """(text, first word, length, items) of each occurrence, by length."""
        if not self.by_length:
            return
        h = s.hashes
        for size, (known, bits, filled, names) in self.by_length.items():
            g = ngrams(h, size)
            maybe = np.flatnonzero(filled[(g >> U64(64 - bits)).astype(np.int64)]) if len(g) else np.zeros(0, np.int64)
            at = np.searchsorted(known, g[maybe])
            maybe = maybe[known[np.minimum(at, len(known) - 1)] == g[maybe]]
            doc = np.searchsorted(s.first, maybe, "right") - 1
            inside = maybe + size <= s.first[doc + 1]
            for i, d in zip(maybe[inside].tolist(), doc[inside].tolist(), strict=True):
                found = names.get(b" ".join(s.words(i, i + size)))
                if found is not None:
                    yield d, i - int(s.first[d]), size, found


def _merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], b)
        else:
            out.append({"start": a, "end": b})
    return out


def _segments(n: int, words: int = 2048):
    """id, t: runs of an item's words that begin ``words`` apart and share
    n - 1 words, so each window is in one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = [], []
            for x, _, s in slices(batch.column(1), PLAIN):
                for i in range(len(s.first) - 1):
                    a, b = int(s.first[i]), int(s.first[i + 1])
                    for start in range(a, max(a + 1, b - n + 1), words) if b > a else ():
                        ids.append(batch.column(0)[x + i])
                        texts.append(b" ".join(s.words(start, min(b, start + words + n - 1))).decode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["id", "t"])

    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text", item: str = "item_id", item_text: str = "text", block_bytes: int = 1 << 20, cut: bool = False) -> DataFrame:
    """``docs`` with n_words, hit_spans (merged, in words, end exclusive) and
    hit_items (distinct, sorted as strings).

    A-Z is lower-cased and words are runs of 0-9, a-z and characters beyond
    ASCII.  A window is ``n`` consecutive words of an item; an item of fewer
    words, but not none, is one window.  A document word inside any occurrence
    is hit.  Null texts have no words; items with a null id hit but are not
    listed; equal ids are one item; an empty benchmark hits nothing; an empty
    table gives no rows; repeated rows are judged each.  Columns of ``docs``
    named like the new ones are replaced; all others are kept as they are.
    With ``cut`` the spans are cut out of the text, as :func:`cut_spans` does.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.select(F.col(item).cast("string").alias("id"), F.col(item_text).alias("t")).mapInArrow(_segments(n), "id string, t string").distinct()
    items = written(items, "benchmark")
    size = items.agg(F.coalesce(F.sum(F.octet_length("t") + 1), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    plain = docs.drop("n_words", "hit_spans", "hit_items")
    df = plain.select("*", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast("array<struct<start:int,end:int>>").alias("hit_spans"), F.lit(None).cast("array<string>").alias("hit_items"))
    at = df.columns.index(text)
    steps = []
    for block in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast([(r["id"], r["t"]) for r in own.collect()])
        steps.append(_pass(sent, n, at))
    if cut:
        steps.append(_cutter(at, len(df.columns) - 2))
    return df.mapInArrow(in_turn(*steps), df.schema)


def _pass(sent, n: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        windows = Windows(sent.value, n)
        for batch in batches:
            for x, y, s in slices(batch.column(at), PLAIN):
                spans, names = defaultdict(list), defaultdict(set)
                for d, a, size, found in windows.find(s):
                    spans[d].append((a, a + size))
                    names[d].update(found)
                part = batch.slice(x, y - x)
                c = part.num_columns
                old_spans, old_names = part.column(c - 2), part.column(c - 1)
                was = old_spans.null_count < len(old_spans)
                new_spans, new_names = [], []
                for i in range(y - x):
                    before = old_spans[i].as_py() if was else None
                    new_spans.append(_merged(spans.get(i, []) + [(z["start"], z["end"]) for z in before or []]) if i in spans or before else [])
                    new_names.append(sorted(names.get(i, set()) | set(old_names[i].as_py() or [] if was else [])))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: c - 3], pa.array(np.diff(s.first)), pa.array(new_spans, old_spans.type), pa.array(new_names, old_names.type)],
                    names=part.schema.names,
                )

    return run


def cut_spans(docs: DataFrame, text: str = "text", spans: str = "hit_spans") -> DataFrame:
    """``docs`` with the word spans of ``spans`` cut from ``text``.

    What stands from a span's first word to its last goes, with the text on
    either side left as it is and a line feed between.  Rows without spans are
    unchanged, a null text with them; rows that share a key are cut each by
    their own spans.
    """
    return docs.mapInArrow(_cutter(docs.columns.index(text), docs.columns.index(spans)), docs.schema)


def _cutter(at: int, by: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(by).to_pylist()
            hit = [i for i, x in enumerate(found) if x]
            if not hit:
                yield batch
                continue
            texts = batch.column(at).to_pylist()
            for i in hit:
                ((_, _, s),) = slices(pa.array([texts[i]]), PLAIN)
                raw, out, upto = s.data.tobytes(), [], 0
                for z in found[i]:
                    out.append(raw[upto : s.start[z["start"]]])
                    upto = int(s.end[z["end"] - 1])
                texts[i] = b"\n".join([*out, raw[upto:]]).decode("utf-8")
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return run
