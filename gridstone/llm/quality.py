"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics come from byte classes, words and lines of whole texts, in
Arrow batches.  The trees are grown on a bounded sample of labelled rows on
the driver and flattened into arrays that numpy walks level by level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .state import bounded_batches, release
from .textcore import SPACED, U64, Slice, _table, mix, slices

_LINES = _table([(0, 9), (11, 255)], False)
_CLASSES = {
    "upper": [(0x41, 0x5A)],
    "lower": [(0x61, 0x7A)],
    "digit": [(0x30, 0x39)],
    "space": [(0x20, 0x20), (0x09, 0x09)],
    "feed": [(0x0A, 0x0D)],
    "point": [(0x2C, 0x2C), (0x2E, 0x2E)],
    "mark": [(0x21, 0x21), (0x3F, 0x3F)],
    "sign": [(0x23, 0x26), (0x2A, 0x2A)],
    "pair": [(0x22, 0x22), (0x27, 0x29), (0x5B, 0x5B), (0x5D, 0x5D), (0x7B, 0x7B), (0x7D, 0x7D)],
    "bar": [(0x7C, 0x7C)],
    "tag": [(0x3C, 0x3E), (0x2F, 0x2F), (0x5C, 0x5C)],
    "other": [(0x2B, 0x2B), (0x2D, 0x2D), (0x3A, 0x3B), (0x40, 0x40), (0x5E, 0x60), (0x7E, 0x7E)],
    "control": [(0, 8), (14, 31), (0x7F, 0x7F)],
    "beyond": [(0x80, 0xFF)],
}
_CLASS = np.zeros(256, np.int64)
for _i, _ranges in enumerate(_CLASSES.values()):
    for _a, _b in _ranges:
        _CLASS[_a : _b + 1] = _i
FEATURES = [
    *(f"share_{c}" for c in _CLASSES), "log_bytes", "log_words", "mean_word", "sd_word", "longest_word", "share_distinct_words", "share_distinct_pairs", "top_word",
    "log_lines", "mean_line", "share_distinct_lines", "words_ending_in_sign", "words_starting_upper", "words_all_upper", "share_same_byte", "lines_with_bar",
]
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_SIGN = np.zeros(256, bool)
for _c in b"!#$%&*?|":
    _SIGN[_c] = True


def _distinct(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, count of the commonest one) of each document."""
    if not len(h):
        return np.zeros(n), np.zeros(n)
    with np.errstate(over="ignore"):
        v = np.sort((mix(h + doc.astype(U64) * U64(0x9E3779B97F4A7C15)) >> U64(24)) | (doc.astype(U64) << U64(40)))
    at = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
    own = (v[at] >> U64(40)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, own, np.diff(np.append(at, len(v))))
    return np.bincount(own, minlength=n).astype(float), most


def statistics(s: Slice) -> np.ndarray:
    """One row of FEATURES for each text; all 0 for an empty one."""
    n = len(s.offsets) - 1
    size = np.diff(s.offsets)
    doc_of_byte = np.repeat(np.arange(n), size)
    by_class = np.bincount(doc_of_byte * len(_CLASSES) + _CLASS[s.data], minlength=n * len(_CLASSES)).reshape(n, -1)
    lines = Slice(s.data, s.offsets, _LINES)
    words, n_lines = np.diff(s.first), np.diff(lines.first)
    doc, line_doc = np.repeat(np.arange(n), words), np.repeat(np.arange(n), n_lines)
    h = s.hashes
    long = (s.end - s.start).astype(float)
    per = lambda x, w: x / np.maximum(w, 1)
    total = lambda x, d: np.bincount(d, weights=x, minlength=n)
    mean = per(total(long, doc), words)
    most = np.zeros(n)
    np.maximum.at(most, doc, long)
    distinct, top = _distinct(doc, h, n)
    with np.errstate(over="ignore"):
        pairs = h[1:] * U64(3) + h[:-1] if len(h) else h
    same = doc[1:] == doc[:-1] if len(h) else np.zeros(0, bool)
    pair_doc = doc[1:][same] if len(h) else doc
    distinct_pairs, _ = _distinct(pair_doc, pairs[same] if len(h) else h, n)
    line_hash = lines.hashes
    distinct_lines, _ = _distinct(line_doc, line_hash, n)
    upper = np.concatenate([[0], np.cumsum(_UPPER[s.data])])
    shout = (upper[s.end] - upper[s.start] == s.end - s.start) & (s.end - s.start > 1)
    again = np.append(False, s.data[1:] == s.data[:-1])[: len(s.data)] if len(s.data) else np.zeros(0, bool)
    bar = np.concatenate([[0], np.cumsum(s.data == 0x7C)])
    columns = [
        *(per(by_class[:, i], size) for i in range(len(_CLASSES))),
        np.log1p(size), np.log1p(words), mean, np.sqrt(np.maximum(per(total(long * long, doc), words) - mean**2, 0)), np.log1p(most), per(distinct, words), per(distinct_pairs, np.bincount(pair_doc, minlength=n)), per(top, words),
        np.log1p(n_lines), np.log1p(per(words, n_lines)), per(distinct_lines, n_lines),
        per(total(_SIGN[s.data[s.end - 1]], doc), words), per(total(_UPPER[s.data[s.start]], doc), words), per(total(shout, doc), words),
        per(total(again, doc_of_byte), size), per(total(bar[lines.end] > bar[lines.start], line_doc), n_lines),
    ]
    return np.stack(columns, 1)


class Trees:
    """Complete binary trees in flat arrays: node i has children 2i+1, 2i+2."""

    def __init__(self, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray, base: float):
        self.feature, self.cut, self.leaf, self.base = feature, cut, leaf, base

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - (leaf.size - 1)]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 2.0, least: int = 10) -> Trees:
    """Gradient boosting of log loss on binned columns.  No rows or one class
    only: no trees, and a score of the smoothed base rate."""
    p = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(p / (1 - p)))
    inner, width = 2**depth - 1, x.shape[1]
    if len(y) < 2 * least or y.min() == y.max():
        return Trees(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    column = np.arange(width) * bins
    out = np.full(len(y), base)
    features, cuts, leaves = [], [], []
    for _ in range(trees):
        q = 1 / (1 + np.exp(-out))
        g, h = y - q, np.maximum(q * (1 - q), 1e-6)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(inner, int), np.full(inner, np.inf)
        for level in range(depth):
            first, wide = 2**level - 1, 2**level
            flat = ((node - first)[:, None] * (width * bins) + column + binned).ravel()
            shape = (wide, width, bins)
            sum_g = np.bincount(flat, np.repeat(g, width), wide * width * bins).reshape(shape).cumsum(2)
            sum_h = np.bincount(flat, np.repeat(h, width), wide * width * bins).reshape(shape).cumsum(2)
            count = np.bincount(flat, minlength=wide * width * bins).reshape(shape).cumsum(2)
            all_g, all_h, all_n = sum_g[:, :, -1:], sum_h[:, :, -1:], count[:, :, -1:]
            gain = sum_g**2 / (sum_h + ridge) + (all_g - sum_g) ** 2 / (all_h - sum_h + ridge) - all_g**2 / (all_h + ridge)
            gain[(count < least) | (all_n - count < least)] = 0
            best = gain.reshape(wide, -1).argmax(1)
            for i, b in enumerate(best):
                j, k = divmod(int(b), bins)
                if gain[i, j, k] > 1e-9 and k < len(edges[j]):
                    feature[first + i], cut[first + i] = j, edges[j][k]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf_of = node - inner
        leaf = rate * np.bincount(leaf_of, g, inner + 1) / (np.bincount(leaf_of, h, inner + 1) + ridge)
        out += leaf[leaf_of]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Trees(np.array(features), np.array(cuts), np.array(leaves), base)


def held_out(key) -> F.Column:
    """One key in five, by crc32 of the key as text, is never learned from."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", most: int = 20_000) -> Trees:
    """Trees from about ``most`` labelled rows at the most, chosen by a hash of
    the key, none of them held out.

    Of contradicting labels of one key the rounded mean counts; rows with a
    null key or label teach nothing.
    """
    bounded_batches(docs.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    known = known.groupBy(F.col(key).alias("k")).agg(F.round(F.avg(label)).cast("double").alias("y"))
    share = min(1.0, most / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("k", F.lit("quality")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    rows = docs.select(F.col(key).alias("k"), text).join(F.broadcast(chosen), "k")  # at most about ``most`` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for x, y, s in slices(batch.column(1), SPACED):
                yield pa.RecordBatch.from_arrays([batch.column(0)[x:y].cast(pa.string()), batch.column(2)[x:y], pa.array(list(statistics(s)), pa.list_(pa.float64()))], ["k", "y", "x"])

    one = rows.mapInArrow(run, "k string, y double, x array<double>").groupBy("k").agg(F.min(F.struct("y", "x")).alias("r"))  # rows repeated under one key teach once
    got = sorted((r["k"], r["r"]["y"], tuple(r["r"]["x"])) for r in one.collect())
    x = np.array([r[2] for r in got]).reshape(len(got), len(FEATURES))
    return grow(x, np.array([r[1] for r in got]))


def score_quality(docs: DataFrame, model: Trees, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with ``name``: how likely label 1 is, 0 to 1.

    Only the text is looked at.  Null and empty texts have all statistics 0
    and the score of that; equal texts score alike; an empty table gives no
    rows; a column called ``name`` is replaced, all others are kept.
    """
    bounded_batches(docs.sparkSession)
    plain = docs.drop(name)
    at = plain.columns.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for x, y, s in slices(batch.column(at), SPACED):
                yield pa.RecordBatch.from_arrays([*batch.slice(x, y - x).columns, pa.array(sent.value.score(statistics(s)))], [*batch.schema.names, name])

    return plain.mapInArrow(run, plain.withColumn(name, F.lit(0.0)).schema)
