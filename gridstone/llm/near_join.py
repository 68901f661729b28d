"""N-gram Jaccard join: MinHash LSH forest, then exact verification.

1. Texts become sets of word n-grams; equal sets are one node with a count.
2. Each tree of the forest labels a node with ``DEEPEST`` MinHash values of one
   byte each, read as one long: sorted longs are the leaves of a prefix trie.
   Matching starts at whole labels and the prefixes are shortened level by
   level.  A level looks only at trie nodes that branch there, and at one of
   those that have the same members in several trees.
3. Members of a trie node are compared by all labels of all trees.  Those that
   agree enough for a link are tied, by a spanning forest a trie node.  The ties
   give the recall of the level: each stands for 1 / p ties, p its chance to
   meet at this depth.  At the target recall the prefixes stay as they are.
4. Nodes joined by ties are a candidate group: linked nodes are in one.  A
   group is cut into chunks of bounded size and each pair of chunks is one
   piece of work, where exact intersections are counted for all of its pairs.
   Out come link counts by node and a spanning forest of the links, not pairs.
5. Components of the links are the classes.

No group is capped: a large one means more pieces of work.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .state import bounded_batches, n_parts, release, written
from .textcore import PLAIN, U64, Slice, mix, ngrams, slices

DEEPEST, LABEL_BITS = 8, 8  # labels of a tree make up one long
CHUNK_NODES, CHUNK_GRAMS = 256, 1 << 19
PIECE = 4096
SENT_KEPT = 1 << 16


def depth_for(threshold: float, trees: int, deepest: int, recall: float) -> int:
    """The longest prefix with the target recall at the threshold."""
    depth = deepest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def gram_sets(s: Slice, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct n-gram hashes, text by text; bounds of the texts).

    A text of fewer than n words, but not none, has one gram of all of them.
    """
    h, words = s.hashes, np.diff(s.first)
    g = ngrams(h, n)
    doc = np.repeat(np.arange(len(words)), words)
    full = np.arange(len(g)) + n <= s.first[1:][doc[: len(g)]] if len(g) else np.zeros(0, bool)
    g, doc = g[full], doc[: len(full)][full]
    short = np.flatnonzero((words > 0) & (words < n))
    if len(short):
        g = np.concatenate([g, [ngrams(h[s.first[i] : s.first[i + 1]], int(words[i]))[0] ^ U64(words[i]) for i in short.tolist()]]).astype(U64)
        doc = np.concatenate([doc, short])
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    if len(g):
        new = np.append(True, (g[1:] != g[:-1]) | (doc[1:] != doc[:-1]))
        g, doc = g[new], doc[new]
    return g, np.searchsorted(doc, np.arange(len(words) + 1))


def _set_id(g: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit value a set, 0 for the empty one."""
    with np.errstate(over="ignore"):
        c = np.concatenate([[U64(0)], np.cumsum(mix(g), dtype=U64)])
        size = np.diff(bounds).astype(U64)
        return np.where(size > 0, mix(c[bounds[1:]] - c[bounds[:-1]] + size * U64(0x9E3779B97F4A7C15)) | U64(1), U64(0))


def _signatures(key_kind: str, n: int, trees: int):
    factors = np.random.default_rng(20240229).integers(1, 1 << 63, (trees, DEEPEST), dtype=np.uint64) * U64(2) + U64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for x, y, s in slices(batch.column(1), PLAIN):
                g, bounds = gram_sets(s, n)
                size = np.diff(bounds)
                rows = np.flatnonzero(size)
                keys = np.zeros((len(rows), trees), U64)
                if len(rows):
                    at = bounds[:-1][rows]
                    with np.errstate(over="ignore"):
                        for t in range(trees):
                            for f in factors[t]:
                                label = mix(np.minimum.reduceat(g * f, at)) >> U64(64 - LABEL_BITS)
                                keys[:, t] = keys[:, t] << U64(LABEL_BITS) | label
                lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(size > 0, trees, 0))]), pa.int64()), pa.array(keys.ravel().view(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[x:y], pa.array(_set_id(g, bounds).view(np.int64)), pa.array(size.astype(np.int64)), lists], ["k", "s", "n", "keys"])

    return run, f"k {key_kind}, s long, n long, keys array<long>"


def _spanning(labels: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A spanning forest of the rows that agree in ``least`` labels or more:
    (row, row it was reached from, labels in which they agree)."""
    left = np.arange(len(labels))
    rows, froms, agree = [], [], []
    while len(left) > 1:
        reached, left = [int(left[0])], left[1:]
        while reached and len(left):
            at = reached.pop()
            same = (labels[left] == labels[at]).sum(1)
            hit = same >= least
            if hit.any():
                rows.append(left[hit])
                froms.append(np.full(int(hit.sum()), at))
                agree.append(same[hit])
                reached += left[hit].tolist()
                left = left[~hit]
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) if x else none for x in (rows, froms, agree))


def _trie_ties(trees: int, least: int):
    """Ties (a, b, labels in which they agree) of each trie node; rows of one
    node stand together: spot, piece, s, keys."""
    width = trees * DEEPEST

    def ties(spot: np.ndarray, s: np.ndarray, labels: np.ndarray) -> pa.RecordBatch:
        head = np.flatnonzero(np.append(True, (spot[1:] != spot[:-1]).any(1)))
        first = np.repeat(head, np.diff(np.append(head, len(s))))
        same = (labels == labels[first]).sum(1)
        own = (same >= least) & (first != np.arange(len(s)))
        a, b, agree = [s[own]], [s[first[own]]], [same[own]]
        weak = np.unique(first[same < least])  # trie nodes where the first row is not enough
        for x, y in zip(weak.tolist(), np.append(head, len(s))[np.searchsorted(head, weak, "right")].tolist(), strict=True):
            row, start, n = _spanning(labels[x:y], least)
            a.append(s[x + row])
            b.append(s[x + start])
            agree.append(n)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (a, b, agree)], ["a", "b", "agree"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        kept: list[tuple[np.ndarray, ...]] = []
        have = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal kept, have
            spot, s, labels = (np.concatenate(x) for x in zip(*kept, strict=True))
            ends = np.flatnonzero((spot[1:] != spot[:-1]).any(1)) + 1
            upto = len(s) if last else int(ends[-1]) if len(ends) else 0
            if upto:
                yield ties(spot[:upto], s[:upto], labels[:upto])
            kept = [(spot[upto:], s[upto:], labels[upto:])] if upto < len(s) else []
            have = len(s) - upto

        for batch in batches:
            if batch.num_rows:
                spot = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
                keys = batch.column(4).flatten().to_numpy().astype("<i8", copy=False)
                kept.append((spot, batch.column(3).to_numpy(), keys.view(np.uint8).reshape(-1, width)))
                have += batch.num_rows
                if have > PIECE:
                    yield from flush(False)
        if kept:
            yield from flush(True)

    return run, "a long, b long, agree long"


def _level(leaves: DataFrame, nodes: DataFrame, depth: int, floor: int, trees: int, least: int, n: int) -> DataFrame:
    """Ties between children of the trie nodes that branch at ``depth``.

    leaves: s, spot (tree and the first ``floor`` labels), rest (the others)."""
    shift = LABEL_BITS * (DEEPEST - depth)
    child = F.col("s") if depth == DEEPEST else F.shiftrightunsigned("rest", shift - LABEL_BITS)
    own = leaves.select("s", "spot", F.shiftrightunsigned("rest", shift).alias("prefix"), child.alias("child"))
    found = own.groupBy("spot", "prefix").agg(F.min("child").alias("low"), F.max("child").alias("high"), F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("s")).alias("who"))
    found = found.where("low <> high").groupBy("size", "who").agg(F.min(F.struct("spot", "prefix")).alias("x")).select("x.spot", "x.prefix", F.ceil(F.col("size") / PIECE).cast("int").alias("pieces"))
    members = own.drop("child").join(found, ["spot", "prefix"])
    piece = F.pmod(F.xxhash64("s"), F.col("pieces")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    members = members.withColumn("piece", piece).withColumn("other", other)
    both = F.least("piece", "other") * F.col("pieces").cast("long") + F.greatest("piece", "other")
    members = members.select("spot", F.col("prefix").cast("long").alias("prefix"), both.cast("long").alias("both"), "s").join(nodes.select("s", "keys"), "s")
    members = members.select("spot", "prefix", "both", "s", "keys").repartition(n, "spot", "prefix", "both").sortWithinPartitions("spot", "prefix", "both", "s")
    run, schema = _trie_ties(trees, least)
    return members.mapInArrow(run, schema).groupBy("a", "b").agg(F.max("agree").alias("agree"))


def forest_ties(nodes: DataFrame, threshold: float, trees: int, recall: float, n: int) -> DataFrame:
    """a, b: nodes that met in the forest and agree enough for a link."""
    samples = trees * DEEPEST
    # six standard deviations below the threshold: a link is as good as never under it
    least = int(samples * threshold - 6 * (samples * threshold * (1 - threshold)) ** 0.5)
    floor = depth_for(threshold, trees, DEEPEST, recall)
    cut = LABEL_BITS * (DEEPEST - floor)
    leaves = nodes.select("s", F.posexplode("keys").alias("tree", "key"))
    spot = F.shiftleft(F.col("tree").cast("long"), 64 - cut).bitwiseOR(F.shiftrightunsigned("key", cut)) if cut else F.xxhash64("tree", "key")
    leaves = leaves.select("s", spot.alias("spot"), F.col("key").bitwiseAND(F.lit((1 << cut) - 1)).alias("rest"))
    shared = leaves.groupBy("spot").agg(F.min("s").alias("low"), F.max("s").alias("high")).where("low <> high").select("spot")
    leaves = written(leaves.join(shared, "spot").select("s", "spot", "rest"), "leaves")

    ties = None
    for depth in range(DEEPEST, floor - 1, -1):
        level = written(_level(leaves, nodes, depth, floor, trees, least, n), "ties")
        ties = level if ties is None else ties.unionByName(level)
        like = F.least(F.col("agree") / float(samples), F.lit(1.0))
        meet = 1 - F.pow(1 - F.pow(like, float(depth)), float(trees))
        met, there = ties.where(like >= threshold).agg(F.count(F.lit(1)), F.sum(1 / meet)).first()
        if met and met >= recall * there:
            break
    return ties.select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, comp (the least node of its component) of a graph with edges a, b.

    Rounds of least-neighbour labels and pointer jumping over tables in the
    shared folder; sums and joins only, so that a hub is not one task's.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp"), F.lit(True).alias("moved")), "labels")
    while labels.where("moved").limit(1).count():
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        labels = written(step.join(jump, "comp").select("node", F.least("comp", "far").alias("comp"), (F.least("comp", "far") < F.col("was")).alias("moved")), "labels")
    return labels.select("node", "comp")


def _gram_rows(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        sent: set[int] = set()  # sets of rows repeated under one key go out once
        for batch in batches:
            want = batch.column(1).to_numpy()
            for x, y, s in slices(batch.column(0), PLAIN):
                g, bounds = gram_sets(s, n)
                rows = np.flatnonzero(_set_id(g, bounds).view(np.int64) == want[x:y])
                once = np.unique(want[x:y][rows], return_index=True)[1]
                rows = np.array([r for r in rows[np.sort(once)].tolist() if int(want[x + r]) not in sent], np.int64)
                if len(sent) > SENT_KEPT:
                    sent.clear()
                sent.update(want[x:y][rows].tolist())
                grams = [g[bounds[i] : bounds[i + 1]].tobytes() for i in rows.tolist()]
                part = batch.slice(x, y - x).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(grams, pa.binary())], [*part.schema.names[1:], "grams"])

    return run


def _linked(nodes: list[tuple[int, int, int, bytes]], within: bool, t: Fraction) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set id, rows linked to it, least linked set id) for (set, rows, chunk, grams), by distinct set."""
    m = len(nodes)
    sets = [np.frombuffer(x[3], U64) for x in nodes]
    ids = np.array([x[0] for x in nodes])
    rows = np.array([x[1] for x in nodes], np.float64)
    chunk = np.array([x[2] for x in nodes])
    size = np.array([len(g) for g in sets], np.int64)
    owner = np.repeat(np.arange(m), size)
    _, gram, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.zeros((m, m), np.float32)
    rare = (often[gram] > 1) & (often[gram] <= 32)
    order = np.flatnonzero(rare)[np.argsort(gram[rare], kind="stable")]
    own, of = owner[order], gram[order]
    for shift in range(1, 32):  # members of one gram stand together
        if len(own) <= shift:
            break
        same = of[shift:] == of[:-shift]
        if not same.any():
            break
        shared += np.bincount(own[:-shift][same] * m + own[shift:][same], minlength=m * m).reshape(m, m)
    shared = shared + shared.T
    dense = np.flatnonzero(often > 32)
    if len(dense):
        number = np.full(len(often), -1)
        number[dense] = np.arange(len(dense))
        wide = max(1, (1 << 20) // m)
        col = number[gram]
        for a in range(0, len(dense), wide):
            own = (col >= a) & (col < a + wide)
            block = np.zeros((m, min(wide, len(dense) - a)), np.float32)
            block[owner[own], col[own] - a] = 1
            shared += block @ block.T
    linked = shared.astype(np.float64) * (t.denominator + t.numerator) >= t.numerator * (size[:, None] + size[None, :])
    np.fill_diagonal(linked, False)
    if not within:
        linked &= chunk[:, None] != chunk[None, :]
    label = np.arange(m)
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], m).min(1))
        least = least[least]
        if (least == label).all():
            break
        label = least
    return ids, (linked @ rows).astype(np.int64), ids[label]


def _verify(t: Fraction):
    out = pa.schema([("s", pa.int64()), ("links", pa.int64()), ("root", pa.int64()), ("whole", pa.bool_())])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # comp, low, high, chunks, chunk, s, rows, grams; sorted by the first three and s
        release()
        kept: list[tuple[np.ndarray, ...]] = []
        for (_, low, high), group in groupby(records(batches), key=lambda r: r[:3]):
            members = [next(same) for _, same in groupby(group, key=lambda r: r[5])]
            ids, links, root = _linked([(r[5], r[6], r[4], r[7]) for r in members], low == high, t)
            kept.append((ids, links, root, np.full(len(ids), members[0][3] == 1)))
            if len(kept) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*kept, strict=True)], schema=out)
                kept = []
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*kept, strict=True)], schema=out)

    return run, "s long, links long, root long, whole boolean"


def near_classes(docs: DataFrame, n: int = 5, threshold: float = 0.8, trees: int = 32, recall: float = 0.99999, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, class_id, n_links of each row.

    Words: A-Z lower-cased, runs of 0-9, a-z and characters beyond ASCII.  Two
    rows are linked if the Jaccard similarity of their sets of ``n``-word
    grams is at least ``threshold`` (a text of fewer words, but not none, is
    one gram).  n_links counts a row's links; class_id is the least key of
    those linked to it directly or through others.

    ``recall`` is the share of links that the forest is to meet, as measured
    on what it met; at the shortest prefix it goes down to, a link right at the
    threshold is met with that probability.  Every link returned is exact
    (grams compared by 64-bit hashes).  A null or wordless text links to nothing and is a class of its
    own.  A row with a null key has a null class and no links, and counts for
    none.  Rows repeated whole are linked to each other.  An empty table gives
    no rows; other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    t = Fraction(threshold).limit_denominator(1000)
    source = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    run, schema = _signatures(source.schema["k"].dataType.simpleString(), n, trees)
    rows = written(source.mapInArrow(run, schema), "signatures")
    known = rows.where("s <> 0 and k is not null")
    nodes = written(known.groupBy("s").agg(F.min("k").alias("rep"), F.count(F.lit(1)).alias("rows"), F.max("n").alias("n"), F.first("keys").alias("keys")), "nodes")

    parts = n_parts(spark, docs.select(text), 4 << 20)
    groups = components(forest_ties(nodes, threshold, trees, recall, parts))
    members = nodes.drop("keys").join(groups.select(F.col("node").alias("s"), "comp"), "s")
    sizes = members.groupBy("comp").agg(F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK_NODES), F.ceil(F.sum("n") / CHUNK_GRAMS)).cast("int").alias("chunks"))
    members = members.join(sizes, "comp").select("rep", "s", "rows", "comp", "chunks", F.pmod(F.xxhash64("s"), F.col("chunks")).cast("int").alias("chunk"))

    texts = source.join(members, source["k"] == members["rep"]).select("text", "s", "rows", "comp", "chunks", "chunk")
    grams = texts.mapInArrow(_gram_rows(n), "s long, rows long, comp long, chunks int, chunk int, grams binary")
    dealt = grams.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select("comp", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunks", "chunk", "s", "rows", "grams")
    dealt = dealt.repartition(parts, "comp", "low", "high").sortWithinPartitions("comp", "low", "high", "s")
    run, schema = _verify(t)
    found = written(dealt.mapInArrow(run, schema), "verified")

    links = found.groupBy("s").agg(F.sum("links").alias("links"), F.min("root").alias("root"), F.max("whole").alias("whole"))
    across = components(found.where("not whole and s <> root").select(F.col("s").alias("a"), F.col("root").alias("b")))
    links = links.join(across, links["s"] == across["node"], "left").select("s", "links", F.when(F.col("whole"), F.col("root")).otherwise(F.coalesce("comp", "s")).alias("comp"))
    placed = nodes.drop("keys").join(links, "s", "left").select("s", "rep", "rows", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("comp", "s").alias("comp"))
    names = placed.groupBy("comp").agg(F.min("rep").alias("class_id"))
    placed = placed.join(names, "comp").select("s", "class_id", (F.col("links") + F.col("rows") - 1).alias("n_links"))
    out = rows.select("k", F.when(F.col("k").isNotNull() & (F.col("s") != 0), F.col("s")).alias("s")).join(placed, "s", "left")
    return out.select(F.col("k").alias(key), F.coalesce("class_id", "k").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def first_of_class(docs: DataFrame, classes: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are the first of their class; rows with a null
    key stay.

    Rows that share a key are one document: of those of a class with links one
    stays, that of the least hash of its columns, so of rows repeated whole one;
    those without links stay all.  An empty table gives no rows.
    """
    heads = classes.where(F.col(key) == F.col("class_id")).groupBy(key).agg(F.max("n_links").alias("__links"))
    kept = docs.join(heads, key).select(*docs.columns, "__links")
    row = F.struct(*docs.columns)
    linked = kept.where("__links > 0").groupBy(F.col(key).alias("__k")).agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("__r")).select("__r.*")
    alone = kept.where("__links = 0").drop("__links")
    return alone.unionByName(linked).unionByName(docs.where(F.col(key).isNull())).select(*docs.columns)
