"""The queries that SQL can't say, against brute force over a whole small table."""

import collections
import hashlib
import math
import struct
import zlib

import pytest

from gridstone.llm import queries, quality

from .test_operators import check_packing, jaccard, library  # noqa: F401

xxhash = pytest.importorskip("xxhash")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_op2(spark, texts):
    got = queries.op2_fingerprints(spark, SF).collect()
    order = sorted(texts, reverse=True)
    following = dict(zip(order, order[1:] + order[:1], strict=True))
    bag = lambda t: collections.Counter(t.lower().split())
    off = []
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        t, nxt = texts[r["doc_id"]], texts[following[r["doc_id"]]]
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        off += [r["near_edited"] - jaccard(bag(t), bag(edited)), r["near_next"] - jaccard(bag(t), bag(nxt))]
    assert abs(sum(off) / len(off)) < 0.02 and max(map(abs, off)) < 0.45
    prints = collections.defaultdict(set)
    for r in got:
        prints[texts[r["doc_id"]]].add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def test_op5_and_op6(spark, texts, library):  # noqa: F811
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    check_packing(queries.op5_best_fit_packing(spark, SF).collect(), {i: x + [2] for i, x in ids.items()}, 1024)
    got = sorted(tuple(r) for r in queries.op6_token_counts(spark, SF).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect())
    assert got == sorted((i, len(texts[i].encode()), len(x), len(x) > 1024) for i, x in ids.items())


def owner(key, shards):
    def score(i):
        h = xxhash.xxh64(struct.pack("<i", i), seed=xxhash.xxh64(struct.pack("<q", key), seed=42).intdigest()).intdigest()
        return -1 / math.log(((h >> 11) + 0.5) / (1 << 53))

    return max(range(shards), key=lambda i: (score(i), -i))


def test_op7(spark, texts):
    got = queries.op7_sharding(spark, SF).collect()
    slots = collections.defaultdict(list)
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert (r["shard"], r["grown_shard"]) == (owner(r["doc_id"], 24), owner(r["doc_id"], 25))
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_op8(spark, texts):
    got = {r["doc_id"]: r for r in queries.op8_quality_classifier(spark, SF).collect()}
    assert sorted(got) == sorted(texts)
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    same = collections.defaultdict(set)
    for i, t in texts.items():
        same[t].add(got[i]["score"])
    assert all(len(s) == 1 for s in same.values())


def test_trees_are_walked_as_one_row_at_a_time():
    import numpy as np

    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, len(quality.FEATURES)))
    y = (x[:, 0] + x[:, 3] ** 2 > 0.8).astype(float)
    model = quality.grow(x, y)

    def walk(row):
        out = model.base
        for feature, cut, leaf in zip(model.feature, model.cut, model.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > cut[node])
            out += leaf[node - len(feature)]
        return 1 / (1 + math.exp(-out))

    assert np.allclose(model.score(x), [walk(row) for row in x])


def test_growing_equals_a_plain_version():
    import numpy as np

    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(120, 3)), 1)
    y = (x[:, 1] - x[:, 2] + rng.normal(size=120) / 2 > 0).astype(float)
    rate, ridge, least, bins, depth = 0.3, 2.0, 5, 8, 2
    model = quality.grow(x, y, trees=4, depth=depth, rate=rate, bins=bins, ridge=ridge, least=least)
    p = (y.sum() + 0.5) / (len(y) + 1)
    out = np.full(len(y), np.log(p / (1 - p)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(3)]
    for _ in range(4):
        chance = 1 / (1 + np.exp(-out))
        g, h = y - chance, chance * (1 - chance)

        def split(rows, level, g=g, h=h):
            """Gain of each cut, by sums over rows alone."""
            if level == depth:
                return [(rows, rate * g[rows].sum() / (h[rows].sum() + ridge))]
            best, where = 1e-9, None
            worth = lambda r: g[r].sum() ** 2 / (h[r].sum() + ridge)
            for j in range(3):
                for cut in edges[j]:
                    left, right = rows[x[rows, j] <= cut], rows[x[rows, j] > cut]
                    if min(len(left), len(right)) >= least and worth(left) + worth(right) - worth(rows) > best + 1e-12:
                        best, where = worth(left) + worth(right) - worth(rows), (left, right)
            left, right = where or (rows, rows[:0])
            return split(left, level + 1) + split(right, level + 1)

        for rows, leaf in split(np.arange(len(y)), 0):
            out[rows] += leaf
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-out)), atol=1e-9)
