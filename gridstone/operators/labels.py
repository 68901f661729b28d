"""Weak labels: equi, overlap and lookup joins with audit; domain constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .asof import bucketed_range_join, interval_overlap


def require(df: DataFrame, ok: Column, what: str) -> None:
    """Raise ValueError with the number of rows that aren't ``ok`` and a few of them."""
    bad = df.where(~F.coalesce(ok, F.lit(False)))
    some = bad.limit(3).collect()
    if some:
        raise ValueError(f"{what}: {bad.count()} rows, e.g. {some}")


def require_unique(df: DataFrame, key: Sequence[str], what: str) -> None:
    require(df.groupBy(*key).count(), F.col("count") == 1, f"{what} is not unique")


def join_labels(labels: DataFrame, frames: DataFrame, key: Sequence[str]) -> DataFrame:
    """Labels of frames in selected scenes, by exact key; others are dropped.
    A key of two labels that meets a frame raises; the check rides on the join."""
    seen = labels.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*key))).join(frames, list(key))
    once = F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(F.lit("label key is not unique")))
    return seen.where(once).drop("__n")


def windows_to_scenes(windows: DataFrame, scenes: DataFrame, key: Sequence[str], first: str, end: str, scene_first: str, scene_last: str, ordinal: str, token: str, width: int) -> DataFrame:
    """``windows`` with scene_tokens (by ordinal) of scenes of the same key that
    overlap: half-open at the window's end, closed at the scene's.  Windows
    without any are dropped.

    Both sides are spread over time buckets for an equi-join; a pair that
    meets in several buckets counts in the first of them only.
    """
    spread = lambda d, a, b: d.withColumn("__b", F.explode(F.sequence(F.floor(F.col(a) / width), F.floor(F.col(b) / width))))
    w = spread(windows.withColumn("__w", F.struct(*windows.columns)), first, end).select(*key, "__b", "__w", F.col(first).alias("__wa"), F.col(end).alias("__wb"))
    s = spread(scenes, scene_first, scene_last).select(*key, "__b", F.col(scene_first).alias("__sa"), F.col(scene_last).alias("__sb"), F.struct(F.col(ordinal).alias("o"), F.col(token).alias("t")).alias("__s"))
    meet = F.col("__b") == F.floor(F.greatest("__wa", "__sa") / width)
    pairs = w.join(s, [*key, "__b"]).where(meet & interval_overlap(F.col("__sa"), F.col("__sb"), F.col("__wa"), F.col("__wb")))
    return pairs.groupBy("__w").agg(F.transform(F.array_sort(F.collect_list("__s")), lambda x: x["t"]).alias("scene_tokens")).select("__w.*", "scene_tokens")


def windows_to_samples(windows: DataFrame, samples: DataFrame, key: Sequence[str], first: str, end: str, ts: str, width: int) -> DataFrame:
    """Samples with first <= ts < end of a window of the same key."""
    return bucketed_range_join(samples, windows, key, ts, first, end, width)


def join_payload_refs(refs: DataFrame, frames: DataFrame, frame_id: str, identity: Sequence[str], payloads: DataFrame | None = None, payload_key: str = "member_path") -> DataFrame:
    """References to frames by id whose identity columns must agree as well;
    payloads are left-joined, absent until they are materialised."""
    r = refs.join(frames.select(F.col(frame_id), F.struct(*identity).alias("__frame")), frame_id)
    require(r, F.struct(*identity) == F.col("__frame"), "a reference and its frame disagree")
    r = r.drop("__frame")
    return r if payloads is None else r.join(payloads, payload_key, "left")


def join_audit(available: Mapping[str, DataFrame], joined: Mapping[str, DataFrame]) -> DataFrame:
    """layer, available, joined: counts by layer."""
    out: DataFrame | None = None
    for layer in sorted(available):
        a = available[layer].agg(F.count(F.lit(1)).alias("available"))
        j = joined[layer].agg(F.count(F.lit(1)).alias("joined"))
        row = a.join(j).select(F.lit(layer).alias("layer"), "available", "joined")
        out = row if out is None else out.unionByName(row)
    return out


def mask_layers(df: DataFrame, layers: Mapping[str, Sequence[str]], chosen: Sequence[str], required: str) -> DataFrame:
    """``df`` with the columns of layers not chosen as null; no rows at all
    without the ``required`` layer."""
    if required not in chosen:
        return df.limit(0)
    off = {c: F.lit(None).cast(df.schema[c].dataType) for layer, cs in layers.items() if layer not in chosen for c in cs}
    return df.withColumns(off) if off else df


def probabilities_ok(names: Sequence[str], tolerance: float = 1e-5) -> Column:
    """All null, or all in [0, 1] with sum 1 within ``tolerance``."""
    none = F.array_compact(F.array(*names))
    full = F.forall(none, lambda p: (p >= 0) & (p <= 1)) & (F.abs(F.aggregate(none, F.lit(0.0), lambda s, p: s + p) - 1) <= tolerance)
    return (F.size(none) == 0) | ((F.size(none) == len(names)) & full)


def fractions_ok(classes: str, tolerance: float = 1e-6) -> Column:
    """array<struct<class_id, fraction>>: unique classes, fractions in [0, 1],
    sum at most 1."""
    c = F.col(classes)
    total = F.aggregate(c, F.lit(0.0), lambda s, x: s + x["fraction"])
    return (F.size(F.array_distinct(F.transform(c, lambda x: x["class_id"]))) == F.size(c)) & F.forall(c, lambda x: (x["fraction"] >= 0) & (x["fraction"] <= 1)) & (total <= 1 + tolerance)


def ordered_ok(*names: str) -> Column:
    """All null or rising, none negative."""
    vs = [F.col(n) for n in names]
    rising = vs[0] >= 0
    for a, b in zip(vs, vs[1:], strict=False):
        rising = rising & (a <= b)
    null = vs[0].isNull()
    for v in vs[1:]:
        null = null & v.isNull()
    return null | F.coalesce(rising, F.lit(False))
