"""Scenes: greedy partition of runs, annotation windows, hybrid graphs, tokens."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.identity import name_uuid
from .asof import bracket, nearest
from .runs import chain_links, first_appearance_union, gap_runs, merge_intervals


def greedy_scenes(stamps: Sequence[int], longest: int, shortest: int, least: int, skip: int) -> tuple[list[int | None], list[str | None]]:
    """(scene number or None, why unassigned) for one run's sorted timestamps.

    A scene spans at most ``longest`` from its first sample.  It is kept if it
    spans ``shortest`` and has ``least`` samples, else its samples are
    candidate_too_short.  After a kept one, samples nearer than ``skip`` to
    its end are inter_scene_skip.
    """
    n = len(stamps)
    scene: list[int | None] = [None] * n
    why: list[str | None] = [None] * n
    at = number = 0
    while at < n:
        end = bisect_right(stamps, stamps[at] + longest, at)
        if stamps[end - 1] - stamps[at] >= shortest and end - at >= least:
            scene[at:end] = [number] * (end - at)
            number += 1
            upto = max(end, bisect_left(stamps, stamps[end - 1] + skip, end))
            why[end:upto] = ["inter_scene_skip"] * (upto - end)
            at = upto
        else:
            why[at:end] = ["candidate_too_short"] * (end - at)
            at = end
    return scene, why


def stretches(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[pa.Table]:
    """Tables of whole stretches of rows that agree in the first ``key``
    columns (null equals null), from batches sorted by them."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        edge = starts(batch, key)
        edge = edge[edge > 0]
        if waiting and not _same(waiting[-1].slice(waiting[-1].num_rows - 1), batch.slice(0, 1), key):
            yield pa.Table.from_batches(waiting)
            waiting = []
        if len(edge):
            yield pa.Table.from_batches([*waiting, batch.slice(0, int(edge[-1]))])
            waiting, batch = [], batch.slice(int(edge[-1]))
        waiting.append(batch)
    if waiting:
        yield pa.Table.from_batches(waiting)


def _same(a: pa.RecordBatch, b: pa.RecordBatch, key: int) -> bool:
    return all(a.column(i)[0].as_py() == b.column(i)[0].as_py() for i in range(key))


def starts(rows: pa.RecordBatch | pa.Table, key: int) -> np.ndarray:
    """Where the first ``key`` columns change, from 0 on; null equals null."""
    n = rows.num_rows
    new = np.zeros(n, bool)
    new[:1] = True
    for i in range(key):
        c = rows.column(i)
        gone = np.asarray(pc.is_null(c))
        other = np.asarray(pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, n - 1)), False)) if n > 1 else np.zeros(0, bool)
        new[1:] |= other | (gone[1:] != gone[:-1])
    return np.flatnonzero(new)


def partition_runs(df: DataFrame, run: Sequence[str], ts: str, longest: int, shortest: int, least: int, skip: int = 0) -> DataFrame:
    """``run`` and ``ts`` columns with scene (number within the run, null if
    none) and unassigned (why).  Each start depends on the scene before, so a
    run is one sequential stretch of sorted rows; runs are many and short by
    their gaps.  Rows with null in ``run`` are a run like others."""
    columns = [*run, ts]
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in stretches(batches, len(run)):
            stamps = rows.column(len(run)).to_pylist()
            edge = starts(rows, len(run)).tolist()
            scene, why = [], []
            for a, b in zip(edge, [*edge[1:], len(stamps)], strict=True):
                s, w = greedy_scenes(stamps[a:b], longest, shortest, least, skip)
                scene += s
                why += w
            out = rows.append_column("scene", pa.array(scene, pa.int64())).append_column("unassigned", pa.array(why, pa.string()))
            yield from out.combine_chunks().to_batches()

    dealt = df.select(*columns).repartition(*run).sortWithinPartitions(*columns)
    return dealt.mapInArrow(work, f"{kinds}, scene long, unassigned string")


def match_annotations(annotations: DataFrame, samples: DataFrame, locator: str, ts: str, tolerance: int, values: Sequence[str] = (), slice_width: int | None = None) -> DataFrame:
    """``annotations`` with the nearest sample of their recording (ts and
    ``values``), error and decision: different_recording (no such recording),
    no_valid_samples, outside_tolerance or matched; ties go to the earlier
    sample, the tolerance is inclusive.

    ``samples`` needs a boolean ``valid``; only valid ones are matched.  With
    ``slice_width`` a recording's time is many tasks, as in ``bracket``.
    """
    known = samples.select(locator).distinct().withColumn("__known", F.lit(True))
    found = bracket(annotations, samples.where("valid"), [locator], ts, values, slice_width)
    near = found.withColumn("nearest", nearest(F.col(ts), F.col("before"), F.col("after"))).drop("before", "after").join(known, locator, "left")
    error = F.col("nearest.ts") - F.col(ts)
    decision = (
        F.when(F.col("__known").isNull(), "different_recording").when(F.col("nearest").isNull(), "no_valid_samples")
        .when(F.abs("error") > tolerance, "outside_tolerance").otherwise("matched")
    )
    return near.withColumn("error", error).withColumn("decision", decision).drop("__known")


def annotation_windows(matched: DataFrame, runs: DataFrame, run: Sequence[str], anchor: str, line: str, labels: str, before: int, after: int, slice_width: int | None = None) -> DataFrame:
    """run, window, first, last, labels, lines: windows around anchors, clipped
    to their run (``runs``: run, run_first, run_last), merged where they
    overlap or touch; labels in order of first appearance by line."""
    cut = matched.join(runs, list(run)).withColumns({"first": F.greatest(F.col(anchor) - before, F.col("run_first")), "last": F.least(F.col(anchor) + after, F.col("run_last"))})
    merged = merge_intervals(cut, run, "first", "last", [line], "window", slice_width)
    by_line = F.collect_list(F.struct(F.col(line).alias("line"), F.col(labels).alias("labels")))
    out = merged.groupBy(*run, "window").agg(F.min("first").alias("first"), F.max("last").alias("last"), by_line.alias("__l"))
    return out.select(*run, "window", "first", "last", first_appearance_union(F.col("__l")).alias("labels"), F.transform(F.array_sort("__l"), lambda s: s["line"]).alias("lines"))


def window_samples(samples: DataFrame, windows: DataFrame, run: Sequence[str], ts: str, width: int) -> DataFrame:
    """Samples inside windows of their run, both ends included."""
    from .asof import bucketed_range_join

    return bucketed_range_join(samples, windows, run, ts, "first", "last", width, closed=True)


def build_scenes(samples: DataFrame, key: str, ts: str, mode: str, max_gap: int, longest: int, shortest: int, least: int, skip: int = 0, windows: DataFrame | None = None, slice_width: int | None = None) -> DataFrame:
    """samples with run_id, kind (automatic or annotation), scene_first (ts of
    the scene's first sample) and unassigned.

    ``automatic`` ignores windows; ``annotation_only`` leaves the rest
    annotation_mode_excluded; ``hybrid`` cuts runs at samples inside windows
    and partitions what is left, so no automatic scene spans a window.
    windows: key, run_id, window, first, last.
    """
    if mode not in ("automatic", "annotation_only", "hybrid"):
        raise ValueError(f"unknown mode {mode}")
    runs = gap_runs(samples, [key], ts, max_gap, slice_width)
    if mode == "automatic" or windows is None:
        taken = runs.withColumn("window", F.lit(None).cast("long"))
    else:
        inside = window_samples(runs.select(key, "run_id", ts), windows.select(key, "run_id", "window", "first", "last"), [key, "run_id"], ts, max(1, longest)).select(key, "run_id", ts, "window")
        taken = runs.join(inside, [key, "run_id", ts], "left")
    rest = [c for c in taken.columns if c not in (key, "run_id", "window", ts)]
    dealt = taken.select(key, "run_id", "window", ts, *rest).repartition(key, "run_id").sortWithinPartitions(key, "run_id", ts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # windows of a run are apart, so their samples, and those between, are stretches of sorted rows
        for rows in stretches(batches, 2):
            stamps, edge, number = rows.column(3).to_pylist(), starts(rows, 3).tolist(), np.asarray(pc.is_valid(rows.column(2)))
            kind, first, why = [], [], []
            for a, b in zip(edge, [*edge[1:], len(stamps)], strict=True):
                n = b - a
                if number[a]:
                    kind += ["annotation"] * n
                    first += [stamps[a]] * n
                    why += [None] * n
                elif mode == "annotation_only":
                    kind += [None] * n
                    first += [None] * n
                    why += ["annotation_mode_excluded"] * n
                else:
                    scene, w = greedy_scenes(stamps[a:b], longest, shortest, least, skip)
                    begin: dict[int, int] = {}
                    for s, x in zip(scene, stamps[a:b], strict=True):
                        if s is not None:
                            begin.setdefault(s, x)
                    kind += [None if s is None else "automatic" for s in scene]
                    first += [None if s is None else begin[s] for s in scene]
                    why += w
            out = rows.drop_columns(["window"])
            for name, values, form in (("unassigned", why, pa.string()), ("kind", kind, pa.string()), ("scene_first", first, pa.int64())):
                out = out.append_column(name, pa.array(values, form))
            yield from out.combine_chunks().to_batches()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.drop("window").schema)
    out = dealt.mapInArrow(work, f"{kinds}, unassigned string, kind string, scene_first long")
    return out.select(*samples.columns, "run_id", "unassigned", "kind", "scene_first")


def name_scenes(scenes: DataFrame, key: str, order: Sequence[str], digest: Column, namespace_hex: str) -> DataFrame:
    """``scenes`` (one row each) with ordinal, name, token, prev and next."""
    w = Window.partitionBy(key).orderBy(*order)
    out = scenes.withColumn("__o", F.row_number().over(w).cast("long") - 1)
    out = out.withColumn("name", F.concat(F.substring(digest, 1, 12), F.lit("-"), F.lpad(F.col("__o").cast("string"), 6, "0")))
    out = out.withColumn("token", name_uuid(namespace_hex, F.concat(F.lit('scene/["'), digest, F.lit('",'), F.col("__o").cast("string"), F.lit("]"))))
    return chain_links(out.drop("__o"), [key], order, "token")
