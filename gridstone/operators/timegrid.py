"""Time-grid downsampling: nearest unused batch for each target within tolerance."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from fractions import Fraction

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scenes import starts, stretches

MOST_TARGETS = 10_000_000
_NS = 1_000_000_000


def match_grid(df: DataFrame, key: str, ts: str, order: Sequence[str], fps: Fraction, tolerance: int) -> DataFrame:
    """key, target_index, target_ts, batch_ts, error of each grid target.

    Targets run from the recording's first batch in source ``order``, at
    half-up multiples of 1/fps seconds, to its largest timestamp plus the
    tolerance.  batch_ts (and error, batch minus target) is null for a miss.
    Where no batch can reach two targets, each target takes its nearest batch
    by joins alone; else a greedy loop a recording gives every batch away once.
    A recording with more than MOST_TARGETS targets, or with two batches of
    one time, fails the job.
    """
    if fps <= 0 or tolerance < 0:
        raise ValueError("fps must be positive and the tolerance not negative")
    if Fraction(_NS) / fps < 1:
        raise ValueError("targets must be a nanosecond apart at least")
    spacing = int(Fraction(_NS) / fps)  # the least distance of two rounded targets
    return _by_joins(df, key, ts, order, fps, tolerance) if 2 * tolerance < spacing else _greedy(df, key, ts, order, fps, tolerance)


def _reach(fps: Fraction) -> int:
    """Distance from the anchor of the first target beyond MOST_TARGETS."""
    return (2 * MOST_TARGETS * _NS * fps.denominator + fps.numerator) // (2 * fps.numerator)


def _too_many() -> str:
    return f"target count exceeds safety limit {MOST_TARGETS}; lower fps or split the recording"


def _target(index, anchor, fps: Fraction):
    num, den = 2 * _NS * fps.denominator, fps.numerator
    wide = lambda c: c.cast("decimal(38,0)")
    return anchor + F.call_function("div", wide(index) * F.lit(str(num)).cast("decimal(30,0)") + F.lit(den).cast("decimal(20,0)"), F.lit(2 * den).cast("decimal(20,0)"))


def _by_joins(df: DataFrame, key: str, ts: str, order: Sequence[str], fps: Fraction, tolerance: int) -> DataFrame:
    once = df.groupBy(key, ts).agg(F.min(F.struct(*order)).alias("order"), F.count(F.lit(1)).alias("n"))
    once = once.select(key, F.when(F.col("n") == 1, F.col(ts)).otherwise(F.raise_error(F.lit("duplicate batch timestamps"))).alias(ts), "order")
    spans = once.groupBy(key).agg(F.min_by(ts, "order").alias("anchor"), F.max(ts).alias("end"))
    wide = lambda c: c.cast("decimal(38,0)")
    guess = lambda x: F.call_function("div", wide(x) * F.lit(fps.numerator).cast("decimal(18,0)"), F.lit(_NS * fps.denominator).cast("decimal(30,0)"))
    span = F.col("end") + tolerance - F.col("anchor")
    last = F.when(wide(span) >= F.lit(str(_reach(fps))).cast("decimal(38,0)"), F.raise_error(F.lit(_too_many()))).otherwise(guess(span))
    grid = spans.select(key, "anchor", "end", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0)) + 1)).alias("target_index"))
    grid = grid.withColumn("target_ts", _target(F.col("target_index"), F.col("anchor"), fps)).where(F.col("target_ts") <= F.col("end") + tolerance)
    near = once.select(key, ts).join(spans.select(key, "anchor"), key).where(F.col(ts) >= F.col("anchor") - tolerance)
    low = F.greatest(guess(F.greatest(F.col(ts) - F.col("anchor"), F.lit(0))), F.lit(0).cast("long"))
    near = near.select(key, ts, "anchor", F.explode(F.array(low, low + 1)).alias("target_index"))
    near = near.withColumn("off", F.col(ts) - _target(F.col("target_index"), F.col("anchor"), fps)).where(F.abs("off") <= tolerance)
    best = near.groupBy(key, "target_index").agg(F.min(F.struct(F.abs("off"), F.col(ts).alias("batch_ts"), F.col("off").alias("error"))).alias("best"))
    return grid.join(best, [key, "target_index"], "left").select(key, "target_index", "target_ts", "best.batch_ts", "best.error")


def greedy_grid(stamps: list[int], fps: Fraction, tolerance: int) -> list[tuple[int, int, int | None]]:
    """(index, target, batch or None) of one recording's batches in source order."""
    if len(set(stamps)) != len(stamps):
        raise ValueError("duplicate batch timestamps")
    if not stamps:
        return []
    ordered = sorted(stamps)
    n = len(ordered)
    down, up = list(range(n + 2)), list(range(n + 2))  # places 1..n; 0 and n + 1 are always free

    def free(links: list[int], i: int) -> int:
        while links[i] != i:
            links[i] = links[links[i]]
            i = links[i]
        return i

    out, anchor, end, index = [], stamps[0], ordered[-1] + tolerance, 0
    if anchor + _reach(fps) <= end:
        raise ValueError(_too_many())
    while True:
        target = anchor + (2 * index * _NS * fps.denominator + fps.numerator) // (2 * fps.numerator)
        if target > end:
            break
        at = bisect_left(ordered, target)
        places = [i for i in (free(down, at), free(up, at + 1)) if 1 <= i <= n]
        best = min(((abs(ordered[i - 1] - target), ordered[i - 1], i) for i in places), default=None)
        if best and best[0] <= tolerance:
            down[best[2]], up[best[2]] = best[2] - 1, best[2] + 1
            out.append((index, target, best[1]))
        else:
            out.append((index, target, None))
        index += 1
    return out


def _greedy(df: DataFrame, key: str, ts: str, order: Sequence[str], fps: Fraction, tolerance: int) -> DataFrame:
    kind = df.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows sorted by recording and source order; integers stay integers beside nulls
        for rows in stretches(batches, 1):
            stamps, edge = rows.column(1).to_pylist(), starts(rows, 1).tolist()
            for a, b in zip(edge, [*edge[1:], len(stamps)], strict=True):
                found = greedy_grid(stamps[a:b], fps, tolerance)
                index, target, batch = (pa.array(c, pa.int64()) for c in zip(*found, strict=True))
                owner = pa.array([rows.column(0)[a].as_py()] * len(found), rows.schema.field(0).type)
                yield pa.RecordBatch.from_arrays([owner, index, target, batch, pc.subtract(batch, target)], [key, "target_index", "target_ts", "batch_ts", "error"])

    place = F.struct(*order)
    dealt = df.select(key, ts, place.alias("__o")).repartition(key).sortWithinPartitions(key, "__o").drop("__o")
    return dealt.mapInArrow(work, f"`{key}` {kind}, target_index long, target_ts long, batch_ts long, error long")


def unused_batches(df: DataFrame, grid: DataFrame, key: str, ts: str) -> DataFrame:
    """Batches that no target took."""
    return df.select(key, ts).join(grid.where("batch_ts is not null").select(key, F.col("batch_ts").alias(ts)), [key, ts], "left_anti")
