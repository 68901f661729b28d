"""Ordered operators within a recording: deltas, gap runs, interval merge, chains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def timeline_observations(df: DataFrame, stream: Sequence[str], ts: str, order: Sequence[str], max_gap: int) -> DataFrame:
    """``df`` with delta to the previous row of its stream in source order,
    non_monotonic (delta <= 0) and gap_exceeded (delta > max_gap)."""
    delta = F.col(ts) - F.lag(ts).over(Window.partitionBy(*stream).orderBy(*order))
    out = df.withColumn("delta", delta)
    return out.withColumns({"non_monotonic": F.coalesce(F.col("delta") <= 0, F.lit(False)), "gap_exceeded": F.coalesce(F.col("delta") > max_gap, F.lit(False))})


def gap_runs(df: DataFrame, key: Sequence[str], ts: str, max_gap: int, slice_width: int | None = None, name: str = "run_id") -> DataFrame:
    """``df`` with run ids, dense from 0 within ``key``: a new run starts where
    the step in ``ts`` is greater than ``max_gap``.

    With ``slice_width`` a recording is cut into slices of that much time that
    are numbered apart and then shifted by what stands before, so that one
    long recording is not one task; slices meet in a table of one row each.
    """
    if slice_width is None:
        order = Window.partitionBy(*key).orderBy(ts)
        step = F.when(F.col(ts) - F.lag(ts).over(order) > max_gap, 1).otherwise(0)
        running = Window.partitionBy(*key).orderBy(ts).rangeBetween(Window.unboundedPreceding, 0)
        return df.withColumn("__new", step).withColumn(name, F.sum("__new").over(running).cast("long")).drop("__new")
    sliced = df.withColumn("__slice", F.floor(F.col(ts) / slice_width))
    own = Window.partitionBy(*key, "__slice").orderBy(ts)
    sliced = sliced.withColumn("__new", F.when(F.col(ts) - F.lag(ts).over(own) > max_gap, 1).otherwise(0))
    sliced = sliced.withColumn("__in", F.sum("__new").over(own.rangeBetween(Window.unboundedPreceding, 0)))
    edges = sliced.groupBy(*key, "__slice").agg(F.min(ts).alias("__a"), F.max(ts).alias("__b"), F.sum("__new").alias("__n"))
    line = Window.partitionBy(*key).orderBy("__slice")
    edges = edges.withColumn("__start", F.when(F.col("__a") - F.lag("__b").over(line) > max_gap, 1).otherwise(0))
    before = F.sum(F.col("__n") + F.col("__start")).over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")
    edges = edges.select(*key, "__slice", before.alias("__before"))
    return sliced.join(edges, [*key, "__slice"]).withColumn(name, (F.col("__in") + F.col("__before")).cast("long")).drop("__slice", "__new", "__in", "__before")


def merge_intervals(df: DataFrame, key: Sequence[str], first: str, last: str, tie: Sequence[str], name: str = "island", slice_width: int | None = None) -> DataFrame:
    """``df`` with the number, from 0 within ``key``, of the island of intervals
    that overlap or touch.

    With ``slice_width`` intervals are dealt by their first time into slices of
    that width; a slice learns how far those before it reach, and how many
    islands they began, from a table of one row a slice.
    """
    order = Window.partitionBy(*key).orderBy(first, last, *tie)
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    if slice_width is None:
        out = df.withColumn("__new", F.when(F.col(first) > F.max(last).over(before(order)), 1).otherwise(0))
        return out.withColumn(name, F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("__new")
    sliced = df.withColumn("__slice", F.floor(F.col(first) / slice_width))
    line = Window.partitionBy(*key).orderBy("__slice")
    reach = sliced.groupBy(*key, "__slice").agg(F.max(last).alias("__r")).withColumn("__reach", F.max("__r").over(before(line))).drop("__r")
    own = Window.partitionBy(*key, "__slice").orderBy(first, last, *tie)
    sliced = sliced.join(reach, [*key, "__slice"]).withColumn("__new", F.when(F.col(first) > F.greatest("__reach", F.max(last).over(before(own))), 1).otherwise(0))
    sliced = sliced.withColumn("__in", F.sum("__new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    begun = sliced.groupBy(*key, "__slice").agg(F.sum("__new").alias("__n")).withColumn("__begun", F.coalesce(F.sum("__n").over(before(line)), F.lit(0))).drop("__n")
    return sliced.join(begun, [*key, "__slice"]).withColumn(name, (F.col("__in") + F.col("__begun")).cast("long")).drop("__slice", "__reach", "__new", "__in", "__begun")


def chain_links(df: DataFrame, key: Sequence[str], order: Sequence[str], token: str) -> DataFrame:
    """``df`` with ordinal (from 0), prev and next tokens, "" at the ends."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumns({"ordinal": F.row_number().over(w).cast("long") - 1, "prev": F.coalesce(F.lag(token).over(w), F.lit("")), "next": F.coalesce(F.lead(token).over(w), F.lit(""))})


def first_appearance_union(values: Column) -> Column:
    """Distinct elements of an array<struct<order, array>> in order of first appearance."""
    return F.array_distinct(F.flatten(F.transform(F.array_sort(values), lambda s: s["labels"])))
