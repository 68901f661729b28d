"""As-of joins: bracket, nearest, with interpolation; windows, not range joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def bracket(queries: DataFrame, samples: DataFrame, key: Sequence[str], ts: str, values: Sequence[str], slice_width: int | None = None) -> DataFrame:
    """Each query row with ``before`` (last sample at or before it) and
    ``after`` (first at or after), structs of ts and ``values``; null where
    none is.  An exact hit is on both sides.

    Samples must be unique in (key, ts).  With ``slice_width`` a key's time is
    cut into slices, each primed with the nearest sample outside it, so that a
    key with most of the rows is many tasks.
    """
    part = [*key, "__slice"] if slice_width else list(key)
    cut = (lambda d: d.withColumn("__slice", F.floor(F.col(ts) / slice_width))) if slice_width else (lambda d: d)
    sample = F.struct(F.col(ts).alias("ts"), *values)
    asked = cut(queries.withColumn("__q", F.struct(*queries.columns)).select(*key, ts, "__q"))
    given = cut(samples.select(*key, ts, sample.alias("__s")))
    both = asked.withColumn("__s", F.lit(None).cast(given.schema["__s"].dataType)).unionByName(given.withColumn("__q", F.lit(None).cast(asked.schema["__q"].dataType)))
    w = Window.partitionBy(*part).orderBy(ts)
    back, forth = w.rangeBetween(Window.unboundedPreceding, 0), w.rangeBetween(0, Window.unboundedFollowing)
    out = both.withColumns({"before": F.last("__s", ignorenulls=True).over(back), "after": F.first("__s", ignorenulls=True).over(forth)}).where("__q is not null")
    if slice_width:
        slices = given.groupBy(*part).agg(F.min_by("__s", ts).alias("__a"), F.max_by("__s", ts).alias("__b")).unionByName(asked.select(*part).distinct(), allowMissingColumns=True)
        slices = slices.groupBy(*part).agg(F.first("__a", ignorenulls=True).alias("__a"), F.first("__b", ignorenulls=True).alias("__b"))
        line = Window.partitionBy(*key).orderBy("__slice")
        edges = slices.select(*part, F.last("__b", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1)).alias("__b"), F.first("__a", ignorenulls=True).over(line.rowsBetween(1, Window.unboundedFollowing)).alias("__a"))
        out = out.join(edges, part).withColumns({"before": F.coalesce("before", "__b"), "after": F.coalesce("after", "__a")})
    return out.select("__q.*", "before", "after")


def fraction(ts: Column, before: Column, after: Column) -> Column:
    """Where ``ts`` stands between the two, 0 to 1; 0 on an exact hit."""
    width = after["ts"] - before["ts"]
    return F.when(width == 0, 0.0).otherwise(F.try_divide((ts - before["ts"]).cast("double"), width.cast("double")))


def nearest(ts: Column, before: Column, after: Column) -> Column:
    """The nearer of the bracket, the earlier on a tie."""
    return F.when(after.isNull() | (ts - before["ts"] <= after["ts"] - ts), before).otherwise(after)


def barrier_interpolate(queries: DataFrame, samples: DataFrame, key: Sequence[str], ts: str, valid: str, values: Sequence[str], slice_width: int | None = None) -> DataFrame:
    """``queries`` with status and the interpolated ``values``.

    Samples that aren't ``valid`` stay as barriers: a query between two samples
    is ``available`` if both are valid, else ``invalid_endpoint``; with a side
    missing it is ``no_bracket``.  Only available ones have values.
    """
    found = bracket(queries, samples, key, ts, [valid, *values], slice_width)
    both = F.col("before").isNotNull() & F.col("after").isNotNull()
    good = both & F.coalesce(F.col("before")[valid] & F.col("after")[valid], F.lit(False))
    t = fraction(F.col(ts), F.col("before"), F.col("after"))
    blend = lambda v: F.col("before")[v] + (F.col("after")[v] - F.col("before")[v]) * t
    out = found.withColumn("status", F.when(good, "available").when(both, "invalid_endpoint").otherwise("no_bracket"))
    return out.select(*queries.columns, "status", *(F.when(good, blend(v)).alias(v) for v in values))


def interval_overlap(a_first: Column, a_last: Column, b_first: Column, b_end: Column) -> Column:
    """Closed interval a against half-open b."""
    return (b_first <= a_last) & (b_end > a_first)


def bucketed_range_join(points: DataFrame, intervals: DataFrame, key: Sequence[str], ts: str, first: str, end: str, width: int, closed: bool = False) -> DataFrame:
    """Points inside [first, end) (or [first, end]) of the same key.

    Intervals are spread over time buckets of ``width`` and points fall into
    one each: an equi-join on (key, bucket), exact conditions after it.
    """
    spread = intervals.withColumn("__b", F.explode(F.sequence(F.floor(F.col(first) / width), F.floor(F.col(end) / width))))
    inside = (F.col(ts) >= F.col(first)) & ((F.col(ts) <= F.col(end)) if closed else (F.col(ts) < F.col(end)))
    return points.withColumn("__b", F.floor(F.col(ts) / width)).join(spread, [*key, "__b"]).where(inside).drop("__b")
