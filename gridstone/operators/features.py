"""Trajectory features of scenes: segment metrics by lag, one row a scene by aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalar import shortest_angle


def segments(df: DataFrame, scene: Sequence[str], ts: str, x: str, y: str, heading: str, stationary_speed: float) -> DataFrame:
    """``df`` with the metrics of the segment that ends at each row (null at a
    scene's first): dt, distance, speed, turn, curvature, stationary."""
    w = Window.partitionBy(*scene).orderBy(ts)
    dt = (F.col(ts) - F.lag(ts).over(w)) / 1e9
    distance = F.hypot(F.col(x) - F.lag(x).over(w), F.col(y) - F.lag(y).over(w))
    out = df.withColumns({"dt": dt, "distance": distance, "turn": shortest_angle(F.col(heading) - F.lag(heading).over(w))})
    out = out.withColumn("speed", F.try_divide("distance", "dt"))
    curvature = F.when(F.col("distance") > 0, F.try_divide("turn", "distance")).otherwise(F.when(F.col("distance").isNotNull(), 0.0))
    out = out.withColumns({"curvature": curvature, "stationary": F.col("speed") <= stationary_speed})
    first_flag = F.lead("stationary").over(w)
    return out.withColumns({
        "stopping": ~F.lag("stationary").over(w) & F.col("stationary"),
        "starting": F.lag("stationary").over(w) & ~F.col("stationary"),
        "cumulative_distance": F.coalesce(F.sum("distance").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0.0)),
        "observation_stationary": F.coalesce("stationary", first_flag, F.lit(True)),
    })


def scene_features(segmented: DataFrame, scene: Sequence[str], ts: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """One row a scene; all metrics 0 where it has no segment; ``extra``
    aggregates beside them, in the same pass.

    mean_speed is the mean of the segments' speeds; time_weighted_speed is
    distance over duration.
    """
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    speed_at = lambda f: zero(f(F.when(F.col("speed").isNotNull(), F.col("speed")), F.when(F.col("speed").isNotNull(), F.col(ts))))
    out = segmented.groupBy(*scene).agg(
        F.count(F.lit(1)).alias("n_samples"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        zero(F.sum("dt")).alias("duration_s"), zero(F.sum("distance")).alias("total_distance"),
        zero(F.avg("speed")).alias("mean_speed"), zero(F.median("speed")).alias("median_speed"), zero(F.max("speed")).alias("max_speed"),
        speed_at(F.min_by).alias("first_speed"), speed_at(F.max_by).alias("last_speed"),
        F.count_if("stopping").alias("stopping_count"), F.count_if("starting").alias("starting_count"),
        zero(F.sum(F.when(F.col("stationary"), F.col("dt")))).alias("stationary_s"), F.count_if(~F.col("stationary")).alias("moving_segments"),
        zero(F.sum("turn")).alias("net_turn"), zero(F.sum(F.abs("turn"))).alias("total_turn"),
        *(c.alias(n) for n, c in (extra or {}).items()),
    )
    weighted = F.when(F.col("duration_s") > 0, F.try_divide("total_distance", "duration_s")).otherwise(0.0)
    # a scene's share of valid samples is a declared feature that is 1 by definition
    return out.withColumns({"abs_turn": F.abs("net_turn"), "time_weighted_speed": weighted, "scene_valid_ratio": F.lit(1.0)})


def channel_coverage(samples: DataFrame, scene: Sequence[str], expected: str, present: str) -> DataFrame:
    """scene, channel, present, expected, ratio by exploding expected channels."""
    slots = samples.select(*scene, F.explode(expected).alias("channel"), F.col(present).alias("__p"))
    out = slots.groupBy(*scene, "channel").agg(F.count_if(F.array_contains("__p", F.col("channel"))).alias("present"), F.count(F.lit(1)).alias("expected"))
    return out.withColumn("ratio", F.col("present") / F.col("expected"))


def reference_observation(data: DataFrame, sample: Sequence[str], channel: str, camera_index: str, reference: str | None, required: bool = False) -> DataFrame:
    """One row a sample: of the reference channel where it is there, else the
    least (channel, camera index); ``fallback`` says which.  Where the channel
    is ``required``, a sample without it raises when it is read."""
    rank = F.struct((F.col(channel) != F.lit(reference)).alias("a") if reference else F.lit(True).alias("a"), channel, camera_index)
    w = Window.partitionBy(*sample).orderBy(rank)
    out = data.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r").withColumn("fallback", F.col(channel) != F.lit(reference) if reference else F.lit(True))
    if not required:
        return out
    return out.where(F.when(F.col("fallback"), F.raise_error(F.concat(F.lit(f"no {reference} in sample "), F.concat_ws("/", *sample)))).otherwise(F.lit(True)))


def computed_tags(
    distance: Column, moving_segments: Column, net_turn: Column, stopping: Column, starting: Column, gnss_ratio: Column, coverage_ratio: Column,
    minimum_movement: float = 5.0, straight_max_deg: float = 10.0, curvature_min_deg: float = 15.0, turn_min_deg: float = 45.0,
) -> Column:
    """Sorted array of tags."""
    side = F.when(net_turn > 0, "left").otherwise("right")
    deg = F.degrees(F.abs(net_turn))
    direction = F.when(deg <= straight_max_deg, "straight").when(deg >= turn_min_deg, F.concat(side, F.lit("_turn"))).when(deg >= curvature_min_deg, F.concat(side, F.lit("_curvature")))
    tags = [
        F.when((distance >= minimum_movement) & (moving_segments > 0), "moving").otherwise("stationary"),
        F.when(stopping > 0, "stopping"), F.when(starting > 0, "starting"), direction,
        F.when(gnss_ratio == 1, "gnss_valid").when(gnss_ratio == 0, "gnss_invalid").otherwise("gnss_partial"),
        F.when(coverage_ratio == 1, "camera_coverage_complete").otherwise("camera_coverage_partial"),
    ]
    return F.array_sort(F.array_compact(F.array(*tags)))
