"""Validity of samples: the pose and grid rules, and the proof that they hold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.trees import largest_leaf
from .integrity import duplicate_keys, orphans
from .policy import observations

#: Sigmas of a position that a bound judges, fixed names.
SIGMAS = ("east_sigma_m", "north_sigma_m", "up_sigma_m")


def pose_rules(sigma_max: float, variance_max: float, gap_max_ms: float, enabled: Sequence[str] = ()) -> list[tuple[str, str, Column, Column, float | None, bool]]:
    """Rules over available, source_validity (array), position_uncertainty and
    orientation_uncertainty (maps of numbers), sync_gap_before_ns and
    sync_gap_after_ns: a null gap, or a sigma that isn't there, doesn't judge."""
    endpoints = F.coalesce(~F.forall("source_validity", lambda v: F.coalesce(v, F.lit(False))), F.lit(False))
    sigmas = F.map_filter("position_uncertainty", lambda k, v: k.isin(*SIGMAS))
    worst = F.array_max(F.map_values(sigmas))
    leaf = largest_leaf(F.col("orientation_uncertainty"))["value"]
    gap, limit = F.greatest("sync_gap_before_ns", "sync_gap_after_ns"), int(gap_max_ms * 1_000_000)
    rules = [
        ("gnss_source_invalid", "pose", ~F.coalesce("available", F.lit(False)) | endpoints, F.coalesce("available", F.lit(False)).cast("int"), None),
        ("position_sigma_exceeded", "pose", worst > sigma_max, worst, sigma_max),
        ("orientation_variance_exceeded", "pose", leaf > variance_max, leaf, variance_max),
        ("gnss_sync_gap_exceeded", "pose", gap > limit, gap, limit),
    ]
    return [(*r, r[0] in enabled) for r in rules]


def grid_misses(grid: DataFrame, keep: Sequence[str], batch: str, target: str, enabled: bool) -> DataFrame:
    """One observation for each grid target without a batch."""
    return observations(grid, [("grid_miss", "grid", F.col(batch).isNull(), F.col(target), None, enabled)], keep)


def reference_findings(samples: DataFrame, grid: DataFrame, batches: DataFrame, poses: DataFrame, key: str) -> DataFrame:
    """code and subject of samples whose grid entry, batch or pose is not there
    or is not theirs; grid entries and batches are unique."""
    at = F.concat_ws("@", key, "ts")
    entry = grid.where("batch_ts is not null").select(key, F.col("target_ts").alias("ts"), F.col("batch_ts").alias("__b"))
    there = batches.select(F.col(key).alias("__k"), F.col("batch_ts").alias("__x")).distinct()
    seen = samples.join(entry, [key, "ts"], "left").join(there, (F.col(key) == F.col("__k")) & (F.col("batch_ts") == F.col("__x")), "left").withColumn("__there", F.col("__k"))
    fault = F.when(F.col("__b").isNull(), "grid_entry_missing").when(F.col("__b") != F.col("batch_ts"), "grid_entry_differs").when(F.col("__there").isNull(), "batch_missing")
    found = [
        seen.select(fault.alias("code"), at.alias("subject")).where("code is not null"),
        orphans(samples, "pose_token", poses, "token").select(F.lit("pose_missing").alias("code"), F.col("key").cast("string").alias("subject")),
        duplicate_keys(entry, [key, "ts"]).select(F.lit("grid_entry_repeated").alias("code"), at.alias("subject")),
        duplicate_keys(batches, [key, "batch_ts"]).select(F.lit("batch_repeated").alias("code"), F.concat_ws("@", key, "batch_ts").alias("subject")),
    ]
    return reduce(DataFrame.unionByName, found)


def enforcement_findings(audits: DataFrame, observed: DataFrame, exported: DataFrame, key: Sequence[str], policy: str) -> DataFrame:
    """code and subject where invalid samples leak, or audits don't follow
    from the observations.

    An audit is valid if no enabled observation is its own; only valid ones
    are final candidates; audit_only are the invalid ones under ``retain`` and
    none else; what is exported is a final candidate.
    """
    at = F.concat_ws("@", *key).alias("subject")
    bad = observed.where("enabled").select(*key).distinct().withColumn("__bad", F.lit(True))
    seen = audits.join(bad, list(key), "left").withColumn("__ok", F.col("__bad").isNull())
    fault = lambda where, code: seen.where(where).select(F.lit(code).alias("code"), at)
    lost = exported.select(*key).join(audits.where("final_candidate").select(*key), list(key), "left_anti")
    found = [
        fault(F.col("valid") != F.col("__ok"), "validity_differs"),
        fault(F.col("final_candidate") != F.col("valid"), "candidate_differs"),
        fault(F.col("audit_only") != (~F.col("valid") & F.lit(policy == "retain")), "audit_only_differs"),
        lost.select(F.lit("exported_not_candidate").alias("code"), at),
        duplicate_keys(audits, key).select(F.lit("audit_repeated").alias("code"), at),
    ]
    return reduce(DataFrame.unionByName, found)


def evaluate(samples: DataFrame, key: Sequence[str], rules: Sequence[tuple], extra: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """All observations of samples: by ``rules``, and those of other scopes
    (timeline, grid) given as observations already."""
    out = observations(samples, rules, key)
    for df in (extra or {}).values():
        out = out.unionByName(df.select(*out.columns))
    return out
