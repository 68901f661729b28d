"""Predicates with evidence: filters with all their reasons, validity, sanity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SceneFilter:
    """Bounds are inclusive; absent ones don't judge."""

    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    min_channel_coverage: Mapping[str, float] = field(default_factory=dict)
    max_channel_coverage: Mapping[str, float] = field(default_factory=dict)
    max_sync_error: tuple[str, float] | None = None
    sets: Mapping[str, tuple[Sequence[str], Sequence[str], Sequence[str]]] = field(default_factory=dict)
    blacklists: Mapping[str, Sequence[object]] = field(default_factory=dict)


def _text(c: Column) -> Column:
    return c.cast("string")


def rejection_reasons(f: SceneFilter, coverage: str = "coverage") -> Column:
    """array<struct<code, measured, op, threshold>> of every predicate that
    fails, in a fixed order; nothing is skipped once one has failed.

    ranges and blacklists: by column; sets: by array column, (any of, all of,
    none of); coverage: a map of ratios by channel, a missing one is 0.
    """
    reason = lambda code, measured, op, limit: F.struct(F.lit(code).alias("code"), _text(measured).alias("measured"), F.lit(op).alias("op"), F.lit(limit).alias("threshold"))
    out: list[Column] = []
    for name, (low, high) in f.ranges.items():
        if low is not None:
            out.append(F.when(F.col(name) < low, reason(f"{name}_below_minimum", F.col(name), ">=", str(low))))
        if high is not None:
            out.append(F.when(F.col(name) > high, reason(f"{name}_above_maximum", F.col(name), "<=", str(high))))
    for limits, worse, op, word in ((f.min_channel_coverage, lambda a, b: a < b, ">=", "below_minimum"), (f.max_channel_coverage, lambda a, b: a > b, "<=", "above_maximum")):
        for channel in sorted(limits):
            ratio = F.coalesce(F.element_at(coverage, channel), F.lit(0.0))
            out.append(F.when(worse(ratio, limits[channel]), reason(f"channel_coverage_{word}", ratio, op, f"{channel}:{limits[channel]}")))
    if f.max_sync_error:
        name, high = f.max_sync_error
        out.append(F.when(F.col(name) > high, reason("sync_error_above_maximum", F.col(name), "<=", str(high))))
    for name, (some, every, none) in f.sets.items():
        listed = lambda xs: F.array(*map(F.lit, sorted(xs)))
        have = F.array_join(F.array_sort(name), ",")
        if some:
            out.append(F.when(~F.arrays_overlap(name, listed(some)), reason(f"{name}_missing_any", have, "any", ",".join(sorted(some)))))
        if every:
            out.append(F.when(F.size(F.array_except(listed(every), name)) > 0, reason(f"{name}_missing_required", have, "all", ",".join(sorted(every)))))
        if none:
            out.append(F.when(F.arrays_overlap(name, listed(none)), reason(f"{name}_excluded", have, "none", ",".join(sorted(none)))))
    for name, values in f.blacklists.items():
        out.append(F.when(F.col(name).isin(list(values)), reason(f"{name}_blacklisted", F.col(name), "not in", "blacklist")))
    return F.array_compact(F.array(*out)) if out else F.array().cast("array<struct<code:string,measured:string,op:string,threshold:string>>")


def filter_scenes(df: DataFrame, f: SceneFilter, coverage: str = "coverage") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with ``reasons``)."""
    judged = df.withColumn("reasons", rejection_reasons(f, coverage))
    return judged.where(F.size("reasons") == 0).drop("reasons"), judged.where(F.size("reasons") > 0)


def matches(f: SceneFilter, coverage: str = "coverage") -> Column:
    return F.size(rejection_reasons(f, coverage)) == 0


def observations(df: DataFrame, rules: Sequence[tuple[str, str, Column, Column, float | int | None, bool]], keep: Sequence[str]) -> DataFrame:
    """Long format, one row for each rule that fires: ``keep`` columns, code,
    scope, measured, threshold, enabled.

    rules: (code, scope, fires, measured, threshold, enabled as invalidator);
    disabled rules are observed all the same.  One pass over ``df``.
    """
    fired = F.array_compact(F.array(*(
        F.when(fires, F.struct(F.lit(code).alias("code"), F.lit(scope).alias("scope"), measured.cast("double").alias("measured"), F.lit(limit).cast("double").alias("threshold"), F.lit(on).alias("enabled")))
        for code, scope, fires, measured, limit, on in rules
    )))
    return df.select(*keep, F.explode(fired).alias("o")).select(*keep, "o.*")


def sample_audits(samples: DataFrame, observed: DataFrame, key: Sequence[str], policy: str) -> DataFrame:
    """Each sample with codes, valid (no enabled observation), final_candidate
    and audit_only (kept for the record under ``retain``)."""
    codes = observed.groupBy(*key).agg(F.array_sort(F.collect_set("code")).alias("codes"), F.bool_or("enabled").alias("__bad"))
    out = samples.join(codes, list(key), "left")
    valid = ~F.coalesce("__bad", F.lit(False))
    return out.withColumns({"codes": F.coalesce("codes", F.array().cast("array<string>")), "valid": valid, "final_candidate": valid, "audit_only": ~valid & F.lit(policy == "retain")}).drop("__bad")


def sanity_findings(df: DataFrame, key: Sequence[str], checks: Mapping[str, tuple[Column, str]]) -> DataFrame:
    """key, code, severity of each aggregate check that holds for a recording.

    checks: {code: (boolean aggregate, "error", "warn" or "off")}.
    """
    on = {c: v for c, v in checks.items() if v[1] != "off"}
    if not on:
        return df.select(*key, F.lit("").alias("code"), F.lit("").alias("severity")).limit(0)
    flags = df.groupBy(*key).agg(*(F.coalesce(c, F.lit(False)).alias(n) for n, (c, _) in on.items()))
    found = F.array_compact(F.array(*(F.when(F.col(n), F.struct(F.lit(n).alias("code"), F.lit(s).alias("severity"))) for n, (_, s) in on.items())))
    return flags.select(*key, F.explode(found).alias("f")).select(*key, "f.*")


def require_sane(findings: DataFrame) -> None:
    """Raise where a finding's severity is error; warnings pass."""
    some = findings.where("severity = 'error'").limit(5).collect()
    if some:
        raise ValueError(f"sanity errors: {[tuple(r) for r in some]}")
