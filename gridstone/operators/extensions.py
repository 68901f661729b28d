"""Findings over the tables and extensions of a published dataset: code and
subject of each fault, no rows if all is well."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalar import microseconds
from .integrity import chain_faults, coverage_differences, duplicate_keys, geometry_ok, orphans, partition_faults

#: Foreign keys of the published tables: (child, column, parent).
LINKS = (
    ("scene", "log_token", "log"), ("sample", "scene_token", "scene"), ("sample_data", "sample_token", "sample"),
    ("sample_data", "ego_pose_token", "ego_pose"), ("sample_data", "calibrated_sensor_token", "calibrated_sensor"), ("calibrated_sensor", "sensor_token", "sensor"),
)


def _rows(df: DataFrame, code: str | Column, subject: Column) -> DataFrame:
    return df.select((F.lit(code) if isinstance(code, str) else code).alias("code"), subject.cast("string").alias("subject"))


def _all(found: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, found).distinct()


def dataset_findings(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Of the published tables that are given: tokens, foreign keys, one pose a
    record, chains of samples and of each channel, ends of scenes, geometry,
    file names.  sample_data has channel, or gets it from its sensor."""
    t = dict(tables)
    token = F.col("token")
    found = [_rows(duplicate_keys(df, ["token"]), f"{name}_token_repeated", token) for name, df in t.items()]
    found += [_rows(orphans(t[c], column, t[p], "token"), f"{c}_{column}_unknown", F.col("key")) for c, column, p in LINKS if c in t and p in t and column in t[c].columns]
    if "sample_data" in t:
        data = t["sample_data"]
        if "ego_pose" in t:
            found.append(_rows(duplicate_keys(data, ["ego_pose_token"]), "pose_shared", F.col("ego_pose_token")))
            found.append(_rows(orphans(t["ego_pose"], "token", data.select(F.col("ego_pose_token").alias("token")), "token"), "pose_unused", F.col("key")))
        if "channel" not in data.columns:
            sensors = t["calibrated_sensor"].select(F.col("token").alias("calibrated_sensor_token"), "sensor_token").join(t["sensor"].select(F.col("token").alias("sensor_token"), "channel"), "sensor_token")
            data = data.join(sensors.drop("sensor_token"), "calibrated_sensor_token", "left")
        if "scene_token" not in data.columns and "sample" in t:
            data = data.join(t["sample"].select(F.col("token").alias("sample_token"), "scene_token"), "sample_token", "left")
        lane = chain_faults(data, ["scene_token", "channel"], "token", "prev", "next", "timestamp")
        found.append(_rows(lane, F.concat(F.lit("sample_data_"), "fault"), token))
        found.append(_rows(duplicate_keys(data, ["filename"]), "filename_repeated", F.col("filename")))
        found.append(_rows(duplicate_keys(data, ["sample_token", "channel"]), "channel_repeated", F.concat_ws("@", "sample_token", "channel")))
    if "sample" in t:
        line = chain_faults(t["sample"], ["scene_token"], "token", "prev", "next", "timestamp")
        found.append(_rows(line, F.concat(F.lit("sample_"), "fault"), token))
        if "scene" in t:
            ends = t["sample"].groupBy(F.col("scene_token").alias("token")).agg(F.min_by("token", "timestamp").alias("a"), F.max_by("token", "timestamp").alias("b"), F.count(F.lit(1)).alias("n"))
            seen = t["scene"].join(ends, "token", "left")
            same = F.col("first_sample_token").eqNullSafe(F.col("a")) & F.col("last_sample_token").eqNullSafe(F.col("b")) & (F.col("nbr_samples") == F.coalesce("n", F.lit(0)))
            found.append(_rows(seen.where(~same), "scene_ends", token))
    for name in ("ego_pose", "calibrated_sensor"):
        if name in t and {"translation", "rotation"} <= set(t[name].columns):
            found.append(_rows(t[name].where(~geometry_ok("translation", "rotation")), f"{name}_geometry", token))
    return _all(found)


def scene_extension_findings(extension: DataFrame, scenes: DataFrame) -> DataFrame:
    """Of a scene extension (scene_token, source_digest, tags): its scenes are
    the table's (token, source_digest), each once with its owner's digest, and
    its tags are sorted and unique."""
    key = F.col("scene_token")
    sides = coverage_differences(extension.select("scene_token"), scenes.select(F.col("token").alias("scene_token")), ["scene_token"])
    owned = extension.join(scenes.select(F.col("token").alias("scene_token"), F.col("source_digest").alias("__d")), "scene_token")
    return _all([
        _rows(duplicate_keys(extension, ["scene_token"]), "scene_repeated", key),
        _rows(sides, F.concat(F.lit("scene_"), "side"), key),
        _rows(owned.where(~F.col("source_digest").eqNullSafe(F.col("__d"))), "owner_differs", key),
        _rows(extension.where(F.array_sort(F.array_distinct("tags")) != F.col("tags")), "tags_unordered", key),
    ])


def validity_row_findings(rows: DataFrame, samples: DataFrame) -> DataFrame:
    """Of validity rows (scene_token, ratios and sync errors, coverage:
    array<struct<channel, present, expected, ratio>>, samples:
    array<struct<sample_token, timestamp_ns>>): numbers in their ranges, each
    ratio exactly present / expected, channels in order, the scene's own
    samples (token, scene_token, timestamp in microseconds) and their times."""
    key = F.col("scene_token")
    inside = reduce(lambda a, b: a & b, (F.col(c).between(0, 1) for c in ("scene_valid_ratio", "source_gnss_valid_ratio", "camera_coverage_ratio")))
    sync = (F.col("max_abs_sync_error_ms") >= 0) & (F.col("mean_abs_sync_error_ms") >= 0)
    good = F.forall("coverage", lambda c: (c["present"] >= 0) & (c["expected"] > 0) & (c["present"] <= c["expected"]) & (c["ratio"] == c["present"] / c["expected"]))
    names = F.transform("coverage", lambda c: c["channel"])
    no = lambda ok: ~F.coalesce(ok, F.lit(False))
    nested = rows.select("scene_token", F.explode("samples").alias("s")).select("scene_token", "s.*")
    official = samples.select(F.col("token").alias("sample_token"), "scene_token", F.col("timestamp").alias("__us"))
    pairs = nested.join(official, ["scene_token", "sample_token"])
    sides = coverage_differences(nested, official.join(rows.select("scene_token"), "scene_token", "left_semi"), ["scene_token", "sample_token"])
    return _all([
        _rows(rows.where(no(inside)), "ratio_range", key),
        _rows(rows.where(no(sync)), "sync_range", key),
        _rows(rows.where(no(good)), "coverage_ratio", key),
        _rows(rows.where(no(F.array_sort(F.array_distinct(names)) == names)), "coverage_order", key),
        _rows(duplicate_keys(nested, ["scene_token", "sample_token"]), "sample_repeated", F.col("sample_token")),
        _rows(sides, F.concat(F.lit("sample_"), "side"), F.col("sample_token")),
        _rows(pairs.where(microseconds(F.col("timestamp_ns")) != F.col("__us")), "sample_time", F.col("sample_token")),
    ])


def pose_extension_findings(rows: DataFrame, data: DataFrame, privacy: bool) -> DataFrame:
    """Of a pose extension (sample_data_token, fraction, gaps, rotation, and
    east_m, north_m, up_m): one row a record, numbers in their ranges, a unit
    rotation; local coordinates are whole and there under ``privacy``, and
    absent without."""
    key = F.col("sample_data_token")
    sides = coverage_differences(rows.select("sample_data_token"), data.select(F.col("token").alias("sample_data_token")), ["sample_data_token"])
    norm = F.aggregate("rotation", F.lit(0.0), lambda s, v: s + v * v)
    gaps = F.coalesce(F.col("sync_gap_before_ns") >= 0, F.lit(True)) & F.coalesce(F.col("sync_gap_after_ns") >= 0, F.lit(True))
    whole = reduce(lambda a, b: a & b, (F.col(c) == F.floor(c) for c in ("east_m", "north_m"))) & F.col("up_m").isNotNull()
    none = reduce(lambda a, b: a & b, (F.col(c).isNull() for c in ("east_m", "north_m", "up_m")))
    no = lambda ok: ~F.coalesce(ok, F.lit(False))
    return _all([
        _rows(duplicate_keys(rows, ["sample_data_token"]), "record_repeated", key),
        _rows(sides, F.concat(F.lit("record_"), "side"), key),
        _rows(rows.where(no(F.col("fraction").between(0, 1))), "fraction_range", key),
        _rows(rows.where(no(gaps)), "gap_range", key),
        _rows(rows.where(no((F.size("rotation") == 4) & (F.abs(norm - 1) <= 1e-6))), "rotation_norm", key),
        _rows(rows.where(no(whole if privacy else none)), "local_coordinates", key),
    ])


def audit_findings(accepted: DataFrame, rejected: DataFrame, selected: DataFrame, unselected: DataFrame, published: DataFrame, split: DataFrame, token: str = "token") -> DataFrame:
    """Of a pipeline's audit: accepted and rejected are apart, selected and
    unselected make up the accepted, and selected, published and split are the
    same scenes."""
    both = accepted.select(token).join(rejected.select(token), token, "left_semi")
    parts = partition_faults(accepted, {"selected": selected, "unselected": unselected}, [token])
    found = [_rows(both, "accepted_and_rejected", F.col(token)), _rows(parts, F.concat(F.lit("selection_"), "fault"), F.col(token))]
    for name, df in (("published", published), ("split", split)):
        found.append(_rows(coverage_differences(selected, df, [token]), F.concat(F.lit(f"{name}_"), "side"), F.col(token)))
    return _all(found)


def position_faults(scenes: DataFrame, source: str, order: list[str], position: str) -> DataFrame:
    """Scenes whose stated position isn't theirs in the order of their source."""
    place = F.row_number().over(Window.partitionBy(source).orderBy(*order)) - 1
    return _rows(scenes.withColumn("__n", place).where(F.col("__n") != F.col(position)), "position_differs", F.col("token"))
