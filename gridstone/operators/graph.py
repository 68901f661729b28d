"""Scene graphs: scene, sample and sample_data rows with tokens, their
validation by recomputation, and what is exported of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.identity import json_string, name_uuid
from .integrity import chain_faults, coverage_differences, duplicate_keys, orphans, partition_faults

#: Tables of a published dataset, fixed names; those that recordings never fill are empty.
TABLES = ("attribute", "calibrated_sensor", "category", "ego_pose", "instance", "log", "map", "sample", "sample_annotation", "sample_data", "scene", "sensor", "visibility")


def graph_token(namespace_hex: str, kind: str, identity: Sequence[Column], prefix: str = "") -> Column:
    """Version 5 UUID of ``prefix`` kind / canonical JSON list of JSON texts."""
    parts = [F.concat(F.lit("," if i else ""), c.cast("string")) for i, c in enumerate(identity)]
    return name_uuid(namespace_hex, F.concat(F.lit(f"{prefix}{kind}/["), *parts, F.lit("]")))


def materialize(assigned: DataFrame, records: DataFrame, key: str, digest: Column, source_json: Column, settings_json: str, namespace_hex: str, prefix: str = "") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scenes, samples, sample_data) of assigned samples.

    assigned: ``key``, ts, batch_ts, kind, scene_first, window_token (null
    without a window); rows without a kind are in no scene.  records: ``key``,
    ts, channel, camera_index, camera_ts, at most one a (sample, channel).
    A scene's identity holds all of its timestamps, which its longest duration
    bounds; everything else is windows over a scene or a scene's channel.
    """
    placed = assigned.where("kind is not null").withColumns({"__digest": digest, "__source": source_json})
    scene_key = [key, "kind", "scene_first", "window_token"]
    stamps = F.array_sort(F.collect_list("ts"))
    scenes = placed.groupBy(*scene_key, "__digest", "__source").agg(stamps.alias("stamps"))
    window = F.coalesce(json_string(F.col("window_token")), F.lit("null"))
    listed = F.concat(F.lit("["), F.array_join(F.transform("stamps", lambda t: t.cast("string")), ","), F.lit("]"))
    identity = [F.col("__source"), json_string(F.col("kind")), window, listed, F.lit(settings_json)]
    scenes = scenes.withColumn("token", graph_token(namespace_hex, "scene", identity, prefix))
    scenes = scenes.withColumn("ordinal", F.row_number().over(Window.partitionBy(key).orderBy("scene_first", "token")).cast("long") - 1)

    named = {c: f"__scene_{c}" for c in scene_key}
    in_scene = scenes.select(F.col("token").alias("scene_token"), *(F.col(c).alias(n) for c, n in named.items()))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(n)) for c, n in named.items()))
    samples = placed.join(in_scene, same).select(key, "ts", "batch_ts", "__digest", "__source", "scene_token")
    samples = samples.withColumn("token", graph_token(namespace_hex, "sample", [F.col("__source"), json_string(F.col("scene_token")), F.col("ts")], prefix))
    line = Window.partitionBy("scene_token").orderBy("ts")
    samples = samples.withColumns({"prev": F.coalesce(F.lag("token").over(line), F.lit("")), "next": F.coalesce(F.lead("token").over(line), F.lit(""))})

    ends = samples.groupBy("scene_token").agg(F.min_by("token", "ts").alias("first_sample_token"), F.max_by("token", "ts").alias("last_sample_token"), F.count(F.lit(1)).alias("nbr_samples"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    name = F.concat(F.substring("__digest", 1, 12), F.lit("-"), F.lpad(F.col("ordinal").cast("string"), 6, "0"))
    scenes = scenes.select(key, "token", name.alias("name"), "ordinal", "kind", "window_token").join(ends.withColumnRenamed("scene_token", "token"), "token")

    data = records.select(key, "ts", "channel", "camera_index", "camera_ts").join(samples.select(key, "ts", F.col("token").alias("sample_token"), "scene_token", "__digest", "__source"), [key, "ts"])
    lane = Window.partitionBy("scene_token", "channel").orderBy("ts")
    data = data.withColumn("ordinal", F.row_number().over(lane).cast("long") - 1)
    identity = [F.col("__source"), json_string(F.col("scene_token")), json_string(F.col("sample_token")), json_string(F.col("channel")), F.col("camera_ts"), F.col("camera_index"), F.col("ordinal")]
    data = data.withColumn("token", graph_token(namespace_hex, "sample-data", identity, prefix))
    data = data.withColumns({"prev": F.coalesce(F.lag("token").over(lane), F.lit("")), "next": F.coalesce(F.lead("token").over(lane), F.lit("")), "filename": F.concat(F.lit("samples/"), "__digest", F.lit("/"), "channel", F.lit("/"), "token", F.lit(".jpg"))})
    data = data.select("token", "sample_token", "scene_token", "channel", "camera_index", "ordinal", "camera_ts", "filename", "prev", "next")
    return scenes, samples.select("token", "scene_token", key, "ts", "batch_ts", "prev", "next"), data


def table_differences(published: DataFrame, recomputed: DataFrame, key: Sequence[str]) -> DataFrame:
    """key and fault (missing, unknown or changed) of rows that differ from
    those recomputed."""
    columns = sorted(set(published.columns) - set(key))
    row = F.struct(*columns) if columns else F.lit(True)
    a = published.select(*key, row.alias("__a"))
    b = recomputed.select(*key, row.alias("__b"))
    fault = F.when(F.col("__a").isNull(), "missing").when(F.col("__b").isNull(), "unknown").when(~F.col("__a").eqNullSafe(F.col("__b")), "changed")
    return a.join(b, list(key), "full_outer").select(*key, fault.alias("fault")).where("fault is not null")


def _told(df: DataFrame, code: str, subject: str, fault: str | None = None) -> DataFrame:
    name = F.concat(F.lit(f"{code}_"), F.col(fault)) if fault else F.lit(code)
    return df.select(name.alias("code"), F.col(subject).cast("string").alias("subject"))


def graph_findings(scenes: DataFrame, samples: DataFrame, data: DataFrame, assigned: DataFrame, key: str, expected: Sequence[str]) -> DataFrame:
    """code and subject of everything that is wrong with a graph; no rows if
    nothing is.

    Tokens are unique over all tables; samples and sample_data are chained in
    the order of their times; a scene's ends, count and members agree; each
    assigned sample is in a scene and no other is; channels are ``expected``
    and at most one record each a sample; files are named once and by token.
    """
    tokens = scenes.select("token").unionAll(samples.select("token")).unionAll(data.select("token"))
    members = samples.groupBy("scene_token").agg(F.count(F.lit(1)).alias("n"), F.min_by("token", "ts").alias("a"), F.max_by("token", "ts").alias("b"))
    ends = scenes.join(members, scenes["token"] == members["scene_token"], "left")
    wrong_ends = ends.where(~((F.col("nbr_samples") == F.col("n")) & (F.col("first_sample_token") == F.col("a")) & (F.col("last_sample_token") == F.col("b"))) | F.col("n").isNull())
    lane = Window.partitionBy("scene_token", "channel").orderBy("camera_ts", "token")
    misplaced = data.withColumn("__n", F.row_number().over(lane) - 1).where(F.col("__n") != F.col("ordinal"))
    taken = assigned.where("kind is not null").select(key, "ts")
    parts = partition_faults(taken, {"sample": samples.select(key, "ts")}, [key, "ts"])
    found = [
        _told(duplicate_keys(tokens, ["token"]), "token_repeated", "token"),
        _told(chain_faults(samples, ["scene_token"], "token", "prev", "next", "ts"), "sample", "token", "fault"),
        _told(chain_faults(data, ["scene_token", "channel"], "token", "prev", "next", "camera_ts"), "sample_data", "token", "fault"),
        _told(wrong_ends, "scene_ends", "token"),
        _told(misplaced, "channel_ordinal", "token"),
        _told(parts.withColumn("at", F.concat_ws("@", key, "ts")), "assignment", "at", "fault"),
        _told(orphans(samples, "scene_token", scenes, "token"), "sample_without_scene", "key"),
        _told(orphans(data, "sample_token", samples, "token"), "data_without_sample", "key"),
        _told(data.where(~F.col("channel").isin(list(expected))), "unexpected_channel", "token"),
        _told(duplicate_keys(data, ["sample_token", "channel"]).withColumn("at", F.concat_ws("@", "sample_token", "channel")), "channel_repeated", "at"),
        _told(duplicate_keys(data, ["filename"]), "filename_repeated", "filename"),
        _told(data.where(~F.col("filename").endswith(F.concat(F.lit("/"), "channel", F.lit("/"), "token", F.lit(".jpg")))), "filename_wrong", "token"),
    ]
    return reduce(DataFrame.unionByName, found).distinct()


def sync_features(samples: DataFrame, data: DataFrame, scene: Sequence[str], grid_error: str, camera_error: str) -> DataFrame:
    """scene, max_sync_error_ms, mean_sync_error_ms over one grid error a
    sample and one camera error a record, both in nanoseconds."""
    errors = samples.select(*scene, F.abs(grid_error).alias("e")).unionAll(data.select(*scene, F.abs(camera_error).alias("e")))
    return errors.groupBy(*scene).agg((F.max("e") / 1e6).alias("max_sync_error_ms"), (F.avg("e") / 1e6).alias("mean_sync_error_ms"))


def chronology(scenes: DataFrame, selected: DataFrame, source: str, order: Sequence[str]) -> DataFrame:
    """All scenes of the sources that the selection draws on, with position in
    their source's order and whether they are selected."""
    own = scenes.join(selected.select(source).distinct(), source, "left_semi")
    marked = own.join(selected.select("token").distinct().withColumn("__s", F.lit(True)), "token", "left")
    place = F.row_number().over(Window.partitionBy(source).orderBy(*order)).cast("long") - 1
    return marked.withColumns({"position": place, "selected": F.coalesce("__s", F.lit(False))}).drop("__s")


def preflight_findings(data: DataFrame, poses: DataFrame, calibrations: DataFrame, files: DataFrame) -> DataFrame:
    """code and subject of records that can't be exported: without a pose, a
    calibration or a staged file, or with a file name of another record."""
    found = [
        _told(orphans(data, "ego_pose_token", poses, "token"), "pose_missing", "key"),
        _told(orphans(data, "calibrated_sensor_token", calibrations, "token"), "calibration_missing", "key"),
        _told(orphans(data, "filename", files, "path"), "file_missing", "key"),
        _told(duplicate_keys(data, ["filename"]), "filename_repeated", "filename"),
    ]
    return reduce(DataFrame.unionByName, found)


def export_tables(selected: DataFrame, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The published tables of the selected scenes (``token``).

    Each table keeps what is reached from them: samples by scene, records by
    sample, poses, calibrations and sensors by record, logs by scene.  Names in
    TABLES that ``tables`` lacks come out empty, with a token alone.
    """
    spark = selected.sparkSession
    out = {name: spark.createDataFrame([], "token string") for name in TABLES}
    reach = lambda name, column, by, own="token": tables[name].join(by.select(F.col(column).alias(own)).distinct(), own, "left_semi")
    out["scene"] = reach("scene", "token", selected)
    out["sample"] = reach("sample", "token", out["scene"], "scene_token")
    out["sample_data"] = reach("sample_data", "token", out["sample"], "sample_token")
    for name, column, of in (("ego_pose", "ego_pose_token", "sample_data"), ("calibrated_sensor", "calibrated_sensor_token", "sample_data"), ("sensor", "sensor_token", "calibrated_sensor"), ("log", "log_token", "scene")):
        if name in tables and column in out[of].columns:
            out[name] = reach(name, column, out[of])
    for name, df in tables.items():
        if name in TABLES and name not in ("scene", "sample", "sample_data", "ego_pose", "calibrated_sensor", "sensor", "log"):
            out[name] = df
    return out


def split_input_findings(features: DataFrame, assignments: DataFrame, scenes: DataFrame, identity: Sequence[str]) -> DataFrame:
    """code and subject: selected features, assignments and scenes must be the
    same identities, each once, and names and sources must agree."""
    at = F.concat_ws("@", *identity).alias("at")
    found = []
    for name, df in (("feature", features), ("assignment", assignments), ("scene", scenes)):
        found.append(_told(duplicate_keys(df, identity).select(at), f"{name}_repeated", "at"))
    sides = coverage_differences(features, assignments, identity).select(at, "side")
    found.append(_told(sides, "identity", "at", "side"))
    lost = features.select(*identity).join(scenes.select(*identity), list(identity), "left_anti").select(at)
    found.append(_told(lost, "scene_missing", "at"))
    source = identity[-1]
    foreign = scenes.select(source).distinct().join(features.select(source).distinct(), source, "left_anti")
    found.append(_told(foreign, "source_foreign", source))
    named = features.select(*identity, F.col("scene_name").alias("__a")).join(scenes.select(*identity, F.col("scene_name").alias("__b")), list(identity)).where(~F.col("__a").eqNullSafe(F.col("__b")))
    found.append(_told(named.select(at), "scene_name_differs", "at"))
    return reduce(DataFrame.unionByName, found)
