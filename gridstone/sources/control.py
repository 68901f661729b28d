"""Control tables of a release: its tree, privacy manifest and three-table
contract, recording tables, dense indexes and scenario windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import repo_file_path, safe_segment
from ..operators.integrity import ISO_DATE, duplicate_keys
from ..operators.labels import require, require_unique

#: Kinds of dense payloads, and counts that a privacy manifest states: fixed names.
DENSE_KINDS = ("semantic", "depth")
COUNTS = ("recording_count", "video_count", "face_plate_blurred_video_count", "missing_camera_slot_count", "not_face_plate_blurred_video_count")


def _found(df: DataFrame, code: str, subject: Column) -> DataFrame:
    return df.select(F.lit(code).alias("code"), subject.cast("string").alias("subject"))


def tree_findings(files: DataFrame, allowed: Sequence[str], required: Sequence[str], base: str = "data/", path: str = "path") -> DataFrame:
    """code and subject: paths given twice, below ``base`` but in no allowed
    family, or with a date in them, and required ones that are absent."""
    p = F.col(path)
    family = reduce(lambda a, b: a | b, (p.startswith(x) for x in allowed), F.lit(False)) | p.isin(list(required))
    asked = files.sparkSession.createDataFrame([(x,) for x in required], f"`{path}` string")
    found = [
        _found(duplicate_keys(files, [path]), "path_repeated", p),
        _found(files.where(p.startswith(base) & ~family), "path_unknown", p),
        _found(files.where(p.rlike(ISO_DATE)), "path_dated", p),
        _found(asked.join(files.select(path), path, "left_anti"), "path_missing", p),
    ]
    return reduce(DataFrame.unionByName, found).distinct()


def privacy_faults(manifest: Mapping[str, object], identity: Mapping[str, object]) -> list[str]:
    """What is wrong with a privacy manifest: fields that must equal
    ``identity``, counts, and their sums."""
    out = [f"{k}_differs" for k, v in identity.items() if manifest.get(k) != v]
    counts = {c: manifest.get(c) for c in COUNTS}
    out += [f"{c}_invalid" for c, n in counts.items() if not isinstance(n, int) or isinstance(n, bool) or n < 0]
    if not out:
        out += ["recording_count_zero"] * (counts["recording_count"] == 0)
        out += ["video_count_differs"] * (counts["video_count"] != counts["face_plate_blurred_video_count"])
        out += ["videos_not_blurred"] * (counts["not_face_plate_blurred_video_count"] != 0)
    return out


def binding_findings(bindings: DataFrame, files: DataFrame) -> DataFrame:
    """code and subject of manifest bindings (path, bytes, sha256) that aren't
    unique or don't equal the files' own (path, size, sha256)."""
    own = files.select("path", F.struct(F.col("size").cast("long").alias("n"), F.col("sha256").alias("h")).alias("__f"))
    seen = bindings.select("path", F.struct(F.col("bytes").cast("long").alias("n"), F.col("sha256").alias("h")).alias("__b")).join(own, "path", "left")
    found = [
        _found(duplicate_keys(bindings, ["path"]), "binding_repeated", F.col("path")),
        _found(seen.where("__f is null"), "file_missing", F.col("path")),
        _found(seen.where(F.col("__f") != F.col("__b")), "file_differs", F.col("path")),
    ]
    return reduce(DataFrame.unionByName, found)


def recording_tables(files: DataFrame, recordings: DataFrame, key: str, prefix: str, camera: str | None = None, path: str = "path") -> DataFrame:
    """key and path of each recording's one table below ``prefix`` whose stem
    ends with the recording's id; none or several raise.

    Ids of one length are compared by equality with the stem's end, so each
    length is one equi-join and no pair of path and id is tried.
    """
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    own = files.where(F.col(path).startswith(prefix))
    if camera is not None:
        own = own.where(F.contains(path, F.lit(f"/camera={camera}/")))
    ids = recordings.select(F.col(key)).distinct()
    lengths = sorted(r[0] for r in ids.select(F.length(key)).distinct().collect())  # few
    ends = F.explode(F.array_distinct(F.array(*(F.when(F.length(stem) >= n, F.right(stem, F.lit(n))) for n in lengths))))
    ends = own.select(path, ends.alias(key)).where(F.col(key).isNotNull()) if lengths else own.select(path, F.lit("").alias(key)).limit(0)
    counted = ids.join(ends, key, "left").groupBy(key).agg(F.count(path).alias("n"), F.min(path).alias(path))
    require(counted, F.col("n") == 1, f"a recording needs exactly one table below {prefix}")
    return counted.drop("n")


def status_counts(slots: DataFrame, status: str) -> DataFrame:
    """status and n over (recording, camera) slots."""
    return slots.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def contract_findings(metadata: DataFrame, viewer: DataFrame, integrity: DataFrame, key: Sequence[str], optional: Sequence[str], allowed_missing: str = "missing") -> DataFrame:
    """code and subject of slots (recording, camera) on which three tables
    (path, and status but for ``integrity``) disagree.

    Slots are the same in all; paths and statuses agree; a slot without a path
    is missing by status, on a camera that may be.
    """
    at = F.concat_ws("@", *key)
    both = metadata.select(*key, F.col("path").alias("mp"), F.col("status").alias("ms"), F.lit(True).alias("m")).join(viewer.select(*key, F.col("path").alias("vp"), F.col("status").alias("vs"), F.lit(True).alias("v")), list(key), "full_outer")
    rows = both.join(integrity.select(*key, F.col("path").alias("ip"), F.lit(True).alias("i")), list(key), "full_outer")
    there = F.col("m").isNotNull() & F.col("v").isNotNull() & F.col("i").isNotNull()
    same = F.col("mp").eqNullSafe(F.col("vp")) & F.col("ip").eqNullSafe(F.col("vp"))
    absent = F.col("vp").isNull()
    may = F.col(key[-1]).isin(list(optional)) & (F.col("vs") == allowed_missing)
    code = F.when(~there, "slot_missing").when(~same, "path_differs").when(~F.col("ms").eqNullSafe(F.col("vs")), "status_differs").when(absent & ~F.coalesce(may, F.lit(False)), "camera_missing").when(~absent & (F.col("vs") == allowed_missing), "status_wrong")
    return rows.select(code.alias("code"), at.alias("subject")).where("code is not null")


def recording_durations(frames: DataFrame, key: str, offset: str) -> DataFrame:
    """key and duration_ns: one past the largest offset."""
    return frames.groupBy(key).agg((F.max(offset) + 1).alias("duration_ns"))


def dense_references(indexes: Sequence[DataFrame], annotations: DataFrame, key: Sequence[str], frame_id: str = "frame_id") -> DataFrame:
    """Rows of all dense indexes with the frame id that the camera annotations
    bind to their key; rows without one, duplicates and bad fields raise."""
    rows = reduce(DataFrame.unionByName, indexes)
    require_unique(annotations, key, "camera source frame")
    out = rows.join(annotations.select(*key, frame_id), list(key), "left")
    require(out, F.col(frame_id).isNotNull(), "a dense index row lacks a camera frame")
    require(out, dense_ok(key), "bad dense index rows")
    require_unique(out, [*key, "artifact_kind"], "dense asset")
    return out


def dense_ok(key: Sequence[str]) -> Column:
    """Constraints of one dense reference; the last two of ``key`` are numbers."""
    counts = reduce(lambda a, b: a & b, (F.col(c) > 0 for c in ("width", "height", "payload_bytes")))
    order = reduce(lambda a, b: a & b, (F.col(c) >= 0 for c in key[-2:]))
    member = F.col("member_path")
    inside = (F.length(member) > 0) & ~F.contains(member, F.lit("\\")) & F.forall(F.split(member, "/"), lambda x: ~x.isin("", ".", ".."))
    return F.coalesce(F.col("artifact_kind").isin(*DENSE_KINDS) & counts & order & safe_segment(F.col(key[0])) & safe_segment(F.col("dtype")) & F.col("payload_sha256").rlike("^[0-9a-f]{64}$") & repo_file_path(F.col("shard_path")) & inside, F.lit(False))


def scenario_ok() -> Column:
    """Constraints of one scenario window."""
    tags = ("validity_tags", "quality_tags", "anomaly_reasons")
    unique = reduce(lambda a, b: a & b, (F.forall(t, safe_segment) & (F.size(F.array_distinct(t)) == F.size(t)) for t in tags))
    window = (F.col("window_index") >= 0) & (F.col("window_start_offset_ns") >= 0) & (F.col("window_end_offset_ns") > F.col("window_start_offset_ns"))
    return F.coalesce(unique & window & safe_segment(F.col("motion_label")) & safe_segment(F.col("run_id")) & (F.col("confidence") >= 0) & (F.col("confidence") <= 1) & ~F.isnan("confidence"), F.lit(False))


def scenario_windows(rows: DataFrame, durations: DataFrame, revision: str, schema_version: str, selected: DataFrame | None = None, key: str = "recording_id") -> DataFrame:
    """Scenario windows of the selected recordings; every row must be of this
    schema and revision, kept ones inside their recording, well formed and
    unique by (recording, window)."""
    require(rows, (F.col("schema_version") == schema_version) & (F.col("source_revision") == revision), "rows of another contract")
    own = rows if selected is None else rows.join(selected.select(key).distinct(), key, "left_semi")
    own = own.join(durations.select(key, "duration_ns"), key, "left")
    require(own, F.col("duration_ns").isNotNull(), "windows of a foreign recording")
    require(own, F.col("window_end_offset_ns") <= F.col("duration_ns"), "windows beyond their recording")
    require(own, scenario_ok(), "bad scenario windows")
    require_unique(own, [key, "window_index"], "scenario window")
    return own.drop("duration_ns")
