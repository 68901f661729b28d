"""Sensor tables: two layouts of frames, calibration and positions made one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.labels import require


def ordered_by_index(df: DataFrame, stream: Sequence[str], index: str, offset: str) -> DataFrame:
    """``df`` if each stream's index runs 0, 1, 2, ... and its offset rises
    strictly with it; else ValueError."""
    w = Window.partitionBy(*stream).orderBy(index)
    seen = df.withColumns({"__n": F.row_number().over(w) - 1, "__last": F.lag(offset).over(w)})
    require(seen, (F.col("__n") == F.col(index)) & (F.col("__last").isNull() | (F.col("__last") < F.col(offset))), "indices have gaps or offsets don't rise")
    return df


def camera_frames(df: DataFrame) -> DataFrame:
    """recording_id, camera_name, frame_index, offset_ns, batch_offset_ns, width,
    height of either layout of frame tables."""
    if "source_camera_name" in df.columns:
        w = Window.partitionBy("recording_id", "source_camera_name").orderBy("packet_index", "frame_id")
        out = df.select("recording_id", F.col("source_camera_name").alias("camera_name"), (F.row_number().over(w) - 1).cast("long").alias("frame_index"), F.col("camera_time_offset_ns").alias("offset_ns"), F.col("batch_time_offset_ns").alias("batch_offset_ns"), "width", "height")
    else:
        out = df.select("recording_id", "camera_name", "frame_index", F.col("recording_offset_ns").alias("offset_ns"), F.col("recording_offset_ns").alias("batch_offset_ns"), "width", "height")
    return ordered_by_index(out, ["recording_id", "camera_name"], "frame_index", "offset_ns")


_LOCAL = "local_enu struct<local_east_m:double,local_north_m:double,local_up_m:double>, orientation struct<roll_rad:double,pitch_rad:double,yaw_rad:double>"


def positions(df: DataFrame) -> DataFrame:
    """recording_id, offset_ns, is_valid, local_enu, orientation of either
    layout; invalid rows stay, as barriers.  Offsets must rise strictly."""
    if "fields_json" in df.columns:
        fields = F.from_json("fields_json", f"is_valid boolean, {_LOCAL}")
        out = df.select("recording_id", F.col("publish_time_offset_ns").alias("offset_ns"), fields.alias("f")).select("recording_id", "offset_ns", "f.*")
    else:
        out = df.select("recording_id", F.col("recording_offset_ns").alias("offset_ns"), "is_valid", "local_enu", "orientation")
    w = Window.partitionBy("recording_id").orderBy("offset_ns")
    require(out.withColumn("__last", F.lag("offset_ns").over(w)), F.col("offset_ns").isNotNull() & (F.col("__last").isNull() | (F.col("__last") < F.col("offset_ns"))), "offsets don't rise")
    return out.withColumn("is_valid", F.coalesce("is_valid", F.lit(False)) & F.col("local_enu").isNotNull() & F.col("orientation").isNotNull())


def calibrations(df: DataFrame) -> DataFrame:
    """recording_id, camera_name, focal (x, y), center (x, y), distortion,
    rotation, translation of either layout; one row a camera."""
    if "intrinsic_json" in df.columns:
        inner = F.from_json("intrinsic_json", "focal_length_x double, focal_length_y double, optical_center_x double, optical_center_y double, distortion array<double>, distortion_coeffs array<double>")
        outer = F.from_json("extrinsic_json", "rotation array<double>, rotation_vector array<double>, translation array<double>, translation_vector array<double>")
        d = df.select("recording_id", F.col("camera").alias("camera_name"), inner.alias("i"), outer.alias("e"))
        out = d.select(
            "recording_id", "camera_name", F.array("i.focal_length_x", "i.focal_length_y").alias("focal"), F.array("i.optical_center_x", "i.optical_center_y").alias("center"),
            F.coalesce("i.distortion_coeffs", "i.distortion").alias("distortion"), F.coalesce("e.rotation_vector", "e.rotation").alias("rotation"), F.coalesce("e.translation_vector", "e.translation").alias("translation"),
        )
    else:
        out = df.select(
            "recording_id", "camera_name", F.array("focal_length_x", "focal_length_y").alias("focal"), F.array("optical_center_x", "optical_center_y").alias("center"),
            F.col("distortion_coeffs").alias("distortion"), F.col("rotation_vector").alias("rotation"), F.col("translation_vector").alias("translation"),
        )
    from ..operators.labels import require_unique

    require_unique(out, ["recording_id", "camera_name"], "calibration")
    return out


def rescaled_intrinsics(df: DataFrame, width: str, height: str, to_width: str, to_height: str) -> DataFrame:
    """``df`` with focal and center scaled to the target size; the aspect
    ratios must agree to one in a million."""
    a, b = F.col(width) / F.col(height), F.col(to_width) / F.col(to_height)
    require(df, F.abs(a - b) <= 1e-6 * F.greatest(a, b), "aspect ratios differ")
    scaled = lambda c: F.transform(c, lambda v: v * F.col(to_width) / F.col(width))
    return df.withColumns({"focal": scaled("focal"), "center": scaled("center")})
