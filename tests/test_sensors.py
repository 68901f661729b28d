"""Layouts of sensor tables, dynamic trees."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gridstone.functions import trees
from gridstone.sources import sensors

from .conftest import rows


def grown(rng, depth=0):
    """A random tree of maps, sequences and leaves of all kinds."""
    kind = rng.random()
    if depth < 4 and kind < 0.35:
        return {rng.choice("pqrst") + str(i): grown(rng, depth + 1) for i in range(rng.randint(0, 4))}
    if depth < 4 and kind < 0.6:
        return [grown(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([rng.randint(-9, 9), rng.random(), str(rng.randint(-50, 50)), "07", "1.5", "word", True, None])


def shaken(rng, tree):
    """The same shape for the most part, with other leaves."""
    if isinstance(tree, dict):
        return {k: shaken(rng, v) for k, v in tree.items() if rng.random() > 0.05}
    if isinstance(tree, list):
        return [shaken(rng, v) for v in tree][: None if rng.random() > 0.1 else -1]
    return grown(rng, 9) if rng.random() < 0.3 else tree


def walked(a, b, t):
    """{path: value} by recursion: None where a branch can't be blended."""
    if isinstance(a, dict) and isinstance(b, dict):
        return {f".{k}{p}": v for k in a.keys() & b.keys() for p, v in (walked(a[k], b[k], t) or {}).items()}
    if isinstance(a, list) and isinstance(b, list):
        each = [walked(x, y, t) for x, y in zip(a, b, strict=False)]
        if len(a) != len(b) or not all(each):
            return {}
        return {f"[{i}]{p}": v for i, e in enumerate(each) for p, v in e.items()}
    x, y = (None if isinstance(v, dict | list) else trees.number(v) for v in (a, b))
    return {} if x is None or y is None else {"": x + (y - x) * t}


def test_trees_equal_a_recursive_walk():
    rng = random.Random(21)
    some = 0
    for _ in range(3000):
        a = {"root": grown(rng)}
        b = shaken(rng, a)
        got, left = trees.blend(a, b, 0.3)
        want = {p[1:]: v for p, v in walked(a, b, 0.3).items()}
        assert got == pytest.approx(want)
        numeric = {p for tree in (a, b) for p, v in trees.flatten(tree)[0].items() if trees.number(v) is not None}
        assert left == sorted(numeric - want.keys())
        some += bool(want) and any(p.count(".") + p.count("[") > 2 for p in want)
    assert some > 100


def test_trees_are_bounded():
    with pytest.raises(ValueError):
        trees.flatten([0] * 20_000)
    deep: list = []
    for _ in range(40):
        deep = [deep]
    with pytest.raises(ValueError):
        trees.flatten(deep)


def test_tree_columns(spark):
    df = spark.createDataFrame([(json.dumps({"a": 1, "b": {"c": "5"}}), json.dumps({"a": 3, "b": {"c": 5}})), (None, "{}")], "x string, y string")
    got = df.select(trees.blended("x", "y", F.lit(0.25)).alias("m")).select("m.*").collect()
    assert got[0]["blended"] == {"a": 1.5, "b.c": 5.0} and got[1]["blended"] is None
    best = df.select(trees.numeric_leaves("x").alias("l")).select(trees.largest_leaf(F.col("l")).alias("b")).collect()
    assert tuple(best[0]["b"]) == ("b.c", 5.0) and best[1]["b"] is None


def test_frame_layouts(spark):
    simple = spark.createDataFrame([("r", "F", i, i * 10, 4, 4) for i in range(2)], "recording_id string, camera_name string, frame_index long, recording_offset_ns long, width long, height long")
    full = spark.createDataFrame([("r", "F", i * 10, i * 10, i + 7, i, 4, 4) for i in range(2)], "recording_id string, source_camera_name string, camera_time_offset_ns long, batch_time_offset_ns long, frame_id long, packet_index long, width long, height long")
    assert rows(sensors.camera_frames(simple)) == rows(sensors.camera_frames(full))
    with pytest.raises(ValueError):
        sensors.camera_frames(simple.withColumn("recording_offset_ns", F.lit(0).cast("long")))
    with pytest.raises(ValueError):
        sensors.camera_frames(simple.where("frame_index = 1"))


def test_position_layouts_keep_barriers(spark):
    enu, att = "struct<local_east_m:double,local_north_m:double,local_up_m:double>", "struct<roll_rad:double,pitch_rad:double,yaw_rad:double>"
    plain = spark.createDataFrame([("r", 0, True, (0.0, 0.0, 0.0), (0.0, 0.0, 0.1)), ("r", 5, False, None, None)], f"recording_id string, recording_offset_ns long, is_valid boolean, local_enu {enu}, orientation {att}")
    packed = plain.select("recording_id", F.col("recording_offset_ns").alias("publish_time_offset_ns"), F.to_json(F.struct("is_valid", "local_enu", "orientation")).alias("fields_json"))
    assert rows(sensors.positions(plain)) == rows(sensors.positions(packed))
    assert [r["is_valid"] for r in sensors.positions(plain).orderBy("offset_ns").collect()] == [True, False]
    with pytest.raises(ValueError):
        sensors.positions(plain.withColumn("recording_offset_ns", F.lit(1).cast("long")))


def test_calibration_layouts_and_rescaling(spark):
    inner = json.dumps({"focal_length_x": 1.0, "focal_length_y": 2.0, "optical_center_x": 3.0, "optical_center_y": 4.0, "distortion": [0.5]})
    packed = spark.createDataFrame([("r", "F", inner, json.dumps({"rotation": [1.0], "translation": [2.0]}))], "recording_id string, camera string, intrinsic_json string, extrinsic_json string")
    got = sensors.calibrations(packed)
    assert tuple(got.first()) == ("r", "F", [1.0, 2.0], [3.0, 4.0], [0.5], [1.0], [2.0])
    sized = got.withColumns({"w": F.lit(100), "h": F.lit(50), "tw": F.lit(200), "th": F.lit(100)})
    assert sensors.rescaled_intrinsics(sized, "w", "h", "tw", "th").first()["focal"] == [2.0, 4.0]
    with pytest.raises(ValueError):
        sensors.rescaled_intrinsics(sized.withColumn("th", F.lit(101)), "w", "h", "tw", "th")
