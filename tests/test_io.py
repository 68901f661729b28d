"""Sources, sinks, the read-only view and streaming forms."""

import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstone.plans.sdk import Dataset
from gridstone.sinks import publish
from gridstone.sources import dense, manifests
from gridstone.streaming import runs as streaming

from .conftest import rows

HASH = "0" * 64


def lines(spark, *texts):
    return spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "line_number long, value string")


def test_manifest_skips_blank_and_comment_lines(spark, tmp_path):
    good = json.dumps({"repo_path": "data/a/b.mcap", "source_size": 3, "sha256": HASH, "note": {"more": [1]}})
    (tmp_path / "m.jsonl").write_text(f"# head\n\n{good}\n")
    got = manifests.parse_manifest(manifests.numbered_lines(spark, f"file://{tmp_path}/m.jsonl"))
    assert rows(got) == [(3, "data/a/b.mcap", 3, HASH)]


def manifest_line(**change):
    return json.dumps({"repo_path": "data/a.mcap", "source_size": 1, "sha256": HASH} | change)


@pytest.mark.parametrize("bad", [
    '{"repo_path":"data/a.mcap","source_size":1}', manifest_line(source_size=True), manifest_line(source_size=0), manifest_line(source_size=1.5), manifest_line(repo_path="data/../a.mcap"),
    manifest_line(repo_path="data/a.mp4"), manifest_line(repo_path="a.mcap"), manifest_line(sha256="zz"), manifest_line(sha256=HASH.upper() if HASH.upper() != HASH else "A" * 64), "[]", "{", "# only a comment",
])
def test_bad_manifest_lines_raise(spark, bad):
    with pytest.raises(ValueError):
        manifests.parse_manifest(lines(spark, bad))


def test_duplicate_paths_raise(spark):
    good = manifest_line()
    with pytest.raises(ValueError, match="not unique"):
        manifests.parse_manifest(lines(spark, good, good))


def test_annotations(spark):
    ok = json.dumps({"repo_path": "data/x.mcap", "timestamp_ns": 5, "labels": ["a", "b"]})
    assert rows(manifests.parse_annotations(lines(spark, ok))) == [(1, "data/x.mcap", 5, ["a", "b"])]
    with pytest.raises(ValueError):
        manifests.parse_annotations(lines(spark, json.dumps({"repo_path": "data/x.mcap", "timestamp_ns": 5, "labels": ["a", "a"]})))


def test_catalog_selection(spark):
    c = spark.createDataFrame([("a", "train"), ("b", "test")], "recording_id string, split string")
    assert rows(manifests.select_recordings(c, ["a", "b"], ["test"])) == [("b", "test")]
    with pytest.raises(ValueError, match="not in the catalog"):
        manifests.select_recordings(c, ["zz"], None)


def test_unpivot_and_agreement(spark):
    c = spark.createDataFrame([("r", ("p1", "p2"), ("1", "2"))], "id string, paths struct<front:string,back:string>, sizes struct<front:string,back:string>")
    assert rows(manifests.unpivot_artifacts(c, "id", {"path": "paths", "size": "sizes"}), "id", "name", "path", "size") == [("r", "back", "p2", "2"), ("r", "front", "p1", "1")]
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string"), spark.createDataFrame([(1, "x"), (3, "z")], "k long, v string")
    assert rows(manifests.agreement({"a": a, "b": b}, ["k"], "v"), "k", "agrees") == [(1, True), (2, False), (3, False)]


def test_strict_schema(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t")
    assert manifests.read_strict(spark, f"{tmp_path}/t", T.StructType([T.StructField("id", T.LongType())])).count() == 3
    with pytest.raises(ValueError):
        manifests.read_strict(spark, f"{tmp_path}/t", T.StructType([T.StructField("id", T.StringType())]))


def test_tar_members(spark, tmp_path):
    with tarfile.open(tmp_path / "a.tar", "w") as tar:
        for name in ("x.npy", "y.npy"):
            info = tarfile.TarInfo(name)
            info.size = 3
            tar.addfile(info, io.BytesIO(b"abc"))
    wanted = spark.createDataFrame([("a.tar", "y.npy")], "shard_path string, member_path string")
    got = dense.tar_members(spark, f"file://{tmp_path}/a.tar", wanted)
    assert [(r["member_path"], r["payload"]) for r in got.orderBy("member_path").collect()] == [("x.npy", None), ("y.npy", bytearray(b"abc"))]
    index = got.select("shard_path", "member_path", "payload_bytes", "payload_sha256")
    assert dense.member_faults(got, index).count() == 0
    changed = index.withColumn("payload_bytes", F.lit(4).cast("long")).where("member_path = 'x.npy'")
    assert rows(dense.member_faults(got, changed), "member_path", "fault") == [("x.npy", "differs"), ("y.npy", "not_indexed")]


def test_publish_and_manifest(spark, tmp_path):
    stage, target = f"file://{tmp_path}/stage", f"file://{tmp_path}/out"
    df = spark.createDataFrame([(2, "b"), (1, "a")], "token long, name string")
    publish.write_json_table(df, f"{stage}/scene.json", ["token"])
    assert json.loads(publish.read_text(spark, f"{stage}/scene.json")) == [{"name": "a", "token": 1}, {"name": "b", "token": 2}]
    manifest = publish.content_manifest(spark, stage).cache()
    assert manifest.select("path").first()[0] == "scene.json" and len(publish.manifest_root(manifest)) == 64
    with pytest.raises(ValueError):
        publish.publish(spark, stage, target, manifest.withColumn("size", F.lit(1).cast("long")))
    publish.publish(spark, stage, target, manifest)
    publish.write_json_table(df, f"{stage}/scene.json", ["token"])
    with pytest.raises(FileExistsError):
        publish.publish(spark, stage, target, publish.content_manifest(spark, stage))


def test_dataset_view(spark):
    sample = spark.createDataFrame([("s1", "sc", 1, "", "s2"), ("s2", "sc", 2, "s1", "")], "token string, scene_token string, timestamp long, prev string, next string")
    data = Dataset({"sample": sample, "scene": spark.createDataFrame([("sc", "test")], "token string, split string")})
    assert data.get("sample", "s2")["timestamp"] == 2 and data.field2token("sample", "scene_token", "sc") == ["s1", "s2"]
    assert [r["token"] for r in data.scene_samples("sc").collect()] == ["s1", "s2"] and data.scenes_in_split("test").count() == 1
    with pytest.raises(LookupError):
        data.one("sample", F.col("scene_token") == "sc")
    broken = Dataset({"sample": sample.withColumn("next", F.lit(""))})
    with pytest.raises(ValueError, match="broken"):
        broken.scene_samples("sc")


def test_stream_equals_batch(spark, tmp_path):
    from gridstone.operators.runs import gap_runs

    df = spark.createDataFrame([(k, t) for k in range(3) for t in (0, 5, 30, 33, 90)], "k long, t long")
    df.where("t < 20").coalesce(1).write.parquet(f"{tmp_path}/in/1")
    df.where("t >= 20").coalesce(1).write.parquet(f"{tmp_path}/in/2")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    q = streaming.stream_gap_runs(stream, "k", "t", 10).writeStream.format("memory").queryName("gap_stream").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert rows(spark.table("gap_stream"), "k", "t", "run_id") == rows(gap_runs(df, ["k"], "t", 10), "k", "t", "run_id")


def test_gate_and_config(spark):
    ok, failed = publish.recording_gate(spark.createDataFrame([("a", "ok"), ("b", "error")], "id string, status string"), "id", "status")
    assert not ok and rows(failed) == [("b", "error")]
    assert publish.load_config('{"a": 1}', {"a": int, "b": str}) == {"a": 1, "b": None}
    for bad in ('{"a": 1, "a": 2}', '{"c": 1}', '{"a": "x"}'):
        with pytest.raises(ValueError):
            publish.load_config(bad, {"a": int, "b": str})
    nested = {"grid": {"fps": float, "cameras": [str]}, "rules": [{"name": str, "quota": int}]}
    got = publish.load_config('{"rules": [{"name": "x"}], "grid": {"fps": 2}}', nested)
    assert got == {"grid": {"fps": 2, "cameras": None}, "rules": [{"name": "x", "quota": None}]} and publish.load_config("{}", nested)["grid"] == {"fps": None, "cameras": None}
    for bad in ('{"grid": {"x": 1}}', '{"grid": []}', '{"rules": {}}', '{"rules": [{"quota": true}]}', '{"grid": {"fps": NaN}}', '{"grid": {"cameras": [1]}}', "[]"):
        with pytest.raises(ValueError):
            publish.load_config(bad, nested)
