"""Scene graphs, validity, control tables, configuration and export beyond what SQL compares."""

import hashlib
import json
import uuid

import pytest
from pyspark.sql import functions as F

from gridstone.functions.identity import canonical_json
from gridstone.operators import graph, policy, selection, validity
from gridstone.plans import config
from gridstone.plans.sdk import Dataset
from gridstone.sinks import publish
from gridstone.sources import control

from .conftest import rows

SPACE = uuid.NAMESPACE_URL


@pytest.fixture(scope="module")
def made(spark):
    assigned = spark.createDataFrame(
        [("r", t * 10, t * 10 + 1, None if t == 9 else "annotation" if t > 5 else "automatic", None if t == 9 else 60 if t > 5 else 0, "w1" if 5 < t < 9 else None) for t in range(10)],
        "rec string, ts long, batch_ts long, kind string, scene_first long, window_token string",
    )
    records = spark.createDataFrame([("r", t * 10, c, t * 3, t * 10 + 2) for t in range(10) for c in ("A", "B") if (t, c) != (2, "B")], "rec string, ts long, channel string, camera_index long, camera_ts long")
    out = graph.materialize(assigned, records, "rec", F.sha2("rec", 256), F.lit('{"id":"r"}'), '{"gap":1}', SPACE.hex, "kit/")
    return *(d.cache() for d in out), assigned


def test_tokens_are_named_by_content(made):
    scenes, samples, data, _ = made
    token = lambda kind, x: str(uuid.uuid5(SPACE, f"kit/{kind}/{canonical_json(x)}"))
    want = {"automatic": ([0, 10, 20, 30, 40, 50], None), "annotation": ([60, 70, 80], "w1")}
    for r in scenes.collect():
        stamps, window = want[r["kind"]]
        assert r["token"] == token("scene", [{"id": "r"}, r["kind"], window, stamps, {"gap": 1}])
        assert r["nbr_samples"] == len(stamps) and (r["first_ts"], r["last_ts"]) == (stamps[0], stamps[-1])
        own = {s["ts"]: s for s in samples.where(F.col("scene_token") == r["token"]).collect()}
        assert {t: s["token"] for t, s in own.items()} == {t: token("sample", [{"id": "r"}, r["token"], t]) for t in stamps}
        assert [own[t]["next"] for t in stamps] == [*(own[t]["token"] for t in stamps[1:]), ""] and own[stamps[0]]["prev"] == ""
        for channel in "AB":
            line = sorted(data.where((F.col("scene_token") == r["token"]) & (F.col("channel") == channel)).collect(), key=lambda d: d["camera_ts"])
            assert [d["ordinal"] for d in line] == list(range(len(line)))
            for i, d in enumerate(line):
                assert d["token"] == token("sample-data", [{"id": "r"}, r["token"], d["sample_token"], channel, d["camera_ts"], d["camera_index"], i])
                assert d["filename"] == f"samples/{hashlib.sha256(b'r').hexdigest()}/{channel}/{d['token']}.jpg"


def test_a_sound_graph_has_no_findings_and_each_fault_has_its_own(made):
    scenes, samples, data, assigned = made
    codes = lambda a, b, c, d=assigned, e=("A", "B"): {r["code"] for r in graph.graph_findings(a, b, c, d, "rec", e).collect()}
    assert codes(scenes, samples, data) == set()
    assert codes(scenes.limit(1), samples, data) >= {"sample_without_scene"}
    assert "data_without_sample" in codes(scenes, samples.where("ts <> 10"), data)
    assert codes(scenes, samples, data.withColumn("ordinal", F.col("ordinal") + 1)) == {"channel_ordinal"}
    assert codes(scenes, samples, data, e=("A",)) == {"unexpected_channel"}
    assert codes(scenes, samples, data.withColumn("filename", F.lit("x"))) == {"filename_repeated", "filename_wrong"}
    assert "token_repeated" in codes(scenes, samples, data.unionAll(data.limit(1)))
    assert codes(scenes, samples, data, assigned.where("ts <> 0")) == {"assignment_unknown"}


def test_sync_is_over_grid_and_camera_errors(spark):
    s = spark.createDataFrame([("a", -3_000_000), ("a", 1_000_000), ("b", 0)], "scene string, e long")
    d = spark.createDataFrame([("a", 2_000_000)], "scene string, e long")
    assert rows(graph.sync_features(s, d, ["scene"], "e", "e")) == [("a", 3.0, 2.0), ("b", 0.0, 0.0)]


def test_export_keeps_what_is_reached_and_round_trips(spark, made, tmp_path):
    scenes, samples, data, _ = made
    data = data.withColumns({"ego_pose_token": F.concat(F.lit("p"), "token"), "calibrated_sensor_token": F.col("channel")})
    tables = {
        "scene": scenes, "sample": samples, "sample_data": data, "ego_pose": data.select(F.col("ego_pose_token").alias("token"), F.lit(1.5).alias("x")),
        "calibrated_sensor": spark.createDataFrame([("A", "s"), ("B", "s"), ("C", "s")], "token string, sensor_token string"), "sensor": spark.createDataFrame([("s",), ("t",)], "token string"),
    }
    out = graph.export_tables(scenes.where("kind = 'annotation'"), tables)
    assert sorted(out) == sorted(graph.TABLES) and {n: d.count() for n, d in out.items() if d.count()} == {"scene": 1, "sample": 3, "sample_data": 6, "ego_pose": 6, "calibrated_sensor": 2, "sensor": 1}
    stage, target = f"file://{tmp_path}/stage", f"file://{tmp_path}/done"
    publish.write_export(out, stage)
    publish.write_split(scenes.select("token", F.lit("train").alias("split")), f"{stage}/split.json", 3, "0.2", ["token"])
    nothing = spark.createDataFrame([], "code string, subject string")
    with pytest.raises(ValueError, match="findings"):
        publish.finalize(spark, stage, target, spark.createDataFrame([("x", "y")], nothing.schema))
    assert len(publish.finalize(spark, stage, target, nothing)) == 64
    written = json.loads((tmp_path / "done" / "sample.json").read_text())
    assert [r["token"] for r in written] == sorted(r["token"] for r in out["sample"].collect())
    back = Dataset.read_json(spark, target)
    back.check_keys()
    assert rows(back.table("sample"), "token", "prev", "next") == rows(out["sample"], "token", "prev", "next") and back.table("visibility").count() == 0
    assert json.loads((tmp_path / "done" / "split.json").read_text())["seed"] == 3 and json.loads((tmp_path / "done" / "visibility.json").read_text()) == []


def test_pose_rules_judge_what_is_there(spark):
    schema = "id int, available boolean, source_validity array<boolean>, position_uncertainty map<string,double>, orientation_uncertainty map<string,double>, sync_gap_before_ns long, sync_gap_after_ns long"
    df = spark.createDataFrame([
        (1, True, [True, True], {"east_sigma_m": 1.0}, {"a": 0.1}, 5, None), (2, True, [True, False], {"up_sigma_m": 9.0, "x": 99.0}, {"a": 0.9, "b": 0.95}, None, 2_000_001),
        (3, False, None, {}, {}, None, None), (4, None, None, None, None, None, None), (5, True, None, {"x": 99.0}, None, 2_000_000, 1),
    ], schema)
    got = validity.evaluate(df, ["id"], validity.pose_rules(2.0, 0.5, 2.0, ["position_sigma_exceeded"]))
    assert rows(got, "id", "code", "measured", "enabled") == sorted([
        (2, "gnss_source_invalid", 1.0, False), (2, "position_sigma_exceeded", 9.0, True), (2, "orientation_variance_exceeded", 0.95, False), (2, "gnss_sync_gap_exceeded", 2000001.0, False),
        (3, "gnss_source_invalid", 0.0, False), (4, "gnss_source_invalid", 0.0, False),
    ], key=lambda r: tuple((x is None, str(x)) for x in r))
    grid = spark.createDataFrame([(1, 10, 10), (1, 20, None)], "id int, target_ts long, batch_ts long")
    assert rows(validity.grid_misses(grid, ["id"], "batch_ts", "target_ts", True), "id", "code", "measured", "enabled") == [(1, "grid_miss", 20.0, True)]


def test_privacy_manifest(spark):
    good = {"repo_id": "x", "schema_version": 2, "recording_count": 3, "video_count": 5, "face_plate_blurred_video_count": 5, "missing_camera_slot_count": 1, "not_face_plate_blurred_video_count": 0}
    who = {"repo_id": "x", "schema_version": 2}
    assert control.privacy_faults(good, who) == []
    for change, fault in (({"repo_id": "y"}, "repo_id_differs"), ({"video_count": True}, "video_count_invalid"), ({"recording_count": 0}, "recording_count_zero"), ({"video_count": 6}, "video_count_differs"), ({"not_face_plate_blurred_video_count": 1}, "videos_not_blurred")):
        assert fault in control.privacy_faults(good | change, who)
    files = spark.createDataFrame([("a", 1, "h"), ("b", 2, "h")], "path string, size long, sha256 string")
    bound = spark.createDataFrame([("a", 1, "h"), ("b", 3, "h"), ("c", 1, "h"), ("a", 1, "h")], "path string, bytes long, sha256 string")
    assert rows(control.binding_findings(bound, files)) == [("binding_repeated", "a"), ("file_differs", "b"), ("file_missing", "c")]


def test_one_table_a_recording(spark):
    ids = spark.createDataFrame([("ab",), ("xyz",)], "id string")
    files = lambda *p: spark.createDataFrame([(x,) for x in p], "path string")
    assert rows(control.recording_tables(files("t/1_ab.parquet", "t/q-xyz.json", "u/ab.json"), ids, "id", "t/")) == [("ab", "t/1_ab.parquet"), ("xyz", "t/q-xyz.json")]
    for bad in (files("t/1_ab.parquet"), files("t/1_ab.parquet", "t/2_ab.parquet", "t/xyz.json")):
        with pytest.raises(ValueError, match="exactly one table"):
            control.recording_tables(bad, ids, "id", "t/")


def test_dense_and_scenario_rows_fail_closed(spark):
    key = ["recording_id", "frame_index", "recording_offset_ns"]
    frames = spark.createDataFrame([("r", 1, 5, "f")], "recording_id string, frame_index long, recording_offset_ns long, frame_id string")
    one = {"recording_id": "r", "frame_index": 1, "recording_offset_ns": 5, "artifact_kind": "depth", "dtype": "u2", "width": 1, "height": 1, "member_path": "a/b", "payload_bytes": 1, "payload_sha256": "0" * 64, "shard_path": "data/x.tar"}
    index = lambda *changes: spark.createDataFrame([one | c for c in changes])
    assert control.dense_references([index({}), index({"artifact_kind": "semantic"})], frames, key).count() == 2
    for bad in ({"frame_index": 2}, {"artifact_kind": "x"}, {"member_path": "a/../b"}, {"member_path": "/a"}, {"width": 0}, {"shard_path": "x.tar"}, {"payload_sha256": "zz"}, {"dtype": "nul"}):
        with pytest.raises(ValueError):
            control.dense_references([index(bad)], frames, key)
    with pytest.raises(ValueError, match="not unique"):
        control.dense_references([index({}), index({})], frames, key)

    row = {"schema_version": "v", "source_revision": "s", "recording_id": "r", "window_index": 0, "window_start_offset_ns": 0, "window_end_offset_ns": 9, "motion_label": "turn", "validity_tags": ["a"], "quality_tags": ["b"], "anomaly_reasons": ["c"], "confidence": 0.5, "run_id": "q"}
    durations = spark.createDataFrame([("r", 9)], "recording_id string, duration_ns long")
    scan = lambda *changes: control.scenario_windows(spark.createDataFrame([row | c for c in changes]), durations, "s", "v")
    assert scan({}).count() == 1
    for bad in ([{"source_revision": "t"}], [{"recording_id": "z"}], [{"window_end_offset_ns": 10}], [{"window_end_offset_ns": 0}], [{"confidence": 1.5}], [{"confidence": float("nan")}], [{"validity_tags": ["a", "a"]}], [{"run_id": "a/b"}], [{}, {}]):
        with pytest.raises(ValueError):
            scan(*bad)


def test_configuration(spark):
    assert config.exact_nanoseconds("0.1", 1_000_000_000) == 100_000_000
    for bad in ("0.0000000001", "nan", "inf"):
        with pytest.raises(ValueError):
            config.exact_nanoseconds(bad, 1_000_000_000)
    rules = config.scenario_rules(2, "weather/rain")
    assert [r[0] for r in rules][-1] == "Annotation Category" and len(rules) == 7
    df = spark.createDataFrame([("t1", "d", ["moving", "straight"], []), ("t2", "d", ["moving"], ["weather/rain"])], "token string, source string, tags array<string>, labels array<string>")
    chosen, _ = selection.select_quotas(df, ["token", "source"], [(n, q, policy.matches(f)) for n, q, f in rules], 1, F.lit('"d"'))
    assert rows(chosen, "token", "rule_name") == [("t1", "Straight"), ("t2", "Annotation Category")]
    assert config.extraction_hash({"a": 1, "b": 2}, ["a"]) == config.extraction_hash({"a": 1, "b": 3}, ["a"]) != config.extraction_hash({"a": 2}, ["a"])
    people = spark.createDataFrame([(i, f"n{i}") for i in range(50)], "id long, name string")
    want = hashlib.sha256(canonical_json([{"id": i, "name": f"n{i}"} for i in range(50)]).encode()).hexdigest()
    assert config.candidate_fingerprint(people.repartition(7), ["id"]) == want
    assert json.loads(config.config_schema({"a": str, "b": bool}, "t"))["properties"]["b"] == {"type": ["boolean", "null"]}


def test_credentials_are_found_by_name_and_by_shape():
    good = {"paths": {"work_dir": "bearer " + "x" * 40}, "keys": ["k"], "tokenizer": "t", "url": "https://h/p?page=2", "n": 3, "text": "bearer short", "monkey": 1}
    assert config.credential_findings(good, paths=["config.paths.work_dir"]) == []
    bad = {
        "api_key": 1, "a": {"DB-Password": "x", "list": [{"my.secret": None}]}, "b": "https://h/p?sig=abc", "c": "Bearer " + "a" * 32 + "==", "d": "eyJhbGciOi.eyJzdWIiOi.c2lnbmF0", "e": "sk-" + "z" * 20, "f": "x;AccountKey=1", "g": "https://h/?sig=",
    }
    assert config.credential_findings(bad) == ["config.api_key", "config.a.DB-Password", "config.a.list[0].my.secret", "config.b", "config.c", "config.d", "config.e", "config.f"]


def test_published_view_accessors(spark):
    d = Dataset({
        "sample_data": spark.createDataFrame([("d1", "p1")], "token string, ego_pose_token string"), "ego_pose": spark.createDataFrame([("p1", 2.0)], "token string, x double"),
        "annotation_scenes": spark.createDataFrame([("s", "g", ["a", "b"], "w")], "scene_token string, source_digest string, annotation_refs array<string>, annotation_window_ref string"),
        "annotation_records": spark.createDataFrame([("a", "g"), ("b", "g")], "token string, source_digest string"), "annotation_matches": spark.createDataFrame([("a", "g"), ("b", "g")], "annotation_token string, source_digest string"),
        "annotation_windows": spark.createDataFrame([("w", "g", ["a", "b"])], "token string, source_digest string, annotation_tokens array<string>"),
    })
    d.check_keys()
    assert d.ego_pose("d1")["x"] == 2.0 and d.annotation("matches", "b")["source_digest"] == "g" and d.annotation("records").count() == 2
    evidence, found = d.scene_evidence()
    assert tuple(evidence.first()) == ("s", "g", "w", 2, 2) and found.count() == 0
    rig = {"calibrated_sensor": spark.createDataFrame([("c", "s"), ("d", "s")], "token string, sensor_token string"), "sensor": spark.createDataFrame([("s", "A")], "token string, channel string")}
    two = [("1", "x", "c"), ("2", "y", "c")]
    Dataset(rig | {"sample_data": spark.createDataFrame(two, "token string, sample_token string, calibrated_sensor_token string")}).check_channels()
    with pytest.raises(ValueError, match="one sample and channel"):
        Dataset(rig | {"sample_data": spark.createDataFrame([*two, ("3", "x", "d")], "token string, sample_token string, calibrated_sensor_token string")}).check_channels()
    with pytest.raises(ValueError, match="tokens of ego_pose"):
        Dataset({"ego_pose": spark.createDataFrame([("p",), ("p",)], "token string")}).check_keys()
