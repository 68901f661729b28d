"""Recording files: faults by row, containers, dynamic messages, cache."""

import hashlib
import json
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from gridstone.sources import recordings

from .conftest import rows

zstandard = pytest.importorskip("zstandard")


def text(s):
    return struct.pack("<I", len(s.encode())) + s.encode()


def record(kind, body):
    return struct.pack("<BQ", kind, len(body)) + body


def schema(number, name, data=b""):
    return record(3, struct.pack("<H", number) + text(name) + text("protobuf") + struct.pack("<I", len(data)) + data)


def channel(number, of, topic):
    return record(4, struct.pack("<HH", number, of) + text(topic) + text("protobuf") + struct.pack("<I", 0))


def message(of, sequence, log, data):
    return record(5, struct.pack("<HIQQ", of, sequence, log, log + 1) + data)


def chunk(inner, how=""):
    raw = zstandard.ZstdCompressor().compress(inner) if how == "zstd" else inner
    return record(6, struct.pack("<QQQI", 0, 0, len(inner), zlib.crc32(inner)) + text(how) + struct.pack("<Q", len(raw)) + raw)


def box(*parts):
    return recordings.MAGIC + record(1, text("") + text("")) + b"".join(parts) + record(15, struct.pack("<I", 0)) + record(2, struct.pack("<QQI", 0, 0, 0)) + recordings.MAGIC


def frame(spark, files):
    return spark.createDataFrame([(p, bytearray(c)) for p, c in files.items()], "path string, content binary")


def test_messages_are_read_in_order_of_time(spark):
    rng = random.Random(6)
    head = schema(1, "a.B") + channel(1, 1, "/x") + channel(2, 1, "/y")
    sent = [(rng.choice([1, 2]), i, rng.randint(0, 40), bytes(rng.randbytes(rng.randint(0, 9)))) for i in range(2500)]
    plain = b"".join(message(*m) for m in sent[:1000])
    files = {"f": box(head, plain, chunk(b"".join(message(*m) for m in sent[1000:1700]), "zstd"), chunk(head + b"".join(message(*m) for m in sent[1700:]))), "empty": box(head)}
    got = recordings.read_messages(frame(spark, files), payload=True).orderBy("position").collect()
    want = sorted(sent, key=lambda m: m[2])
    assert [(r["topic"], r["sequence"], r["log_time"], r["publish_time"], bytes(r["data"]), r["size"], r["position"]) for r in got] == [("/x" if c == 1 else "/y", s, t, t + 1, d, len(d), i) for i, (c, s, t, d) in enumerate(want)]
    some = recordings.read_messages(frame(spark, files), ["/y"])
    assert some.count() == sum(m[0] == 2 for m in sent) and "data" not in some.columns
    recordings.require_same_messages(recordings.read_messages(frame(spark, files)), recordings.read_messages(frame(spark, files), payload=True), "path")
    with pytest.raises(ValueError, match="differ"):
        recordings.require_same_messages(some, recordings.read_messages(frame(spark, files), payload=True), "path")


def test_bad_files_are_rows_of_their_own(spark):
    good = box(schema(1, "a"), channel(1, 1, "/x"), message(1, 0, 5, b"z"))
    broken = bytearray(chunk(message(1, 0, 5, b"zz")))
    broken[-1] ^= 1
    files = {
        "good": good, "none": b"", "magic": b"x" + good, "cut": good[:-20], "channel": box(message(1, 0, 5, b"")), "schema": box(channel(1, 7, "/x")), "crc": box(schema(1, "a"), channel(1, 1, "/x"), bytes(broken)),
        "lz4": box(chunk(b"", "lz4")), "twice": box(schema(1, "a"), schema(1, "b")),
    }
    got = {r["path"]: r["error"] for r in recordings.read_messages(frame(spark, files)).collect()}
    assert set(got) == set(files) and [p for p, e in got.items() if e is None] == ["good"]


def descriptor():
    pb = pytest.importorskip("google.protobuf.descriptor_pb2")
    from google.protobuf import timestamp_pb2

    f = pb.FileDescriptorProto(name="cam.proto", package="kit", syntax="proto3", dependency=["part.proto", "google/protobuf/timestamp.proto"])
    m = f.message_type.add(name="Batch")
    kinds = pb.FieldDescriptorProto
    m.field.add(name="number_of_cameras", number=10, type=kinds.TYPE_INT32, label=1)
    m.field.add(name="rec_timestamp", number=2, type=kinds.TYPE_MESSAGE, type_name=".google.protobuf.Timestamp", label=1)
    m.field.add(name="data", number=6, type=kinds.TYPE_BYTES, label=3)
    m.field.add(name="name", number=7, type=kinds.TYPE_STRING, label=3)
    m.field.add(name="camera_timestamp", number=8, type=kinds.TYPE_MESSAGE, type_name=".google.protobuf.Timestamp", label=3)
    m.field.add(name="part", number=9, type=kinds.TYPE_MESSAGE, type_name=".kit.Part", label=1)
    part = pb.FileDescriptorProto(name="part.proto", package="kit", syntax="proto3")
    part.message_type.add(name="Part").nested_type.add(name="Inner")
    stamp = pb.FileDescriptorProto()
    timestamp_pb2.DESCRIPTOR.CopyToProto(stamp)
    return pb.FileDescriptorSet(file=[f, stamp, part]).SerializeToString()


def test_dynamic_messages_become_camera_rows(spark):
    data = descriptor()
    classes = recordings.message_classes(data)
    assert set(classes) == {"kit.Batch", "kit.Part", "kit.Part.Inner", "google.protobuf.Timestamp"}
    specs = [("number_of_cameras", 10, "int32", False), ("data", 6, "bytes", True), ("rec_timestamp", 2, "google.protobuf.Timestamp", False)]
    recordings.require_fields(classes["kit.Batch"], specs)
    for bad in (("number_of_cameras", 11, "int32", False), ("data", 6, "string", True), ("data", 6, "bytes", False), ("gone", 1, "int32", False)):
        with pytest.raises(recordings.RecordingError):
            recordings.require_fields(classes["kit.Batch"], [bad])
    b = classes["kit.Batch"](number_of_cameras=2, name=["l", "r"], data=[b"1", b"2"])
    b.rec_timestamp.seconds, b.rec_timestamp.nanos = 1_700_000_000, 120
    for s in (1, 2):
        b.camera_timestamp.add(seconds=1_700_000_000 + s)
    late = classes["kit.Batch"](number_of_cameras=1, name=["l"], data=[b"3"])
    file = box(schema(1, "kit.Batch", data), channel(1, 1, "/c"), message(1, 0, 7, b.SerializeToString()), message(1, 1, 9, late.SerializeToString()), message(1, 2, 11, b"\xff"))
    decoded = recordings.decode_messages(recordings.read_messages(frame(spark, {"f": file}), payload=True), "kit.Batch", specs)
    assert [r["error"] is None for r in decoded.orderBy("position").collect()] == [True, True, False]
    assert json.loads(decoded.orderBy("position").first()["value"])["name"] == ["l", "r"]
    got = [tuple(r)[1:] for r in recordings.camera_rows(decoded).orderBy("position", "camera_index").collect()]
    base = 1_700_000_000 * 10**9
    assert got == [(0, base + 120, 0, "l", base + 10**9, "MQ=="), (0, base + 120, 1, "r", base + 2 * 10**9, "Mg=="), (1, 9, 0, "l", 9, "Mw==")]
    wrong = classes["kit.Batch"](number_of_cameras=2, name=["l"], data=[b"1"])
    file = box(schema(1, "kit.Batch", data), channel(1, 1, "/c"), message(1, 0, 7, wrong.SerializeToString()))
    with pytest.raises(ValueError, match="don't agree"):
        recordings.camera_rows(recordings.decode_messages(recordings.read_messages(frame(spark, {"f": file}), payload=True), "kit.Batch"))
    for bad in (b"\xff\xff", b""):
        with pytest.raises(recordings.RecordingError):
            recordings.message_classes(bad)


def test_acquired_files_are_judged_one_by_one(spark, tmp_path):
    for name, body in (("a", b"hello\n"), ("b", b"x"), ("c", b"y")):
        (tmp_path / name).write_bytes(body)
    files = spark.read.format("binaryFile").load(f"file://{tmp_path}")
    at = lambda n: f"file:{tmp_path}/{n}"
    catalog = spark.createDataFrame([
        (1, at("a"), 6, hashlib.sha1(b"blob 6\0hello\n").hexdigest()), (2, at("b"), 1, hashlib.sha256(b"x").hexdigest()), (3, at("c"), 1, "0" * 64), (4, at("c"), 2, hashlib.sha256(b"y").hexdigest()), (5, at("d"), 1, "0" * 64),
    ], "id int, path string, size long, sha256 string")
    got = recordings.prepare_source("decoded", catalog, files, {"decoded": "path"})
    assert rows(got, "id", "error") == [(1, None), (2, None), (3, "digest_differs"), (4, "size_differs"), (5, "file_missing")]
    with pytest.raises(ValueError, match="unknown source"):
        recordings.prepare_source("other", catalog, files, {"decoded": "path"})


def test_frames_and_cache(spark, tmp_path):
    labels = spark.createDataFrame([(1, 4, 4), (2, 4, 4), (3, 4, 4)], "f int, width int, height int")
    frames = spark.createDataFrame([(1, 4, 4), (2, 8, 4)], "f int, width int, height int")
    assert rows(recordings.frame_evidence(labels, frames, ["f"])) == [(2, "size_differs"), (3, "frame_missing")]
    made = []

    def make():
        made.append(1)
        return spark.range(5).withColumn("x", F.col("id") * 2)

    for config, runs in (({"a": 1}, 1), ({"a": 1}, 1), ({"a": 2}, 2)):
        assert recordings.cached(spark, f"file://{tmp_path}", "d1", config, make).count() == 5 and len(made) == runs
