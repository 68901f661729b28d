"""Recording files: acquired catalogs with their faults, MCAP containers as
rows, dynamic protobuf messages, and a cache of extracted tables.

MCAP is read by its published layout; chunks may be plain or zstd (lz4 needs
its library).  Protobuf messages need ``google.protobuf`` and raise without it.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from graphlib import CycleError, TopologicalSorter
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import canonical_hash, git_blob_id
from ..operators.labels import require

#: Magic bytes and record kinds of the container, fixed values.
MAGIC = b"\x89MCAP0\r\n"
FOOTER, SCHEMA, CHANNEL, MESSAGE, CHUNK = 0x02, 0x03, 0x04, 0x05, 0x06
_INDEX = "schema_name string, topic string, encoding string, sequence long, log_time long, publish_time long, size long"


class RecordingError(ValueError):
    """A file that isn't what it should be."""


def prepared(catalog: DataFrame, files: DataFrame, path: str = "path", size: str = "size", digest: str = "sha256") -> DataFrame:
    """``catalog`` with ``error``: null where its file is there with its size and
    its digest (SHA-256, or git's blob id where that has 40 digits), else why
    not.  files: path, length and content, as ``binaryFile`` reads them.

    A fault is a row's own: the other recordings go on.
    """
    seen = files.select(F.col("path").alias("__p"), F.col("length").cast("long").alias("__n"), F.sha2("content", 256).alias("__h"), git_blob_id(F.col("content")).alias("__g"))
    both = catalog.join(seen, F.col(path) == F.col("__p"), "left")
    same = F.when(F.length(digest) == 40, F.col("__g") == F.col(digest)).otherwise(F.col("__h") == F.col(digest))
    error = F.when(F.col("__p").isNull(), "file_missing").when(F.col("__n") != F.col(size), "size_differs").when(~F.coalesce(same, F.lit(False)), "digest_differs")
    return both.withColumn("error", error).drop("__p", "__n", "__h", "__g")


def prepare_source(kind: str, catalog: DataFrame, files: DataFrame, layouts: Mapping[str, str]) -> DataFrame:
    """:func:`prepared` for one generation of configuration: ``layouts`` names,
    by kind, the catalog column that holds a recording's path."""
    if kind not in layouts:
        raise ValueError(f"unknown source {kind}; known are {sorted(layouts)}")
    return prepared(catalog, files, layouts[kind])


def _text(data: memoryview, at: int) -> tuple[str, int]:
    (n,) = struct.unpack_from("<I", data, at)
    return bytes(data[at + 4 : at + 4 + n]).decode(), at + 4 + n


def _records(data: memoryview, at: int) -> Iterator[tuple[int, memoryview]]:
    while at < len(data):
        if at + 9 > len(data):
            raise RecordingError("truncated record")
        kind, n = struct.unpack_from("<BQ", data, at)
        at += 9
        if n > len(data) - at:
            raise RecordingError("truncated record")
        yield kind, data[at : at + n]
        at += n
        if kind == FOOTER:
            return


def _chunk(body: memoryview) -> memoryview:
    _, _, size, crc = struct.unpack_from("<QQQI", body, 0)
    how, at = _text(body, 28)
    (n,) = struct.unpack_from("<Q", body, at)
    raw = bytes(body[at + 8 : at + 8 + n])
    if how == "zstd":
        import zstandard

        raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=size)
    elif how:
        raise RecordingError(f"chunks compressed by {how} can't be read")
    if len(raw) != size or crc and zlib.crc32(raw) != crc:
        raise RecordingError("a chunk's size or checksum differs")
    return memoryview(raw)


class Container:
    """Messages of one file in order of log time, then of file order."""

    def __init__(self, content: bytes, topics: Sequence[str] | None = None):
        data = memoryview(content)
        if bytes(data[: len(MAGIC)]) != MAGIC:
            raise RecordingError("no MCAP file")
        self.schemas: dict[int, tuple[str, str, bytes]] = {0: ("", "", b"")}
        self.channels: dict[int, tuple[int, str, str]] = {}
        self.messages: list[tuple[int, int, int, int, memoryview]] = []
        ended = False
        for kind, body in _records(data, len(MAGIC)):
            ended = kind == FOOTER
            for inner, part in _records(_chunk(body), 0) if kind == CHUNK else ((kind, body),):
                self._take(inner, part, topics)
        if not ended:
            raise RecordingError("the file has no end")
        self.messages.sort(key=lambda m: m[0])  # stable

    def _take(self, kind: int, body: memoryview, topics: Sequence[str] | None) -> None:
        if kind == SCHEMA:
            (number,) = struct.unpack_from("<H", body, 0)
            name, at = _text(body, 2)
            encoding, at = _text(body, at)
            (n,) = struct.unpack_from("<I", body, at)
            self._once(self.schemas, number, (name, encoding, bytes(body[at + 4 : at + 4 + n])), "schema")
        elif kind == CHANNEL:
            number, schema = struct.unpack_from("<HH", body, 0)
            topic, at = _text(body, 4)
            encoding, _ = _text(body, at)
            if schema not in self.schemas:
                raise RecordingError("a channel's schema is not there")
            self._once(self.channels, number, (schema, topic, encoding), "channel")
        elif kind == MESSAGE:
            channel, sequence, log_time, publish_time = struct.unpack_from("<HIQQ", body, 0)
            if channel not in self.channels:
                raise RecordingError("a message's channel is not there")
            if topics is None or self.channels[channel][1] in topics:
                self.messages.append((log_time, publish_time, channel, sequence, body[22:]))

    @staticmethod
    def _once(table: dict, number: int, value: tuple, what: str) -> None:
        if table.setdefault(number, value) != value:
            raise RecordingError(f"{what} {number} is given twice and differs")


def read_messages(files: DataFrame, topics: Sequence[str] | None = None, payload: bool = False, key: str = "path", content: str = "content") -> DataFrame:
    """key and, a row a message, schema_name, topic, encoding, sequence,
    log_time, publish_time, size and position (from 0, by log time); with
    ``payload`` also schema_data and data; error is null.

    A file that can't be read is one row with ``error`` and nothing else.  The
    index, without payloads, is the first pass; a payload pass must agree with
    it (:func:`require_same_messages`).  A file is one task's.
    """
    kind = files.schema[key].dataType.simpleString()
    names = [key, *(c.split()[0] for c in _INDEX.split(", ")), "position", *(["schema_data", "data"] if payload else []), "error"]
    schema = f"`{key}` {kind}, {_INDEX}, position long, " + ("schema_data binary, data binary, " if payload else "") + "error string"
    most = 1024

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.string(), pa.string(), *[pa.int64()] * 5, *([pa.binary(), pa.binary()] if payload else []), pa.string()]

        def rows(of: pa.Scalar, found: list[tuple]) -> pa.RecordBatch:
            keys = pa.array([of.as_py()] * len(found), of.type)
            return pa.RecordBatch.from_arrays([keys, *(pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True))], names)

        for batch in batches:
            for i in range(batch.num_rows):
                of, raw = batch.column(0)[i], batch.column(1)[i].as_py()
                try:
                    box = Container(raw or b"", topics)
                except (RecordingError, struct.error, UnicodeDecodeError) as e:
                    yield rows(of, [(*[None] * (len(types) - 1), str(e))])
                    continue
                found = []
                for place, (log, publish, channel, sequence, body) in enumerate(box.messages):
                    schema_id, topic, encoding = box.channels[channel]
                    name, _, data = box.schemas[schema_id]
                    found.append((name, topic, encoding, sequence, log, publish, len(body), place, *((data, bytes(body)) if payload else ()), None))
                    if len(found) == most:
                        yield rows(of, found)
                        found = []
                if found:
                    yield rows(of, found)

    return files.select(key, content).mapInArrow(run, schema)


def require_same_messages(index: DataFrame, payloads: DataFrame, key: str) -> None:
    """Raise unless both passes saw the same messages."""
    columns = [key, *(c.split()[0] for c in _INDEX.split(", ")), "position"]
    a, b = index.where("error is null").select(columns), payloads.where("error is null").select(columns)
    differ = a.exceptAll(b).unionAll(b.exceptAll(a))
    require(differ.limit(5), F.lit(False), "the passes over a recording differ")


def message_classes(descriptor_set: bytes) -> dict[str, type]:
    """Message classes by full name of a serialized FileDescriptorSet, in
    whatever order its files stand."""
    try:
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory, timestamp_pb2
        from google.protobuf.message import DecodeError
    except ImportError as e:  # pragma: no cover
        raise RecordingError("protobuf messages need google.protobuf") from e
    found = descriptor_pb2.FileDescriptorSet()
    try:
        found.ParseFromString(descriptor_set)
    except DecodeError as e:
        raise RecordingError("no FileDescriptorSet") from e
    if not found.file:
        raise RecordingError("the FileDescriptorSet is empty")
    pool = descriptor_pool.DescriptorPool()
    known = timestamp_pb2.DESCRIPTOR
    pool.AddSerializedFile(known.serialized_pb)
    files = {f.name: f for f in found.file if f.name != known.name}
    if len(files) != sum(f.name != known.name for f in found.file):
        raise RecordingError("a descriptor file is given twice")
    try:
        order = list(TopologicalSorter({n: [d for d in f.dependency if d in files] for n, f in files.items()}).static_order())
    except CycleError as e:
        raise RecordingError("descriptor files depend on each other") from e
    out: dict[str, type] = {}
    for name in order:
        try:
            pool.Add(files[name])
        except (TypeError, ValueError) as e:
            raise RecordingError(f"descriptor file {name} is malformed") from e
    todo = [(f.package, m) for f in found.file for m in f.message_type]
    while todo:
        scope, m = todo.pop()
        full = f"{scope}.{m.name}" if scope else m.name
        out[full] = message_factory.GetMessageClass(pool.FindMessageTypeByName(full))
        todo += [(full, n) for n in m.nested_type if not n.options.map_entry]
    return out


def require_fields(message: type, specs: Sequence[tuple[str, int, str, bool]]) -> None:
    """Raise unless the message has fields (name, number, type, repeated).

    type: a scalar type's name in lower case, or a message's full name.
    """
    from google.protobuf.descriptor import FieldDescriptor

    scalars = {getattr(FieldDescriptor, n): n[5:].lower() for n in dir(FieldDescriptor) if n.startswith("TYPE_")}
    for name, number, kind, repeated in specs:
        field = message.DESCRIPTOR.fields_by_name.get(name)
        if field is None:
            raise RecordingError(f"{message.DESCRIPTOR.full_name} lacks {name}")
        own = field.message_type.full_name if field.message_type is not None else scalars[field.type]
        many = field.is_repeated if hasattr(field, "is_repeated") else field.label == FieldDescriptor.LABEL_REPEATED
        if field.number != number or own != kind or bool(many) is not repeated:
            raise RecordingError(f"{name} has another number, type or cardinality")


def decode_messages(payloads: DataFrame, name: str, specs: Sequence[tuple[str, int, str, bool]] = (), key: str = "path") -> DataFrame:
    """key, position, log_time, value (JSON text of the message ``name``, in its
    own field names, 64-bit integers as text and bytes in base64) and error.

    The schema is checked against ``specs`` once a distinct descriptor.
    """
    kind = payloads.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from google.protobuf.json_format import MessageToDict
        from google.protobuf.message import DecodeError

        made: dict[bytes, type] = {}
        for batch in batches:
            values, errors = [], []
            for schema, data in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                try:
                    if schema not in made:
                        classes = message_classes(schema)
                        if name not in classes:
                            raise RecordingError(f"no message {name}")
                        require_fields(classes[name], specs)
                        made[schema] = classes[name]
                    got = made[schema].FromString(data)
                    values.append(json.dumps(MessageToDict(got, preserving_proto_field_name=True), sort_keys=True, ensure_ascii=False))
                    errors.append(None)
                except (RecordingError, DecodeError) as e:
                    values.append(None)
                    errors.append(str(e) or "malformed message")
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(values, pa.string()), pa.array(errors, pa.string())], [key, "position", "log_time", "value", "error"])

    wanted = payloads.where((F.col("error").isNull()) & (F.col("schema_name") == name))
    return wanted.select(key, "position", "log_time", "schema_data", "data").mapInArrow(run, f"`{key}` {kind}, position long, log_time long, value string, error string")


def camera_rows(decoded: DataFrame, key: str = "path") -> DataFrame:
    """A row a camera of each decoded batch message: key, position, batch_time,
    camera_index, camera, camera_time, payload (base64).

    The message holds number_of_cameras names and payloads, and as many camera
    timestamps or none; a missing batch time is the log time, a missing camera
    time the batch's.  Anything else raises.
    """
    shape = "number_of_cameras int, rec_timestamp string, name array<string>, data array<string>, camera_timestamp array<string>"
    rows = decoded.where("error is null").withColumn("m", F.from_json("value", shape))
    sizes = (F.size("m.name") == F.col("m.number_of_cameras")) & (F.size("m.data") == F.col("m.number_of_cameras")) & (F.col("m.camera_timestamp").isNull() | (F.size("m.camera_timestamp") == F.col("m.number_of_cameras")))
    require(rows, sizes & (F.size(F.array_distinct("m.name")) == F.size("m.name")), "camera messages whose arrays don't agree")
    rows = rows.withColumn("batch_time", F.coalesce(timestamp_ns(F.col("m.rec_timestamp")), F.col("log_time")))
    out = rows.select(key, "position", "batch_time", "m", F.posexplode("m.name").alias("camera_index", "camera"))
    time = timestamp_ns(F.get("m.camera_timestamp", F.col("camera_index")))
    return out.select(key, "position", "batch_time", "camera_index", "camera", F.coalesce(time, F.col("batch_time")).alias("camera_time"), F.get("m.data", F.col("camera_index")).alias("payload"))


def timestamp_ns(text: Column) -> Column:
    """RFC 3339 text, in UTC and with up to nine decimals, as nanoseconds."""
    whole = F.regexp_extract(text, r"^(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d)(?:\.\d{1,9})?Z$", 1)
    rest = F.rpad(F.regexp_extract(text, r"\.(\d{1,9})Z$", 1), 9, "0").cast("long")
    seconds = F.unix_timestamp(F.to_timestamp_ltz(F.concat(F.nullif(whole, F.lit("")), F.lit("Z")), F.lit("yyyy-MM-dd'T'HH:mm:ssX")))
    return seconds * 1_000_000_000 + rest


def frame_evidence(labels: DataFrame, frames: DataFrame, key: Sequence[str], size: Sequence[str] = ("width", "height")) -> DataFrame:
    """key and fault of labels whose frame isn't there, or has another size."""
    own = frames.select(*key, F.struct(*size).alias("__f"))
    seen = labels.select(*key, F.struct(*size).alias("__l")).join(own, list(key), "left")
    fault = F.when(F.col("__f").isNull(), "frame_missing").when(F.col("__f") != F.col("__l"), "size_differs")
    return seen.select(*key, fault.alias("fault")).where("fault is not null")


def cached(spark: SparkSession, root: str, source_digest: str, config: Mapping[str, Any], make: Callable[[], DataFrame]) -> DataFrame:
    """The table kept below ``root`` for this source and configuration, made and
    written if it isn't there.

    Spark's marker of a finished write stands for a whole one; a table without
    it is written anew.  The schema is kept beside, and must still be its own.
    """
    from ..sinks.publish import read_text, write_text

    path = f"{root.rstrip('/')}/source={source_digest}/config={canonical_hash(dict(config))}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/table/_SUCCESS")
    if not fs.exists(marker):
        made = make()
        made.write.mode("overwrite").parquet(f"{path}/table")
        write_text(spark, f"{path}/schema.json", spark.read.parquet(f"{path}/table").schema.json(), overwrite=True)
    out = spark.read.parquet(f"{path}/table")
    if out.schema.json() != read_text(spark, f"{path}/schema.json"):
        raise RecordingError(f"the cached table at {path} has another schema")
    return out
