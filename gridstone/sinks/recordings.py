"""MCAP containers from rows: one file's bytes a recording."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Mapping

import pandas as pd
from pyspark.sql import DataFrame

from ..sources.recordings import CHANNEL, CHUNK, FOOTER, MAGIC, MESSAGE, SCHEMA

HEADER, DATA_END = 0x01, 0x0F


def _text(s: str) -> bytes:
    raw = s.encode()
    return struct.pack("<I", len(raw)) + raw


def _record(kind: int, body: bytes) -> bytes:
    return struct.pack("<BQ", kind, len(body)) + body


def container(topics: Mapping[str, tuple[str, bytes]], messages: Iterable[tuple[str, int, int, bytes]], encoding: str = "protobuf", chunk_bytes: int = 1 << 20) -> bytes:
    """A file of messages (topic, sequence, time, data), in plain chunks.

    topics: each topic's schema name and serialized descriptors."""
    out = [MAGIC, _record(HEADER, _text("") + _text(""))]
    number = {}
    for i, (topic, (name, data)) in enumerate(topics.items(), 1):
        number[topic] = i
        out.append(_record(SCHEMA, struct.pack("<H", i) + _text(name) + _text(encoding) + struct.pack("<I", len(data)) + data))
        out.append(_record(CHANNEL, struct.pack("<HH", i, i) + _text(topic) + _text(encoding) + struct.pack("<I", 0)))
    held: list[bytes] = []
    times: list[int] = []
    size = 0

    def chunk() -> None:
        inner = b"".join(held)
        if inner:
            out.append(_record(CHUNK, struct.pack("<QQQI", min(times), max(times), len(inner), zlib.crc32(inner)) + _text("") + struct.pack("<Q", len(inner)) + inner))
        held.clear()
        times.clear()

    for topic, sequence, time, data in messages:
        held.append(_record(MESSAGE, struct.pack("<HIQQ", number[topic], sequence, time, time) + data))
        times.append(time)
        size += len(held[-1])
        if size > chunk_bytes:
            chunk()
            size = 0
    chunk()
    out += [_record(DATA_END, struct.pack("<I", 0)), _record(FOOTER, struct.pack("<QQI", 0, 0, 0)), MAGIC]
    return b"".join(out)


def containers(rows: DataFrame, key: str, schemas: Mapping[str, tuple[str, bytes]]) -> DataFrame:
    """key and content: the file of each recording's rows (topic, sequence,
    time, data), in order of sequence.  A file is one task's, as it is when read."""
    kind = rows.schema[key].dataType.simpleString()

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("sequence")
        messages = zip(pdf["topic"], pdf["sequence"].astype(int), pdf["time"].astype(int), pdf["data"], strict=True)
        return pd.DataFrame({key: [pdf[key].iloc[0]], "content": [container(schemas, messages)]})

    return rows.select(key, "topic", "sequence", "time", "data").groupBy(key).applyInPandas(one, f"`{key}` {kind}, content binary")
