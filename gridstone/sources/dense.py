"""Tar archives of dense payloads: exact member sets, verified bytes, late selection."""

from __future__ import annotations

import hashlib
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Budgets of one archive and of a batch, fixed values.
MOST_MEMBERS, MOST_MEMBER = 250_000, 256 << 20
BATCH_BYTES, BATCH_ROWS = 16 << 20, 1024


def tar_members(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """shard_path, member_path, payload_bytes, payload_sha256, payload.

    payload is null but for ``wanted`` (shard_path, member_path) members, if
    given.  Links, devices and unsafe names raise.  shard_path is the archive's
    file name; one archive is one task's.
    """
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("shard_path"), "content")
    if wanted is None:
        files = files.withColumn("wanted", F.lit(None).cast("array<string>"))
    else:
        files = files.join(wanted.groupBy("shard_path").agg(F.collect_set("member_path").alias("wanted")), "shard_path", "left").withColumn("wanted", F.coalesce("wanted", F.array().cast("array<string>")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, asked = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                keep = None if asked is None else set(asked)
                rows, held, members = [], 0, 0
                # the archive is read through Arrow's own buffer, and its rows go on in bounded batches
                with tarfile.open(fileobj=pa.BufferReader(batch.column(1)[i].as_buffer())) as tar:
                    for m in tar:
                        members += 1
                        if members > MOST_MEMBERS:
                            raise ValueError(f"{shard} has more than {MOST_MEMBERS} members")
                        if not m.isfile() or m.name.startswith("/") or ".." in m.name.split("/") or m.size > MOST_MEMBER:
                            raise ValueError(f"unsafe member {m.name!r} in {shard}")
                        data = tar.extractfile(m).read()
                        wanted = keep is None or m.name in keep
                        rows.append((shard, m.name, len(data), hashlib.sha256(data).hexdigest(), data if wanted else None))
                        held += len(data) if wanted else 0
                        if held > BATCH_BYTES or len(rows) == BATCH_ROWS:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return files.select("shard_path", "content", "wanted").mapInArrow(run, "shard_path string, member_path string, payload_bytes long, payload_sha256 string, payload binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["shard_path", "member_path", "payload_bytes", "payload_sha256", "payload"])


def member_faults(members: DataFrame, index: DataFrame) -> DataFrame:
    """Members that the index lacks, has twice or describes otherwise, and the reverse."""
    key = ["shard_path", "member_path"]
    a = members.groupBy(*key).agg(F.count(F.lit(1)).alias("have"), F.first("payload_bytes").alias("b"), F.first("payload_sha256").alias("h"))
    b = index.groupBy(*key).agg(F.count(F.lit(1)).alias("listed"), F.first("payload_bytes").alias("ib"), F.first("payload_sha256").alias("ih"))
    fault = (
        F.when(F.col("listed").isNull(), "not_indexed").when(F.col("have").isNull(), "missing")
        .when((F.col("have") > 1) | (F.col("listed") > 1), "duplicate").when((F.col("b") != F.col("ib")) | (F.col("h") != F.col("ih")), "differs")
    )
    return a.join(b, key, "full_outer").withColumn("fault", fault).where("fault is not null").select(*key, "fault")
