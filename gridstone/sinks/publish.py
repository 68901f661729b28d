"""Sinks: canonical JSON, content manifests, rejection manifests, publication."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import canonical_hash, canonical_json


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """One small file through Hadoop's file systems."""
    fs, p = _fs(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.format("binaryFile").load(path).select(F.decode("content", "utf-8")).first()[0]


def write_json_table(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """A JSON array of objects in ``order``, keys sorted, one final line feed.

    For the small official tables; rows stream through the driver one
    partition at a time.
    """
    rows = (r.asDict(recursive=True) for r in df.orderBy(*order).toLocalIterator())
    write_text(df.sparkSession, path, "[" + ",".join(map(canonical_json, rows)) + "]\n")


def write_lines(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Canonical JSON lines, range-partitioned and sorted: any size."""
    df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value"), *(F.col(c).alias(f"__{i}") for i, c in enumerate(order))).orderBy(*(f"__{i}" for i in range(len(order)))).select("value").write.mode("errorifexists").text(path)


def content_manifest(spark: SparkSession, root: str) -> DataFrame:
    """path (below root), size, sha256 of every file."""
    base = _fs(spark, root)[1].toString().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    below = F.regexp_extract("path", "^[a-z0-9]*:?/*(.*)$", 1)
    bare = base.split(":", 1)[-1].lstrip("/") if ":" in base else base.lstrip("/")
    return files.select(F.regexp_replace(F.substring(below, len(bare) + 1, 1 << 30), "^/+", "").alias("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def manifest_root(manifest: DataFrame) -> str:
    """One hash over the list of files in order."""
    return canonical_hash([[r["path"], r["size"], r["sha256"]] for r in manifest.orderBy("path").toLocalIterator()])


def manifest_differences(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """path and fault: unlisted, missing or changed."""
    a = files.select("path", F.struct("size", "sha256").alias("f"))
    b = manifest.select("path", F.struct("size", "sha256").alias("m"))
    fault = F.when(F.col("m").isNull(), "unlisted").when(F.col("f").isNull(), "missing").when(F.col("f") != F.col("m"), "changed")
    return a.join(b, "path", "full_outer").select("path", fault.alias("fault")).where("fault is not null")


def failures(stages: dict[str, DataFrame], key: str) -> DataFrame:
    """key, stage, error: the failures of all stages as one table."""
    out: DataFrame | None = None
    for name, df in stages.items():
        own = df.select(key, F.lit(name).alias("stage"), "error")
        out = own if out is None else out.unionByName(own)
    return out


def merge_rejections(new: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """The set of rejection rows of both."""
    return new.distinct() if old is None else new.unionByName(old).distinct()


def publish(spark: SparkSession, staging: str, target: str, manifest: DataFrame) -> None:
    """Rename a staged folder into place once its files equal the manifest.

    Never over something that is there; the rename is the only step seen."""
    if content_faults := manifest_differences(content_manifest(spark, staging), manifest).limit(3).collect():
        raise ValueError(f"staged files differ from the manifest: {content_faults}")
    fs, to = _fs(spark, target)
    if fs.exists(to):
        raise FileExistsError(target)
    if not fs.rename(_fs(spark, staging)[1], to):
        raise OSError(f"could not rename {staging} to {target}")


def write_export(tables: dict[str, DataFrame], root: str) -> None:
    """Each table as a JSON array sorted by token, below ``root``."""
    for name in sorted(tables):
        write_json_table(tables[name], f"{root.rstrip('/')}/{name}.json", ["token"])


def write_split(assignments: DataFrame, path: str, seed: int, fraction: str, order: Sequence[str]) -> None:
    """The split of selected scenes as one JSON object with its parameters."""
    rows = [r.asDict(recursive=True) for r in assignments.orderBy(*order).toLocalIterator()]  # selected scenes: bounded by the quotas
    write_text(assignments.sparkSession, path, canonical_json({"assignments": rows, "fraction": fraction, "seed": seed}) + "\n")


def finalize(spark: SparkSession, staging: str, target: str, findings: DataFrame, report: str = "validation.json") -> str:
    """Publish a staged dataset: no findings, a report, a manifest of its files
    that they still equal, and one rename.  Returns the manifest's hash."""
    some = findings.limit(5).collect()
    if some:
        raise ValueError(f"findings: {[tuple(r) for r in some]}")
    write_text(spark, f"{staging.rstrip('/')}/{report}", canonical_json({"findings": [], "valid": True}) + "\n")
    manifest = content_manifest(spark, staging)
    rows = [(r["path"], r["size"], r["sha256"]) for r in manifest.orderBy("path").collect()]  # one row a file
    fixed = spark.createDataFrame(rows, "path string, size long, sha256 string")
    publish(spark, staging, target, fixed)
    return manifest_root(fixed)


def recording_gate(outcomes: DataFrame, key: str, status: str) -> tuple[bool, DataFrame]:
    """(may it be published, the recordings that failed)."""
    failed = outcomes.where(F.col(status) != "ok").select(key, status)
    return not failed.limit(1).count(), failed


def load_config(text: str, fields: Mapping[str, object]) -> dict:
    """A JSON object with these fields only; missing ones are None.

    A field is a type, a mapping (a section of fields, empty if missing), or a
    list of one of these (a list of such).  Keys given twice, numbers that are
    not finite and booleans in place of numbers are errors.
    """

    def pairs(items: list[tuple[str, object]]) -> dict:
        out = dict(items)
        if len(out) != len(items):
            raise ValueError("duplicate key")
        return out

    def constant(name: str) -> None:
        raise ValueError(f"{name} is not JSON")

    def read(value: object, kind: object, at: str) -> object:
        if isinstance(kind, Mapping):
            value = {} if value is None else value
            if not isinstance(value, dict) or set(value) - set(kind):
                raise ValueError(f"unknown fields in {at}: {sorted(set(value) - set(kind)) if isinstance(value, dict) else value!r}")
            return {n: read(value.get(n), k, f"{at}.{n}") for n, k in kind.items()}
        if value is None:
            return None
        if isinstance(kind, list):
            if not isinstance(value, list):
                raise ValueError(f"{at} must be a list")
            return [read(v, kind[0], f"{at}[{i}]") for i, v in enumerate(value)]
        whole = int if kind is float else kind  # a number without a point is one too
        if not isinstance(value, (kind, whole)) or isinstance(value, bool) and kind is not bool:
            raise ValueError(f"{at} must be {kind.__name__}")
        return value

    return read(json.loads(text, object_pairs_hook=pairs, parse_constant=constant), fields, "config")
