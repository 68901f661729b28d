"""Manifests, annotations and control tables: fail-closed scans of text and Parquet."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import repo_recording_path, safe_relative_path

#: Budgets of one file, fixed values.
MOST_BYTES, MOST_LINE_BYTES, MOST_LABEL_LINE_BYTES, MOST_RECORDS = 64 << 20, 64 << 10, 256 << 10, 250_000
MANIFEST = {"repo_path": str, "source_size": int, "sha256": str}
ANNOTATION = {"repo_path": str, "timestamp_ns": int, "labels": list}


def read_strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet whose schema is exactly this one, names, types and order."""
    df = spark.read.parquet(path)
    got, want = [(f.name, f.dataType) for f in df.schema], [(f.name, f.dataType) for f in schema]
    if got != want:
        raise ValueError(f"schema of {path} is {got}, not {want}")
    return df


def schema_digest(df: DataFrame) -> str:
    """SHA-256 over name, type and nullability of each column."""
    from ..functions.identity import canonical_hash

    return canonical_hash([[f.name, f.dataType.simpleString(), f.nullable] for f in df.schema])


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """line_number (from 1) and value of one text file, within its budgets.

    A file is at most 64 MiB, so one task reads it whole and counts.
    """
    files = spark.read.format("binaryFile").load(path)
    big = files.where(F.col("length") > MOST_BYTES).select("path").limit(1).collect()
    if big:
        raise ValueError(f"{big[0][0]} is larger than {MOST_BYTES} bytes")
    lines = files.select(F.posexplode(F.split(F.decode("content", "utf-8"), r"\r?\n")).alias("pos", "value"))
    return lines.select((F.col("pos") + 1).cast("long").alias("line_number"), "value")


def _pairs(pairs: list[tuple[str, object]]) -> dict:
    out = dict(pairs)
    if len(out) != len(pairs):
        raise ValueError("duplicate key")
    return out


def _constant(name: str):
    raise ValueError(f"{name} is not JSON")


def strict_json_lines(lines: DataFrame, fields: dict[str, type], line_bytes: int = MOST_LINE_BYTES, comments: bool = True, closed: bool = True) -> DataFrame:
    """line_number, value (canonical JSON, null on error) and error of each
    line that is neither blank nor (with ``comments``) begins with #.

    A line is one object with these fields and types.  Where it is ``closed``
    it has no others, and a key given twice is an error, which from_json would
    pass over in silence.
    """

    def parse(text: str) -> tuple[str | None, str | None]:
        try:
            if len(text.encode()) > line_bytes:
                raise ValueError("line too long")
            got = json.loads(text, object_pairs_hook=_pairs, parse_constant=_constant) if closed else json.loads(text)
            if not isinstance(got, dict) or not set(fields) <= set(got) or closed and set(got) != set(fields):
                raise ValueError("fields must be " + ", ".join(sorted(fields)))
            for name, kind in fields.items():
                if not isinstance(got[name], kind) or isinstance(got[name], bool):
                    raise ValueError(f"{name} must be {kind.__name__}")
            return json.dumps(got, sort_keys=True, separators=(",", ":"), ensure_ascii=False), None
        except ValueError as e:
            return None, str(e)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [parse(t) for t in pdf["value"]]
            yield pd.DataFrame({"line_number": pdf["line_number"], "value": [g[0] for g in got], "error": [g[1] for g in got]})

    wanted = F.trim("value") != ""
    if comments:
        wanted = wanted & ~F.ltrim("value").startswith("#")
    return lines.where(wanted).mapInPandas(run, "line_number long, value string, error string")


def _checked(parsed: DataFrame, duplicate: Sequence[str]) -> DataFrame:
    from ..operators.labels import require, require_unique

    require(parsed, F.col("error").isNull(), "malformed lines")
    require(parsed.agg(F.count(F.lit(1)).alias("n")), F.col("n") <= MOST_RECORDS, "too many records")
    require_unique(parsed, duplicate, "record")
    return parsed


def parse_manifest(lines: DataFrame) -> DataFrame:
    """line_number, repo_path, source_size, sha256; any fault raises.

    Further fields are allowed and passed over; a path is one of a recording;
    sizes are positive; a manifest has a row at least.
    """
    from ..operators.labels import require

    read = strict_json_lines(lines, MANIFEST, closed=False)
    rows = read.select("line_number", F.from_json("value", "repo_path string, source_size long, sha256 string").alias("v"), "error").select("line_number", "v.*", "error")
    rows = _checked(rows, ["repo_path"])
    require(rows.agg(F.count(F.lit(1)).alias("n")), F.col("n") > 0, "no recordings")
    require(rows, repo_recording_path(F.col("repo_path")) & (F.col("source_size") > 0) & F.col("sha256").rlike("^[0-9a-f]{64}$"), "bad manifest rows")
    return rows.drop("error")


def parse_annotations(lines: DataFrame) -> DataFrame:
    """line_number, repo_path, timestamp_ns, labels; any fault raises."""
    rows = strict_json_lines(lines, ANNOTATION, MOST_LABEL_LINE_BYTES).select("line_number", F.from_json("value", "repo_path string, timestamp_ns long, labels array<string>").alias("v"), "error").select("line_number", "v.*", "error")
    from ..operators.labels import require

    rows = _checked(rows, ["repo_path", "timestamp_ns", "labels"])
    labels = F.col("labels")
    require(rows, safe_relative_path(F.col("repo_path")) & (F.col("timestamp_ns") >= 0) & (F.size(labels) > 0) & (F.size(F.array_distinct(labels)) == F.size(labels)) & F.forall(labels, lambda x: F.trim(x) != ""), "bad annotation rows")
    return rows.drop("error")


def select_recordings(catalog: DataFrame, ids: Sequence[str] | None, splits: Sequence[str] | None, key: str = "recording_id", split: str = "split") -> DataFrame:
    """The catalog's rows of these ids and splits; an id that isn't there raises."""
    out = catalog
    if ids is not None:
        spark = catalog.sparkSession
        asked = spark.createDataFrame([(i,) for i in ids], f"`{key}` {catalog.schema[key].dataType.simpleString()}")
        gone = [r[0] for r in asked.join(catalog, key, "left_anti").limit(5).collect()]
        if gone:
            raise ValueError(f"not in the catalog: {gone}")
        out = out.join(F.broadcast(asked), key, "left_semi") if len(ids) <= 100_000 else out.join(asked, key, "left_semi")
    return out if splits is None else out.where(F.col(split).isin(list(splits)))


def unpivot_artifacts(catalog: DataFrame, key: str, maps: dict[str, str]) -> DataFrame:
    """key, name and one column a map: struct or map columns keyed alike."""
    as_map = lambda c: F.from_json(F.to_json(c), "map<string,string>")
    first = next(iter(maps.values()))
    rows = catalog.select(key, *(as_map(F.col(c)).alias(n) for n, c in maps.items()), F.explode(F.map_keys(as_map(F.col(first)))).alias("name"))
    return rows.select(key, "name", *(F.element_at(n, F.col("name")).alias(n) for n in maps))


def verify_artifacts(artifacts: DataFrame, index: DataFrame, key: Sequence[str]) -> DataFrame:
    """Artifacts without an equal row (path, size, digest) in the index."""
    return artifacts.join(index, list(key), "left_anti")


def agreement(tables: dict[str, DataFrame], key: Sequence[str], value: str) -> DataFrame:
    """key, a value a table, and agrees: present everywhere and all the same."""
    out: DataFrame | None = None
    for name, df in tables.items():
        own = df.select(*key, F.col(value).alias(name), F.lit(True).alias(f"__{name}"))
        out = own if out is None else out.join(own, list(key), "full_outer")
    names = list(tables)
    same: Column = F.lit(True)
    for n in names:
        same = same & F.coalesce(F.col(f"__{n}"), F.lit(False)) & F.col(n).eqNullSafe(F.col(names[0]))
    return out.select(*key, *names, same.alias("agrees"))


def repo_video_path(path: Column) -> Column:
    """hf://...@revision/data/x and videos/x as data/videos/x.mp4 paths; else null."""
    bare = F.regexp_replace(F.regexp_replace(path, r"^hf://[^@]+@[0-9a-f]+/", ""), r"^(data/)?videos/", "data/videos/")
    return F.when(bare.rlike(r"^data/videos/[^/].*\.mp4$"), bare)


def partition_value(path: Column, name: str) -> Column:
    """The value of a name=value path segment."""
    return F.nullif(F.regexp_extract(path, rf"(?:^|/){name}=([^/]+)(?:/|$)", 1), F.lit(""))
