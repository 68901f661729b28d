"""Validation as assertion queries: each returns findings, no rows if all is well."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FINDING = "family string, code string, subject string"
#: Words of key names, and a date in a value, that must not be published: fixed values.
FORBIDDEN_WORDS = ("date", "epoch", "timestamp", "latitude", "longitude", "lat", "lon", "coordinate", "geometry", "endpoint", "osm", "road_name", "gps_week", "gps_day", "day_of_year")
ISO_DATE = r"(^|[^0-9])[0-9]{4}-[0-9]{2}-[0-9]{2}([^0-9]|$)"
#: What a published text should not hold beside: an own check.
SECRET = r"(?i)(password|passwd|secret|token|api[_-]?key|private[_-]?key)\s*[=:]\s*\S{6,}"
#: Words that tell absolute time, a list of its own beside FORBIDDEN_WORDS.
ABSOLUTE_KEYS = ("time_of_day", "date", "datetime", "utc", "unix", "epoch", "absolute", "timestamp", "year", "month", "day", "week", "gps_time", "gps_week", "gps_day", "day_of_year", "day_of_week", "time_of_week", "week_number")


def _find(df: DataFrame, family: str, code: str, subject: Column) -> DataFrame:
    return df.select(F.lit(family).alias("family"), F.lit(code).alias("code"), subject.cast("string").alias("subject"))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """key and how often, of keys that occur more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values of a foreign key without a parent, and how often; null is one."""
    keys = child.groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return keys.join(parent.select(F.col(parent_column).alias("key")).distinct(), "key", "left_anti")


def array_orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    return orphans(child.select(F.explode(column).alias("key")), "key", parent, parent_column)


def coverage_differences(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """key and side (left_only, right_only) of keys on one side alone."""
    left, right = a.select(*key).distinct().withColumn("__a", F.lit(1)), b.select(*key).distinct().withColumn("__b", F.lit(1))
    both = left.join(right, list(key), "full_outer").where("__a is null or __b is null")
    return both.select(*key, F.when(F.col("__b").isNull(), "left_only").otherwise("right_only").alias("side"))


def partition_faults(whole: DataFrame, parts: Mapping[str, DataFrame], key: Sequence[str]) -> DataFrame:
    """key, fault of rows that the parts miss, share or invent."""
    tagged = reduce(DataFrame.unionByName, [d.select(*key, F.lit(n).alias("__p")) for n, d in parts.items()])
    seen = tagged.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).withColumn("__in", F.lit(True))
    both = whole.select(*key).distinct().withColumn("__w", F.lit(True)).join(seen, list(key), "full_outer")
    fault = F.when(F.col("__in").isNull(), "missing").when(F.col("__w").isNull(), "unknown").when(F.col("__n") > 1, "shared")
    return both.withColumn("fault", fault).where("fault is not null").select(*key, "fault")


def chain_faults(df: DataFrame, key: Sequence[str], token: str, prev: str, following: str, order: str) -> DataFrame:
    """Findings over prev/next links: compared with lag and lead in ``order``,
    which must rise strictly.  Links that equal the neighbours in a strict
    order are symmetric, acyclic, have one start and cover the chain."""
    w = Window.partitionBy(*key).orderBy(order, token)
    seen = df.withColumns({"__p": F.coalesce(F.lag(token).over(w), F.lit("")), "__n": F.coalesce(F.lead(token).over(w), F.lit("")), "__o": F.lag(order).over(w)})
    faults = F.array_compact(F.array(
        F.when(~F.col(prev).eqNullSafe(F.col("__p")), "prev_mismatch"),
        F.when(~F.col(following).eqNullSafe(F.col("__n")), "next_mismatch"),
        F.when(F.col("__o") >= F.col(order), "order_not_increasing"),
    ))
    return seen.select(*key, F.col(token).alias("token"), F.explode(faults).alias("fault"))


def geometry_ok(translation: str, rotation: str) -> Column:
    """A finite 3-vector and a unit quaternion within 1e-9."""
    finite = lambda c: F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    norm = F.sqrt(F.aggregate(rotation, F.lit(0.0), lambda s, v: s + v * v))
    return F.coalesce((F.size(translation) == 3) & finite(translation) & (F.size(rotation) == 4) & finite(rotation) & (F.abs(norm - 1) <= 1e-9), F.lit(False))


def missing_channels(data: DataFrame, sample: Sequence[str], channel: str, required: Sequence[str]) -> DataFrame:
    """Samples that lack required channels, and which."""
    have = data.groupBy(*sample).agg(F.collect_set(channel).alias("__c"))
    lacking = F.array_sort(F.array_except(F.array(*map(F.lit, sorted(required))), "__c"))
    return have.select(*sample, lacking.alias("missing")).where(F.size("missing") > 0)


def name_words(name: str) -> str:
    """Words of a field name joined by _, in lower case: a word ends at what is
    no letter or digit and before a capital that follows a small one."""
    words, last = [""], ""
    for c in name:
        if not c.isalnum():
            words.append("")
        elif c.isupper() and (last.islower() or last.isdigit()):
            words.append(c.lower())
        else:
            words[-1] += c.lower()
        last = c
    return "_".join(w for w in words if w)


def forbidden_name(name: str, words: Sequence[str] = ABSOLUTE_KEYS) -> bool:
    own = f"_{name_words(name)}_"
    return any(f"_{w}_" in own for w in words)


def forbidden_columns(df: DataFrame, words: Sequence[str] = ABSOLUTE_KEYS) -> list[str]:
    """Paths of fields, nested ones too, whose name holds one of ``words``."""
    from pyspark.sql import types as T

    def walk(kind: T.DataType, path: str) -> list[str]:
        if isinstance(kind, T.StructType):
            out = []
            for f in kind.fields:
                at = f"{path}.{f.name}" if path else f.name
                out += ([at] if forbidden_name(f.name, words) else []) + walk(f.dataType, at)
            return out
        if isinstance(kind, T.ArrayType):
            return walk(kind.elementType, f"{path}[]")
        return walk(kind.valueType, f"{path}{{}}") if isinstance(kind, T.MapType) else []

    return walk(df.schema, "")


def forbidden_text(df: DataFrame, key: str, text: str, date: str = ISO_DATE, secret: str = SECRET) -> DataFrame:
    """key and what is forbidden in its text: iso_date, credential."""
    found = F.array_compact(F.array(F.when(F.col(text).rlike(date), "iso_date"), F.when(F.col(text).rlike(secret), "credential")))
    return df.select(key, F.explode(found).alias("finding"))


def forbidden_json(df: DataFrame, key: Sequence[str], text: str, words: Sequence[str] = FORBIDDEN_WORDS) -> DataFrame:
    """key, path and finding (forbidden_name, iso_date) of JSON texts: of keys
    at any depth, and of strings, where JSON within a string is read as well.
    What is no JSON is one string.  Arrow batches: SQL has no walk of
    unbounded depth."""
    columns = [*key, text]
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in key)

    def walk(value: object, at: str) -> Iterator[tuple[str, str]]:
        todo = [(value, at)]
        while todo:
            value, at = todo.pop()
            if isinstance(value, dict):
                for k, v in value.items():
                    if forbidden_name(k, words):
                        yield f"{at}.{k}", "forbidden_name"
                    todo.append((v, f"{at}.{k}"))
            elif isinstance(value, list):
                todo += [(v, f"{at}[{i}]") for i, v in enumerate(value)]
            elif isinstance(value, str):
                if re.search(ISO_DATE, value):
                    yield at, "iso_date"
                if value.strip()[:1] in ("{", "["):
                    try:
                        todo.append((json.loads(value), at))
                    except ValueError:
                        continue

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, paths, what = [], [], []
            for i, t in enumerate(batch.column(len(key)).to_pylist()):
                try:
                    value = json.loads(t) if t is not None else None
                except ValueError:
                    value = t
                for path, finding in walk(value, "root"):
                    rows.append(i)
                    paths.append(path)
                    what.append(finding)
            own = batch.select(list(range(len(key)))).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(paths, pa.string()), pa.array(what, pa.string())], [*key, "path", "finding"])

    return df.select(*columns).mapInArrow(run, f"{kinds}, path string, finding string")


def report(findings: Sequence[DataFrame]) -> DataFrame:
    """All findings, distinct; families and codes in order when collected."""
    return reduce(DataFrame.unionByName, findings).distinct()


def key_findings(name: str, df: DataFrame, key: Sequence[str]) -> DataFrame:
    return _find(duplicate_keys(df, key), "tokens", f"{name}_duplicate_key", F.concat_ws("|", *key))


def foreign_findings(name: str, child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    return _find(orphans(child, column, parent, parent_column), "foreign_keys", f"{name}_orphan", F.col("key"))
