"""Identities: canonical JSON text, SHA-256 hashes, name-based UUIDs, git blobs."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(value: Any) -> str:
    """Sorted keys, no blanks, no escapes beyond JSON's own, no NaN."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def canonical_hash(value: Any) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


def json_string(text: Column) -> Column:
    """A string column as a JSON string literal."""
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for raw, name in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        out = F.replace(out, F.lit(raw), F.lit(name))
    return F.concat(F.lit('"'), out, F.lit('"'))


def json_object(**fields: Column | str | int) -> Column:
    """Canonical JSON of an object: strings quoted, integers plain, keys sorted.

    Column values must be strings already made JSON (json_string) or integers.
    """
    parts: list[Column] = []
    for i, name in enumerate(sorted(fields)):
        value = fields[name]
        if not isinstance(value, Column):
            value = F.lit(canonical_json(value))
        parts += [F.lit(("," if i else "{") + canonical_json(name) + ":"), value.cast("string")]
    return F.concat(*parts, F.lit("}"))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def name_uuid(namespace_hex: str, name: Column, hyphens: bool = True) -> Column:
    """RFC 4122 version 5 UUID of a UTF-8 name."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(name, "utf-8")))
    variant = F.element_at(F.array(*map(F.lit, "89ab")), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1).cast("int"))
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat_ws("-" if hyphens else "", *parts)


def git_blob_id(content: Column) -> Column:
    """The id git gives a blob of these bytes."""
    head = F.encode(F.concat(F.lit("blob "), F.length(content).cast("string")), "utf-8")
    return F.sha1(F.concat(head, F.unhex(F.lit("00")), content))
