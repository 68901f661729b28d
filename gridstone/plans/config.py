"""Configuration that the plans share: exact durations, rule templates, source
fingerprints, hashes and the schema of a configuration file."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence
from decimal import Decimal
from typing import Any
from urllib.parse import parse_qsl, urlsplit

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import canonical_hash, canonical_json, json_object, json_string, sha256
from ..operators.policy import SceneFilter

#: Scenario rules by what they require, in order; the last one asks for a label of the caller's.
TEMPLATES = (
    ("Straight", ("straight", "moving")), ("Stopping", ("stopping",)), ("Left Turn", ("left_turn",)), ("Right Turn", ("right_turn",)),
    ("Left Curvature", ("left_curvature",)), ("Right Curvature", ("right_curvature",)),
)
#: Names of fields that hold credentials, in letters and digits alone, endings
#: that tell them, and marks of secret values: fixed values.
SECRET_NAMES = (
    "accesstoken", "accountkey", "apikey", "auth", "authentication", "authorization", "authtoken", "bearertoken", "clientsecret", "connectionstring",
    "credential", "credentials", "idtoken", "key", "passwd", "password", "privatekey", "refreshtoken", "sastoken", "secret", "secretkey", "sharedaccesskey",
    "signingkey", "storagekey", "token",
)
SECRET_ENDINGS = (
    "accesskey", "accountkey", "apikey", "clientkey", "credential", "credentials", "encryptionkey", "passwd", "password", "privatekey", "secret", "secretkey",
    "signingkey", "storagekey", "token",
)
SECRET_MARKS = ("accountkey=", "api_key=", "client_secret=", "sharedaccesssignature=", "-----begin private key-----")
SECRET_QUERIES = (*SECRET_NAMES, "sig", "signature")
_JWT = re.compile(r"(?<![\w-])eyJ[\w-]{5,}(?:\.[\w-]{5,}){2}(?![\w-])", re.ASCII)
_OPAQUE = re.compile(r"bearer[ \t]+[\w.~+/-]{32,}=*", re.ASCII | re.IGNORECASE)
_ISSUED = re.compile(r"sk-[\w-]{20,}", re.ASCII)
_JSON_KINDS = {str: "string", int: "integer", float: "number", bool: "boolean", list: "array", dict: "object"}


def exact_nanoseconds(value: str | int | Decimal, unit_ns: int) -> int:
    """value units in nanoseconds; a part of a nanosecond is an error."""
    got = Decimal(str(value)) * unit_ns
    if not got.is_finite() or got != got.to_integral_value():
        raise ValueError(f"{value} is not a whole number of nanoseconds")
    return int(got)


def scenario_rules(quota: int, label: str, tags: str = "tags", labels: str = "labels") -> list[tuple[str, int, SceneFilter]]:
    """(name, quota, filter) of the canonical rules."""
    rules = [(name, quota, SceneFilter(sets={tags: ((), need, ())})) for name, need in TEMPLATES]
    return [*rules, ("Annotation Category", quota, SceneFilter(sets={labels: ((), (label,), ())}))]


def source_digest(**fields: Column | str | int) -> Column:
    """SHA-256 of a source's canonical JSON; columns of text are quoted."""
    return sha256(json_object(**{k: json_string(v) if isinstance(v, Column) else v for k, v in fields.items()}))


def locator(repo_path: Column, recording_id: Column) -> Column:
    """A source's path in its repository, or else the recording's id."""
    return F.coalesce(repo_path, recording_id)


def _bare(name: object) -> str:
    return "".join(c for c in str(name).lower() if c.isascii() and c.isalnum())


def credential_findings(value: object, at: str = "config", paths: Sequence[str] = ()) -> list[str]:
    """Places in a configuration where a key names a credential, or a text
    looks like one: marked, in a URL's query, a web token or a bearer's.
    paths: places of file paths, where a bearer's shape proves nothing."""
    if isinstance(value, Mapping):
        named = [f"{at}.{k}" for k in value if _bare(k) in SECRET_NAMES or _bare(k).endswith(SECRET_ENDINGS)]
        return named + [f for k, v in value.items() if f"{at}.{k}" not in named for f in credential_findings(v, f"{at}.{k}", paths)]
    if isinstance(value, list | tuple):
        return [f for i, v in enumerate(value) for f in credential_findings(v, f"{at}[{i}]", paths)]
    if not isinstance(value, str):
        return []
    told = any(m in value.lower() for m in SECRET_MARKS) or bool(_JWT.search(value)) or bool(_ISSUED.fullmatch(value))
    if not told and value.lower().startswith(("http://", "https://")):
        try:
            told = any(v and _bare(k) in SECRET_QUERIES for k, v in parse_qsl(urlsplit(value).query))
        except ValueError:
            told = False
    return [at] if told or at not in paths and _OPAQUE.fullmatch(value.strip()) else []


def extraction_hash(config: Mapping[str, Any], relevant: Sequence[str]) -> str:
    """Hash of the parts of a configuration that extraction depends on."""
    return canonical_hash({k: config.get(k) for k in relevant})


def candidate_fingerprint(rows: DataFrame, identity: Sequence[str]) -> str:
    """SHA-256 over the rows as canonical JSON in the order of their identity.

    Rows stream through the driver one partition at a time; nothing is kept.
    """
    out = hashlib.sha256(b"[")
    for i, r in enumerate(rows.orderBy(*identity).toLocalIterator()):
        out.update(("," if i else "").encode() + canonical_json(r.asDict(recursive=True)).encode())
    out.update(b"]")
    return out.hexdigest()


def config_schema(fields: Mapping[str, type], title: str) -> str:
    """JSON Schema of a configuration with these optional fields and no others."""
    kinds = {name: {"type": [_JSON_KINDS[kind], "null"]} for name, kind in fields.items()}
    return canonical_json({"$schema": "https://json-schema.org/draft/2020-12/schema", "additionalProperties": False, "properties": kinds, "title": title, "type": "object"})
