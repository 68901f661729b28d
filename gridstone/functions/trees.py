"""Dynamic JSON trees as flat maps of path to number, bounded in size."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Limits of one tree, fixed values.
MOST_DEPTH, MOST_NODES, MOST_LEAVES = 32, 10_000, 8_000
_INTEGER = re.compile(r"0|-?[1-9][0-9]*")
_STEP = re.compile(r"\[[0-9]+\]$")


def number(leaf: object) -> float | None:
    """A finite number, or a canonical 64-bit integer given as text."""
    if isinstance(leaf, bool):
        return None
    if isinstance(leaf, str):
        return float(leaf) if _INTEGER.fullmatch(leaf) and len(leaf) < 21 and -(2**63) <= int(leaf) < 2**64 else None
    if isinstance(leaf, int | float):
        if not math.isfinite(leaf):
            raise ValueError("numbers in a tree must be finite")
        return float(leaf)
    return None


def flatten(tree: object) -> tuple[dict[str, object], dict[str, int]]:
    """({path: leaf}, {path of a sequence: its length}); empty containers have
    no leaf.  Beyond the limits it raises."""
    leaves: dict[str, object] = {}
    lengths: dict[str, int] = {}
    todo, nodes = [("", tree, 0)], 0
    while todo:
        path, value, depth = todo.pop()
        nodes += 1
        if depth > MOST_DEPTH or nodes > MOST_NODES or len(leaves) > MOST_LEAVES:
            raise ValueError("tree beyond its limits")
        if isinstance(value, dict):
            todo += [(f"{path}.{k}" if path else str(k), v, depth + 1) for k, v in value.items()]
        elif isinstance(value, list):
            lengths[path] = len(value)
            todo += [(f"{path}[{i}]", v, depth + 1) for i, v in enumerate(value)]
        else:
            leaves[path] = value
    return leaves, lengths


def blend(a: object, b: object, t: float) -> tuple[dict[str, float], list[str]]:
    """({path: value between the trees}, numeric paths that are in neither).

    A path counts if both trees have a number there.  A sequence counts whole
    or not at all: lengths must agree and each element must hold a value.
    """
    (la, na), (lb, nb) = flatten(a), flatten(b)
    va, vb = ({p: x for p, v in leaves.items() if (x := number(v)) is not None} for leaves in (la, lb))
    mixed = {p: va[p] + (vb[p] - va[p]) * t for p in va.keys() & vb.keys()}
    for path in sorted(na.keys() | nb.keys(), key=len, reverse=True):  # inner sequences first
        ok = na.get(path) == nb.get(path)
        below = [p for p in mixed if p.startswith(f"{path}[")]
        if ok:
            filled = {p[len(path) :].split("]", 1)[0] for p in below}
            ok = len(filled) == na[path]
        if not ok:
            for p in below:
                del mixed[p]
    return mixed, sorted((va.keys() | vb.keys()) - mixed.keys())


def _leaves(trees: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for series in trees:
        yield pd.Series([None if x is None else {p: n for p, v in flatten(json.loads(x))[0].items() if (n := number(v)) is not None} for x in series], dtype=object)


def _blended(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for a, b, t in batches:
        rows = [(None, None) if x is None or y is None or pd.isna(f) else blend(json.loads(x), json.loads(y), f) for x, y, f in zip(a, b, t, strict=True)]
        yield pd.DataFrame(rows, columns=["blended", "uninterpolated"])


def numeric_leaves(tree: Column | str) -> Column:
    """Numeric leaves by path of a JSON text; null stays null."""
    return F.pandas_udf(_leaves, "map<string,double>")(tree)


def blended(a: Column | str, b: Column | str, t: Column | str) -> Column:
    """:func:`blend` of JSON texts; null if either is."""
    return F.pandas_udf(_blended, "blended map<string,double>, uninterpolated array<string>")(a, b, t)


def largest_leaf(leaves: Column) -> Column:
    """struct<path, value> of the largest number, the first path on a tie."""
    entries = F.transform(F.map_entries(leaves), lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("path"), e["value"].alias("value")))
    best = F.array_min(entries)
    return F.when(best.isNotNull(), F.struct(best["path"].alias("path"), best["value"].alias("value")))
