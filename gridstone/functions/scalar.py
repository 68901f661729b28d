"""Scalar expressions: rounding, angles, quaternions, projection, names, paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Web Mercator sphere radius (EPSG:3857), a fixed value.
EARTH_RADIUS_M = 6378137.0


def rounded_ratio(numerator: Column, denominator: Column) -> Column:
    """Half-up quotient of non-negative integers, exact beyond 64 bits."""
    wide = lambda c: c.cast("decimal(38,0)")
    return F.call_function("div", wide(numerator) * 2 + wide(denominator), wide(denominator) * 2).cast("long")


def round_half_away(x: Column) -> Column:
    return F.when(x >= 0, F.floor(x + 0.5)).otherwise(F.ceil(x - 0.5))


def half_up_target(n: Column, fraction: str) -> Column:
    """floor(n * fraction + 0.5) in exact decimal arithmetic."""
    return F.floor(n.cast("decimal(18,0)") * F.lit(fraction).cast("decimal(20,18)") + F.lit("0.5").cast("decimal(2,1)")).cast("long")


def lerp(a: Column, b: Column, t: Column) -> Column:
    return a + (b - a) * t


def shortest_angle(x: Column) -> Column:
    """Angle wrapped into (-pi, pi]: a positive multiple of pi stays positive."""
    wrapped = F.pmod(x + F.pi(), F.lit(2) * F.pi()) - F.pi()
    return F.when((wrapped == -F.pi()) & (x > 0), F.pi()).otherwise(wrapped)


def microseconds(ns: Column) -> Column:
    """Floor of non-negative nanoseconds in microseconds."""
    return F.call_function("div", ns, F.lit(1000).cast("long"))


def mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to EPSG:3857 metres."""
    return F.radians(lon) * EARTH_RADIUS_M, F.ln(F.tan(F.pi() / 4 + F.radians(lat) / 2)) * EARTH_RADIUS_M


def inverse_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / EARTH_RADIUS_M), F.degrees(F.atan(F.exp(y / EARTH_RADIUS_M)) * 2 - F.pi() / 2)


def quaternion(w: Column, x: Column, y: Column, z: Column) -> Column:
    """Unit quaternion array (w, x, y, z); null for a zero or non-finite norm."""
    norm = F.sqrt(w * w + x * x + y * y + z * z)
    finite = (norm > 0) & (norm < float("inf")) & ~F.isnan(norm)
    return F.when(finite, F.array(*(F.try_divide(c, norm) for c in (w, x, y, z))))


def euler_quaternion(roll: Column, pitch: Column, yaw: Column) -> Column:
    """Rotation about fixed x, then y, then z (radians) as a unit quaternion."""
    (cr, sr), (cp, sp), (cy, sy) = ((F.cos(a / 2), F.sin(a / 2)) for a in (roll, pitch, yaw))
    return quaternion(cr * cp * cy + sr * sp * sy, sr * cp * cy - cr * sp * sy, cr * sp * cy + sr * cp * sy, cr * cp * sy - sr * sp * cy)


def axis_angle_quaternion(x: Column, y: Column, z: Column) -> Column:
    """Rotation vector as a unit quaternion; the zero vector is the identity."""
    angle = F.sqrt(x * x + y * y + z * z)
    s = F.when(angle > 0, F.try_divide(F.sin(angle / 2), angle)).otherwise(0.0)
    return F.array(F.cos(angle / 2), x * s, y * s, z * s)


def yaw(q: Column) -> Column:
    w, x, y, z = (F.get(q, i) for i in range(4))
    return F.atan2((w * z + x * y) * 2, 1 - (y * y + z * z) * 2)


def slerp(a: Column, b: Column, t: Column, near: float = 0.9995) -> Column:
    """Shortest-path spherical interpolation of unit quaternion arrays; above
    ``near`` the straight line, brought back to unit length.

    ``a`` and ``b`` stand in the expression many times: give columns of an
    earlier select, not long expressions."""
    parts = [(F.get(a, i), F.get(b, i)) for i in range(4)]
    raw = sum((p * q for p, q in parts[1:]), parts[0][0] * parts[0][1])
    sign = F.when(raw < 0, -1.0).otherwise(1.0)
    dot = F.least(F.abs(raw), F.lit(1.0))
    angle = F.acos(dot)
    scale = F.sin(angle)
    from_a = F.when(dot > near, 1 - t).otherwise(F.try_divide(F.sin(angle * (1 - t)), scale))
    from_b = F.when(dot > near, t).otherwise(F.try_divide(F.sin(angle * t), scale)) * sign
    return quaternion(*(p * from_a + q * from_b for p, q in parts))


def channel_name(name: Column) -> Column:
    """Upper case, - as _, with the prefix CAM_ and single underscores."""
    upper = F.upper(F.replace(name, F.lit("-"), F.lit("_")))
    return F.regexp_replace(F.when(upper.startswith("CAM_"), upper).otherwise(F.concat(F.lit("CAM_"), upper)), "_+", "_")


#: Names of devices that some systems keep for themselves, fixed values.
RESERVED = "CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9]"


def safe_segment(name: Column) -> Column:
    """Is this usable as one path segment anywhere: no separators, wildcards or
    control and unassigned characters, no blank at an end, no dot at the last,
    no device name before the first dot?"""
    clean = name.rlike(r"^[^/\\<>:\"|?*\p{C}]+$") & ~name.rlike(r"(?U)^\s|\s$") & ~name.endswith(".")
    return F.coalesce(clean & ~name.rlike(rf"^(?i:{RESERVED})(\.|$)"), F.lit(False))


def safe_relative_path(path: Column, suffix: str | None = None) -> Column:
    """Relative, made of safe segments, optionally with a suffix."""
    ok = F.forall(F.split(path, "/"), safe_segment) & (F.length(path) > 0)
    return F.coalesce(ok & path.endswith(suffix) if suffix else ok, F.lit(False))


#: Kinds of files a repository path may name, fixed values.
FILE_SUFFIXES = ("mp4", "parquet", "json", "jsonl", "tar")


def _below_data(path: Column) -> Column:
    """data/..., normal, with no empty or dotted segment and nothing that an address would decode."""
    return path.startswith("data/") & ~path.rlike(r"[\\%?#]") & F.forall(F.split(path, "/"), lambda x: ~x.isin("", ".", ".."))


def repo_file_path(path: Column) -> Column:
    """A file of a known kind below data/, all of whose segments are safe."""
    kind = path.rlike(rf"[^/]\.({'|'.join(FILE_SUFFIXES)})$")
    return F.coalesce(_below_data(path) & kind & F.forall(F.split(path, "/"), safe_segment), F.lit(False))


def repo_recording_path(path: Column) -> Column:
    """An .mcap recording below data/."""
    return F.coalesce(_below_data(path) & path.endswith(".mcap"), F.lit(False))


def numeric_leaf(text: Column) -> Column:
    """A canonical 64-bit integer string as a double, else null."""
    return F.when(text.rlike(r"^(0|-?[1-9][0-9]{0,19})$"), F.try_to_number(text, F.lit("S99999999999999999999")).cast("double"))


def mapped_lerp(a: Column, b: Column, t: Column) -> Column:
    """Interpolate two map<string,double> by their common keys."""
    both = F.map_zip_with(a, b, lambda k, x, y: x + (y - x) * t)
    return F.map_filter(both, lambda k, v: v.isNotNull())


def mapped_blend(a: Column, b: Column, t: Column) -> Column:
    """Blend two map<string,string> by their common keys: numbers are
    interpolated, equal values kept, others taken from the nearer end (the
    first one below 0.5)."""
    def one(k: Column, x: Column, y: Column) -> Column:
        p, q = x.try_cast("double"), y.try_cast("double")
        return F.when(p.isNotNull() & q.isNotNull(), (p + (q - p) * t).cast("string")).when(x == y, x).otherwise(F.when(t < 0.5, x).otherwise(y))

    shared = F.array_intersect(F.map_keys(a), F.map_keys(b))
    keep = lambda m: F.map_filter(m, lambda k, v: F.array_contains(shared, k))
    return F.map_zip_with(keep(a), keep(b), one)
