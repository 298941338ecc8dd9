"""Scalar functions as column expressions: rotations, poses, cameras, geodesy, time, ids, numbers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: factor of the pair id.
PAIR_BASE = 2147483647
# WGS84 ellipsoid.
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
WGS84_E2 = WGS84_F * (2 - WGS84_F)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def at(array: str | Column, i: int) -> Column:
    return F.get(col(array), F.lit(i))


# -- numbers ---------------------------------------------------------------------------


def sign(x: str | Column) -> Column:
    """+1 for zero and above, else -1."""
    return F.when(col(x) >= 0, 1).otherwise(-1)


def clamp(x: str | Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), col(x)))


def sigmoid(x: str | Column, alpha: float = 1.0) -> Column:
    return 1 / (1 + F.exp(-alpha * col(x)))


def polynomial(coefficients: Sequence[float], x: str | Column) -> Column:
    """Horner's rule; coefficients from the highest power down."""
    out: Column = F.lit(float(coefficients[0]))
    for c in coefficients[1:]:
        out = out * col(x) + float(c)
    return out


def confidence(inlier_ratio: Column, n: Column) -> Column:
    return F.least(F.lit(1.0), inlier_ratio * F.sqrt(n / 100.0))


def depth_sigma(depth: str | Column, base: float, quad: float) -> Column:
    return base + quad * col(depth) * col(depth)


def ransac_trials(inliers: Column, samples: Column, sample_size: int, probability: float = 0.99, multiplier: float = 1.0) -> Column:
    """Trials that draw an all-inlier sample with the given probability; exact product without replacement."""
    p: Column = F.lit(1.0)
    for i in range(sample_size):
        p = p * ((inliers - i) / (samples - i))
    trials = F.ceil(F.lit(math.log(1 - probability)) / F.ln(1 - p) * multiplier)
    return F.when(inliers < sample_size, F.lit(None).cast("long")).when(p >= 1, F.lit(1).cast("long")).otherwise(trials.cast("long"))


# -- ids and strings -------------------------------------------------------------------


def pair_id(a: str | Column, b: str | Column) -> Column:
    """One id for two image ids in either order."""
    low, high = F.least(col(a), col(b)), F.greatest(col(a), col(b))
    return low.cast("long") * PAIR_BASE + high.cast("long")


def pair_first(pair: str | Column) -> Column:
    return F.round((col(pair) - col(pair) % PAIR_BASE) / PAIR_BASE).cast("long")


def pair_second(pair: str | Column) -> Column:
    return (col(pair) % PAIR_BASE).cast("long")


def frame_number(name: str | Column) -> Column:
    """Number in a file name's stem: frames/000015.png is 15."""
    return F.regexp_extract(col(name), r"(\d+)(?:\.[^./]*)?$", 1).try_cast("int")


def path_segments(path: str | Column) -> Column:
    return F.split(F.lower(F.trim(col(path), F.lit("/"))), "/")


def compressed_format(fmt: str | Column) -> Column:
    """struct(encoding, codec) of strings such as '16UC1; png compressed '; jpg is jpeg."""
    parts = F.split(col(fmt), ";", 2)
    said = F.lower(F.trim(F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0)))))
    codec = F.when(said.contains("png"), "png").when(said.contains("jpeg") | said.contains("jpg"), "jpeg")
    return F.struct(F.when(F.size(parts) > 1, F.trim(F.get(parts, F.lit(0)))).otherwise("").alias("encoding"), codec.alias("codec"))


# -- time ------------------------------------------------------------------------------


def stamp_ns(sec: str | Column, nsec: str | Column) -> Column:
    return col(sec).cast("long") * 1_000_000_000 + col(nsec).cast("long")


def seconds(ns: str | Column) -> Column:
    return col(ns) / 1e9


def format_seconds(ns: str | Column) -> Column:
    return F.format_string("%.6f", seconds(ns))


def iso_utc(ns: str | Column) -> Column:
    """ISO time in UTC from nanoseconds, to the microsecond; made of date arithmetic, whatever the session's zone."""
    us = F.round((col(ns) - F.pmod(col(ns), F.lit(1000))) / 1000).cast("long")
    days = F.floor(us / 86_400_000_000).cast("int")
    rest = us - days.cast("long") * 86_400_000_000
    hms = F.format_string("%02d:%02d:%02d.%06d", F.floor(rest / 3_600_000_000), F.floor(rest / 60_000_000) % 60, F.floor(rest / 1_000_000) % 60, rest % 1_000_000)
    return F.concat(F.date_from_unix_date(days).cast("string"), F.lit("T"), hms, F.lit("+00:00"))


# -- vectors, rotations, poses ---------------------------------------------------------


def dot(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return sum((x * y for x, y in zip(a, b, strict=True)), F.lit(0.0))


def norm(a: Sequence[Column]) -> Column:
    return F.sqrt(dot(a, a))


def angle_between(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Radians; 0 where a vector is null-length."""
    size = norm(a) * norm(b)
    return F.when(size > 0, F.acos(clamp(dot(a, b) / F.when(size > 0, size), -1.0, 1.0))).otherwise(0.0)


def rotation_of(q: str | Column) -> Column:
    """Row-major 3x3 matrix of a quaternion w, x, y, z, normalised first."""
    q = col(q)
    n = norm([at(q, i) for i in range(4)])
    w, x, y, z = (at(q, i) / n for i in range(4))
    return F.array(1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y), 2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x), 2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y))


def quaternion_of(r: str | Column) -> Column:
    """Quaternion x, y, z, w of a row-major rotation; the branch with the largest divisor."""
    m = [at(r, i) for i in range(9)]
    trace = m[0] + m[4] + m[8]
    s0 = F.sqrt(F.greatest(F.lit(0.0), trace + 1)) * 2
    s1 = F.sqrt(F.greatest(F.lit(0.0), 1 + m[0] - m[4] - m[8])) * 2
    s2 = F.sqrt(F.greatest(F.lit(0.0), 1 + m[4] - m[0] - m[8])) * 2
    s3 = F.sqrt(F.greatest(F.lit(0.0), 1 + m[8] - m[0] - m[4])) * 2

    def q(s: Column, x: Column, y: Column, z: Column, w: Column) -> Column:
        return F.array(x, y, z, w)

    return (
        F.when(trace > 0, q(s0, (m[7] - m[5]) / s0, (m[2] - m[6]) / s0, (m[3] - m[1]) / s0, s0 / 4))
        .when((m[0] > m[4]) & (m[0] > m[8]), q(s1, s1 / 4, (m[1] + m[3]) / s1, (m[2] + m[6]) / s1, (m[7] - m[5]) / s1))
        .when(m[4] > m[8], q(s2, (m[1] + m[3]) / s2, s2 / 4, (m[5] + m[7]) / s2, (m[2] - m[6]) / s2))
        .otherwise(q(s3, (m[2] + m[6]) / s3, (m[5] + m[7]) / s3, s3 / 4, (m[3] - m[1]) / s3))
    )


def transpose(r: str | Column) -> Column:
    return F.array(*[at(r, 3 * j + i) for i in range(3) for j in range(3)])


def compose(a: str | Column, b: str | Column) -> Column:
    """Product of two row-major 3x3 matrices."""
    return F.array(*[sum((at(a, 3 * i + k) * at(b, 3 * k + j) for k in range(3)), F.lit(0.0)) for i in range(3) for j in range(3)])


def rotate(r: str | Column, v: str | Column) -> Column:
    return F.array(*[sum((at(r, 3 * i + k) * at(v, k) for k in range(3)), F.lit(0.0)) for i in range(3)])


def add(a: str | Column, b: str | Column) -> Column:
    return F.array(*[at(a, i) + at(b, i) for i in range(3)])


def camera_to_world(r: str | Column, t: str | Column) -> tuple[Column, Column]:
    """(rotation, translation) of the inverse pose; the translation is the camera centre."""
    inverse = transpose(r)
    return inverse, F.transform(rotate(inverse, t), lambda x: -x)


def similarity(scale: float | Column, r: str | Column, t: str | Column, v: str | Column) -> Column:
    """scale * R v + t."""
    return F.array(*[F.get(rotate(r, v), F.lit(i)) * scale + at(t, i) for i in range(3)])


def rotation_angle(a: str | Column, b: str | Column) -> Column:
    """Degrees between two rotations."""
    trace = sum((at(a, i) * at(b, i) for i in range(9)), F.lit(0.0))
    return F.degrees(F.acos(clamp((trace - 1) / 2, -1.0, 1.0)))


def lerp_pose(qa: str | Column, ta: str | Column, qb: str | Column, tb: str | Column, s: float | Column) -> tuple[Column, Column]:
    """Spherical interpolation of rotations (w, x, y, z), linear of translations."""
    d0 = sum((at(qa, i) * at(qb, i) for i in range(4)), F.lit(0.0))
    flip = F.when(d0 < 0, -1.0).otherwise(1.0)
    d = F.least(F.lit(1.0), F.abs(d0))
    theta = F.acos(d)
    near = d > 1 - 1e-9
    sin = F.when(near, F.lit(1.0)).otherwise(F.sin(theta))
    s = F.lit(s) if isinstance(s, float) else s
    wa = F.when(near, 1 - s).otherwise(F.sin((1 - s) * theta) / sin)
    wb = F.when(near, s).otherwise(F.sin(s * theta) / sin) * flip
    return F.array(*[at(qa, i) * wa + at(qb, i) * wb for i in range(4)]), F.array(*[at(ta, i) * (1 - s) + at(tb, i) * s for i in range(3)])


# -- cameras ---------------------------------------------------------------------------


def project(x: Column, y: Column, z: Column, fx: float, fy: float, cx: float, cy: float) -> tuple[Column, Column]:
    zz = F.when(z > 0, z)
    return x / zz * fx + cx, y / zz * fy + cy


def backproject(u: Column, v: Column, depth: Column, fx: float, fy: float, cx: float, cy: float) -> tuple[Column, Column, Column]:
    return (u - cx) * depth / fx, (v - cy) * depth / fy, depth


def distort(x: Column, y: Column, k1: float, k2: float, p1: float, p2: float, k3: float = 0.0) -> tuple[Column, Column]:
    """Radial and tangential distortion of normalised coordinates."""
    r2 = x * x + y * y
    radial = 1 + r2 * (k1 + r2 * (k2 + r2 * k3))
    return x * radial + 2 * p1 * x * y + p2 * (r2 + 2 * x * x), y * radial + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y


def undistort(x: Column, y: Column, k1: float, k2: float, p1: float, p2: float, k3: float = 0.0, rounds: int = 20) -> Column:
    """struct(x, y) of the inverse by a fixed number of fixed-point rounds."""
    start = F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"), x.cast("double").alias("x0"), y.cast("double").alias("y0"))

    def step(s: Column, _: Column) -> Column:
        r2 = s["x"] * s["x"] + s["y"] * s["y"]
        radial = 1 + r2 * (k1 + r2 * (k2 + r2 * k3))
        dx = 2 * p1 * s["x"] * s["y"] + p2 * (r2 + 2 * s["x"] * s["x"])
        dy = p1 * (r2 + 2 * s["y"] * s["y"]) + 2 * p2 * s["x"] * s["y"]
        return F.struct(((s["x0"] - dx) / radial).alias("x"), ((s["y0"] - dy) / radial).alias("y"), s["x0"].alias("x0"), s["y0"].alias("y0"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step, lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y")))


def intrinsics_of(k: str | Column) -> Column:
    """struct(fx, fy, cx, cy) of a row-major camera matrix."""
    return F.struct(at(k, 0).alias("fx"), at(k, 4).alias("fy"), at(k, 2).alias("cx"), at(k, 5).alias("cy"))


def distortion_of(d: str | Column) -> Column:
    """Coefficients, five zeros where there are none."""
    return F.when(F.size(F.coalesce(col(d), F.array().cast("array<double>"))) > 0, col(d)).otherwise(F.array(*[F.lit(0.0)] * 5))


def camera_model(d: str | Column, equal_focal: Column) -> Column:
    """PINHOLE without distortion, SIMPLE_RADIAL with one coefficient and one focal length, else OPENCV."""
    nonzero = F.filter(F.coalesce(col(d), F.array().cast("array<double>")), lambda x: x != 0)
    only_k1 = (F.size(nonzero) == 1) & (at(d, 0) != 0)
    return F.when(F.size(nonzero) == 0, "PINHOLE").when(only_k1 & equal_focal, "SIMPLE_RADIAL").otherwise("OPENCV")


def camera_params(model: Column, fx: Column, fy: Column, cx: Column, cy: Column, d: str | Column) -> Column:
    zero = F.lit(0.0)
    k = [F.coalesce(at(d, i), zero) for i in range(4)]
    return F.when(model == "PINHOLE", F.concat_ws(",", fx, fy, cx, cy)).when(model == "SIMPLE_RADIAL", F.concat_ws(",", fx, cx, cy, k[0])).otherwise(F.concat_ws(",", fx, fy, cx, cy, *k))


def depth_band(depth: str | Column, low: float, high: float) -> Column:
    """Depth within the band, else 0."""
    return F.when(col(depth).between(low, high), col(depth)).otherwise(0.0)


def depth_millimetres(depth: str | Column) -> Column:
    """Saturating 16-bit millimetres, cut toward zero."""
    return clamp(col(depth) * 1000, 0.0, 65535.0).cast("int")


def depth_visual(depth: str | Column, top: float) -> Column:
    return (clamp(col(depth) / top, 0.0, 1.0) * 255).cast("int")


# -- geodesy ---------------------------------------------------------------------------


def to_ecef(lat: str | Column, lon: str | Column, alt: str | Column) -> tuple[Column, Column, Column]:
    """Earth-centred metres of WGS84 degrees and metres."""
    p, q, h = F.radians(col(lat)), F.radians(col(lon)), col(alt)
    n = WGS84_A / F.sqrt(1 - WGS84_E2 * F.sin(p) * F.sin(p))
    return (n + h) * F.cos(p) * F.cos(q), (n + h) * F.cos(p) * F.sin(q), (n * (1 - WGS84_E2) + h) * F.sin(p)


def from_ecef(x: Column, y: Column, z: Column, rounds: int = 10) -> Column:
    """struct(lat, lon, alt) by a fixed number of rounds for the latitude."""
    r = F.sqrt(x * x + y * y)
    start = F.atan2(z, r * (1 - WGS84_E2))

    def step(lat: Column, _: Column) -> Column:
        n = WGS84_A / F.sqrt(1 - WGS84_E2 * F.sin(lat) * F.sin(lat))
        return F.atan2(z + WGS84_E2 * n * F.sin(lat), r)

    lat = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)
    n = WGS84_A / F.sqrt(1 - WGS84_E2 * F.sin(lat) * F.sin(lat))
    # the form that stays exact at the poles
    alt = r * F.cos(lat) + z * F.sin(lat) - WGS84_A * WGS84_A / n
    return F.struct(F.degrees(lat).alias("lat"), F.degrees(F.atan2(y, x)).alias("lon"), alt.alias("alt"))


def to_enu(x: Column, y: Column, z: Column, lat0: float, lon0: float, alt0: float) -> tuple[Column, Column, Column]:
    """East, north, up metres from a reference place."""
    p, q = math.radians(lat0), math.radians(lon0)
    n = WGS84_A / math.sqrt(1 - WGS84_E2 * math.sin(p) ** 2)
    x0, y0, z0 = (n + alt0) * math.cos(p) * math.cos(q), (n + alt0) * math.cos(p) * math.sin(q), (n * (1 - WGS84_E2) + alt0) * math.sin(p)
    dx, dy, dz = x - x0, y - y0, z - z0
    east = -math.sin(q) * dx + math.cos(q) * dy
    north = -math.sin(p) * math.cos(q) * dx - math.sin(p) * math.sin(q) * dy + math.cos(p) * dz
    up = math.cos(p) * math.cos(q) * dx + math.cos(p) * math.sin(q) * dy + math.sin(p) * dz
    return east, north, up
