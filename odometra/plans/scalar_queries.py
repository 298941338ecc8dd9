"""Queries on scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as M
from .common import Registry, micros, r6, table

REGISTRY = Registry()
QUAT = "q AS (SELECT vec_id, embedding[1]::DOUBLE AS w0, embedding[2]::DOUBLE AS x0, embedding[3]::DOUBLE AS y0, embedding[4]::DOUBLE AS z0, embedding[5]::DOUBLE AS t0, embedding[6]::DOUBLE AS t1, embedding[7]::DOUBLE AS t2 FROM embeddings), n AS (SELECT *, sqrt(w0*w0+x0*x0+y0*y0+z0*z0) AS s FROM q), u AS (SELECT vec_id, w0/s AS w, x0/s AS x, y0/s AS y, z0/s AS z, t0, t1, t2 FROM n)"
ROT = QUAT + ", r AS (SELECT *, 1-2*(y*y+z*z) AS r0, 2*(x*y-w*z) AS r1, 2*(x*z+w*y) AS r2, 2*(x*y+w*z) AS r3, 1-2*(x*x+z*z) AS r4, 2*(y*z-w*x) AS r5, 2*(x*z-w*y) AS r6, 2*(y*z+w*x) AS r7, 1-2*(x*x+y*y) AS r8 FROM u)"


def _poses(spark, sf):
    e = table(spark, sf, "embeddings")
    part = lambda a, b: F.transform(F.slice("embedding", a, b), lambda v: v.cast("double"))
    return e.select("vec_id", part(1, 4).alias("q"), part(5, 3).alias("t")).withColumn("R", M.rotation_of("q"))


@REGISTRY.add("m01_quaternion_to_rotation", f"WITH {ROT} SELECT vec_id, " + ", ".join(f"round(r{i}, 6) AS r{i}" for i in range(9)) + " FROM r")
def m01(spark, sf):
    return _poses(spark, sf).select("vec_id", *[r6(M.at("R", i)).alias(f"r{i}") for i in range(9)])


@REGISTRY.add("m01_rotation_to_quaternion", f"WITH {QUAT} SELECT vec_id, round(abs(w), 5) AS w, round(x * CASE WHEN w < 0 THEN -1 ELSE 1 END, 5) AS x, round(y * CASE WHEN w < 0 THEN -1 ELSE 1 END, 5) AS y, round(z * CASE WHEN w < 0 THEN -1 ELSE 1 END, 5) AS z FROM u")
def m01b(spark, sf):
    q = _poses(spark, sf).select("vec_id", M.quaternion_of("R").alias("p"))
    side = F.when(M.at("p", 3) < 0, -1).otherwise(1)
    return q.select("vec_id", F.round(F.abs(M.at("p", 3)), 5).alias("w"), *[F.round(M.at("p", i) * side, 5).alias(c) for i, c in enumerate("xyz")])


@REGISTRY.add("m02_camera_centre", f"WITH {ROT} SELECT vec_id, round(-(r0*t0+r3*t1+r6*t2), 6) AS cx, round(-(r1*t0+r4*t1+r7*t2), 6) AS cy, round(-(r2*t0+r5*t1+r8*t2), 6) AS cz FROM r")
def m02(spark, sf):
    _, c = M.camera_to_world("R", "t")
    return _poses(spark, sf).select("vec_id", c.alias("c")).select("vec_id", *[r6(M.at("c", i)).alias(f"c{a}") for i, a in enumerate("xyz")])


@REGISTRY.add("m03_similarity_on_point", f"WITH {ROT} SELECT vec_id, " + ", ".join(f"round(2.5 * (r{3 * i} * 1 + r{3 * i + 1} * 2 + r{3 * i + 2} * 3) + t{i}, 6) AS p{i}" for i in range(3)) + " FROM r")
def m03(spark, sf):
    point = F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0))
    return _poses(spark, sf).select("vec_id", M.similarity(2.5, "R", "t", point).alias("p")).select("vec_id", *[r6(M.at("p", i)).alias(f"p{i}") for i in range(3)])


@REGISTRY.add("m04_backproject_project", "SELECT l_orderkey, l_linenumber, round((l_quantity * 10 - 320) * (l_extendedprice / 10000) / 525, 6) AS x, round((l_linenumber * 40 - 240) * (l_extendedprice / 10000) / 525, 6) AS y, round(l_quantity * 10, 4) AS u, round(l_linenumber * 40, 4) AS v FROM lineitem WHERE l_extendedprice > 0")
def m04(spark, sf):
    li = table(spark, sf, "lineitem").where("l_extendedprice > 0")
    x, y, z = M.backproject(F.col("l_quantity") * 10, F.col("l_linenumber") * 40, F.col("l_extendedprice") / 10000, 525.0, 525.0, 320.0, 240.0)
    u, v = M.project(F.col("x"), F.col("y"), F.col("z"), 525.0, 525.0, 320.0, 240.0)
    return li.select("l_orderkey", "l_linenumber", x.alias("x"), y.alias("y"), z.alias("z")).select("l_orderkey", "l_linenumber", r6("x").alias("x"), r6("y").alias("y"), F.round(u, 4).alias("u"), F.round(v, 4).alias("v"))


@REGISTRY.add("m05_distort_undistort", "SELECT vec_id, round(x * (1 + r2 * (0.1 + r2 * 0.01)) + 2 * 0.001 * x * y + 0.002 * (r2 + 2 * x * x), 6) AS dx, round(x, 5) AS ux, round(y, 5) AS uy FROM (SELECT vec_id, x, y, x * x + y * y AS r2 FROM (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings))")
def m05(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"))
    k = (0.1, 0.01, 0.001, 0.002)
    dx, dy = M.distort(F.col("x"), F.col("y"), *k)
    back = e.select("vec_id", dx.alias("dx"), dy.alias("dy")).withColumn("u", M.undistort(F.col("dx"), F.col("dy"), *k))
    return back.select("vec_id", r6("dx").alias("dx"), F.round("u.x", 5).alias("ux"), F.round("u.y", 5).alias("uy"))


@REGISTRY.add("m06_camera_model", """SELECT c_custkey, CASE WHEN d1 = 0 AND d2 = 0 THEN 'PINHOLE' WHEN d2 = 0 AND f THEN 'SIMPLE_RADIAL' ELSE 'OPENCV' END AS model FROM
 (SELECT c_custkey, c_custkey % 2 AS d1, c_custkey % 3 AS d2, c_custkey % 5 < 3 AS f FROM customer)""")
def m06(spark, sf):
    c = table(spark, sf, "customer")
    d = F.array((F.col("c_custkey") % 2).cast("double"), (F.col("c_custkey") % 3).cast("double"))
    return c.select("c_custkey", M.camera_model(d, F.col("c_custkey") % 5 < 3).alias("model"))


@REGISTRY.add("m07_time_conversion", "SELECT event_id, epoch_us(ts) * 1000 AS ns, round(epoch_us(ts) * 1000 / 1e9, 6) AS sec, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS iso FROM events")
def m07(spark, sf):
    e = table(spark, sf, "events").select("event_id", micros("ts").alias("us"))
    ns = M.stamp_ns(F.floor(F.col("us") / 1_000_000), (F.col("us") % 1_000_000) * 1000)
    return e.select("event_id", ns.alias("ns")).select("event_id", "ns", r6(M.seconds("ns")).alias("sec"), M.iso_utc("ns").alias("iso"))


@REGISTRY.add("m08_strings", "SELECT page_id, regexp_extract(url, '(\\d+)(\\.[^./]*)?$', 1) != '' AS numbered, len(string_split(lower(trim(url, '/')), '/')) AS segments FROM pages")
def m08(spark, sf):
    return table(spark, sf, "pages").select("page_id", M.frame_number("url").isNotNull().alias("numbered"), F.size(M.path_segments("url")).cast("long").alias("segments"))


@REGISTRY.add("m09_pair_id", "SELECT DISTINCT l_suppkey AS a, l_linenumber AS b, least(l_suppkey, l_linenumber) * 2147483647 + greatest(l_suppkey, l_linenumber) AS pair, least(l_suppkey, l_linenumber) AS first, greatest(l_suppkey, l_linenumber)::BIGINT AS second FROM lineitem")
def m09(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("a"), F.col("l_linenumber").alias("b")).distinct()
    return li.withColumn("pair", M.pair_id("a", "b")).withColumn("first", M.pair_first("pair")).withColumn("second", M.pair_second("pair"))


@REGISTRY.add("m10_math", "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN 1 ELSE -1 END AS sign, greatest(0, least(5000, c_acctbal)) AS clamped, round(1 / (1 + exp(-c_acctbal / 1000)), 6) AS sigmoid, round((2 * (c_acctbal / 1000) - 3) * (c_acctbal / 1000) + 1, 6) AS poly, round(radians(c_acctbal), 6) AS rad FROM customer")
def m10(spark, sf):
    b = F.col("c_acctbal")
    return table(spark, sf, "customer").select("c_custkey", M.sign(b).alias("sign"), M.clamp(b, 0.0, 5000.0).alias("clamped"), r6(M.sigmoid(b / 1000)).alias("sigmoid"), r6(M.polynomial([2.0, -3.0, 1.0], b / 1000)).alias("poly"), r6(F.radians(b)).alias("rad"))


@REGISTRY.add("m11_angles", f"WITH {QUAT} SELECT vec_id, round(acos(greatest(-1, least(1, (w0*t0+x0*t1+y0*t2) / (sqrt(w0*w0+x0*x0+y0*y0) * sqrt(t0*t0+t1*t1+t2*t2))))), 6) AS angle FROM n")
def m11(spark, sf):
    e = table(spark, sf, "embeddings")
    v = [F.get("embedding", F.lit(i)).cast("double") for i in (0, 1, 2, 4, 5, 6)]
    return e.select("vec_id", r6(M.angle_between(v[:3], v[3:])).alias("angle"))


@REGISTRY.add("m12_geodesy", """WITH g AS (SELECT c_custkey, radians((c_custkey * 7) % 170 - 85) AS p, radians((c_custkey * 11) % 360 - 180) AS q, c_acctbal AS h FROM customer),
k AS (SELECT *, 6378137.0 / sqrt(1 - (1/298.257223563) * (2 - 1/298.257223563) * sin(p) * sin(p)) AS n FROM g)
SELECT c_custkey, round((n + h) * cos(p) * cos(q), 3) + 0.0 AS x, round((n + h) * cos(p) * sin(q), 3) + 0.0 AS y, round((n * (1 - (1/298.257223563) * (2 - 1/298.257223563)) + h) * sin(p), 3) AS z, round(degrees(p), 6) AS lat, round(h, 3) AS alt FROM k""")
def m12(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", ((F.col("c_custkey") * 7) % 170 - 85).alias("lat"), ((F.col("c_custkey") * 11) % 360 - 180).alias("lon"), "c_acctbal")
    x, y, z = M.to_ecef("lat", "lon", "c_acctbal")
    c = c.select("c_custkey", x.alias("x"), y.alias("y"), z.alias("z")).withColumn("g", M.from_ecef(F.col("x"), F.col("y"), F.col("z")))
    return c.select("c_custkey", *[(F.round(k, 3) + 0.0).alias(k) for k in "xyz"], r6("g.lat").alias("lat"), F.round("g.alt", 3).alias("alt"))


@REGISTRY.add("m13_ransac_trials", "SELECT p_partkey, CASE WHEN i < 3 THEN NULL WHEN i >= n THEN 1 ELSE ceil(ln(0.01) / ln(1 - (i / n) * ((i - 1) / (n - 1)) * ((i - 2) / (n - 2))))::BIGINT END AS trials FROM (SELECT p_partkey, p_size + 2 AS i, 100 AS n FROM part)")
def m13(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", M.ransac_trials(F.col("p_size") + 2, F.lit(100), 3).alias("trials"))


@REGISTRY.add("m14_m15_confidence_sigma", "SELECT p_partkey, round(least(1.0, p_size / 50 * sqrt(p_size / 100)), 6) AS confidence, round(0.01 + 0.002 * (p_retailprice / 1000) * (p_retailprice / 1000), 6) AS sigma FROM part")
def m14(spark, sf):
    return table(spark, sf, "part").select("p_partkey", r6(M.confidence(F.col("p_size") / 50, F.col("p_size"))).alias("confidence"), r6(M.depth_sigma(F.col("p_retailprice") / 1000, 0.01, 0.002)).alias("sigma"))


@REGISTRY.add("m16_json_fields", "SELECT event_id, (props->>'$.k')::BIGINT AS k, coalesce((props->>'$.missing'), 'none') AS missing FROM events")
def m16(spark, sf):
    j = F.from_json("props", "struct<k:long,missing:string>")
    return table(spark, sf, "events").select("event_id", j["k"].alias("k"), F.coalesce(j["missing"], F.lit("none")).alias("missing"))


SLERP = (
    "e AS (SELECT vec_id, " + ", ".join(f"embedding[{i}]::DOUBLE / sqrt(" + " + ".join(f"embedding[{j}]::DOUBLE^2" for j in range(1, 5)) + f") AS q{i - 1}" for i in range(1, 5)) + ", " + ", ".join(f"embedding[{i + 5}]::DOUBLE AS t{i}" for i in range(3)) + " FROM embeddings), "
    "d AS (SELECT a.vec_id, " + " + ".join(f"a.q{i} * b.q{i}" for i in range(4)) + " AS d FROM e a JOIN e b ON b.vec_id = a.vec_id + 1), "
    "w AS (SELECT vec_id, CASE WHEN abs(d) > 1 - 1e-9 THEN 0.5 ELSE sin(0.5 * acos(least(1, abs(d)))) / sin(acos(least(1, abs(d)))) END AS w, CASE WHEN d < 0 THEN -1 ELSE 1 END AS side FROM d)"
)


@REGISTRY.add("m18_pose_interpolation", f"WITH {SLERP} SELECT vec_id, " + ", ".join(f"round(a.q{i} * w + b.q{i} * w * side, 6) AS q{i}" for i in range(4)) + ", " + ", ".join(f"round((a.t{i} + b.t{i}) / 2, 6) AS t{i}" for i in range(3)) + " FROM w JOIN e a USING (vec_id) JOIN e b ON b.vec_id = w.vec_id + 1")
def m18(spark, sf):
    p = _poses(spark, sf)
    nxt = p.select((F.col("vec_id") - 1).alias("vec_id"), F.col("q").alias("q2"), F.col("t").alias("t2"))
    unit = lambda q: F.transform(q, lambda v: v / M.norm([M.at(q, i) for i in range(4)]))
    q, t = M.lerp_pose(unit(F.col("q")), "t", unit(F.col("q2")), "t2", 0.5)
    return p.join(nxt, "vec_id").select("vec_id", q.alias("q"), t.alias("t")).select("vec_id", *[r6(M.at("q", i)).alias(f"q{i}") for i in range(4)], *[r6(M.at("t", i)).alias(f"t{i}") for i in range(3)])


@REGISTRY.add("c05_c06_depth_band_scale", "SELECT l_orderkey, l_linenumber, CASE WHEN d BETWEEN 0.3 AND 4.0 THEN d ELSE 0 END AS banded, trunc(greatest(0, least(65535, d * 1000)))::INT AS mm, trunc(greatest(0, least(1, d / 5)) * 255)::INT AS visual FROM (SELECT l_orderkey, l_linenumber, l_extendedprice / 10000 AS d FROM lineitem)")
def c05(spark, sf):
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 10000).alias("d"))
    return d.select("l_orderkey", "l_linenumber", M.depth_band("d", 0.3, 4.0).alias("banded"), M.depth_millimetres("d").alias("mm"), M.depth_visual("d", 5.0).alias("visual"))


@REGISTRY.add("c09_norm_band", f"WITH {QUAT} SELECT vec_id FROM n WHERE sqrt(w0*w0+x0*x0+y0*y0) BETWEEN 0.1 AND 0.3")
def c09(spark, sf):
    v = [F.get("embedding", F.lit(i)).cast("double") for i in range(3)]
    return table(spark, sf, "embeddings").where(M.norm(v).between(0.1, 0.3)).select("vec_id")


@REGISTRY.add("c10_grid_subsample", "SELECT e.vec_id, u, v, d FROM (SELECT vec_id, unnest(range(64))::INT AS i, unnest(embedding)::DOUBLE AS d FROM embeddings) e, LATERAL (SELECT i % 8 AS u, i // 8 AS v) WHERE u % 2 = 0 AND v % 2 = 0 AND d > 0.05 AND d < 0.2")
def c10(spark, sf):
    g = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "d"))
    u, v, d = F.col("i") % 8, F.expr("i div 8").cast("int"), F.col("d").cast("double")
    return g.select("vec_id", u.alias("u"), v.alias("v"), d.alias("d")).where("u % 2 = 0 and v % 2 = 0 and d > 0.05D and d < 0.2D")


@REGISTRY.add("c11_c12_pixel_bounds", "SELECT vec_id, round_even(u, 0)::INT AS pu, round_even(v, 0)::INT AS pv FROM (SELECT vec_id, embedding[3]::DOUBLE AS z, embedding[1]::DOUBLE / embedding[3]::DOUBLE * 100 + 50 AS u, embedding[2]::DOUBLE / embedding[3]::DOUBLE * 100 + 50 AS v FROM embeddings WHERE embedding[3] > 0) WHERE round_even(u, 0) BETWEEN 0 AND 99 AND round_even(v, 0) BETWEEN 0 AND 99")
def c11(spark, sf):
    x, y, z = (F.get("embedding", F.lit(i)).cast("double") for i in range(3))
    u, v = M.project(x, y, z, 100.0, 100.0, 50.0, 50.0)
    p = table(spark, sf, "embeddings").where(z > 0).select("vec_id", F.rint(u).alias("pu"), F.rint(v).alias("pv"))
    return p.where("pu between 0 and 99 and pv between 0 and 99").select("vec_id", F.col("pu").cast("int").alias("pu"), F.col("pv").cast("int").alias("pv"))
