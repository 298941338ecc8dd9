"""Queries on fits and correspondences."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import similarity as S
from .common import Registry, r6, table

REGISTRY = Registry()
V = "v AS (SELECT vec_id, label, " + ", ".join(f"embedding[{i + 1}]::DOUBLE AS e{i}" for i in range(9)) + " FROM embeddings)"


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(9)])


@REGISTRY.add(
    "e09_scale_median",
    f"""WITH {V}, r AS (SELECT label, sqrt(e3*e3+e4*e4+e5*e5) / sqrt(e0*e0+e1*e1+e2*e2) AS r FROM v), m AS (SELECT label, median(r) AS m FROM r GROUP BY 1), d AS (SELECT label, any_value(m) AS m, median(abs(r - m)) AS d, count(*) AS n FROM r JOIN m USING (label) GROUP BY 1),
i AS (SELECT label, any_value(m) AS m, any_value(n) AS n, count(*) FILTER (abs(r - m) < 2.5 * d) / count(*) AS s FROM r JOIN d USING (label) GROUP BY 1) SELECT label, round(m, 6) AS scale, n, round(s, 6) AS inlier_ratio, round(least(1.0, s * sqrt(n / 100)), 6) AS confidence FROM i""",
)
def e09(spark, sf):
    got = S.scale_by_median(vectors(spark, sf), cam=["e0", "e1", "e2"], world=["e3", "e4", "e5"], by=["label"])
    return got.select("label", r6("scale").alias("scale"), "n", r6("inlier_ratio").alias("inlier_ratio"), r6("confidence").alias("confidence"))


def known_pairs(spark, sf):
    """Targets made from sources by scale 1.5, a quarter turn about z and a shift that depends on the label."""
    v = vectors(spark, sf)
    return v.select("vec_id", "label", "e0", "e1", "e2", (F.col("e1") * -1.5 + F.col("label")).alias("q0"), (F.col("e0") * 1.5 + 2).alias("q1"), (F.col("e2") * 1.5 - 1).alias("q2"))


@REGISTRY.add("e10_e11_similarity_fit", "SELECT label, count(*) AS n, 1.5::DOUBLE AS scale, 0.0::DOUBLE AS r0, -1.0::DOUBLE AS r1, 1.0::DOUBLE AS r3, label::DOUBLE AS t0, 2.0::DOUBLE AS t1, -1.0::DOUBLE AS t2 FROM embeddings GROUP BY label")
def e10(spark, sf):
    f = S.similarity_fit(known_pairs(spark, sf), source=["e0", "e1", "e2"], target=["q0", "q1", "q2"], by=["label"])
    return f.select("label", "n", *[(F.round(c, 6) + 0.0).alias(c) for c in ("scale", "r0", "r1", "r3", "t0", "t1", "t2")])


@REGISTRY.add("e12_scale_ransac")
def e12(spark, sf):
    got = S.scale_by_ransac(vectors(spark, sf), cam=["e0", "e1", "e2"], world=["e3", "e4", "e5"], by=["label"], order=["vec_id"])
    return got.withColumn("scale", r6("scale"))


PROJECTED = f"""{V}, p AS (SELECT vec_id % 5 AS image, vec_id AS point, e0 AS x, e1 AS y, e2 + 2 AS z FROM v), q AS (SELECT *, x / z * 60 + 32 AS u, y / z * 60 + 24 AS v FROM p),
g AS (SELECT image, u, v, 3 + 0.2 * (((u * 7 + v * 13 + image) % 10) / 10) - 0.1 AS depth FROM range(5) a(image), range(64) b(u), range(48) c(v)),
j AS (SELECT q.image, point, z AS depth, g.depth AS measured FROM q JOIN g ON g.image = q.image AND g.u = round_even(q.u, 0) AND g.v = round_even(q.v, 0))"""


def projected(spark, sf):
    v = vectors(spark, sf)
    p = v.select((F.col("vec_id") % 5).alias("image"), F.col("vec_id").alias("point"), F.col("e0").alias("x"), F.col("e1").alias("y"), (F.col("e2") + 2).alias("z"))
    eye = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]
    poses = spark.range(5).select(F.col("id").alias("image"), *[F.lit(x).alias(f"r{i}") for i, x in enumerate(eye)], *[F.lit(0.0).alias(f"t{i}") for i in range(3)])
    return S.project_points(p, poses, image="image", fx=60.0, fy=60.0, cx=32.0, cy=24.0)


def measured(spark):
    g = spark.range(5).select(F.col("id").alias("image"), F.explode(F.sequence(F.lit(0), F.lit(63))).alias("u")).select("image", "u", F.explode(F.sequence(F.lit(0), F.lit(47))).alias("v"))
    return g.withColumn("depth", 3 + 0.2 * (((F.col("u") * 7 + F.col("v") * 13 + F.col("image")) % 10) / 10) - 0.1)


@REGISTRY.add("d09_depth_correspondences", f"WITH {PROJECTED} SELECT image, point, round(depth, 6) AS depth, round(measured, 6) AS measured FROM j WHERE abs(measured - depth * 1.5) < 0.05 * (depth * 1.5)")
def d09(spark, sf):
    p = projected(spark, sf).withColumn("k", F.lit(1.5))
    return S.match_depth(p, measured(spark), image="image", tolerance=0.05, scale="k").select("image", "point", r6("depth").alias("depth"), r6("measured").alias("measured"))


@REGISTRY.add("e14_frame_scale_ratios", f"WITH {PROJECTED} SELECT image, round(median(measured / depth), 6) AS ratio, count(*) AS n FROM j GROUP BY 1 HAVING count(*) >= 50")
def e14(spark, sf):
    return S.frame_scales(projected(spark, sf), measured(spark), image="image").withColumn("ratio", r6("ratio"))


@REGISTRY.add(
    "e13_global_scale",
    f"""WITH {PROJECTED}, f AS (SELECT image, median(measured / depth) AS r, count(*) AS n FROM j GROUP BY 1), gg AS (SELECT median(measured / depth) AS r FROM j),
k AS (SELECT j.*, coalesce(CASE WHEN f.n >= 50 THEN f.r END, gg.r) AS c FROM j JOIN f USING (image), gg) SELECT round(median(measured / depth), 6) AS scale, count(*) AS n FROM k WHERE abs(measured - depth * c) < 0.1 * (depth * c)""",
)
def e13(spark, sf):
    p, m = projected(spark, sf), measured(spark)
    per = S.frame_scales(p, m, image="image").select("image", "ratio")
    all_ratio = S.match_depth(p, m, image="image", tolerance=1e9).agg(F.percentile(F.col("measured") / F.col("depth"), F.lit(0.5)).alias("g"))
    k = p.join(per, "image", "left").crossJoin(all_ratio).withColumn("k", F.coalesce("ratio", "g"))
    got = S.match_depth(k, m, image="image", tolerance=0.1, scale="k")
    return got.agg(r6(F.percentile(F.col("measured") / F.col("depth"), F.lit(0.5))).alias("scale"), F.count("*").alias("n"))


@REGISTRY.add(
    "d10_observation_build",
    f"""WITH {PROJECTED}, l AS (SELECT q.image, point, z, j2.measured FROM q LEFT JOIN (SELECT image, point, measured FROM j) j2 USING (image, point)), f AS (SELECT image, median(measured / z) AS r, count(measured) AS n FROM l GROUP BY 1), gg AS (SELECT median(measured / z) AS r FROM l),
k AS (SELECT l.*, coalesce(CASE WHEN f.n >= 5 THEN f.r END, gg.r, 1) * z AS e FROM l JOIN f USING (image), gg) SELECT image, point, round(CASE WHEN abs(measured - e) < 0.05 * e THEN measured ELSE -1 END, 6) AS obs_depth, round(CASE WHEN abs(measured - e) < 0.05 * e THEN 0.01 + 0.002 * measured * measured ELSE 0 END, 6) AS sigma FROM k""",
)
def d10(spark, sf):
    p = projected(spark, sf)
    got = S.observations_with_depth(p.select("image", "point"), p, measured(spark), image="image", point="point", tolerance=0.05, base_sigma=0.01, quad_sigma=0.002)
    return got.select("image", "point", r6("obs_depth").alias("obs_depth"), r6("sigma").alias("sigma"))


@REGISTRY.add("h12_chained_products", "SELECT c_nationkey, c_custkey, round(exp(sum(ln(1 + (c_custkey % 7) / 100)) OVER (PARTITION BY c_nationkey ORDER BY c_custkey)), 6) AS product FROM customer")
def h12(spark, sf):
    w = Window.partitionBy("c_nationkey").orderBy("c_custkey").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return table(spark, sf, "customer").select("c_nationkey", "c_custkey", r6(F.product(1 + (F.col("c_custkey") % 7) / 100).over(w)).alias("product"))


#: Segments of one customer each that turn about z. The SQL follows the chain pose by pose: own fit, then the rigid motion that restores the step between the boundary poses.
SEGMENTS = """g AS (SELECT c_nationkey AS k, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS i, c_custkey, 1 + (c_custkey % 7) / 100 AS s, (c_custkey % 11) / 10 AS f, (c_custkey % 5)::DOUBLE AS tx, (c_custkey % 3)::DOUBLE AS ty,
c_acctbal / 1007 AS fx, (c_custkey % 13)::DOUBLE AS fy, c_acctbal / 1007 + 0.5 AS lx, (c_custkey % 13) + 0.25 AS ly FROM customer),
h AS (SELECT k, i, s, f AS a, tx AS dx, ty AS dy, lx, ly FROM g WHERE i = 1
UNION ALL SELECT k, i, s, a0, px + cos(a0 - f) * tx - sin(a0 - f) * ty - (cos(a0 - f) * cx - sin(a0 - f) * cy), py + sin(a0 - f) * tx + cos(a0 - f) * ty - (sin(a0 - f) * cx + cos(a0 - f) * cy), lx, ly FROM (
SELECT g.k, g.i, g.s, g.f, g.tx, g.ty, g.lx, g.ly, h.a AS a0, h.s * (cos(h.a) * h.lx - sin(h.a) * h.ly) + h.dx + cos(h.a) * (fx - h.lx) - sin(h.a) * (fy - h.ly) AS px, h.s * (sin(h.a) * h.lx + cos(h.a) * h.ly) + h.dy + sin(h.a) * (fx - h.lx) + cos(h.a) * (fy - h.ly) AS py,
g.s * (cos(g.f) * fx - sin(g.f) * fy) + g.tx AS cx, g.s * (sin(g.f) * fx + cos(g.f) * fy) + g.ty AS cy FROM h JOIN g ON g.k = h.k AND g.i = h.i + 1))"""


@REGISTRY.add("h12_chained_transforms", f"WITH RECURSIVE {SEGMENTS} SELECT c_custkey, round(h.s, 6) AS scale, round(cos(a), 6) AS r0, round(sin(a), 6) AS r3, round(dx, 5) + 0.0 AS t0, round(dy, 5) + 0.0 AS t1 FROM h JOIN g USING (k, i)")
def h12_transforms(spark, sf):
    key, a = F.col("c_custkey"), F.col("c_custkey") % 11 / 10
    turn = [F.cos(a), -F.sin(a), F.lit(0.0), F.sin(a), F.cos(a), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)]
    x, y = F.col("c_acctbal") / 1007, (key % 13).cast("double")
    c = table(spark, sf, "customer").select("c_nationkey", "c_custkey", (1 + key % 7 / 100).alias("scale"), *[r.alias(f"r{i}") for i, r in enumerate(turn)], (key % 5).cast("double").alias("t0"), (key % 3).cast("double").alias("t1"), F.lit(1.0).alias("t2"), x.alias("fx"), y.alias("fy"), F.lit(2.0).alias("fz"), (x + 0.5).alias("lx"), (y + 0.25).alias("ly"), F.lit(2.0).alias("lz"))
    got = S.chain_transforms(c, by=["c_nationkey"], order="c_custkey", first=["fx", "fy", "fz"], last=["lx", "ly", "lz"])
    return got.select("c_custkey", *[r6(k).alias(k) for k in ("scale", "r0", "r3")], *[(F.round(k, 5) + 0.0).alias(k) for k in ("t0", "t1")])


@REGISTRY.add("i06_i07_segment_correction", f"WITH {V} SELECT vec_id, round(-1.5 * e1 + label, 5) + 0.0 AS x, round(1.5 * e0 + 2, 5) + 0.0 AS y, round(1.5 * e2 - 1, 5) + 0.0 AS z FROM v")
def i06(spark, sf):
    k = known_pairs(spark, sf)
    fits = S.similarity_fit(k, source=["e0", "e1", "e2"], target=["q0", "q1", "q2"], by=["label"]).where("n >= 20")
    rows = k.select("vec_id", "label", F.col("e0").alias("x"), F.col("e1").alias("y"), F.col("e2").alias("z"))
    return S.apply_segment_fits(rows, fits, by=["label"], xyz=["x", "y", "z"]).select("vec_id", *[(F.round(c, 5) + 0.0).alias(c) for c in "xyz"])


@REGISTRY.add("i08_low_confidence_segments", f"WITH {V}, r AS (SELECT label, sqrt(e3*e3+e4*e4+e5*e5) / sqrt(e0*e0+e1*e1+e2*e2) AS r FROM v), m AS (SELECT label, median(r) AS m FROM r GROUP BY 1), d AS (SELECT label, any_value(m) AS m, median(abs(r - m)) AS d, count(*) AS n FROM r JOIN m USING (label) GROUP BY 1), i AS (SELECT label, any_value(n) AS n, count(*) FILTER (abs(r - m) < 2.5 * d) / count(*) AS s FROM r JOIN d USING (label) GROUP BY 1) SELECT label FROM i WHERE least(1.0, s * sqrt(n / 100)) < 0.57")
def i08(spark, sf):
    got = S.scale_by_median(vectors(spark, sf), cam=["e0", "e1", "e2"], world=["e3", "e4", "e5"], by=["label"])
    return got.where("confidence < 0.57").select("label")


def surface_points(spark, sf):
    return table(spark, sf, "lineitem").select((F.col("l_suppkey") % 10).alias("model"), F.col("l_quantity").alias("x"), (F.floor(F.col("l_linenumber") / 3) + F.col("l_discount") / 5).alias("y"), (F.col("l_extendedprice") / 1000).alias("z"), F.col("l_suppkey").alias("image"), F.col("l_discount").alias("v"))


#: The layers that the heights are made of, as bands.
LAYERS = """o AS (SELECT l_suppkey % 10 AS model, l_suppkey AS image, floor(l_linenumber / 3) AS layer, l_quantity AS x, floor(l_linenumber / 3) + l_discount / 5 AS y, l_extendedprice / 1000 AS z, l_discount FROM lineitem),
la AS (SELECT model, layer, row_number() OVER (PARTITION BY model ORDER BY layer) - 1 AS band, count(*) AS n, min(y) AS low, max(y) AS high, avg(y) AS height, min(x) AS x0, max(x) AS x1, min(z) AS z0, max(z) AS z1 FROM o GROUP BY 1, 2 HAVING count(*) >= 100)"""


@REGISTRY.add("i09_planar_bands", f"WITH {LAYERS} SELECT model, band, n, round(low, 6) AS low, round(high, 6) AS high, round(height, 6) AS height, x0, x1, round(z0, 6) AS z0, round(z1, 6) AS z1, true AS level FROM la")
def i09(spark, sf):
    got = S.planar_bands(surface_points(spark, sf), by=["model"], min_points=100)
    flat = (F.col("residual") < 0.01) & (F.col("verticality") > 0.999)
    return got.select("model", "band", "n", *[r6(c).alias(c) for c in ("low", "high", "height")], "x0", "x1", r6("z0").alias("z0"), r6("z1").alias("z1"), flat.alias("level"))


@REGISTRY.add(
    "i11_footprint_overlap",
    """WITH d AS (SELECT DISTINCT l_linenumber AS k, l_suppkey AS i, floor(l_quantity / 51 * 8) * 8 + floor(l_discount / 0.11 * 8) AS c FROM lineitem), n AS (SELECT k, i, count(*) AS n FROM d GROUP BY ALL),
m AS (SELECT a.k AS a, b.k AS b, i, count(*) AS m FROM d a JOIN d b USING (i, c) WHERE a.k < b.k GROUP BY ALL), s AS (SELECT x.k AS a, y.k AS b, x.i AS i, x.n AS na FROM n x JOIN n y ON x.i = y.i AND x.k < y.k)
SELECT a, b, count(*) AS frames, round(avg(coalesce(m, 0) / na), 6) AS overlap FROM s LEFT JOIN m USING (a, b, i) GROUP BY ALL HAVING count(*) >= 5""",
)
def i11(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("k"), F.col("l_suppkey").alias("i"), F.col("l_quantity").alias("u"), F.col("l_discount").alias("v"))
    return S.footprint_overlap(li, cluster="k", image="i", u="u", v="v", width=51.0, height=0.11, cells=8).withColumn("overlap", r6("overlap"))


@REGISTRY.add("l07_align_merge", "SELECT c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS merged_from, c_nationkey::DOUBLE AS x, round(-c_acctbal / 1007, 4) + 0.0 AS y, (c_custkey % 13)::DOUBLE AS z FROM customer")
def l07(spark, sf):
    """Two models of customers as images, a third of them in both; the second is half as large, turned a quarter about z and moved. The merged one is turned to have x upwards."""
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"), (F.col("c_custkey") % 13).cast("double").alias("x"), (-F.col("c_acctbal") / 1007).alias("y"), (-F.col("c_nationkey")).cast("double").alias("z"))
    first = c.where("c_custkey % 3 != 0").drop("c_custkey")
    second = c.where("c_custkey % 3 != 1").select("name", (F.col("y") * -0.5 + 7).alias("x"), (F.col("x") * 0.5 - 2).alias("y"), (F.col("z") * 0.5 + 1).alias("z"))
    merged = S.orient_model(S.merge_models(first, second, key="name", xyz=["x", "y", "z"]), xyz=["x", "y", "z"], up=[1.0, 0.0, 0.0])
    return merged.select("name", "merged_from", *[(F.round(k, 4) + 0.0).alias(k) for k in "xyz"])


@REGISTRY.add("l08_normalised_extent", "WITH g AS (SELECT c_nationkey, min(c_acctbal) AS a, max(c_acctbal) AS b FROM customer GROUP BY 1) SELECT c_custkey, round((c_acctbal - (a + b) / 2) / (b - a) * 10, 6) AS x FROM customer JOIN g USING (c_nationkey)")
def l08(spark, sf):
    c = table(spark, sf, "customer")
    g = c.groupBy("c_nationkey").agg(F.min("c_acctbal").alias("a"), F.max("c_acctbal").alias("b"))
    return c.join(g, "c_nationkey").select("c_custkey", r6((F.col("c_acctbal") - (F.col("a") + F.col("b")) / 2) / (F.col("b") - F.col("a")) * 10).alias("x"))


@REGISTRY.add("l10_relative_pose_errors", f"WITH {V} SELECT a.vec_id, round(sqrt((b.e0-a.e0)^2+(b.e1-a.e1)^2+(b.e2-a.e2)^2), 6) AS dt, round(degrees(acos(greatest(-1, least(1, (a.e0*b.e0+a.e1*b.e1+a.e2*b.e2) / (sqrt(a.e0*a.e0+a.e1*a.e1+a.e2*a.e2) * sqrt(b.e0*b.e0+b.e1*b.e1+b.e2*b.e2)))))), 5) AS angle FROM v a JOIN v b ON b.vec_id = a.vec_id + 1")
def l10(spark, sf):
    from ..functions.scalar import angle_between

    a = vectors(spark, sf).select("vec_id", "e0", "e1", "e2")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), *[F.col(f"e{i}").alias(f"f{i}") for i in range(3)])
    j = a.join(b, "vec_id")
    x, y = [F.col(f"e{i}") for i in range(3)], [F.col(f"f{i}") for i in range(3)]
    dt = F.sqrt(sum(((q - p) * (q - p) for p, q in zip(x, y, strict=True)), F.lit(0.0)))
    return j.select("vec_id", r6(dt).alias("dt"), F.round(F.degrees(angle_between(x, y)), 5).alias("angle"))


@REGISTRY.add("e35_point_cloud_proxy", f"WITH {PROJECTED} SELECT image, round_even(u, 0)::INT AS u, round_even(v, 0)::INT AS v, round(min(z), 6) AS depth FROM q GROUP BY ALL")
def e35(spark, sf):
    p = projected(spark, sf).select("image", "u", "v", F.col("depth").alias("d")).withColumnsRenamed({"u": "uu", "v": "vv"})
    return Q.rasterize(p, by=["image"], u=F.col("uu"), v=F.col("vv"), z="d").withColumn("depth", r6("depth"))
