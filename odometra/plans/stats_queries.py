"""Queries on robust statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats as S
from .common import Registry, r6, table

REGISTRY = Registry()
RATIO = "r AS (SELECT l_orderkey, l_suppkey, l_linenumber, l_extendedprice / l_quantity AS ratio, l_quantity AS q FROM lineitem)"
MAD = f"""{RATIO}, m AS (SELECT l_suppkey, median(ratio) AS m FROM r GROUP BY 1),
d AS (SELECT l_suppkey, any_value(m) AS m, median(abs(ratio - m)) AS d, count(*) AS n FROM r JOIN m USING (l_suppkey) GROUP BY 1)"""


def ratios(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_suppkey", "l_linenumber", (F.col("l_extendedprice") / F.col("l_quantity")).alias("ratio"), F.col("l_quantity").alias("q"))


@REGISTRY.add("e01_median", f"WITH {RATIO} SELECT l_suppkey, round(median(ratio), 6) AS median FROM r GROUP BY 1")
def e01(spark, sf):
    return ratios(spark, sf).groupBy("l_suppkey").agg(r6(S.quantile("ratio", 0.5)).alias("median"))


@REGISTRY.add("e02_mad", f"WITH {MAD} SELECT l_suppkey, round(m, 6) AS median, round(d, 6) AS mad, n FROM d")
def e02(spark, sf):
    return S.median_mad(ratios(spark, sf), "ratio", ["l_suppkey"]).select("l_suppkey", r6("median").alias("median"), r6("mad").alias("mad"), "n")


@REGISTRY.add(
    "e03_iqr_outliers",
    f"""WITH {RATIO}, q AS (SELECT l_suppkey, quantile_cont(ratio, 0.25) AS a, quantile_cont(ratio, 0.75) AS b FROM r GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_suppkey FROM r JOIN q USING (l_suppkey) WHERE ratio BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)""",
)
def e03(spark, sf):
    return S.iqr_inliers(ratios(spark, sf), "ratio", ["l_suppkey"]).select("l_orderkey", "l_linenumber", "l_suppkey")


@REGISTRY.add("e04_mad_outliers", f"WITH {MAD} SELECT l_orderkey, l_linenumber, l_suppkey FROM r JOIN d USING (l_suppkey) WHERE d = 0 OR abs(0.6745 * (ratio - m) / d) < 1.2")
def e04(spark, sf):
    return S.mad_inliers(ratios(spark, sf), "ratio", ["l_suppkey"], k=1.2).select("l_orderkey", "l_linenumber", "l_suppkey")


@REGISTRY.add(
    "e05_robust_mean",
    f"""WITH {RATIO}, q AS (SELECT l_suppkey, quantile_cont(ratio, 0.25) AS a, quantile_cont(ratio, 0.75) AS b, median(ratio) AS m, avg(ratio) AS p FROM r GROUP BY 1)
SELECT l_suppkey, round(any_value(m), 6) AS median, round(coalesce(avg(ratio) FILTER (ratio BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)), any_value(m)), 6) AS trimmed, round(any_value(p), 6) AS plain FROM r JOIN q USING (l_suppkey) GROUP BY 1""",
)
def e05(spark, sf):
    r, by = ratios(spark, sf), ["l_suppkey"]
    parts = [S.robust_mean(r, "ratio", by, m).select("l_suppkey", r6("value").alias(m)) for m in ("median", "trimmed", "plain")]
    return parts[0].join(parts[1], by).join(parts[2], by)


@REGISTRY.add("e06_robust_std", f"WITH {MAD}, s AS (SELECT l_suppkey, stddev_pop(ratio) AS s FROM r GROUP BY 1) SELECT l_suppkey, round(1.4826 * d, 6) AS robust, round(s, 4) AS plain FROM d JOIN s USING (l_suppkey)")
def e06(spark, sf):
    r, by = ratios(spark, sf), ["l_suppkey"]
    return S.robust_std(r, "ratio", by).select("l_suppkey", r6("value").alias("robust")).join(S.robust_std(r, "ratio", by, "std").select("l_suppkey", F.round("value", 4).alias("plain")), by)


@REGISTRY.add("e07_huber_weights", "SELECT l_returnflag, round(sum(CASE WHEN abs(l_quantity - 25) <= 1.345 THEN 1 ELSE 1.345 / abs(l_quantity - 25) END), 6) AS weight FROM lineitem GROUP BY 1")
def e07(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(r6(F.sum(S.huber_weight(F.col("l_quantity") - 25))).alias("weight"))


def _irls(n: int) -> str:
    w = "CASE WHEN abs(l_extendedprice / 1000 - (a * l_quantity + b)) <= 1.345 THEN 1 ELSE 1.345 / abs(l_extendedprice / 1000 - (a * l_quantity + b)) END"
    s = ["f0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, false AS stop)"]
    for k in range(n):
        weight = "1.0" if k == 0 else w
        stop = f"p.stop OR ({'false' if k == 0 else 'true'} AND greatest(abs(na - p.a), abs(nb - p.b)) < 1e-6)"
        s.append(
            f"""f{k + 1} AS (SELECT CASE WHEN p.stop THEN p.a ELSE na END AS a, CASE WHEN p.stop THEN p.b ELSE nb END AS b, {stop} AS stop FROM f{k} p,
 (SELECT (w * xy - x * y) / (w * xx - x * x) AS na, (xx * y - x * xy) / (w * xx - x * x) AS nb FROM
  (SELECT sum(w) AS w, sum(w * q) AS x, sum(w * e) AS y, sum(w * q * q) AS xx, sum(w * q * e) AS xy FROM
   (SELECT l_quantity AS q, l_extendedprice / 1000 AS e, {weight} AS w FROM lineitem, f{k}))))"""
        )
    return "WITH " + ",\n".join(s) + f" SELECT round(a, 5) AS slope, round(b, 5) AS intercept FROM f{n}"


@REGISTRY.add("e08_irls_regression", _irls(11))
def e08(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", (F.col("l_extendedprice") / 1000).alias("e"))
    a, b = S.irls_line(li, "l_quantity", "e")
    return spark.range(1).select(F.round(F.lit(a), 5).alias("slope"), F.round(F.lit(b), 5).alias("intercept"))


@REGISTRY.add(
    "e15_scale_diagnostics",
    f"""WITH {RATIO}, v AS (SELECT l_suppkey, CASE WHEN q > 5 AND (l_linenumber % 10) / 10 > 0.1 THEN ratio END AS v FROM r),
s AS (SELECT l_suppkey, median(v) AS m, stddev_pop(v) AS s FROM v GROUP BY 1)
SELECT l_suppkey, count(v) AS n_valid, count(*) - count(v) AS n_outliers, round(any_value(m), 6) AS median, round(any_value(s), 4) AS std, round(count(*) FILTER (abs(v - m) < 2 * s) / count(v), 6) AS within FROM v JOIN s USING (l_suppkey) GROUP BY 1""",
)
def e15(spark, sf):
    f = ratios(spark, sf).withColumn("n", F.when(F.col("q") > 5, 1).otherwise(0)).withColumn("c", F.col("l_linenumber") % 10 / 10)
    d = S.scale_diagnostics(f, by=["l_suppkey"], scale="ratio", n="n", confidence="c")
    return d.select("l_suppkey", "n_valid", "n_outliers", r6("median").alias("median"), F.round("std", 4).alias("std"), r6("within").alias("within"))


@REGISTRY.add(
    "e16_histogram",
    """WITH s AS (SELECT l_suppkey, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY 1),
t AS (SELECT l_suppkey, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM s),
c AS (SELECT l_suppkey, least(19, floor((l_quantity - lo) / (hi - lo) * 20))::INT AS bin, count(*) AS n FROM lineitem JOIN t USING (l_suppkey) GROUP BY ALL),
b AS (SELECT l_suppkey, unnest(range(20))::INT AS bin, lo, hi FROM t)
SELECT l_suppkey, bin, round(lo + bin * ((hi - lo) / 20), 6) AS low, round(lo + (bin + 1) * ((hi - lo) / 20), 6) AS high, coalesce(n, 0) AS n FROM b LEFT JOIN c USING (l_suppkey, bin)""",
)
def e16(spark, sf):
    h = S.histogram(table(spark, sf, "lineitem"), "l_quantity", 20, ["l_suppkey"])
    return h.select("l_suppkey", "bin", r6("low").alias("low"), r6("high").alias("high"), F.col("n").cast("long").alias("n"))


@REGISTRY.add("e19_percentiles_sample_variance", "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.9), 6) AS p90, round(avg(l_quantity), 6) AS mean, round(var_samp(l_quantity), 6) AS variance, round(stddev_samp(l_quantity), 6) AS std FROM lineitem GROUP BY 1")
def e19(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(r6(S.quantile("l_extendedprice", 0.9)).alias("p90"), r6(F.avg("l_quantity")).alias("mean"), r6(F.var_samp("l_quantity")).alias("variance"), r6(F.stddev_samp("l_quantity")).alias("std"))


def _box(axis: str) -> str:
    return f"{axis}s[(a + 1)::INT] AS min_{axis}, {axis}s[(b + 1)::INT] AS max_{axis}, round(list_sum({axis}s[(a + 1)::INT:(b + 1)::INT]) / (b - a + 1), 6) AS mean_{axis}"


@REGISTRY.add(
    "e20_trimmed_bounding_box",
    f"""WITH g AS (SELECT c_nationkey, count(*) AS n, list(c_acctbal ORDER BY c_acctbal) AS xs, list(c_custkey::DOUBLE ORDER BY c_custkey) AS ys FROM customer GROUP BY 1),
k AS (SELECT *, floor(0.1 * (n - 1)) AS a, ceil(0.9 * (n - 1)) AS b FROM g) SELECT c_nationkey, n, {_box("x")}, {_box("y")} FROM k""",
)
def e20(spark, sf):
    c = table(spark, sf, "customer").select("c_nationkey", F.col("c_acctbal").alias("x"), F.col("c_custkey").cast("double").alias("y"))
    b = S.trimmed_box(c, by=["c_nationkey"], xyz=["x", "y"], low=0.1, high=0.9)
    return b.select("c_nationkey", "n", *[c for a in "xy" for c in (f"min_{a}", f"max_{a}", r6(f"mean_{a}").alias(f"mean_{a}"))])


@REGISTRY.add("e23_error_summary", f"WITH {RATIO} SELECT l_suppkey, round(min(ratio), 6) AS min, round(max(ratio), 6) AS max, round(avg(ratio), 6) AS mean, round(median(ratio), 6) AS median, round(quantile_cont(ratio, 0.9), 6) AS p90, round(quantile_cont(ratio, 0.99), 6) AS p99 FROM r GROUP BY 1")
def e23(spark, sf):
    e = S.error_summary(ratios(spark, sf), "ratio", ["l_suppkey"])
    return e.select("l_suppkey", *[r6(c).alias(c) for c in ("min", "max", "mean", "median", "p90", "p99")])


@REGISTRY.add("e25_adaptive_threshold", f"WITH {MAD} SELECT l_suppkey, round(greatest(m - d, 1000), 6) AS threshold FROM d")
def e25(spark, sf):
    return S.adaptive_threshold(ratios(spark, sf), "ratio", 1000.0, ["l_suppkey"]).select("l_suppkey", r6("threshold").alias("threshold"))


@REGISTRY.add("e26_support_measures", "SELECT l_suppkey, count(*) FILTER (l_quantity <= 20) AS inliers, coalesce(sum(l_quantity) FILTER (l_quantity <= 20), 0) AS residual_sum, count(DISTINCT l_partkey) FILTER (l_quantity <= 20) AS unique_inliers, sum(least(l_quantity, 20)) AS truncated_loss FROM lineitem GROUP BY 1")
def e26(spark, sf):
    return S.support(table(spark, sf, "lineitem"), "l_quantity", 20, ["l_suppkey"], unique="l_partkey")


@REGISTRY.add("e27_database_counters", "SELECT count(*) AS n_images, (SELECT count(*) FROM lineitem) AS n_keypoints, (SELECT sum(l_linenumber) FROM lineitem)::BIGINT AS sum_rows, (SELECT max(l_linenumber) FROM lineitem) AS max_rows FROM orders")
def e27(spark, sf):
    images = table(spark, sf, "orders").agg(F.count("*").alias("n_images"))
    return images.crossJoin(table(spark, sf, "lineitem").agg(F.count("*").alias("n_keypoints"), F.sum("l_linenumber").alias("sum_rows"), F.max("l_linenumber").alias("max_rows")))


#: Largest eigenvalue of a symmetric 3 x 3 matrix in closed form; its vector is the longest cross product of two rows of M - value.
TOP_DIRECTION = """u AS (SELECT label, e[1] / n AS x, e[2] / n AS y, e[3] / n AS z FROM (SELECT label, embedding[1:3]::DOUBLE[] AS e, sqrt(embedding[1]::DOUBLE^2 + embedding[2]::DOUBLE^2 + embedding[3]::DOUBLE^2) AS n FROM embeddings) WHERE n > 0),
m AS (SELECT label, sum(x * x) AS a, sum(y * y) AS b, sum(z * z) AS c, sum(x * y) AS d, sum(y * z) AS e, sum(x * z) AS f, sum(x) AS sx, sum(y) AS sy, sum(z) AS sz, count(*) / 3 AS q FROM u GROUP BY 1),
p AS (SELECT *, sqrt(((a - q)^2 + (b - q)^2 + (c - q)^2 + 2 * (d * d + e * e + f * f)) / 6) AS p FROM m),
r AS (SELECT *, ((a - q) * ((b - q) * (c - q) - e * e) - d * (d * (c - q) - e * f) + f * (d * e - (b - q) * f)) / (2 * p^3) AS r FROM p),
l AS (SELECT *, q + 2 * p * cos(acos(greatest(-1, least(1, r))) / 3) AS l FROM r),
v AS (SELECT label, sx, sy, sz, unnest([[d * e - f * (b - l), f * d - (a - l) * e, (a - l) * (b - l) - d * d], [d * (c - l) - f * e, f * f - (a - l) * (c - l), (a - l) * e - d * f], [(b - l) * (c - l) - e * e, e * f - d * (c - l), d * e - (b - l) * f]]) AS v FROM l),
w AS (SELECT label, v, sqrt(v[1]^2 + v[2]^2 + v[3]^2) AS n, CASE WHEN v[1] * sx + v[2] * sy + v[3] * sz < 0 THEN -1 ELSE 1 END AS side FROM v QUALIFY row_number() OVER (PARTITION BY label ORDER BY v[1]^2 + v[2]^2 + v[3]^2 DESC) = 1)"""


@REGISTRY.add("e36_mean_direction", f"WITH {TOP_DIRECTION} SELECT label, " + ", ".join(f"round(v[{i + 1}] / n * side, 6) AS u{i}" for i in range(3)) + " FROM w")
def e36(spark, sf):
    e = table(spark, sf, "embeddings").select("label", *[F.get("embedding", F.lit(i)).cast("double").alias(f"v{i}") for i in range(3)])
    m = S.mean_unit_vector(e, by=["label"], vector=["v0", "v1", "v2"])
    return m.select("label", *[r6(f"u{i}").alias(f"u{i}") for i in range(3)])


@REGISTRY.add("e38_least_absolute")
def e38(spark, sf):
    """Per return flag and status: price per piece and what is left, least absolute deviations to the end."""
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", F.lit(1.0).alias("one"), (F.col("l_quantity") / 50).alias("quantity"), (F.col("l_extendedprice") / 100000).alias("price"))
    got = S.least_absolute_exact(li, by=["l_returnflag", "l_linestatus"], features=["one", "quantity"], target="price")
    return got.select("l_returnflag", "l_linestatus", *[r6(F.get("x", F.lit(i))).alias(f"x{i}") for i in range(2)], r6("loss").alias("loss"), "converged")


#: Rounds of progressive draws, and the pool in each, by its definition.
POOLS = """WITH RECURSIVE n AS (SELECT n_regionkey AS g, count(*)::INT AS total FROM nation GROUP BY 1),
p AS (SELECT g, total, 0 AS t, 3 AS pool, 1.0::DOUBLE AS until, 200000.0::DOUBLE * 6 / (total * (total - 1) * (total - 2)) AS worth FROM n
  UNION ALL SELECT g, total, t + 1, CASE WHEN t + 1 = until AND pool < total THEN pool + 1 ELSE pool END,
    CASE WHEN t + 1 = until AND pool < total THEN until + ceil(worth * (pool + 1) / (pool - 2) - worth) ELSE until END,
    CASE WHEN t + 1 = until AND pool < total THEN worth * (pool + 1) / (pool - 2) ELSE worth END FROM p WHERE t < 40)"""


@REGISTRY.add("e37_progressive", POOLS + " SELECT g AS region, t AS round, pool::BIGINT AS pool, until >= t AS newest FROM p WHERE t > 0")
def e37_progressive(spark, sf):
    return S.sampling_pools(table(spark, sf, "nation").withColumnRenamed("n_regionkey", "region"), by=["region"], sample=3, rounds=40)


@REGISTRY.add("e37_sample_combinations", "SELECT a.n_regionkey, a.n_nationkey AS c0, b.n_nationkey AS c1, c.n_nationkey AS c2 FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND b.n_nationkey > a.n_nationkey JOIN nation c ON c.n_regionkey = a.n_regionkey AND c.n_nationkey > b.n_nationkey")
def e37(spark, sf):
    return S.combinations(table(spark, sf, "nation"), "n_nationkey", 3, ["n_regionkey"])
