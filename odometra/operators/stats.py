"""Robust statistics per group, each as one or two grouped aggregations."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import discard, materialize
from ..shipping import ship_package


def quantile(x: str | Column, q: float) -> Column:
    """Exact, with linear interpolation."""
    return F.percentile(x, F.lit(q))


def with_group(rows: DataFrame, by: Sequence[str], **aggregates: Column) -> DataFrame:
    """rows with their group's aggregates; combined before the shuffle, and the join can split a hot group."""
    if not by:
        return rows.crossJoin(rows.agg(*[c.alias(k) for k, c in aggregates.items()]))  # one row
    return rows.join(rows.groupBy(*by).agg(*[c.alias(k) for k, c in aggregates.items()]), list(by))


def median_mad(rows: DataFrame, x: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, median, mad) with mad the median of distances from the median."""
    m = with_group(rows.where(F.col(x).isNotNull()), by, __m=quantile(x, 0.5))
    return m.groupBy(*by).agg(F.first("__m").alias("median"), quantile(F.abs(F.col(x) - F.col("__m")), 0.5).alias("mad"), F.count("*").alias("n"))


def iqr_inliers(rows: DataFrame, x: str, by: Sequence[str] = (), k: float = 1.5) -> DataFrame:
    q = with_group(rows, by, __q=F.percentile(x, F.array(F.lit(0.25), F.lit(0.75))))
    low, high = F.get("__q", F.lit(0)), F.get("__q", F.lit(1))
    return q.where(F.col(x).between(low - k * (high - low), high + k * (high - low))).drop("__q")


def mad_inliers(rows: DataFrame, x: str, by: Sequence[str] = (), k: float = 3.0) -> DataFrame:
    """Rows with 0.6745 * distance / mad below k; all where mad is 0."""
    m = median_mad(rows, x, by).select(*by, F.col("median").alias("__m"), F.col("mad").alias("__d"))
    joined = rows.join(m, list(by)) if by else rows.crossJoin(m)
    near = F.abs(0.6745 * (F.col(x) - F.col("__m")) / F.when(F.col("__d") > 0, F.col("__d"))) < k
    return joined.where((F.col("__d") == 0) | near).drop("__m", "__d")


def robust_mean(rows: DataFrame, x: str, by: Sequence[str] = (), method: str = "median") -> DataFrame:
    """(by, value): median, trimmed (mean of IQR inliers, median if none) or plain mean; 0 for no values."""
    if method == "median":
        return rows.groupBy(*by).agg(F.coalesce(quantile(x, 0.5), F.lit(0.0)).alias("value"))
    if method == "trimmed":
        q = with_group(rows, by, __q=F.percentile(x, F.array(F.lit(0.25), F.lit(0.75))))
        low, high = F.get("__q", F.lit(0)), F.get("__q", F.lit(1))
        inside = F.col(x).between(low - 1.5 * (high - low), high + 1.5 * (high - low))
        return q.groupBy(*by).agg(F.coalesce(F.avg(F.when(inside, F.col(x))), quantile(x, 0.5), F.lit(0.0)).alias("value"))
    return rows.groupBy(*by).agg(F.coalesce(F.avg(x), F.lit(0.0)).alias("value"))


def robust_std(rows: DataFrame, x: str, by: Sequence[str] = (), method: str = "mad") -> DataFrame:
    if method == "mad":
        return median_mad(rows, x, by).select(*by, F.coalesce(1.4826 * F.col("mad"), F.lit(0.0)).alias("value"))
    return rows.groupBy(*by).agg(F.coalesce(F.stddev_pop(x), F.lit(0.0)).alias("value"))


def huber_weight(residual: str | Column, c: float = 1.345) -> Column:
    a = F.abs(F.col(residual) if isinstance(residual, str) else residual)
    return F.when(a <= c, 1.0).otherwise(c / F.when(a > c, a))


def irls_line(rows: DataFrame, x: str, y: str, *, c: float = 1.345, rounds: int = 10, tolerance: float = 1e-6) -> tuple[float, float]:
    """(slope, intercept) by iteratively reweighted least squares with Huber weights.

    Each round is one aggregation of five weighted sums; only those reach the driver.
    """
    a = b = 0.0
    for k in range(rounds + 1):
        w = F.lit(1.0) if k == 0 else huber_weight(F.col(y) - (a * F.col(x) + b), c)
        s = rows.agg(F.sum(w), F.sum(w * F.col(x)), F.sum(w * F.col(y)), F.sum(w * F.col(x) * F.col(x)), F.sum(w * F.col(x) * F.col(y))).first()
        if s[0] is None:
            return 0.0, 0.0
        det = s[0] * s[3] - s[1] * s[1]
        if abs(det) < 1e-30:
            return 0.0, s[2] / s[0]
        new = (s[0] * s[4] - s[1] * s[2]) / det, (s[3] * s[2] - s[1] * s[4]) / det
        moved, (a, b) = max(abs(new[0] - a), abs(new[1] - b)), new
        if k and moved < tolerance:
            break
    return a, b


def histogram(rows: DataFrame, x: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """(by, bin, low, high, n): equal bins over the range, the last closed on the right, empty bins too.

    A range of a single value spans half a unit either side.
    """
    span = rows.where(F.col(x).isNotNull()).groupBy(*by).agg(F.min(x).alias("__lo"), F.max(x).alias("__hi"))
    flat = F.col("__lo") == F.col("__hi")
    span = span.select(*by, F.when(flat, F.col("__lo") - 0.5).otherwise(F.col("__lo")).alias("__lo"), F.when(flat, F.col("__hi") + 0.5).otherwise(F.col("__hi")).alias("__hi"))
    placed = (rows.join(span, list(by)) if by else rows.crossJoin(span)).where(F.col(x).isNotNull())
    place = F.least(F.lit(bins - 1), F.floor((F.col(x) - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins)).cast("int")
    counts = placed.groupBy(*by, place.alias("bin")).agg(F.count("*").alias("n"))
    all_bins = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("__hi") - F.col("__lo")) / bins
    return all_bins.join(counts, [*by, "bin"], "left").select(*by, "bin", (F.col("__lo") + F.col("bin") * width).alias("low"), (F.col("__lo") + (F.col("bin") + 1) * width).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def scale_diagnostics(frames: DataFrame, *, by: Sequence[str], scale: str, n: str, confidence: str) -> DataFrame:
    """Median and spread of valid estimates (n > 0, confidence > 0.1), counts, and the share within two sigma."""
    valid = (F.col(n) > 0) & (F.col(confidence) > 0.1)
    marked = with_group(frames.withColumn("__v", F.when(valid, F.col(scale))), by, __m=quantile("__v", 0.5), __s=F.stddev_pop("__v"))
    near = F.abs(F.col("__v") - F.col("__m")) < 2 * F.col("__s")
    return marked.groupBy(*by).agg(F.count("__v").alias("n_valid"), (F.count("*") - F.count("__v")).alias("n_outliers"), F.first("__m").alias("median"), F.first("__s").alias("std"), (F.count_if(near) / F.count("__v")).alias("within"))


def trimmed_box(points: DataFrame, *, by: Sequence[str], xyz: Sequence[str], low: float, high: float) -> DataFrame:
    """Per axis the order statistics at ranks floor(low * (n - 1)) and ceil(high * (n - 1)), and the mean between them.

    Axes are rows of their own, so that each is sorted by itself, on disk where it is large.
    """
    long = points.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("axis"), F.col(c).cast("double").alias("v")) for c in xyz])).alias("__x")).select(*by, "__x.axis", "__x.v").where("v is not null")
    w = Window.partitionBy(*by, "axis")
    placed = long.withColumn("n", F.count("*").over(w)).withColumn("k", F.row_number().over(w.orderBy("v")) - 1)
    inside = placed.where(F.col("k").between(F.floor(F.lit(low) * (F.col("n") - 1)), F.ceil(F.lit(high) * (F.col("n") - 1))))
    kinds = {"min": F.min, "max": F.max, "mean": F.avg}
    return inside.groupBy(*by).agg(F.max("n").alias("n"), *[f(F.when(F.col("axis") == c, F.col("v"))).alias(f"{name}_{c}") for c in xyz for name, f in kinds.items()])


def error_summary(rows: DataFrame, x: str, by: Sequence[str] = ()) -> DataFrame:
    q = F.percentile(x, F.array(F.lit(0.5), F.lit(0.9), F.lit(0.99)))
    return rows.groupBy(*by).agg(F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"), q.alias("__q")).select(*by, "min", "max", "mean", *[F.get("__q", F.lit(i)).alias(k) for i, k in enumerate(("median", "p90", "p99"))])


def support(rows: DataFrame, residual: str, limit: float, by: Sequence[str] = (), unique: str | None = None) -> DataFrame:
    """Inliers (residual <= limit), their residual sum, distinct inliers, and the truncated loss."""
    inside = F.col(residual) <= limit
    return rows.groupBy(*by).agg(
        F.count_if(inside).alias("inliers"),
        F.coalesce(F.sum(F.when(inside, F.col(residual))), F.lit(0.0)).alias("residual_sum"),
        *([F.count_distinct(F.when(inside, F.col(unique))).alias("unique_inliers")] if unique else []),
        F.sum(F.least(F.col(residual), F.lit(float(limit)))).alias("truncated_loss"),
    )


def adaptive_threshold(rows: DataFrame, x: str, floor: float, by: Sequence[str] = ()) -> DataFrame:
    """max(median - mad, floor)."""
    return median_mad(rows, x, by).select(*by, F.greatest(F.col("median") - F.col("mad"), F.lit(floor)).alias("threshold"))


def mean_unit_vector(rows: DataFrame, *, by: Sequence[str], vector: Sequence[str], weight: str | None = None) -> DataFrame:
    """(by, x..): direction that has the largest weighted sum of squared cosines, signed like the weighted mean.

    The outer products are summed by Spark; one small symmetric matrix per group is solved.
    """
    w = F.col(weight) if weight else F.lit(1.0)
    n = len(vector)
    length = F.sqrt(sum((F.col(v) * F.col(v) for v in vector), F.lit(0.0)))
    unit = [F.col(v) / length for v in vector]
    cells = [F.sum(w * unit[i] * unit[j]).alias(f"m{i}_{j}") for i in range(n) for j in range(i, n)] + [F.sum(w * u).alias(f"s{i}") for i, u in enumerate(unit)]
    sums = rows.where(length > 0).groupBy(*by).agg(*cells)

    def solve(batches):
        for pdf in batches:
            m = np.zeros((len(pdf), n, n))
            for i in range(n):
                for j in range(i, n):
                    m[:, i, j] = m[:, j, i] = pdf[f"m{i}_{j}"]
            top = np.linalg.eigh(m)[1][:, :, -1] if len(pdf) else np.zeros((0, n))
            side = np.einsum("ij,ij->i", top, pdf[[f"s{i}" for i in range(n)]].to_numpy()) if len(pdf) else np.zeros(0)
            top = top * np.where(side < 0, -1.0, 1.0)[:, None]
            yield pd.concat([pdf[list(by)].reset_index(drop=True), pd.DataFrame(top, columns=[f"u{i}" for i in range(n)])], axis=1)

    schema = ", ".join([f"{k} {t}" for k, t in rows.select(*by).dtypes] + [f"u{i} double" for i in range(n)])
    return sums.mapInPandas(solve, schema)


def combinations(items: DataFrame, key: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    """All k-subsets of a group's keys in increasing order, as a chain of joins; for the small groups of a sampler."""
    out = items.select(*by, F.col(key).alias("c0"))
    for i in range(1, k):
        step = items.select(*by, F.col(key).alias(f"c{i}"))
        out = (out.join(step, list(by)) if by else out.crossJoin(step)).where(F.col(f"c{i}") > F.col(f"c{i - 1}"))
    return out


#: Rounds of least absolute deviations after which the rows' state is written.
WRITTEN = 5


def least_absolute(rows: DataFrame, *, by: Sequence[str], features: Sequence[str], target: str, rho: float = 1.0, alpha: float = 1.0, rounds: int = 1000, absolute: float = 1e-4, relative: float = 1e-2, ridge: float = 0.0) -> DataFrame:
    """(by, x, loss, rounds, converged): per group the x that makes the sum of |features . x - target| least.

    By the alternating direction method: the normal equations of a group are summed and
    inverted once; each round then is one pass over the rows, whose sums per group give x by
    that inverse, and a shrink step that stays with the rows. What rows hold follows from the x
    of the rounds before, and is written every WRITTEN rounds only. Groups leave when the primal and the dual
    residual are within the absolute and relative tolerance. Rows with a null take no part;
    groups with fewer rows than features, or whose equations have no single solution, have x null.
    """
    by, k = list(by), len(features)
    a = F.array(*[F.col(f).cast("double") for f in features])
    held = rows.select(*by, a.alias("a"), F.col(target).cast("double").alias("b")).where(~F.exists("a", lambda v: v.isNull()) & F.col("b").isNotNull())
    ship_package(rows.sparkSession)
    sums = held.groupBy(*by).agg(F.count("*").alias("n"), F.sqrt(F.sum(F.col("b") * F.col("b"))).alias("b_norm"), *[F.sum(F.get("a", F.lit(i)) * F.get("a", F.lit(j))).alias(f"m{i}_{j}") for i in range(k) for j in range(i, k)])

    def inverted(batches):
        for pdf in batches:
            m = np.zeros((len(pdf), k, k))
            for i in range(k):
                for j in range(i, k):
                    m[:, i, j] = m[:, j, i] = pdf[f"m{i}_{j}"]
            out = []
            for n, one in zip(pdf["n"], m + ridge * np.eye(k), strict=True):
                fits = n >= k and np.isfinite(one).all() and np.linalg.matrix_rank(one, hermitian=True) == k
                out.append(np.linalg.inv(one).ravel().tolist() if fits else None)
            yield pdf[[*by, "n", "b_norm"]].assign(inverse=out)

    kinds = ", ".join(f"{c} {t}" for c, t in rows.select(*by).dtypes)
    groups = materialize(sums.mapInPandas(inverted, f"{kinds}, n long, b_norm double, inverse array<double>"))
    row = [*by, *[F.get("a", F.lit(i)).alias(f"a{i}") for i in range(k)], "b"]
    state = materialize(held.join(groups.where("inverse is not null").select(*by), by, "left_semi").select(*row, F.lit(0.0).alias("z"), F.lit(0.0).alias("u")))
    found, pending = None, []
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    each = lambda value: [F.sum(F.col(f"a{i}") * value) for i in range(k)]
    size = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))

    def stepped(rows: DataFrame, x: DataFrame) -> DataFrame:
        """rows after a round with the x of their groups."""
        moved = rows.join(x.select(*by, *[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(k)]), by).withColumn("ax", sum((F.col(f"a{i}") * F.col(f"x{i}") for i in range(k)), F.lit(0.0)))
        gap = alpha * F.col("ax") + (1 - alpha) * (F.col("z") + F.col("b")) - F.col("b") + F.col("u")
        new = F.least(gap + 1 / rho, F.lit(0.0)) + F.greatest(gap - 1 / rho, F.lit(0.0))
        return moved.withColumn("gap", gap).withColumn("new", new).select(*by, *[f"a{i}" for i in range(k)], "b", "ax", F.col("z").alias("z0"), F.col("new").alias("z"), (F.col("gap") - F.col("new")).alias("u"))

    right = state.groupBy(*by).agg(F.array(*each(F.col("b"))).alias("right"))
    for step in range(1, rounds + 1):
        x = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: dot(F.slice("inverse", i * k + 1, F.lit(k)), F.col("right")))
        pending.append(materialize(right.join(groups.select(*by, "inverse"), by).select(*by, x.alias("x"))))
        following = reduce(stepped, pending, state)
        left = F.col("ax") - F.col("z") - F.col("b")
        norms = following.groupBy(*by).agg(
            F.sum(F.abs(F.col("ax") - F.col("b"))).alias("loss"), F.sqrt(F.sum(left * left)).alias("r"), F.sqrt(F.sum(F.col("ax") * F.col("ax"))).alias("ax_norm"), F.sqrt(F.sum(F.col("z") * F.col("z"))).alias("z_norm"),
            F.array(*each(F.col("z") - F.col("z0"))).alias("dz"), F.array(*each(F.col("u"))).alias("au"), F.array(*each(F.col("b") + F.col("z") - F.col("u"))).alias("right")
        ).join(groups.select(*by, "n", "b_norm"), by).join(pending[-1], by)
        near = (F.col("r") < F.sqrt("n") * absolute + relative * F.greatest("ax_norm", "z_norm", "b_norm")) & (rho * size(F.col("dz")) < k**0.5 * absolute + relative * rho * size(F.col("au")))
        judged = materialize(norms.select(*by, "x", "loss", F.lit(step).alias("rounds"), near.alias("converged"), "right"))
        done = judged if step == rounds else judged.where("converged")
        some = not done.isEmpty()
        if some:
            done = done.drop("right")
            found = done if found is None else found.unionByName(done)
        right = judged.where("not converged").select(*by, "right")
        if step == rounds or right.isEmpty():
            break
        if some or len(pending) == WRITTEN:
            written = materialize(following.select(*state.columns).join(right.select(*by), by, "left_semi"))
            discard(state, *pending)
            state, pending = written, []
    discard(state)
    results = groups.select(*by) if found is None else groups.select(*by).join(found, by, "left")
    if found is None:
        results = results.select(*by, F.lit(None).cast("array<double>").alias("x"), F.lit(None).cast("double").alias("loss"), F.lit(None).cast("int").alias("rounds"), F.lit(None).cast("boolean").alias("converged"))
    return results.withColumn("converged", F.coalesce("converged", F.lit(False)))


#: Rows with a sign to be decided that a task takes for a group at once, four times as many in each round after so many; and steps of a line search, in parts of the way to the model's least.
UNDECIDED, GROWS, STEPS = 1 << 14, 6, (64.0, 16.0, 4.0, 2.0, 1.0, 0.5, 0.25, 1 / 16, 1 / 64)


def _corner(a: np.ndarray, b: np.ndarray, w: np.ndarray, g: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, bool]:
    """An x that makes sum(w |a x - b|) + g x least, found from x along edges, each to its least, and whether it does; where that goes without end, some x on the way.

    Targets are moved apart by parts in 10^10 of their scale, so that no more rows than unknowns
    meet in a corner; the rows that meet in the last one give x by their own targets.
    """
    k, held = a.shape[1], []
    size = np.abs(a).sum(axis=1)
    scale = size * max(1.0, np.abs(x).max(initial=0.0)) + np.abs(b)
    moved = b + 1e-10 * scale * (np.random.default_rng(1).random(len(b)) - 0.5)
    nothing = 1e-12 * (np.abs(g).sum() + (w * size).sum())
    for _ in range(100 + 40 * len(b)):
        r = a @ x - moved
        r[held] = 0.0
        slope = g + a.T @ (w * np.sign(r))
        if len(held) < k:
            d = -slope
            if held:
                q = np.linalg.qr(a[held].T)[0]
                d = d - q @ (q.T @ d)
            if flat := np.linalg.norm(d) <= nothing:
                if not held:
                    return x, True
                d = np.linalg.svd(a[held])[2][len(held)]
        else:
            pull = np.linalg.solve(a[held].T, -slope)
            over, flat = np.abs(pull) / w[held], False
            j = int(over.argmax())
            if over[j] <= 1 + 1e-9:
                return np.linalg.solve(a[held], b[held]), True
            e = np.zeros(k)
            e[j] = np.sign(pull[j])
            d = np.linalg.solve(a[held], e)
            slope = slope + w[held[j]] * e[j] * a[held[j]]
            held.pop(j)
        move = a @ d
        move[np.abs(move) <= 1e-13 * size * np.abs(d).max()] = 0.0
        move[held] = 0.0
        if flat and not (r * move < 0).any():
            d, move = -d, -move
        ahead = np.flatnonzero(r * move < 0)
        if not len(ahead):
            far = max(np.abs(r).max() / max(size.max(), 1e-300), 1e-6 * max(1.0, np.abs(x).max()))
            return x + far / np.abs(d).max() * d, False
        t = -r[ahead] / move[ahead]
        order = np.argsort(t, kind="stable")
        past = slope @ d + np.cumsum(2 * (w * np.abs(move))[ahead[order]])
        at = min(int(np.searchsorted(past, 0.0)), len(order) - 1)
        x = x + t[order[at]] * d
        if past[at] < 0:
            break
        held.append(int(ahead[order[at]]))
    return x, False


def least_absolute_exact(rows: DataFrame, *, by: Sequence[str], features: Sequence[str], target: str, rounds: int | None = None) -> DataFrame:
    """(by, x, loss, rounds, converged): per group an x that makes the sum of |features . x - target| least, to the end.

    Rows far from the present x keep their sign, so that they are sums, counted by powers of two
    of their distance; the nearest, UNDECIDED at most (or all at the least distance), go to a task per group, which
    makes these and the sums least exactly, along edges. No sum of absolute values is below that, so
    where the loss of all rows is equal to it, x is the least of all (converged). Else the best of
    some steps towards it is the next round's x, and where none is better the next round's steps
    are shorter. After GROWS rounds more rows are taken each time, so that at the latest a round
    with all of them ends it. A round is three passes over the rows, which are not shuffled. rounds: none, or a bound. Nulls, small groups and groups without a
    single solution of their normal equations are as in least_absolute().
    """
    by, k = list(by), len(features)
    ship_package(rows.sparkSession)
    a = F.array(*[F.col(f).cast("double") for f in features])
    held = rows.select(*by, a.alias("a"), F.col(target).cast("double").alias("b")).where(~F.exists("a", lambda v: v.isNull()) & F.col("b").isNotNull())
    held = materialize(held.select(*by, *[F.get("a", F.lit(i)).alias(f"a{i}") for i in range(k)], "b"))
    cells = [(i, j) for i in range(k) for j in range(i, k)]
    sums = held.groupBy(*by).agg(F.count("*").alias("n"), *[F.sum(F.col(f"a{i}") * F.col(f"a{j}")).alias(f"m{i}_{j}") for i, j in cells], *[F.sum(F.col(f"a{i}") * F.col("b")).alias(f"c{i}") for i in range(k)])

    def begun(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                one = np.zeros((k, k))
                for i, j in cells:
                    one[i, j] = one[j, i] = getattr(r, f"m{i}_{j}")
                fits = r.n >= k and np.isfinite(one).all() and np.linalg.matrix_rank(one, hermitian=True) == k
                out.append(np.linalg.solve(one, [getattr(r, f"c{i}") for i in range(k)]).tolist() if fits else None)
            yield pdf[by].assign(x=out)

    kinds = ", ".join(f"{c} {t}" for c, t in rows.select(*by).dtypes)
    groups = materialize(sums.mapInPandas(begun, f"{kinds}, x array<double>"))
    now, found, step = groups.where("x is not null").withColumn("short", F.lit(1.0)), None, 0
    dot = lambda x: sum((F.col(f"a{i}") * F.get(x, F.lit(i)) for i in range(k)), F.lit(0.0))
    names = [f"a{i}" for i in range(k)]

    def least(key: tuple, near: pd.DataFrame, far: pd.DataFrame) -> pd.DataFrame:
        if not len(far):
            return pd.DataFrame(columns=[*by, "x", "to", "model", "short"])
        x, one = np.array(far["x"].iloc[0]), far.iloc[0]
        g = np.array([one[f"g{i}"] for i in range(k)])
        na, nb, nw = near[names].to_numpy(float), near["b"].to_numpy(float), near["w"].to_numpy(float)
        to, ends = _corner(na, nb, nw, g, x)
        model = float((nw * np.abs(na @ to - nb)).sum() + g @ to - one["gb"]) if ends else -math.inf
        return pd.DataFrame({**{c: [v] for c, v in zip(by, key, strict=True)}, "x": [x.tolist()], "to": [to.tolist()], "model": [model], "short": [one["short"]]})

    while not now.isEmpty() and (rounds is None or step < rounds):
        step += 1
        r = dot("x") - F.col("b")
        placed = held.join(now, by).withColumn("r", r).withColumn("bin", F.when(F.col("r") == 0, -1100).otherwise(F.greatest(F.lit(-45), F.floor(F.log2(F.abs("r"))))).cast("int"))
        signed = F.signum("r")
        bins = materialize(placed.groupBy(*by, "bin").agg(F.count("*").alias("n"), *[F.sum(signed * F.col(c)).alias(f"g{i}") for i, c in enumerate(names)], F.sum(signed * F.col("b")).alias("gb")))
        upto = bins.withColumn("upto", F.sum("n").over(Window.partitionBy(*by).orderBy("bin")))
        lowest = F.min("bin")
        limit = UNDECIDED * 4 ** max(0, step - GROWS)
        edge = materialize(upto.groupBy(*by).agg(F.coalesce(F.max(F.when(F.col("upto") <= limit, F.col("bin"))), lowest).alias("edge")))
        outer = bins.join(edge, by).groupBy(*by).agg(*[F.sum(F.when(F.col("bin") > F.col("edge"), F.col(c)).otherwise(0.0)).alias(c) for c in (*[f"g{i}" for i in range(k)], "gb")])
        near = placed.join(edge, by).where("bin <= edge").groupBy(*by, *names, "b").agg(F.count("*").alias("w"))
        to = materialize(near.groupBy(*by).cogroup(outer.join(now, by).groupBy(*by)).applyInPandas(least, f"{kinds}, x array<double>, to array<double>, model double, short double"))
        at = lambda t: F.zip_with("x", "to", lambda p, q: p + F.lit(t) * F.col("short") * (q - p))
        tried = held.join(to.select(*by, "to", *[at(t).alias(f"x{i}") for i, t in enumerate((0.0, *STEPS))]), by)
        losses = tried.groupBy(*by).agg(F.sum(F.abs(dot("to") - F.col("b"))).alias("whole"), *[F.sum(F.abs(dot(f"x{i}") - F.col("b"))).alias(f"f{i}") for i in range(len(STEPS) + 1)])
        best = F.array_min(F.array(*[F.struct(F.col(f"f{i}").alias("loss"), F.lit(-i).alias("place"), at(t).alias("x")) for i, t in enumerate((0.0, *STEPS))]))
        judged = to.join(losses, by).withColumn("converged", F.col("whole") - F.col("model") <= 1e-11 * F.greatest("whole", F.lit(1e-300)))
        judged = judged.withColumn("best", best).withColumn("short", F.when(F.col("best.loss") < F.col("f0") * (1 - 1e-14), 1.0).otherwise(F.col("short") / 1024))
        last = F.lit(rounds is not None and step == rounds) | (F.col("short") < 1e-15)  # steps are less than rounding
        done = materialize(judged.select(*by, F.when(F.col("converged"), F.col("to")).otherwise(F.col("best.x")).alias("x"), F.when(F.col("converged"), F.col("whole")).otherwise(F.col("best.loss")).alias("loss"), F.lit(step).alias("rounds"), "converged", "short", (F.col("converged") | last).alias("out")))
        over = done.where("out").drop("out", "short")
        found = over if found is None else found.unionByName(over)
        discard(bins, edge, to)
        now = done.where("not out").select(*by, "x", "short")
    discard(held)
    if found is None:
        return groups.select(*by, F.lit(None).cast("array<double>").alias("x"), F.lit(None).cast("double").alias("loss"), F.lit(None).cast("int").alias("rounds"), F.lit(False).alias("converged"))
    return groups.select(*by).join(found, by, "left").withColumn("converged", F.coalesce("converged", F.lit(False)))


#: Draws after which the whole table is the pool.
PROGRESSIVE_DRAWS = 200_000


def progressive_pools(total: int, sample: int, rounds: int, draws: int = PROGRESSIVE_DRAWS) -> tuple[np.ndarray, np.ndarray]:
    """(pool, newest) of each round: the first so many rows by quality are drawn from, and whether the one behind them must be in the sample.

    The pool grows by a row when the draws that its size is worth are used up: a sample within
    the first n of all rows comes as often as it would among `draws` samples of all.
    """
    worth = draws * float(np.prod([(sample - i) / (total - i) for i in range(sample)]))
    pool, until = sample, 1.0
    pools, newest = np.zeros(rounds, np.int64), np.zeros(rounds, bool)
    for t in range(1, rounds + 1):
        if t == until and pool < total:
            more = worth * (pool + 1) / (pool + 1 - sample)
            until += np.ceil(more - worth)
            worth, pool = more, pool + 1
        pools[t - 1], newest[t - 1] = pool, until >= t
    return pools, newest


def sampling_pools(rows: DataFrame, *, by: Sequence[str], sample: int, rounds: int) -> DataFrame:
    """(by, round, pool, newest) of the progressive sampler for groups of rows; groups smaller than a sample have none."""
    ship_package(rows.sparkSession)
    kinds = ", ".join(f"{c} {t}" for c, t in rows.select(*by).dtypes)

    def run(batches):
        for pdf in batches:
            for r in pdf.to_dict("records"):
                pools, newest = progressive_pools(r["total"], sample, rounds)
                yield pd.DataFrame({**{c: [r[c]] * rounds for c in by}, "round": np.arange(1, rounds + 1, dtype=np.int32), "pool": pools, "newest": newest})

    sizes = rows.groupBy(*by).agg(F.count("*").alias("total")).where(F.col("total") >= sample)
    return sizes.mapInPandas(run, f"{kinds}, round int, pool long, newest boolean")


def progressive_draws(total: int, sample: int, rounds: int, seed: int) -> np.ndarray:
    """Places (from 0, by quality) of each round's sample: a row a round. Fewer rows than a sample are all taken."""
    if total <= sample:
        return np.tile(np.arange(total), (rounds, 1))
    rng, out = np.random.default_rng(seed), np.zeros((rounds, sample), np.int64)
    for t, (pool, newest) in enumerate(zip(*progressive_pools(total, sample, rounds), strict=True)):
        if newest:
            out[t, :-1] = rng.choice(pool - 1, sample - 1, replace=False)
            out[t, -1] = min(pool, total - 1)
        else:
            out[t] = rng.choice(pool, sample, replace=False)
    return out
