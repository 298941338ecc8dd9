"""Scale and similarity-transform fits, correspondences between models and depth, per-segment corrections."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import materialize
from ..shipping import ship_package
from .pairs import dense_ids
from .stats import progressive_draws, quantile, with_group

_AXES = ("x", "y", "z")


def norm(names: Sequence[str]) -> Column:
    return F.sqrt(sum((F.col(c) * F.col(c) for c in names), F.lit(0.0)))


def confidence(ratio: Column, n: Column) -> Column:
    return F.least(F.lit(1.0), ratio * F.sqrt(n / 100.0))


def scale_by_median(pairs: DataFrame, *, cam: Sequence[str], world: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, scale, n, inlier_ratio, confidence) from ratios of norms; fewer than three valid rows give scale 1 and nothing else.

    A row is valid if both norms are positive. Inliers lie strictly within 2.5 times the
    median distance from the median.
    """
    valid = pairs.withColumn("__c", norm(cam)).withColumn("__w", norm(world))
    ratio = F.when((F.col("__c") > 1e-12) & (F.col("__w") > 1e-12), F.col("__w") / F.when(F.col("__c") > 1e-12, F.col("__c")))
    m = with_group(valid.withColumn("__r", ratio), by, __m=quantile("__r", 0.5))
    d = with_group(m.withColumn("__d", F.abs(F.col("__r") - F.col("__m"))), by, __mad=quantile("__d", 0.5))
    g = d.groupBy(*by).agg(F.first("__m").alias("scale"), F.count("__r").alias("n"), F.count_if(F.col("__d") < 2.5 * F.col("__mad")).alias("inliers"))
    few = F.col("n") < 3
    share = F.when(few, 0.0).otherwise(F.col("inliers") / F.when(F.col("n") > 0, F.col("n")))
    return g.select(*by, F.when(few, 1.0).otherwise(F.col("scale")).alias("scale"), "n", share.alias("inlier_ratio"), F.when(few, 0.0).otherwise(confidence(share, F.col("n"))).alias("confidence"))


def similarity_fit(pairs: DataFrame, *, source: Sequence[str], target: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, n, scale, r0..r8, t0..t2): the least-squares similarity target = scale * R source + t.

    Spark sums counts, means and cross products, combined before the shuffle; only a 3x3
    matrix per group is decomposed, in batches.
    """
    ship_package(pairs.sparkSession)
    s, t = [F.col(c) for c in source], [F.col(c) for c in target]
    aggregates = [F.count("*").alias("n")]
    aggregates += [F.avg(c).alias(f"s{i}") for i, c in enumerate(s)] + [F.avg(c).alias(f"t{i}") for i, c in enumerate(t)]
    means = pairs.groupBy(*by).agg(*aggregates)
    # centred before the products: sums of raw squares would cancel
    m = means.withColumnsRenamed({c: f"__{c}" for c in [*[f"s{i}" for i in range(3)], *[f"t{i}" for i in range(3)], "n"]})
    centred = pairs.join(m, list(by)) if by else pairs.crossJoin(m)
    cross = [F.avg((t[i] - F.col(f"__t{i}")) * (s[j] - F.col(f"__s{j}"))).alias(f"c{3 * i + j}") for i in range(3) for j in range(3)]
    spread = F.avg(sum(((c - F.col(f"__s{i}")) * (c - F.col(f"__s{i}")) for i, c in enumerate(s)), F.lit(0.0))).alias("var")
    sums = centred.groupBy(*by).agg(F.first("__n").alias("n"), *[F.first(f"__{a}{i}").alias(f"{a}{i}") for a in "st" for i in range(3)], *cross, spread)

    def solve(batches):
        for pdf in batches:
            k = len(pdf)
            if not k:
                yield pd.DataFrame(columns=[*by, "n", "scale", *[f"r{i}" for i in range(9)], "t0", "t1", "t2"])
                continue
            c = pdf[[f"c{i}" for i in range(9)]].to_numpy().reshape(k, 3, 3)
            u, d, vt = np.linalg.svd(c)
            sign = np.ones((k, 3))
            sign[np.linalg.det(u) * np.linalg.det(vt) < 0, 2] = -1
            r = np.einsum("kij,kj,kjl->kil", u, sign, vt)
            var = pdf["var"].to_numpy()
            scale = np.where(var > 0, (d * sign).sum(axis=1) / np.where(var > 0, var, 1), 1.0)
            a, b = pdf[["s0", "s1", "s2"]].to_numpy(), pdf[["t0", "t1", "t2"]].to_numpy()
            move = b - scale[:, None] * np.einsum("kij,kj->ki", r, a)
            out = pdf[[*by, "n"]].reset_index(drop=True)
            out["scale"] = scale
            for i in range(9):
                out[f"r{i}"] = r.reshape(k, 9)[:, i]
            for i in range(3):
                out[f"t{i}"] = move[:, i]
            yield out

    schema = ", ".join([f"{k} {v}" for k, v in pairs.select(*by).dtypes] + ["n long", "scale double"] + [f"r{i} double" for i in range(9)] + [f"t{i} double" for i in range(3)])
    return sums.mapInPandas(solve, schema)


def moved(columns: Sequence[str | Column]) -> list[Column]:
    """scale * R v + t of a joined fit."""
    v = [F.col(c) if isinstance(c, str) else c for c in columns]
    return [F.col("scale") * sum((F.col(f"r{3 * i + j}") * v[j] for j in range(3)), F.lit(0.0)) + F.col(f"t{i}") for i in range(3)]


def fit_quality(pairs: DataFrame, fits: DataFrame, *, source: Sequence[str], target: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, n, scale, inlier_ratio, confidence): inliers have a residual strictly below twice the median residual."""
    f = fits.withColumnRenamed("n", "__n")
    joined = pairs.join(f, list(by)) if by else pairs.crossJoin(f)
    p = moved(source)
    res = F.sqrt(sum(((F.col(c) - p[i]) * (F.col(c) - p[i]) for i, c in enumerate(target)), F.lit(0.0)))
    m = with_group(joined.withColumn("__res", res), by, __med=quantile("__res", 0.5))
    g = m.groupBy(*by).agg(F.count("*").alias("n"), F.first("scale").alias("scale"), (F.count_if(F.col("__res") < 2 * F.col("__med")) / F.count("*")).alias("inlier_ratio"))
    return g.withColumn("confidence", confidence(F.col("inlier_ratio"), F.col("n")))


def scale_by_ransac(pairs: DataFrame, *, cam: Sequence[str], world: Sequence[str], by: Sequence[str], order: Sequence[str], rounds: int = 1000, sample: int = 3, tolerance: float = 0.05, seed: int = 42, sampler: str = "random") -> DataFrame:
    """(by, scale, inliers, n): the best median of `sample` ratios over seeded draws, the first of equals.

    With the sampler "progressive", order is that of quality, the best first: draws come from a
    pool of the best rows that grows with the rounds. No row leaves for it but those drawn.

    A row is valid if both norms are positive; draws are places of valid rows in `order`, and
    take what there is where fewer than `sample` are valid. A ratio is an inlier of a candidate
    if it differs by less than `tolerance` of it. n and the share are of valid rows; groups of
    fewer than three rows have scale 1 and no inliers. Only drawn ratios and, per group and
    interval between the candidates' limits, counts of ratios leave the rows' partitions.
    """
    if sampler not in ("random", "progressive"):
        raise ValueError(f"unknown sampler {sampler}")
    ship_package(pairs.sparkSession)
    c, w = norm(cam), norm(world)
    valid = pairs.withColumn("__c", c).withColumn("__w", w).where("__c > 0 and __w > 0")
    # places in a group from one range-sorted numbering of all rows: no group is sorted in one task
    kept = materialize(valid.select(*by, F.struct(*order).alias("__order"), (F.col("__w") / F.col("__c")).alias("ratio")))
    numbered = materialize(dense_ids(kept, [*by, "__order"], out="__k"))
    firsts = numbered.groupBy(*by).agg((F.min("__k") - 1).alias("__before"))
    ratios = materialize(numbered.join(firsts, list(by)).select(*by, (F.col("__k") - F.col("__before")).cast("int").alias("__k"), "ratio"))
    totals = pairs.groupBy(*by).agg(F.count("*").alias("__total")).join(ratios.groupBy(*by).agg(F.count("*").alias("n")), list(by), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    draws = totals.where("__total >= 3 and n > 0")
    keys = ", ".join(f"{k} {t}" for k, t in pairs.select(*by).dtypes)

    def draw(batches):
        for pdf in batches:
            for _, row in pdf.iterrows():
                if sampler == "progressive":
                    places = progressive_draws(row["n"], sample, rounds, seed)
                else:
                    rng = np.random.default_rng(seed)
                    places = np.array([rng.choice(row["n"], min(sample, row["n"]), replace=False) for _ in range(rounds)])
                yield pd.DataFrame({**{k: [row[k]] * places.size for k in by}, "round": np.repeat(np.arange(rounds), places.shape[1]), "__k": places.ravel() + 1})

    drawn = draws.select(*by, "n").mapInPandas(draw, f"{keys}, round int, __k int").join(ratios, [*by, "__k"])
    candidates = materialize(drawn.groupBy(*by, "round").agg(F.percentile("ratio", F.lit(0.5)).alias("candidate")))
    limits = candidates.groupBy(*by).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array(F.col("candidate") * (1 - tolerance), F.col("candidate") * (1 + tolerance)))))).alias("limits"))

    def place(batches):
        for pdf in batches:
            at = [(np.searchsorted(x, r, "left"), np.searchsorted(x, r, "right")) for x, r in zip(pdf["limits"], pdf["ratio"], strict=True)]
            yield pdf[list(by)].assign(left=[i for i, _ in at], right=[j for _, j in at])

    placed = ratios.join(limits, list(by)).select(*by, "limits", "ratio").mapInPandas(place, f"{keys}, left int, right int")
    # how many ratios are below a limit (right: limits at or below the ratio), and how many at or below it
    counted = placed.groupBy(*by, "left", "right").agg(F.count("*").alias("m")).groupBy(*by).agg(F.collect_list(F.struct("left", "right", "m")).alias("counts"))
    ready = candidates.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("round", "candidate"))).alias("c")).join(limits, list(by)).join(counted, list(by))

    def best(batches):
        for pdf in batches:
            got = []
            for c, x, counts in zip(pdf["c"], pdf["limits"], pdf["counts"], strict=True):
                x, size = np.asarray(x), len(x) + 1
                left, right = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
                for k in counts:
                    left[k["left"]] += k["m"]
                    right[k["right"]] += k["m"]
                at_most, below = np.cumsum(left), np.cumsum(right)  # ratios <= x[i], ratios < x[i]
                values = np.array([k["candidate"] for k in c])
                low, high = np.searchsorted(x, values * (1 - tolerance)), np.searchsorted(x, values * (1 + tolerance))
                inliers = below[high] - at_most[low]
                k = int(np.argmax(inliers))
                got.append((values[k], inliers[k]) if inliers[k] > 0 else (1.0, 0))
            yield pd.concat([pdf[list(by)].reset_index(drop=True), pd.DataFrame(got, columns=["scale", "inliers"])], axis=1)

    found = ready.mapInPandas(best, f"{keys}, scale double, inliers long")
    out = totals.join(found, list(by), "left")
    return out.select(*by, F.coalesce("scale", F.lit(1.0)).alias("scale"), F.coalesce("inliers", F.lit(0)).cast("long").alias("inliers"), F.when(F.col("__total") >= 3, F.col("n")).otherwise(0).cast("long").alias("n"))


def estimate_scale(pairs: DataFrame, *, method: str, cam: Sequence[str], world: Sequence[str], by: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """(by, scale, n, ..) by `median`, `umeyama` (the scale of a similarity fit) or `ransac`."""
    if method == "median":
        return scale_by_median(pairs, cam=cam, world=world, by=by)
    if method == "umeyama":
        return fit_quality(pairs, similarity_fit(pairs, source=cam, target=world, by=by), source=cam, target=world, by=by)
    if method == "ransac":
        r = scale_by_ransac(pairs, cam=cam, world=world, by=by, order=order or [*cam, *world])
        return r.withColumn("inlier_ratio", F.when(F.col("n") > 0, F.col("inliers") / F.col("n")).otherwise(0.0)).withColumn("confidence", confidence(F.col("inlier_ratio"), F.col("n")))
    raise ValueError(f"unknown method {method}")


def project_points(points: DataFrame, poses: DataFrame, *, image: str, fx: float, fy: float, cx: float, cy: float) -> DataFrame:
    """Points (with image and x, y, z) in their image: u, v, depth, for those in front; poses: image, r0..r8, t0..t2 world to camera."""
    p = points.join(poses, image)
    cam = [sum((F.col(f"r{3 * i + j}") * F.col(_AXES[j]) for j in range(3)), F.lit(0.0)) + F.col(f"t{i}") for i in range(3)]
    front = p.withColumn("__x", cam[0]).withColumn("__y", cam[1]).withColumn("depth", cam[2]).where(F.col("depth") > 0)
    return front.withColumn("u", F.col("__x") / F.col("depth") * fx + cx).withColumn("v", F.col("__y") / F.col("depth") * fy + cy).drop("__x", "__y", *[f"r{i}" for i in range(9)], *[f"t{i}" for i in range(3)])


def match_depth(projected: DataFrame, measured: DataFrame, *, image: str, tolerance: float, scale: str | None = None) -> DataFrame:
    """Projected points with the measured depth of their rounded pixel, where it agrees within tolerance of the expected depth.

    An equi-join on image and pixel; scale, if given, is a column that expected depths are multiplied by.
    """
    pixel = projected.withColumn("__u", F.rint("u").cast("int")).withColumn("__v", F.rint("v").cast("int"))
    m = measured.select(F.col(image), F.col("u").alias("__u"), F.col("v").alias("__v"), F.col("depth").alias("measured")).where(F.col("measured") > 0)
    expected = F.col("depth") * (F.col(scale) if scale else 1.0)
    return pixel.join(m, [image, "__u", "__v"]).where(F.abs(F.col("measured") - expected) < tolerance * expected).drop("__u", "__v")


def frame_scales(projected: DataFrame, measured: DataFrame, *, image: str, min_points: int = 50) -> DataFrame:
    """(image, ratio, n): median of measured over projected depth per image with min_points or more."""
    pixel = projected.withColumn("__u", F.rint("u").cast("int")).withColumn("__v", F.rint("v").cast("int"))
    m = measured.select(F.col(image), F.col("u").alias("__u"), F.col("v").alias("__v"), F.col("depth").alias("measured")).where(F.col("measured") > 0)
    r = pixel.join(m, [image, "__u", "__v"]).withColumn("__r", F.col("measured") / F.col("depth"))
    return r.groupBy(image).agg(quantile("__r", 0.5).alias("ratio"), F.count("*").alias("n")).where(F.col("n") >= min_points)


def observations_with_depth(points2d: DataFrame, projected: DataFrame, measured: DataFrame, *, image: str, point: str, tolerance: float, base_sigma: float, quad_sigma: float, min_samples: int = 5) -> DataFrame:
    """Every 2D-3D observation, with depth and sigma where the gate passes, else -1 and 0.

    The gate compares measured depth with the expected one times the image's median ratio,
    or the pooled median where the image has fewer than min_samples, or 1.
    """
    pixel = projected.withColumn("__u", F.rint("u").cast("int")).withColumn("__v", F.rint("v").cast("int"))
    m = measured.select(F.col(image), F.col("u").alias("__u"), F.col("v").alias("__v"), F.col("depth").alias("measured")).where(F.col("measured") > 0)
    r = pixel.join(m, [image, "__u", "__v"], "left").withColumn("__r", F.col("measured") / F.col("depth"))
    per = r.groupBy(image).agg(F.count("__r").alias("__n"), quantile("__r", 0.5).alias("__m"))
    pooled = r.agg(quantile("__r", 0.5).alias("__p"))
    c = F.coalesce(F.when(F.col("__n") >= min_samples, F.col("__m")), F.col("__p"), F.lit(1.0))
    gated = r.join(per, image).crossJoin(pooled).withColumn("__e", F.col("depth") * c)
    ok = F.coalesce(F.abs(F.col("measured") - F.col("__e")) < tolerance * F.col("__e"), F.lit(False))
    depths = gated.select(image, point, F.when(ok, F.col("measured")).otherwise(-1.0).alias("obs_depth"), F.when(ok, base_sigma + quad_sigma * F.col("measured") * F.col("measured")).otherwise(0.0).alias("sigma"))
    return points2d.join(depths, [image, point], "left").withColumn("obs_depth", F.coalesce("obs_depth", F.lit(-1.0))).withColumn("sigma", F.coalesce("sigma", F.lit(0.0)))


def apply_segment_fits(rows: DataFrame, fits: DataFrame, *, by: Sequence[str], xyz: Sequence[str]) -> DataFrame:
    """rows with each segment's similarity applied; segments without a fit stay."""
    joined = rows.join(fits.drop("n"), list(by), "left")
    p = moved(xyz)
    for i, c in enumerate(xyz):
        joined = joined.withColumn(f"__{i}", F.when(F.col("scale").isNotNull(), p[i]).otherwise(F.col(c)))
    for i, c in enumerate(xyz):
        joined = joined.withColumn(c, F.col(f"__{i}"))
    return joined.drop("scale", *[f"r{i}" for i in range(9)], *[f"t{i}" for i in range(3)], *[f"__{i}" for i in range(3)])


def chain_transforms(segments: DataFrame, *, by: Sequence[str], order: str, first: Sequence[str], last: Sequence[str]) -> DataFrame:
    """Each segment's similarity made to continue the one before: rows with r0..r8 and t0..t2 replaced, scale kept.

    segments: scale, r0..r8, t0..t2 of the own fit; first and last: the camera's place in the
    segment's first and last pose before correction. A rigid motion after the own fit keeps
    the original motion from the last pose of one segment to the first of the next. Then all
    segments turn by the rotation of the first, and from segment to segment the shift grows
    by that rotation of (s' - 1) * last' - (s - 1) * first, so a running sum chains them.
    """
    w = Window.partitionBy(*by).orderBy(order)
    out = segments
    for i in range(3):
        step = (F.lag("scale").over(w) - 1) * F.lag(last[i]).over(w) - (F.col("scale") - 1) * F.col(first[i])
        out = out.withColumn(f"__step{i}", F.coalesce(step, F.lit(0.0)))
    for i in range(3):
        out = out.withColumn(f"__d{i}", F.sum(f"__step{i}").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    for i in range(9):
        out = out.withColumn(f"__r{i}", F.first(f"r{i}").over(w))
    for i in range(3):
        turned = sum((F.col(f"__r{3 * i + j}") * F.col(f"__d{j}") for j in range(3)), F.lit(0.0))
        out = out.withColumn(f"__t{i}", F.first(f"t{i}").over(w) + turned)
    made = {f"r{i}": F.col(f"__r{i}") for i in range(9)} | {f"t{i}": F.col(f"__t{i}") for i in range(3)}
    return out.withColumns(made).drop(*[f"__{k}{i}" for k in ("step", "d", "t") for i in range(3)], *[f"__r{i}" for i in range(9)])


def planar_bands(points: DataFrame, *, by: Sequence[str], xyz: Sequence[str] = ("x", "y", "z"), up: int = 1, bin_width: float = 0.05, max_height: float = 0.5, max_residual: float = 0.10, min_verticality: float = 0.85, min_points: int = 300) -> DataFrame:
    """Horizontal planar clusters along the up axis, a row each: (by, band, n, low, high, height, residual, verticality, x0, x1, z0, z1).

    low, high: extremes of its points on the up axis; height: their mean; x0..z1: the box on
    the other two axes. The axis is cut into equal bins of at most bin_width from the lowest
    point to the highest. From a bin with points on, a window grows up to max_height; the last
    one of min_points or more whose plane fits within max_residual (root mean square) and is
    level enough is a band, growth ends at the first that fails after one that passed, and the
    search goes on behind the window that was tried last. Spark reduces points to sufficient
    statistics per bin (counts, extremes, sums, products about the model's lowest corner); only
    those of a model meet in one place.
    """
    ship_package(points.sparkSession)
    c = [F.col(x) for x in xyz]
    span = points.groupBy(*by).agg(*[F.min(x).alias(f"__o{i}") for i, x in enumerate(c)], F.max(c[up]).alias("__top"))
    span = span.where(F.col("__top") > F.col(f"__o{up}")).withColumn("__bins", F.greatest(F.lit(1), F.ceil((F.col("__top") - F.col(f"__o{up}")) / bin_width)).cast("int"))
    span = span.withColumn("__step", (F.col("__top") - F.col(f"__o{up}")) / F.col("__bins"))
    j = points.join(span, list(by)) if by else points.crossJoin(span)
    low = F.col(f"__o{up}")
    k = F.floor((c[up] - low) / F.col("__step"))
    k = F.when(c[up] < k * F.col("__step") + low, k - 1).when(c[up] >= (k + 1) * F.col("__step") + low, k + 1).otherwise(k)
    d = [x - F.col(f"__o{i}") for i, x in enumerate(c)]
    binned = j.withColumn("bin", F.greatest(F.lit(0), F.least(k, F.col("__bins") - 1)).cast("int"))
    stats = binned.groupBy(*by, "bin").agg(
        F.first("__bins").alias("bins"),
        *[F.first(f"__o{i}").alias(f"o{i}") for i in range(3)],
        F.count("*").alias("n"),
        *[F.sum(x).alias(f"s{i}") for i, x in enumerate(d)],
        *[F.sum(d[i] * d[m]).alias(f"q{i}{m}") for i in range(3) for m in range(i, 3)],
        *[f(x).alias(f"{name}{i}") for i, x in enumerate(c) for f, name in ((F.min, "a"), (F.max, "b"))],
    )
    sides = [i for i in range(3) if i != up]
    names = ["band", "n", "low", "high", "height", "residual", "verticality", "x0", "x1", "z0", "z1"]

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        at = {b: i for i, b in enumerate(pdf["bin"])}
        sums = pdf[["n", "s0", "s1", "s2", "q00", "q01", "q02", "q11", "q12", "q22"]].to_numpy(float)
        least, most = pdf[["a0", "a1", "a2"]].to_numpy(float), pdf[["b0", "b1", "b2"]].to_numpy(float)
        bins, origin = int(pdf["bins"].iloc[0]), float(pdf[f"o{up}"].iloc[0])

        def plane(s: np.ndarray) -> tuple[float, float]:
            m = s[1:4] / s[0]
            q = np.array([[s[4], s[5], s[6]], [s[5], s[7], s[8]], [s[6], s[8], s[9]]]) / s[0] - np.outer(m, m)
            values, vectors = np.linalg.eigh(q)
            return float(np.sqrt(max(values[0], 0.0))), float(abs(vectors[up, 0]))

        out, b = [], 0
        while b < bins:
            if b not in at:
                b += 1
                continue
            best, held, total, size = None, [], np.zeros(10), 1
            while size <= max(1, round(max_height / bin_width)) and b + size <= bins:
                if (i := at.get(b + size - 1)) is not None:
                    held.append(i)
                    total = total + sums[i]
                if total[0] >= min_points:
                    residual, level = plane(total)
                    if residual <= max_residual and level >= min_verticality:
                        lo, hi = least[held].min(axis=0), most[held].max(axis=0)
                        best = (int(total[0]), lo[up], hi[up], origin + total[1 + up] / total[0], residual, level, *[v for s in sides for v in (lo[s], hi[s])])
                    elif best is not None:
                        break
                size += 1
            if best is None:
                b += 1
            else:
                out.append((len(out), *best))
                b += size
        got = pd.DataFrame(out, columns=names).astype({k: "int64" if k in ("band", "n") else "float64" for k in names})
        for k in by:
            got[k] = pdf[k].iloc[0]
        return got

    schema = ", ".join([f"{k} {'long' if k in ('band', 'n') else 'double'}" for k in names] + [f"{k} {v}" for k, v in points.select(*by).dtypes])
    return stats.groupBy(*by).applyInPandas(grow, schema)


def in_bands(points: DataFrame, bands: DataFrame, *, by: Sequence[str], up: str) -> DataFrame:
    """points with the band of their model that they are in; a model has few bands, and bands share no height."""
    limits = bands.groupBy(*by).agg(F.collect_list(F.struct("band", "low", "high")).alias("__bands"))
    inside = F.filter("__bands", lambda b: F.col(up).between(b["low"], b["high"]))
    return points.join(limits, list(by)).withColumn("band", F.get(inside, F.lit(0))["band"]).where("band is not null").drop("__bands")


def footprint_overlap(obs: DataFrame, *, cluster: str, image: str, u: str, v: str, width: float, height: float, cells: int = 32, min_frames: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """(by, a, b, frames, overlap): mean share of a's occupied cells that b also has, over shared images; needs min_frames of them."""
    place = lambda c, size: F.greatest(F.lit(0), F.least((F.col(c) / size * cells).cast("int"), F.lit(cells - 1)))
    d = obs.select(*by, F.col(cluster).alias("a"), F.col(image).alias("__i"), (place(u, width) * cells + place(v, height)).alias("__c")).distinct()
    n = d.groupBy(*by, "a", "__i").agg(F.count("*").alias("__n"))
    both = d.join(d.withColumnRenamed("a", "b"), [*by, "__i", "__c"]).where("a < b").groupBy(*by, "a", "b", "__i").agg(F.count("*").alias("__m"))
    shared = n.join(n.select(*by, F.col("a").alias("b"), "__i"), [*by, "__i"]).where("a < b")
    per = shared.join(both, [*by, "a", "b", "__i"], "left").withColumn("__share", F.coalesce("__m", F.lit(0)) / F.col("__n"))
    return per.groupBy(*by, "a", "b").agg(F.count("*").alias("frames"), F.avg("__share").alias("overlap")).where(F.col("frames") >= min_frames)


def box_iou(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Intersection over union of boxes (x0, x1, z0, z1); 0 where they don't overlap."""
    wide, deep = F.least(a[1], b[1]) - F.greatest(a[0], b[0]), F.least(a[3], b[3]) - F.greatest(a[2], b[2])
    area = lambda x: F.greatest(x[1] - x[0], F.lit(1e-9)) * F.greatest(x[3] - x[2], F.lit(1e-9))
    return F.when((wide > 0) & (deep > 0), wide * deep / (area(a) + area(b) - wide * deep)).otherwise(0.0)


def duplicate_surfaces(bands: DataFrame, overlap: DataFrame, *, by: Sequence[str] = (), min_separation: float = 0.2, max_separation: float = 3.0, min_gap: float = 0.12, min_iou: float = 0.25, min_overlap: float = 0.3) -> DataFrame:
    """(by, a, b, separation, gap, iou, frames, overlap): pairs of planar_bands() that look like one surface twice.

    Their mean heights are within limits of each other, their points min_gap apart at least,
    their boxes overlap by min_iou, and they are seen at the same pixels (footprint_overlap()).
    """
    box = ("x0", "x1", "z0", "z1")
    side = lambda name: bands.select(*by, F.col("band").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("height", "low", "high", *box)])
    pairs = overlap.where(F.col("overlap") >= min_overlap).join(side("a"), [*by, "a"]).join(side("b"), [*by, "b"])
    pairs = pairs.withColumn("separation", F.abs(F.col("height_a") - F.col("height_b"))).withColumn("gap", F.greatest("low_a", "low_b") - F.least("high_a", "high_b"))
    pairs = pairs.withColumn("iou", box_iou([F.col(f"{c}_a") for c in box], [F.col(f"{c}_b") for c in box]))
    return pairs.where(F.col("separation").between(min_separation, max_separation) & (F.col("gap") >= min_gap) & (F.col("iou") >= min_iou)).select(*by, "a", "b", "separation", "gap", "iou", "frames", "overlap")


def align_models(source: DataFrame, target: DataFrame, *, key: str, xyz: Sequence[str]) -> DataFrame:
    """(n, scale, r0..r8, t0..t2): the similarity that takes one model's places to those of another, by what both have under one key (an image's name)."""
    a, b = [f"__from{i}" for i in range(3)], [f"__to{i}" for i in range(3)]
    pairs = source.select(key, *[F.col(c).alias(n) for c, n in zip(xyz, a, strict=True)]).join(target.select(key, *[F.col(c).alias(n) for c, n in zip(xyz, b, strict=True)]), key)
    return similarity_fit(pairs, source=a, target=b)


def transform_model(rows: DataFrame, fit: DataFrame, *, xyz: Sequence[str]) -> DataFrame:
    """rows moved by one similarity (a single row)."""
    joined = rows.crossJoin(F.broadcast(fit.drop("n")))  # one row
    return joined.withColumns(dict(zip(xyz, moved(xyz), strict=True))).drop("scale", *[f"r{i}" for i in range(9)], *[f"t{i}" for i in range(3)])


def merge_models(first: DataFrame, second: DataFrame, *, key: str, xyz: Sequence[str]) -> DataFrame:
    """Rows of the first model, and those of the second under keys that the first lacks, moved into the first one's frame; with merged_from, 1 or 2."""
    moved_rows = transform_model(second.join(first.select(key), key, "left_anti"), align_models(second, first, key=key, xyz=xyz), xyz=xyz)
    return first.withColumn("merged_from", F.lit(1)).unionByName(moved_rows.withColumn("merged_from", F.lit(2)))


def orient_model(rows: DataFrame, *, xyz: Sequence[str], up: Sequence[float]) -> DataFrame:
    """rows turned so that the direction `up` becomes the z axis, by the shortest turn; a direction straight down turns about x."""
    u = np.asarray(up, float) / np.linalg.norm(up)
    v, c = np.cross(u, [0.0, 0.0, 1.0]), float(u[2])
    k = np.array([[0, -v[2], v[1]], [v[2], 0, -v[0]], [-v[1], v[0], 0]])
    turn = np.diag([1.0, -1.0, -1.0]) if c < -1 + 1e-12 else np.eye(3) + k + k @ k / (1 + c)
    p = [F.col(x) for x in xyz]
    return rows.withColumns({x: sum((float(turn[i, j]) * p[j] for j in range(3)), F.lit(0.0)) for i, x in enumerate(xyz)})
