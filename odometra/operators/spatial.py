"""Spatial re-ranking of retrieved images: Hough votes of feature matches for a similarity, then verification of the best."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import materialize
from ..functions.scalar import ransac_trials

#: Bins of translation, scale and turn at the finest level, and levels; each level halves them.
TRANSLATION_BINS, SCALE_BINS, ANGLE_BINS, LEVELS = 64, 32, 8, 3
#: Largest translation and scale that vote.
MAX_IMAGE, MAX_SCALE = 4096.0, 10.0
#: Transformations that are verified, squared transfer error and ratio of areas of an inlier, and cells of the effective count.
BEST, MAX_TRANSFER, MAX_AREA, CELLS = 10, 100.0 * 100.0, 2.0, 32
#: Matches that determine an affine transformation.
SAMPLES = 3


def transforms(matches: DataFrame) -> DataFrame:
    """matches (x1, y1, scale1, angle1, x2, y2, scale2, angle2) with the similarity (scale, angle, tx, ty) of each.

    Matches with a null, or with a scale that isn't positive, give none and are left out.
    """
    scale, angle = F.when(F.col("scale1") > 0, F.col("scale2") / F.when(F.col("scale1") > 0, F.col("scale1"))), F.col("angle2") - F.col("angle1")
    # out of a list of one, so that conditions on what follows don't work these out again each
    m = matches.select("*", F.inline(F.array(F.struct(scale.alias("scale"), angle.alias("angle"), (scale * F.cos(angle)).alias("__c"), (scale * F.sin(angle)).alias("__s")))))
    m = m.withColumn("tx", F.col("x2") - (F.col("__c") * F.col("x1") - F.col("__s") * F.col("y1"))).withColumn("ty", F.col("y2") - (F.col("__s") * F.col("x1") + F.col("__c") * F.col("y1")))
    return m.where((F.col("scale") > 0) & F.col("tx").isNotNull() & F.col("ty").isNotNull()).drop("__c", "__s")


def hough_bins(moved: DataFrame, by: Sequence[str], *, levels: int = LEVELS, translation_bins: int = TRANSLATION_BINS, scale_bins: int = SCALE_BINS, angle_bins: int = ANGLE_BINS, max_image: float = MAX_IMAGE) -> DataFrame:
    """(by, na, ns, nx, ny, votes, score, scale, angle, tx, ty): occupied bins of matches as transforms() gives them.

    votes are those of the finest bin and scale to ty the means of its matches; score adds the
    votes of the wider bins around it, each level at half the weight of the one before, so that
    matches just beyond a border still count.
    """
    log_range = math.log2(MAX_SCALE)
    log_scale = F.log2("scale")
    fits = (F.abs("tx") <= max_image) & (F.abs("ty") <= max_image) & (F.abs(log_scale) <= log_range)
    place = lambda v, span, n: F.least(((v + span) / (2 * span) * n).cast("int"), F.lit(n - 1))
    voted = moved.where(fits).select(
        *by,
        "scale",
        "angle",
        "tx",
        "ty",
        place(F.col("angle"), math.pi, angle_bins).alias("na"),
        place(log_scale, log_range, scale_bins).alias("ns"),
        place(F.col("tx"), max_image, translation_bins).alias("nx"),
        place(F.col("ty"), max_image, translation_bins).alias("ny"),
    )
    dims = ("na", "ns", "nx", "ny")
    bins = voted.groupBy(*by, *dims).agg(F.count("*").alias("votes"), *[F.avg(c).alias(c) for c in ("scale", "angle", "tx", "ty")])
    score = F.col("votes").cast("double")
    for level in range(1, levels):
        wider = Window.partitionBy(*by, *[F.shiftright(d, level) for d in dims])
        score = score + 0.5**level * F.sum("votes").over(wider)
    return bins.withColumn("score", score)


def best_bins(bins: DataFrame, by: Sequence[str], k: int = BEST) -> DataFrame:
    """The k bins of the highest score with their rank from 0; ties to the smaller bin."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "ny", "nx", "ns", "na")
    # compared as it is numbered, so that the planner keeps the first k before the shuffle
    return bins.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).withColumn("rank", F.col("rank") - 1)


def _inlier(a: Column, b: Column, c: Column, d: Column, tx: Column, ty: Column, max_transfer: float, max_area: float) -> Column:
    """Whether a match fits x2 = [a b; c d] x1 + t both ways, and its features' areas as well."""
    x1, y1, x2, y2 = (F.col(n) for n in ("x1", "y1", "x2", "y2"))
    det = a * d - b * c
    safe = F.when(det != 0, det)
    ex, ey = x2 - a * x1 - b * y1 - tx, y2 - c * x1 - d * y1 - ty
    bx, by = x1 - (d * (x2 - tx) - b * (y2 - ty)) / safe, y1 - (a * (y2 - ty) - c * (x2 - tx)) / safe
    ratio = F.col("scale1") * F.col("scale1") * F.abs(det) / (F.col("scale2") * F.col("scale2"))
    fits = (F.greatest(ratio, 1 / F.when(ratio > 0, ratio)) <= max_area) & (ex * ex + ey * ey + bx * bx + by * by <= max_transfer)
    return F.coalesce(fits, F.lit(False))


def vote_and_verify(matches: DataFrame, by: Sequence[str], *, best: int = BEST, confidence: float = 0.99, max_transfer: float = MAX_TRANSFER, max_area: float = MAX_AREA, cells: int = CELLS) -> DataFrame:
    """(by, matches, inliers, effective) of pairs of images with feature matches; see transforms() for the columns.

    The best bins' mean similarities are verified in their order, as far as the number of
    trials asks that the inliers found so far leave; the last of those with most inliers is
    refined by an affine fit to its inliers, which is taken if it has more. effective counts the
    occupied cells of a grid over the inliers in the first image, so that many matches in one
    spot count little. Pairs below three matches or inliers have 0. Everything is a keyed
    aggregate or a join on the pair.
    """
    by = list(by)
    moved = materialize(transforms(matches))
    sizes = moved.groupBy(*by).agg(F.count("*").alias("matches"))
    turned = F.struct((F.col("scale") * F.cos("angle")).alias("c"), (F.col("scale") * F.sin("angle")).alias("s"), "tx", "ty").alias("t")
    top = materialize(best_bins(hough_bins(moved, by), by, best).select(*by, "rank", turned))
    c, s = F.col("t.c"), F.col("t.s")
    similar = _inlier(c, -s, s, c, F.col("t.tx"), F.col("t.ty"), max_transfer, max_area)
    given = moved.drop("scale", "angle", "tx", "ty")
    # numbers only, as an aggregate that keeps structs sorts its rows
    counted = given.join(top, by).groupBy(*by, "rank").agg(F.count_if(similar).alias("inliers")).join(top, [*by, "rank"])
    listed = counted.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("rank", "inliers", "t"))).alias("tried")).join(sizes, by)

    nothing = F.struct(F.lit(0).cast("long").alias("inliers"), F.lit(-1).alias("rank"), F.lit(2**62).cast("long").alias("trials"))

    def step(state: Column, t: Column) -> Column:
        better = (t["rank"] < state["trials"]) & (t["inliers"] >= state["inliers"]) & (t["inliers"] >= SAMPLES)
        left = F.when(t["inliers"] == F.col("matches"), F.lit(0).cast("long")).otherwise(F.coalesce(ransac_trials(t["inliers"].cast("double"), F.col("matches").cast("double"), SAMPLES, confidence), F.lit(2**62)))
        taken = F.struct(t["inliers"].alias("inliers"), t["rank"].alias("rank"), left.alias("trials"))
        return F.when(better, taken).otherwise(state)

    chosen = listed.withColumn("best", F.aggregate("tried", nothing, step)).select(*by, "matches", F.col("best.inliers").alias("inliers"), F.when(F.col("best.rank") >= 0, F.get("tried", F.col("best.rank"))["t"]).alias("t"))
    chosen = materialize(chosen)
    some = given.join(chosen.where("t is not null").select(*by, "inliers", "t"), by)
    x, y = F.col("x1").cast("double"), F.col("y1").cast("double")
    terms = {"xx": x * x, "xy": x * y, "yy": y * y, "x": x, "y": y, "n": F.lit(1.0), "xu": x * F.col("x2"), "yu": y * F.col("x2"), "u": F.col("x2"), "xv": x * F.col("y2"), "yv": y * F.col("y2"), "v": F.col("y2")}
    fit = some.where(similar).groupBy(*by).agg(*[F.sum(e).alias(f"s_{k}") for k, e in terms.items()])
    # about the mean, two unknowns a row remain
    m = lambda p, q, pq: F.col(f"s_{pq}") - F.col(f"s_{p}") * F.col(f"s_{q}") / F.col("s_n")
    xx, xy, yy = m("x", "x", "xx"), m("x", "y", "xy"), m("y", "y", "yy")
    det = xx * yy - xy * xy
    safe = F.when(det > 1e-9 * F.greatest(F.lit(1e-12), xx * yy), det)
    a, b = (m("x", "u", "xu") * yy - m("y", "u", "yu") * xy) / safe, (m("y", "u", "yu") * xx - m("x", "u", "xu") * xy) / safe
    c2, d = (m("x", "v", "xv") * yy - m("y", "v", "yv") * xy) / safe, (m("y", "v", "yv") * xx - m("x", "v", "xv") * xy) / safe
    fit = fit.select(*by, a.alias("a"), b.alias("b"), c2.alias("c"), d.alias("d"), *[F.col(f"s_{k}").alias(f"s_{k}") for k in ("x", "y", "u", "v", "n")])
    shift = lambda p, q, w: (F.col(f"s_{w}") - F.col(p) * F.col("s_x") - F.col(q) * F.col("s_y")) / F.col("s_n")
    fit = fit.select(*by, F.struct("a", "b", "c", "d", shift("a", "b", "u").alias("tx"), shift("c", "d", "v").alias("ty")).alias("f"))
    affine = _inlier(*[F.col(f"f.{k}") for k in ("a", "b", "c", "d", "tx", "ty")], max_transfer, max_area)
    refined = materialize(some.join(fit, by, "left").select(*by, "inliers", "x1", "y1", similar.alias("similar"), affine.alias("affine")))
    more = refined.groupBy(*by).agg(F.count_if("affine").alias("affine_inliers"), F.first("inliers").alias("inliers"))
    final = more.select(*by, (F.col("affine_inliers") > F.col("inliers")).alias("use_affine"), F.greatest("affine_inliers", "inliers").alias("best_inliers"))
    inside = refined.join(final, by).where(F.when(F.col("use_affine"), F.col("affine")).otherwise(F.col("similar"))).select(*by, "x1", "y1", "best_inliers")
    box = inside.groupBy(*by).agg(F.min("x1").alias("x0"), F.min("y1").alias("y0"), F.max("x1").alias("xe"), F.max("y1").alias("ye"))
    cell = lambda v, low, high: F.when(F.col(high) > F.col(low), F.least(F.lit(cells - 1), F.floor((F.col(v) - F.col(low)) * cells / (F.col(high) - F.col(low))))).otherwise(0)
    occupied = inside.join(box, by).select(*by, "best_inliers", cell("x1", "x0", "xe").alias("cx"), cell("y1", "y0", "ye").alias("cy")).groupBy(*by, "cx", "cy").agg(F.first("best_inliers").alias("best_inliers"))
    effective = occupied.groupBy(*by).agg(F.count("*").alias("effective"), F.first("best_inliers").alias("best_inliers"))
    out = sizes.join(effective, by, "left")
    return out.select(*by, "matches", F.coalesce("best_inliers", F.lit(0)).alias("inliers"), F.coalesce("effective", F.lit(0)).alias("effective"))


def rerank(scored: DataFrame, verified: DataFrame, by: Sequence[str] = ("query", "image")) -> DataFrame:
    """(query, image, score, rank): retrieval scores plus effective inliers, per query; ties to the smaller image."""
    query, image = by
    s = scored.join(verified.select(*by, "effective"), list(by), "left").withColumn("score", F.col("score") + F.coalesce("effective", F.lit(0)))
    return s.select(query, image, "score", F.row_number().over(Window.partitionBy(query).orderBy(F.col("score").desc(), image)).alias("rank"))
