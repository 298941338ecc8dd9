"""Filters and statistics of point models: tracks, observations, cameras."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import materialize


def drop_short_tracks(tracks: DataFrame, *, point: str, min_length: int) -> DataFrame:
    """Observations of points with min_length or more; sizes are counted before the shuffle."""
    long = tracks.groupBy(point).agg(F.count("*").alias("__n")).where(F.col("__n") >= min_length).select(point)
    return tracks.join(long, point, "left_semi")


def drop_large_errors(obs: DataFrame, *, point: str, error: str, max_error: float) -> DataFrame:
    """Observations with error <= max_error of points that keep them, with the point's mean error.

    A point goes as a whole if all but one or fewer of its observations are left, or it had
    fewer than two. The mean divides by what remains.
    """
    ok = F.col(error) <= max_error
    per_point = obs.groupBy(point).agg(F.count("*").alias("__n"), F.count_if(~ok).alias("__gone"), F.avg(F.when(ok, F.col(error))).alias("mean_error"))
    alive = per_point.where((F.col("__n") >= 2) & (F.col("__gone") < F.col("__n") - 1)).select(point, "mean_error")
    return obs.where(ok).join(alive, point)


def drop_behind(obs: DataFrame, *, z: str) -> DataFrame:
    return obs.where(F.col(z) > 0)


def _degrees_between(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Angle of two vectors by sine and cosine, exact for small angles, where the cosine alone has no digits left."""
    crossed = [a[i] * b[j] - a[j] * b[i] for i, j in ((1, 2), (2, 0), (0, 1))]
    return F.degrees(F.atan2(F.sqrt(sum((c * c for c in crossed), F.lit(0.0))), sum((u * v for u, v in zip(a, b, strict=True)), F.lit(0.0))))


def drop_small_angles(obs: DataFrame, *, point: str, rays: Sequence[str], min_angle: float) -> DataFrame:
    """Observations of points seen under min_angle degrees or more by some pair of views; rays are unit vectors.

    First by the cone around a point's mean ray. If a ray is min_angle (up to 90) off the mean,
    some other ray is as far from it; if all are within half of min_angle, no pair is so wide.
    Only points between the two compare rays, and of these only rays that could be one side of
    a wide pair with the outermost: pairs as rows, which the join can split.
    """
    x, y, z = (F.col(c) for c in rays)
    sums = obs.groupBy(F.col(point).alias("__of")).agg(*[F.sum(c).alias(f"__s{i}") for i, c in enumerate(rays)], F.count("*").alias("__n"))
    length = F.sqrt(sum((F.col(f"__s{i}") * F.col(f"__s{i}") for i in range(3)), F.lit(0.0)))
    mean = [F.col(f"__s{i}") / F.when(length > 1e-9, length) for i in range(3)]
    off = F.when(length > 1e-9, _degrees_between((x, y, z), mean))
    views = materialize(obs.join(sums, F.col(point) == F.col("__of")).where("__n > 1").select(F.col(point).alias("__of"), x.alias("__x"), y.alias("__y"), z.alias("__z"), off.alias("__off")))
    cones = materialize(views.groupBy("__of").agg(F.max("__off").alias("__most"), F.count("__off").alias("__known"), F.count("*").alias("__n")).withColumn("__sure", (F.col("__known") == F.col("__n"))))
    slack = 1e-6
    wide = F.col("__sure") & (F.col("__most") >= min_angle + slack) if min_angle <= 90 else F.lit(False)
    narrow = F.col("__sure") & (2 * F.col("__most") < min_angle - slack)
    kept = cones.where(wide).select("__of")
    open_ = cones.where(~F.coalesce(wide, F.lit(False)) & ~F.coalesce(narrow, F.lit(False))).select("__of", "__most")
    asked = materialize(views.join(open_, "__of").where(F.col("__off").isNull() | F.col("__most").isNull() | (F.col("__off") >= min_angle - F.col("__most") - slack)).select("__of", "__x", "__y", "__z"))
    other = asked.toDF("__of", "__u", "__v", "__w")
    angle = _degrees_between([F.col(c) for c in ("__x", "__y", "__z")], [F.col(c) for c in ("__u", "__v", "__w")])
    kept = kept.unionByName(asked.join(other, "__of").where(angle >= min_angle).select("__of").distinct())
    return obs.join(kept, F.col(point) == F.col("__of"), "left_semi")


def filter_points(obs: DataFrame, *, point: str, error: str, rays: Sequence[str], max_error: float, min_angle: float) -> DataFrame:
    """Error filter first, then the angle filter on what is left."""
    return drop_small_angles(drop_large_errors(obs, point=point, error=error, max_error=max_error), point=point, rays=rays, min_angle=min_angle)


def stationary(matches: DataFrame, *, x1: str, y1: str, x2: str, y2: str, max_distance: float) -> DataFrame:
    """Matches that moved by more than max_distance."""
    dx, dy = F.col(x1) - F.col(x2), F.col(y1) - F.col(y2)
    return matches.where(~(dx * dx + dy * dy <= max_distance * max_distance))


#: Shifts of a pair that are checked against all of its matches.
SHIFTS = 4


def border_ratio(matches: DataFrame, by: Sequence[str], *, border: float = 0.1) -> DataFrame:
    """(by, matches, border_ratio): the share of matches that lie in the border of both images, border * diagonal wide.

    matches: x1, y1, x2, y2 and the images' width1, height1, width2, height2. A point on the
    edge of the inner box is inside it.
    """

    def outside(k: int) -> Column:
        x, y, w, h = (F.col(f"{c}{k}") for c in ("x", "y", "width", "height"))
        margin = border * F.sqrt(w * w + h * h)
        return ~(x.between(margin, w - margin) & y.between(margin, h - margin))

    inside_both = F.count_if(outside(1) & outside(2))
    return matches.groupBy(*by).agg(F.count("*").alias("matches"), (inside_both / F.count("*")).alias("border_ratio"))


def watermarks(matches: DataFrame, by: Sequence[str], *, border: float = 0.1, min_ratio: float = 0.7, max_error: float = 4.0, shifts: int = SHIFTS) -> DataFrame:
    """(by, matches, border_ratio, shift_ratio, dx, dy, watermark): pairs whose matches are a mark that both images carry.

    A watermark lies in the border of both images and moves by one shift between them. Pairs
    with a border_ratio below min_ratio aren't looked at further (shift_ratio null). For the
    others every match votes for its shift, in cells of max_error; a cell counts with the eight
    around it, and the mean shifts of the best such neighbourhoods are checked against all
    matches of the pair, and once more after moving to the mean of the matches within
    max_error. The best one's share of matches is shift_ratio. Votes are counted per cell
    before they meet, so that thousands of equal shifts cost as much as one.
    """
    by = list(by)
    ratios = materialize(border_ratio(matches, by, border=border))
    asked = ratios.where(F.col("border_ratio") >= min_ratio).select(*by)
    moves = materialize(matches.join(asked, by, "left_semi").select(*by, (F.col("x2") - F.col("x1")).alias("mx"), (F.col("y2") - F.col("y1")).alias("my")))
    cell = lambda c: F.floor(F.col(c) / max_error)
    cells = moves.groupBy(*by, cell("mx").alias("cx"), cell("my").alias("cy")).agg(F.count("*").alias("n"), F.sum("mx").alias("sx"), F.sum("my").alias("sy"))
    around = F.explode(F.array(*[F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    spread = cells.select(*by, "n", "sx", "sy", around.alias("c")).groupBy(*by, F.col("c.cx").alias("cx"), F.col("c.cy").alias("cy")).agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy")])
    order = Window.partitionBy(*by).orderBy(F.col("n").desc(), "cx", "cy")
    tried = spread.withColumn("k", F.row_number().over(order)).where(F.col("k") <= shifts).select(*by, "k", (F.col("sx") / F.col("n")).alias("dx"), (F.col("sy") / F.col("n")).alias("dy"))

    def support(candidates: DataFrame) -> DataFrame:
        """Matches near each shift, and their mean."""
        ex, ey = F.col("mx") - F.col("dx"), F.col("my") - F.col("dy")
        near = moves.join(candidates, by).where(ex * ex + ey * ey <= max_error * max_error)
        return near.groupBy(*by, "k", "dx", "dy").agg(F.count("*").alias("n"), F.avg("mx").alias("ax"), F.avg("my").alias("ay"))

    first = materialize(support(tried))
    again = support(first.select(*by, "k", F.col("ax").alias("dx"), F.col("ay").alias("dy")))
    both = first.unionByName(again)
    best = both.groupBy(*by).agg(F.max(F.struct("n", (-F.col("k")).alias("k"), "dx", "dy")).alias("b"))
    out = ratios.join(best.select(*by, F.col("b.n").alias("__n"), "b.dx", "b.dy"), by, "left")
    share = F.when(F.col("border_ratio") >= min_ratio, F.coalesce(F.col("__n"), F.lit(0)) / F.col("matches"))
    return out.select(*by, "matches", "border_ratio", share.alias("shift_ratio"), "dx", "dy", F.coalesce(share >= min_ratio, F.lit(False)).alias("watermark"))


def model_statistics(cameras: DataFrame, images: DataFrame, points: DataFrame, obs: DataFrame, *, error: str | None = None) -> DataFrame:
    """One row: counts, mean track length, mean observations per image, mean error of points that have one."""
    n = lambda df, name: df.agg(F.count("*").alias(name))
    out = n(cameras, "cameras").crossJoin(n(images, "images")).crossJoin(n(obs, "observations"))
    out = out.crossJoin(points.agg(F.count("*").alias("points"), *([F.avg(error).alias("mean_error")] if error else [])))
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return out.withColumn("mean_track_length", per("observations", "points")).withColumn("mean_observations", per("observations", "images"))


def point_errors(obs: DataFrame, *, point: str, error: str) -> DataFrame:
    return obs.groupBy(point).agg(F.avg(error).alias("mean_error"), F.count("*").alias("track_length"))


def crop(points: DataFrame, low: Sequence[float], high: Sequence[float], xyz: Sequence[str]) -> DataFrame:
    inside: Column = F.lit(True)
    for c, a, b in zip(xyz, low, high, strict=True):
        inside = inside & F.col(c).between(a, b)
    return points.where(inside)


def bogus_camera(width: Column, height: Column, focal: Column, extra: Column, *, min_ratio: float = 0.1, max_ratio: float = 10.0, max_extra: float = 1.0) -> Column:
    """A focal length out of proportion to the larger side, or a large extra parameter."""
    ratio = focal / F.greatest(width, height)
    return ~ratio.between(min_ratio, max_ratio) | (F.abs(extra) > max_extra)


def frames_to_filter(frames: DataFrame, *, frame: str, bogus: str, observations: str, min_observations: int) -> DataFrame:
    """Frames with any bogus camera or fewer than min_observations in all."""
    g = frames.groupBy(frame).agg(F.bool_or(bogus).alias("bogus"), F.sum(observations).alias("observations"))
    return g.where(F.col("bogus") | (F.col("observations") < min_observations))


def integrity(points: DataFrame, images: DataFrame, obs: DataFrame, *, point: str, image: str) -> DataFrame:
    """(check, violations): observations without a point or image, points without observations, repeated keys."""
    rows = [
        ("observation_without_point", obs.join(points.select(point), point, "left_anti")),
        ("observation_without_image", obs.join(images.select(image), image, "left_anti")),
        ("point_without_observation", points.join(obs.select(point), point, "left_anti")),
        ("repeated_observation", obs.groupBy(point, image).agg(F.count("*").alias("n")).where("n > 1")),
    ]
    out = None
    for name, df in rows:
        one = df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
        out = one if out is None else out.unionByName(one)
    return out


def remove_images(images: DataFrame, obs: DataFrame, gone: DataFrame, *, image: str) -> tuple[DataFrame, DataFrame]:
    """Images and observations without those of gone."""
    g = gone.select(image).distinct()
    return images.join(g, image, "left_anti"), obs.join(g, image, "left_anti")


def connected_images(pairs: DataFrame, images: DataFrame, *, config: str, rows: str, min_rows: int, watermark: int = 7) -> DataFrame:
    """Images in a usable pair: enough inlier rows, and not a watermark."""
    ok = pairs.where((F.col(config) != watermark) & (F.col(rows) >= min_rows))
    ends = ok.select(F.col("id1").alias("image_id")).unionByName(ok.select(F.col("id2").alias("image_id")))
    return images.join(ends, "image_id", "left_semi")


def calibrated_cameras(pairs: DataFrame, *, threshold: float) -> DataFrame:
    """(camera, votes, n, calibrated): share of a camera's pairs that are calibrated, strictly over threshold."""
    ends = pairs.select(F.col("camera1").alias("camera"), "calibrated").unionByName(pairs.where("camera1 != camera2").select(F.col("camera2").alias("camera"), "calibrated"))
    g = ends.groupBy("camera").agg(F.count_if("calibrated").alias("votes"), F.count("*").alias("n"))
    return g.withColumn("calibrated", F.col("votes") / F.col("n") > threshold)


def fused_points(pixels: DataFrame, *, cluster: str, columns: Sequence[str], min_pixels: int) -> DataFrame:
    """Median of each column per cluster of min_pixels or more."""
    return pixels.groupBy(cluster).agg(F.count("*").alias("n"), *[F.median(c).alias(c) for c in columns]).where(F.col("n") >= min_pixels)


def depth_ranges(obs: DataFrame, *, image: str, depth: str, default: tuple[float, float] = (0.1, 100.0), min_points: int = 10) -> DataFrame:
    """2nd and 98th percentile of an image's positive depths; the default where there are fewer than min_points."""
    d = F.when(F.col(depth) > 0, F.col(depth))
    g = obs.groupBy(image).agg(F.count(d).alias("n"), F.percentile(d, F.array(F.lit(0.02), F.lit(0.98))).alias("q"))
    few = F.col("n") < min_points
    return g.select(image, "n", F.when(few, F.lit(default[0])).otherwise(F.get("q", F.lit(0))).alias("low"), F.when(few, F.lit(default[1])).otherwise(F.get("q", F.lit(1))).alias("high"))


def majority_vote(rows: DataFrame, *, key: str, choice: str) -> DataFrame:
    """Most frequent choice per key; ties to the smallest."""
    n = rows.groupBy(key, choice).agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(F.min_by(F.struct(choice, "n"), F.struct(-F.col("n"), F.col(choice))).alias("b")).select(key, f"b.{choice}", "b.n")


def rasterize(points: DataFrame, *, by: Sequence[str], u: Column, v: Column, z: str) -> DataFrame:
    """Nearest depth per rounded pixel."""
    return points.where(F.col(z) > 0).groupBy(*by, F.rint(u).cast("int").alias("u"), F.rint(v).cast("int").alias("v")).agg(F.min(z).alias("depth"))


def top_per_group(rows: DataFrame, *, by: Sequence[str], order: Sequence[Column | str], k: int) -> DataFrame:
    """First k rows of each group; the limit is applied to each partition before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def visibility_score(points: DataFrame, *, image: str, x: str, y: str, width: float, height: float, levels: int) -> DataFrame:
    """Occupied cells of a pyramid of 2^l by 2^l cells, each level weighted by its number of cells; one pass counts all levels."""
    counts = []
    for level in range(1, levels + 1):
        n = 2**level
        cell = F.least(F.lit(n - 1), F.floor(F.col(x) / width * n)) * n + F.least(F.lit(n - 1), F.floor(F.col(y) / height * n))
        counts.append((level, n * n, cell))
    cells = points.select(image, F.explode(F.array(*[F.struct(F.lit(w).alias("w"), c.cast("long").alias("c")) for _, w, c in counts])).alias("l")).select(image, "l.w", "l.c").distinct()
    return cells.groupBy(image).agg(F.sum("w").cast("long").alias("score"))
