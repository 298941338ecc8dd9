"""Operators over time-ordered rows: as-of joins, steps, segments, change points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _window(by: Sequence[str], *order: str | Column):
    return Window.partitionBy(*by).orderBy(*order)


def nearest_asof(left: DataFrame, right: DataFrame, *, left_ts: str, right_ts: str, tolerance: int, by: Sequence[str] = (), right_order: str | None = None, out_ts: str = "matched_ts", out_delta: str = "delta") -> DataFrame:
    """Each left row with the nearest right time within tolerance (inclusive), else nulls.

    Of two right rows as near, the one first by right_order (default: the earlier) matches;
    many left rows may match one right row. Rows are dealt by time bucket, right rows also to
    a neighbour bucket that lies within tolerance, so the work is linear, no key or time range
    needs one task, and two window passes replace a range join.
    """
    width = max(1, 16 * int(tolerance))
    order = F.col(right_order or right_ts)
    r = right.where(F.col(right_ts).isNotNull()).groupBy(*by, F.col(right_ts).alias("__ts")).agg(F.min(order).alias("__order"))
    near = F.sequence(F.floor((F.col("__ts") - tolerance) / width), F.floor((F.col("__ts") + tolerance) / width))
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    r = r.select(*by, F.explode(near).alias("__bucket"), "__ts", F.lit(0).alias("__side"), F.struct("__ts", "__order").alias("__right"), F.lit(None).cast(left.select(row.alias("x")).schema["x"].dataType).alias("__left"))
    lt = left.select(*by, F.floor(F.col(left_ts) / width).alias("__bucket"), F.col(left_ts).alias("__ts"), F.lit(1).alias("__side"), F.lit(None).cast(r.schema["__right"].dataType).alias("__right"), row.alias("__left"))
    both = r.unionByName(lt)
    upto = (Window.unboundedPreceding, Window.currentRow)
    before = F.last("__right", ignorenulls=True).over(_window([*by, "__bucket"], "__ts", "__side").rowsBetween(*upto))
    after = F.last("__right", ignorenulls=True).over(_window([*by, "__bucket"], F.col("__ts").desc(), "__side").rowsBetween(*upto))

    def candidate(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(f"{c}.__ts") - F.col("__ts")).alias("d"), F.col(f"{c}.__order").alias("o"), F.col(f"{c}.__ts").alias("t")))

    best = F.least(candidate("__before"), candidate("__after"))
    found = both.withColumn("__before", before).withColumn("__after", after).where("__side = 1").withColumn("__best", best)
    hit = F.col("__best.d") <= tolerance
    return found.select("__left.*", F.when(hit, F.col("__best.t")).alias(out_ts), F.when(hit, F.col("__best.d")).alias(out_delta))


def rekey_by_time(items: DataFrame, association: DataFrame, *, item_ts: str, assoc_ts: str, key: str, order: str) -> DataFrame:
    """Items under the key of the association with their time; unmatched items go, of equal times the last by order counts."""
    last = association.where(F.col(assoc_ts).isNotNull()).groupBy(F.col(assoc_ts).alias("__t")).agg(F.max_by(F.col(key), F.struct(F.col(order), F.col(key))).alias("__key"))
    return items.join(last, F.col(item_ts) == F.col("__t")).drop("__t").withColumnRenamed("__key", key)


def lookup_times(rows: DataFrame, times: DataFrame, *, key: str, ts: str) -> DataFrame:
    """rows with the time of their key; rows without one keep a null."""
    return rows.join(times.select(key, ts), key, "left")


def stride(rows: DataFrame, *, order: Sequence[str], step: int, by: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """Every step-th row of the order, from the first; limit bounds the raw place, as an early stop would."""
    place = F.row_number().over(_window(by, *order)) - 1
    out = rows.withColumn("place", place)
    if limit is not None:
        out = out.where(F.col("place") < limit)
    return out.where(F.col("place") % step == 0)


def steps(traj: DataFrame, *, by: Sequence[str], order: str, ts: str | None = None, xyz: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Step length from the row before, time between, and speed where time moves on."""
    w = _window(by, order)
    length = F.sqrt(sum(((F.col(c) - F.lag(c).over(w)) * (F.col(c) - F.lag(c).over(w)) for c in xyz), F.lit(0.0)))
    out = traj.withColumn("step", length).withColumn("idx", F.row_number().over(w) - 1)
    if ts:
        out = out.withColumn("dt", (F.col(ts) - F.lag(ts).over(w)) / 1e9).withColumn("speed", F.when(F.col("dt") > 0, F.col("step") / F.col("dt")))
    return out


def rotation_steps(traj: DataFrame, *, by: Sequence[str], order: str, rotation: str) -> DataFrame:
    """Angle in degrees between each row's rotation (row-major array of 9) and the one before."""
    before = F.lag(rotation).over(_window(by, order))
    trace = F.aggregate(F.zip_with(F.col(rotation), before, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    angle = F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (trace - 1) / 2))))
    return traj.withColumn("angle", F.when(before.isNotNull(), angle))


def speed_segments(traj: DataFrame, *, by: Sequence[str], order: str, ts: str, max_speed: float = 3.0, xyz: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Segment number per row: a new one where the step's speed exceeds max_speed; unknown or still time never breaks."""
    s = steps(traj, by=by, order=order, ts=ts, xyz=xyz)
    jump = F.coalesce((F.col("speed") > max_speed).cast("int"), F.lit(0))
    return s.withColumn("segment", F.sum(jump).over(_window(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def segment_sizes(segmented: DataFrame, *, by: Sequence[str]) -> DataFrame:
    """Rows per segment, and which is the largest (the first of equals)."""
    n = segmented.groupBy(*by, "segment").agg(F.count("*").alias("n"))
    first = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("n").desc(), "segment"))
    return n.withColumn("majority", first == 1)


def filter_disconnected(segmented: DataFrame, *, by: Sequence[str], merge_distance: float = 2.0, dominance: float = 3.0, xyz: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Decision per row of a segmented trajectory: (.., distance, merged, resolved, kept).

    A minority segment within merge_distance (inclusive) of the largest joins it. The rest is
    dropped if the joined majority has dominance times as many rows; else nothing is.
    Distances: first, segments that share a cell with the majority so small that all in it are
    within merge_distance; for the others, distinct places in neighbouring cells of
    merge_distance are compared, which decides the threshold exactly without all pairs.
    All joins are sort-merge joins: every side grows with the rows, the 27 cells of a row aren't
    in the planner's estimate of a side, and what it takes for small passes the driver.
    """
    sizes = segment_sizes(segmented, by=by)
    rows = segmented.join(sizes.hint("merge"), [*by, "segment"])
    fine = [F.floor(F.col(c) / (merge_distance / 2)).alias(f"__f{i}") for i, c in enumerate(xyz)]  # a diagonal is 0.87 of merge_distance
    held = rows.where("majority").select(*by, *fine).distinct()
    sharing = rows.where("not majority").select(*by, "segment", *fine).distinct().join(held.hint("merge"), [*by, "__f0", "__f1", "__f2"], "left_semi").select(*by, "segment").distinct()
    cell = [F.floor(F.col(c) / merge_distance).alias(f"__c{i}") for i, c in enumerate(xyz)]
    major = rows.where("majority").select(*by, *cell, *[F.col(c).alias(f"__m{i}") for i, c in enumerate(xyz)]).distinct()
    around = F.explode(F.array(*[F.struct(*[F.lit(d).alias(f"d{i}") for i, d in enumerate(ds)]) for ds in [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)]])).alias("__d")
    minor = rows.where("not majority").join(sharing.hint("merge"), [*by, "segment"], "left_anti").select(*by, "segment", *xyz, *cell).distinct().select("*", around)
    minor = minor.select(*by, "segment", *xyz, *[(F.col(f"__c{i}") + F.col(f"__d.d{i}")).alias(f"__c{i}") for i in range(3)])
    d2 = sum(((F.col(c) - F.col(f"__m{i}")) * (F.col(c) - F.col(f"__m{i}")) for i, c in enumerate(xyz)), F.lit(0.0))
    near = minor.join(major.hint("merge"), [*by, "__c0", "__c1", "__c2"]).where(d2 <= merge_distance * merge_distance).select(*by, "segment").distinct()
    close = sharing.unionByName(near).withColumn("merged", F.lit(True))
    verdict = sizes.join(close.hint("merge"), [*by, "segment"], "left").withColumn("merged", F.coalesce("merged", F.col("majority")))
    w = Window.partitionBy(*by)
    total = F.sum(F.when(F.col("merged"), F.col("n")).otherwise(0)).over(w)
    apart = F.sum(F.when(~F.col("merged"), F.col("n")).otherwise(0)).over(w)
    verdict = verdict.withColumn("resolved", total >= dominance * apart).withColumn("kept", F.col("merged") | ~F.col("resolved"))
    return segmented.join(verdict.select(*by, "segment", "majority", "merged", "resolved", "kept").hint("merge"), [*by, "segment"])


def rolling_median(rows: DataFrame, *, by: Sequence[str], order: str, value: str, half: int, out: str) -> DataFrame:
    """Centred median of half rows on either side, cut at the ends."""
    return rows.withColumn(out, F.percentile(value, F.lit(0.5)).over(_window(by, order).rowsBetween(-half, half)))


def regime_candidates(rows: DataFrame, *, by: Sequence[str], order: str, value: str, half: int = 5, jump: float = 1.5) -> DataFrame:
    """Smoothed series with medians before and after each row, and whether they differ by a factor over jump.

    Only rows with half rows on both sides can be boundaries.
    """
    w = _window(by, order)
    s = rolling_median(rows, by=by, order=order, value=value, half=half, out="smooth")
    s = s.withColumn("idx", F.row_number().over(w) - 1).withColumn("n", F.count("*").over(Window.partitionBy(*by)))
    s = s.withColumn("before", F.percentile("smooth", F.lit(0.5)).over(w.rowsBetween(-half, -1))).withColumn("after", F.percentile("smooth", F.lit(0.5)).over(w.rowsBetween(0, half - 1)))
    ratio = F.when(F.col("before") > 0, F.col("after") / F.col("before"))
    inside = (F.col("idx") >= half) & (F.col("idx") < F.col("n") - half)
    return s.withColumn("candidate", F.coalesce(inside & ((ratio > jump) | (ratio < 1 / jump)), F.lit(False)))


def accept_boundaries(candidates: DataFrame, *, by: Sequence[str], min_gap: int = 10) -> DataFrame:
    """Of each group's candidates, those at least min_gap rows after the last accepted one (the first counts from row 0).

    A fold over the group's few candidate places, in order, as an array aggregate.
    """
    places = candidates.where("candidate").groupBy(*by).agg(F.array_sort(F.collect_list("idx")).alias("p"))
    start = F.array(F.lit(0).cast("int"))
    kept = F.aggregate("p", start, lambda acc, i: F.when(i - F.element_at(acc, -1) >= min_gap, F.concat(acc, F.array(i))).otherwise(acc))
    return places.select(*by, F.explode(F.slice(kept, 2, 2147483646)).alias("idx"))


def regime_segments(rows: DataFrame, *, by: Sequence[str], order: str, value: str, half: int = 5, jump: float = 1.5, min_gap: int = 10) -> DataFrame:
    """Segment number per row of a ratio series; a series of fewer than 2 * half rows is one segment."""
    c = regime_candidates(rows, by=by, order=order, value=value, half=half, jump=jump)
    marks = accept_boundaries(c.where(F.col("n") >= 2 * half), by=by, min_gap=min_gap).withColumn("mark", F.lit(1))
    marked = c.join(marks, [*by, "idx"], "left")
    return marked.withColumn("segment", F.coalesce(F.sum("mark").over(_window(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0)))


def plausibility(traj: DataFrame, *, by: Sequence[str], order: str, ts: str, limit: float = 15.0, xyz: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Path length against the bounding box's diagonal, per trajectory; severe above limit."""
    s = steps(traj, by=by, order=order, ts=ts, xyz=xyz)
    diag = F.sqrt(sum(((F.max(c) - F.min(c)) * (F.max(c) - F.min(c)) for c in xyz), F.lit(0.0)))
    out = s.groupBy(*by).agg(F.count("*").alias("n"), diag.alias("diagonal"), F.coalesce(F.sum("step"), F.lit(0.0)).alias("path"), F.max("step").alias("max_step"), F.min_by("idx", F.when(F.col("step").isNotNull(), F.struct(-F.col("step"), F.col("idx")))).alias("max_step_at"))
    ratio = F.when(F.col("n") < 2, F.lit(0.0)).when(F.col("diagonal") <= 1e-6, F.lit(float("inf"))).otherwise(F.col("path") / F.when(F.col("diagonal") > 1e-6, F.col("diagonal")))
    return out.withColumn("ratio", ratio).withColumn("severe", F.col("ratio") > limit)


def scene_metadata(traj: DataFrame, *, by: Sequence[str], order: str, ts: str, xyz: Sequence[str] = ("x", "y", "z"), leading: int = 2) -> DataFrame:
    """Length, duration, speeds, extent and box volume per trajectory, with where the top speed is and whether it leads."""
    s = steps(traj, by=by, order=order, ts=ts, xyz=xyz)
    out = s.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("step"), F.lit(0.0)).alias("length"),
        ((F.max(ts) - F.min(ts)) / 1e9).alias("duration"),
        F.avg("speed").alias("avg_speed"),
        F.max("speed").alias("max_speed"),
        F.stddev_pop("speed").alias("std_speed"),
        F.min_by("idx", F.when(F.col("speed").isNotNull(), F.struct(-F.col("speed"), F.col("idx")))).alias("max_speed_at"),
        *[(F.max(c) - F.min(c)).alias(f"extent_{c}") for c in xyz],
    )
    volume = F.lit(1.0)
    for c in xyz:
        volume = volume * F.col(f"extent_{c}")
    return out.withColumn("volume", volume).withColumn("leading", F.col("max_speed_at") - 1 < leading)


def boundary_rows(segmented: DataFrame, *, by: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """First and last row's columns of each segment."""
    row = F.struct(*columns)
    return segmented.groupBy(*by, "segment").agg(F.min_by(row, order).alias("first"), F.max_by(row, order).alias("last"))
