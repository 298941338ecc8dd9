"""Accuracy: recall, area under the recall curve, roll-ups, edge errors, comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def recall_auc(errors: DataFrame, *, error: str, thresholds: Sequence[float], by: Sequence[str] = (), min_error: float | str = 0.0) -> DataFrame:
    """(by, threshold, n, recall, auc) in percent.

    recall: share of errors <= threshold. auc: trapezoids of the recall curve from 0 up to
    the threshold, an error below min_error counting as min_error. The cumulative rank comes from counts per distinct error, so groups are summed before they
    are ordered.
    """
    floor = F.col(min_error) if isinstance(min_error, str) else F.lit(float(min_error))
    e = errors.select(*by, F.greatest(F.col(error), floor).cast("double").alias("__e"), F.col(error).cast("double").alias("__raw"))
    totals = e.groupBy(*by).agg(F.count("*").alias("__n"))
    steps = e.where(F.col("__e") <= max(thresholds)).groupBy(*by, "__e").agg(F.count("*").alias("__k"))
    order = Window.partitionBy(*by).orderBy("__e")
    curve = (steps.join(totals, list(by)) if by else steps.crossJoin(totals)).withColumn("__r1", F.sum("__k").over(order.rowsBetween(Window.unboundedPreceding, 0)) / F.col("__n"))
    curve = curve.withColumn("__r0", F.coalesce(F.lag("__r1").over(order), F.lit(0.0))).withColumn("__e0", F.coalesce(F.lag("__e").over(order), F.lit(0.0))).drop("__n")
    limits = F.explode(F.array(*[F.lit(float(t)) for t in thresholds]))
    grid = totals.withColumn("threshold", limits)
    met = grid.join(curve, list(by), "left") if by else grid.crossJoin(curve)
    inside = F.col("__e") <= F.col("threshold")
    area = F.sum(F.when(inside, (F.col("__e") - F.col("__e0")) * (F.col("__r0") + F.col("__r1")) / 2))
    g = met.groupBy(*by, "threshold").agg(F.first("__n").alias("n"), area.alias("__a"), F.max(F.when(inside, F.col("__e"))).alias("__le"), F.max(F.when(inside, F.col("__r1"))).alias("__lr"))
    auc = (F.coalesce("__a", F.lit(0.0)) + (F.col("threshold") - F.coalesce("__le", F.lit(0.0))) * F.coalesce("__lr", F.lit(0.0))) / F.col("threshold") * 100
    met_by = [F.count_if(F.col("__raw") <= float(t)) for t in thresholds]
    shares = e.groupBy(*by).agg(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), (m / F.count("*") * 100).alias("recall")) for t, m in zip(thresholds, met_by, strict=True)]).alias("__s"))
    recall = shares.select(*by, F.explode("__s").alias("__x")).select(*by, "__x.threshold", "__x.recall")
    return g.select(*by, "threshold", "n", auc.alias("auc")).join(recall, [*by, "threshold"])


def rollup_metrics(errors: DataFrame, *, levels: Sequence[str], error: str, threshold: float) -> DataFrame:
    """Per-scene recall, and at each level above __avg__ (mean of scenes) and __all__ (recomputed from pooled errors).

    One GROUPING SETS pass over the errors gives scenes and pools; means are of the scenes.
    """
    recall = F.count_if(F.col(error) <= threshold) / F.count("*") * 100
    rolled = errors.rollup(*levels).agg(recall.alias("recall"), F.count("*").alias("n"), F.grouping_id().alias("g"))
    scenes = rolled.where("g = 0").select(*levels, F.lit("scene").alias("kind"), "recall", "n")
    pooled = rolled.where("g != 0").select(*levels, F.lit("__all__").alias("kind"), "recall", "n")
    means = scenes.rollup(*levels).agg(F.avg("recall").alias("recall"), F.sum("n").alias("n"), F.grouping_id().alias("g")).where("g != 0").select(*levels, F.lit("__avg__").alias("kind"), "recall", "n")
    return scenes.unionByName(pooled).unionByName(means)


def mean_std(runs: DataFrame, *, by: Sequence[str], value: str) -> DataFrame:
    """Mean and sample deviation over runs; one run has deviation 0."""
    return runs.groupBy(*by).agg(F.avg(value).alias("mean"), F.coalesce(F.nanvl(F.stddev_samp(value), F.lit(0.0)), F.lit(0.0)).alias("std"), F.count("*").alias("runs"))


def diff_metrics(a: DataFrame, b: DataFrame, *, keys: Sequence[str], value: str) -> DataFrame:
    """b - a on the keys that both have."""
    return a.select(*keys, F.col(value).alias("a")).join(b.select(*keys, F.col(value).alias("b")), list(keys)).withColumn("diff", F.col("b") - F.col("a"))


def edge_errors(truth: DataFrame, found: DataFrame, *, error: Column, missing: float = 180.0) -> DataFrame:
    """Error per edge of either set: measured where both have it, else `missing`; keys id1, id2."""
    t, f = truth.withColumn("__t", F.lit(True)), found.withColumn("__f", F.lit(True))
    both = t.join(f, ["id1", "id2"], "full_outer")
    side = F.when(F.col("__f").isNull(), "missed").when(F.col("__t").isNull(), "extra").otherwise("both")
    return both.select("id1", "id2", side.alias("side"), F.when(side == "both", error).otherwise(missing).alias("error"))


def frame_overlap(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(n_a, n_both, overlap): share of a's distinct keys that b has."""
    x, y = a.select(*keys).distinct(), b.select(*keys).distinct()
    n, both = x.agg(F.count("*").alias("n_a")), x.intersect(y).agg(F.count("*").alias("n_both"))
    return n.crossJoin(both).withColumn("overlap", F.when(F.col("n_a") > 0, F.col("n_both") / F.col("n_a")).otherwise(0.0))
