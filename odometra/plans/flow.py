"""End-to-end flows: synchronise streams, and scale, filter and check a trajectory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checkpoints import materialize
from ..operators import temporal as T


def synchronise(colour: DataFrame, depth: DataFrame, info: DataFrame | None = None, *, tolerance: int = 33_000_000, info_tolerance: int = 100_000_000) -> tuple[DataFrame, DataFrame]:
    """(associations, depth frames under their colour frame's number); frames: frame_id, ts_ns, filename.

    A recording without depth or camera information gives nulls there.
    """
    a = T.nearest_asof(colour.select("frame_id", F.col("ts_ns").alias("rgb_ts")), depth, left_ts="rgb_ts", right_ts="ts_ns", tolerance=tolerance, out_ts="depth_ts", out_delta="delta")
    if info is None:
        a = a.withColumn("camera_info_ts", F.lit(None).cast("long"))
    else:
        a = T.nearest_asof(a, info, left_ts="rgb_ts", right_ts="ts_ns", tolerance=info_tolerance, out_ts="camera_info_ts", out_delta="__d").drop("__d")
    a = materialize(a.select("frame_id", "rgb_ts", "depth_ts", "camera_info_ts", "delta"))
    keyed = T.rekey_by_time(depth.drop("frame_id"), a, item_ts="ts_ns", assoc_ts="depth_ts", key="frame_id", order="rgb_ts")
    return a, keyed


def scale_and_check(poses: DataFrame, scales: DataFrame, *, by: Sequence[str], order: str, ts: str, xyz: Sequence[str] = ("x", "y", "z"), max_speed: float = 3.0, limit: float = 15.0, lost: float = 0.05, override: bool = False) -> tuple[DataFrame, DataFrame]:
    """(metric poses, report per trajectory): scaled, disconnected segments filtered, plausibility and metadata, and the gate.

    ok is false where the path is implausible, or an unresolved split affects more than
    `lost` of the poses; override lets those pass too. A trajectory without a scale keeps its own.
    """
    s = poses.join(scales.select(*by, F.col("scale").alias("__s")), list(by), "left").withColumn("__s", F.coalesce("__s", F.lit(1.0)))
    for c in xyz:
        s = s.withColumn(c, F.col(c) * F.col("__s"))
    seg = T.speed_segments(s.drop("__s"), by=by, order=order, ts=ts, max_speed=max_speed, xyz=xyz)
    marked = materialize(T.filter_disconnected(seg.drop("step", "idx", "dt", "speed"), by=by, xyz=xyz))
    kept = marked.where("kept").select(*poses.columns)
    apart = marked.groupBy(*by).agg((F.count_if(~F.col("merged")) / F.count("*")).alias("apart"), F.bool_and("resolved").alias("resolved"))
    fine = T.plausibility(kept, by=by, order=order, ts=ts, limit=limit, xyz=xyz).select(*by, "ratio", "severe")
    about = T.scene_metadata(kept, by=by, order=order, ts=ts, xyz=xyz)
    bad = F.col("severe") | (~F.col("resolved") & (F.col("apart") > lost))
    return kept, about.join(fine, list(by)).join(apart, list(by)).withColumn("ok", ~bad | F.lit(override))
