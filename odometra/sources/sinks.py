"""Sinks: CSV, trajectory texts, JSON reports, recordings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import at, camera_to_world, quaternion_of


def timestamps_csv(frames: DataFrame, path: str) -> None:
    frames.select(F.col("ts_ns").alias("timestamp_ns"), "filename").orderBy("timestamp_ns").write.mode("overwrite").csv(path, header=True)


def associations_csv(assoc: DataFrame, path: str, *, zero_as_empty: bool = False) -> None:
    """Nulls are empty; zero_as_empty writes zeros so too."""
    shown = [F.when(F.col(c) != 0, F.col(c)).alias(c) if zero_as_empty and c != "frame_id" else F.col(c) for c in assoc.columns]
    assoc.select(*shown).orderBy("frame_id").write.mode("overwrite").csv(path, header=True, nullValue="")


def tum_lines(traj: DataFrame, *, ts: str) -> DataFrame:
    """timestamp tx ty tz qx qy qz qw with six decimals, sorted by time; traj has R (c2w) and t."""
    q = traj.withColumn("__q", quaternion_of("R"))
    cells = [F.col(ts) / 1e9, *[at("t", i) for i in range(3)], *[at("__q", i) for i in range(4)]]
    return q.select(F.col(ts).alias("__ts"), F.format_string(" ".join(["%.6f"] * 8), *cells).alias("value")).orderBy("__ts").select("value")


def kitti_lines(traj: DataFrame, *, order: str) -> DataFrame:
    """Twelve numbers a row: the 3x4 pose."""
    cells: list[Column] = []
    for i in range(3):
        cells += [*[at("R", 3 * i + j) for j in range(3)], at("t", i)]
    return traj.select(F.col(order).alias("__o"), F.format_string(" ".join(["%.6f"] * 12), *cells).alias("value")).orderBy("__o").select("value")


def trajectory_table(traj: DataFrame, *, matrices: bool = False, centres: bool = False) -> DataFrame:
    """Flat columns for CSV; centres are those of world-to-camera poses qvec/tvec where given, else t."""
    out = [F.col("frame_id"), *[at("t", i).alias(f"t{c}") for i, c in enumerate("xyz")]]
    if matrices:
        out += [at("R", i).alias(f"r{i // 3}{i % 3}") for i in range(9)]
    if centres:
        _, c = camera_to_world("R", "t")
        out += [F.get(c, F.lit(i)).alias(f"c{a}") for i, a in enumerate("xyz")]
    return traj.select(*out)


def write_lines(lines: DataFrame, path: str) -> None:
    """A trajectory is small: one file, in order."""
    lines.coalesce(1).write.mode("overwrite").text(path)


def report(cameras: DataFrame, images: DataFrame, points: DataFrame, scale: DataFrame) -> DataFrame:
    """One row of counts and the scale (a one-row table)."""
    n = lambda df, name: df.agg(F.count("*").alias(name))
    return n(cameras, "num_cameras").crossJoin(n(images, "num_images")).crossJoin(n(points, "num_points")).crossJoin(scale)


def json_document(rows: DataFrame, path: str) -> None:
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def scale_report(frames: DataFrame, *, order: str, value: str, keep: int = 100) -> DataFrame:
    """Median, deviation and the first `keep` per-frame values."""
    first = frames.orderBy(order).limit(keep).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda s: s[value]).alias("values"))
    return frames.agg(F.median(value).alias("median"), F.stddev_pop(value).alias("std"), F.count("*").alias("n")).crossJoin(first)


def manifest_document(topics: DataFrame, **fields: str | int) -> DataFrame:
    """One row: fields, and the topics (role, name) as a map."""
    m = topics.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("role", "name")))).alias("topics"))
    for k, v in fields.items():
        m = m.withColumn(k, F.lit(v))
    return m


def processed_recording(messages: DataFrame, poses: DataFrame, *, topic: str, msgtype: str, summary_topic: str) -> DataFrame:
    """All messages, a pose message per row of poses (ts_ns and others), and one summary at the last pose's time."""
    cols = [c for c in poses.columns if c != "ts_ns"]
    body = F.to_json(F.struct(*cols)).cast("binary")
    pose = poses.select(F.lit(topic).alias("topic"), "ts_ns", F.lit(msgtype).alias("msgtype"), body.alias("payload"))
    last = poses.agg(F.max("ts_ns").alias("ts_ns"), F.count("*").alias("poses"))
    summary = last.where("ts_ns is not null").select(F.lit(summary_topic).alias("topic"), "ts_ns", F.lit("Summary").alias("msgtype"), F.to_json(F.struct("poses")).cast("binary").alias("payload"))
    return messages.unionByName(pose).unionByName(summary)


def write_recording(messages: DataFrame, path: str) -> None:
    messages.write.mode("overwrite").partitionBy("topic").parquet(path)
