"""Queries through sources and sinks (A5-A7, A10, A12, A13, B1-B9, B13, B17) and keyframes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..checkpoints import shared_dir
from ..sources import binary_model, sinks, tables, text_model, transactional
from ..streaming import keyframes
from .common import Registry, micros, r6, table

REGISTRY = Registry()


def _folder(spark, name: str) -> str:
    import uuid

    return f"{shared_dir(spark)}/odometra-{name}-{uuid.uuid4().hex}"


def model(spark, sf):
    """Nations are cameras, suppliers images, orders points, and line items the observations between them."""
    cameras = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("camera_id"), F.lit("PINHOLE").alias("model"), F.lit(640).alias("width"), F.lit(480).alias("height"), F.array(F.lit(500.0), F.lit(500.0), F.lit(320.0), (F.col("n_nationkey") + 0.5)).alias("params"))
    one = F.lit(1.0)
    images = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("image_id"), one.alias("qw"), *[F.lit(0.0).alias(c) for c in ("qx", "qy", "qz")], F.col("s_acctbal").alias("tx"), F.lit(0.0).alias("ty"), F.lit(0.0).alias("tz"), F.col("s_nationkey").cast("long").alias("camera_id"), F.col("s_name").alias("name"))
    li = table(spark, sf, "lineitem").dropDuplicates(["l_suppkey", "l_orderkey", "l_linenumber"])
    points2d = li.select(F.col("l_suppkey").alias("image_id"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("int").alias("point2d_idx"), F.col("l_quantity").alias("x"), F.col("l_discount").alias("y"), F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("point3d_id"))
    points = table(spark, sf, "orders").select(F.col("o_orderkey").alias("point3d_id"), F.col("o_totalprice").alias("x"), F.lit(1.0).alias("y"), F.lit(2.0).alias("z"), *[F.lit(7).alias(c) for c in "rgb"], F.lit(0.5).alias("error"))
    tracks = points2d.where("point3d_id is not null").select("point3d_id", "image_id", "point2d_idx")
    return {"cameras": cameras, "images": images, "points2d": points2d, "points3d": points, "tracks": tracks}


def _round_trip(spark, sf):
    folder = _folder(spark, "model")
    text_model.write_model(model(spark, sf), folder)
    return text_model.read_model(spark, folder)


@REGISTRY.add("a05_b06_cameras_text", "SELECT n_nationkey::BIGINT AS camera_id, 'PINHOLE' AS model, 640 AS width, 480 AS height, n_nationkey + 0.5::DOUBLE AS cy FROM nation")
def a05(spark, sf):
    c = _round_trip(spark, sf)["cameras"]
    return c.select("camera_id", "model", "width", "height", F.get("params", F.lit(3)).alias("cy"))


@REGISTRY.add("a06_b06_images_text", "SELECT s_suppkey AS image_id, s_name AS name, s_acctbal AS tx, coalesce(n, 0) AS points, coalesce(linked, 0) AS linked FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n, count(*) FILTER (l_linenumber != 7) AS linked FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber FROM lineitem) GROUP BY 1) ON l_suppkey = s_suppkey")
def a06(spark, sf):
    m = _round_trip(spark, sf)
    n = m["points2d"].groupBy("image_id").agg(F.count("*").alias("points"), F.count("point3d_id").alias("linked"))
    return m["images"].join(n, "image_id", "left").select("image_id", "name", "tx", F.coalesce("points", F.lit(0)).alias("points"), F.coalesce("linked", F.lit(0)).alias("linked"))


@REGISTRY.add("a07_b06_points_text", "SELECT o_orderkey AS point3d_id, o_totalprice AS x, coalesce(n, 0) AS track FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber != 7) GROUP BY 1) ON l_orderkey = o_orderkey")
def a07(spark, sf):
    m = _round_trip(spark, sf)
    n = m["tracks"].groupBy("point3d_id").agg(F.count("*").alias("track"))
    return m["points3d"].join(n, "point3d_id", "left").select("point3d_id", "x", F.coalesce("track", F.lit(0)).alias("track"))


def _binary_round_trip(spark, sf):
    folder = _folder(spark, "model")
    binary_model.write_model(model(spark, sf), folder)
    return binary_model.read_model(spark, folder)


@REGISTRY.add("a08_a19_cameras_binary", "SELECT n_nationkey::BIGINT AS camera_id, 'PINHOLE' AS model, 640 AS width, 480 AS height, n_nationkey + 0.5::DOUBLE AS cy FROM nation")
def a08(spark, sf):
    return _binary_round_trip(spark, sf)["cameras"].select("camera_id", "model", "width", "height", F.get("params", F.lit(3)).alias("cy"))


@REGISTRY.add("a19_b06_images_binary", "SELECT s_suppkey AS image_id, s_name AS name, s_acctbal AS tx, coalesce(n, 0) AS points, coalesce(linked, 0) AS linked FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n, count(*) FILTER (l_linenumber != 7) AS linked FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber FROM lineitem) GROUP BY 1) ON l_suppkey = s_suppkey")
def a19(spark, sf):
    m = _binary_round_trip(spark, sf)
    n = m["points2d"].groupBy("image_id").agg(F.count("*").alias("points"), F.count("point3d_id").alias("linked"))
    return m["images"].join(n, "image_id", "left").select("image_id", "name", "tx", F.coalesce("points", F.lit(0)).alias("points"), F.coalesce("linked", F.lit(0)).alias("linked"))


@REGISTRY.add("a19_b06_points_binary", "SELECT o_orderkey AS point3d_id, o_totalprice AS x, coalesce(n, 0) AS track, coalesce(images, 0) AS images FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_suppkey) AS images FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber != 7) GROUP BY 1) ON l_orderkey = o_orderkey")
def a19_points(spark, sf):
    m = _binary_round_trip(spark, sf)
    n = m["tracks"].groupBy("point3d_id").agg(F.count("*").alias("track"), F.sum("image_id").alias("images"))
    return m["points3d"].join(n, "point3d_id", "left").select("point3d_id", "x", F.coalesce("track", F.lit(0)).alias("track"), F.coalesce("images", F.lit(0)).alias("images"))


@REGISTRY.add("b10_b11_versioned_delete", "SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) GROUP BY 1")
def b10_versioned(spark, sf):
    """Rows of images that go are deleted by key from a written table, which is replaced as a whole."""
    rows, path = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity"), _folder(spark, "versions")
    transactional.replace(rows, path)
    transactional.delete_keys(spark, path, rows.schema, table(spark, sf, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("l_suppkey")), ["l_suppkey"])
    return transactional.read(spark, path, rows.schema).groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@REGISTRY.add("a12_b01_timestamps_csv", "SELECT event_id::INT AS frame_id, epoch_us(ts) * 1000 AS ts_ns FROM events WHERE event_type = 'view'")
def a12(spark, sf):
    f = table(spark, sf, "events").where("event_type = 'view'").select((micros("ts") * 1000).alias("ts_ns"), F.format_string("%09d.png", "event_id").alias("filename"))
    path = _folder(spark, "timestamps")
    sinks.timestamps_csv(f, path)
    return tables.read_timestamps(spark, path).select("frame_id", "ts_ns")


@REGISTRY.add("a13_b17_manifest_json", "SELECT 5 AS topics, '2' AS version, (SELECT count(*) FROM events)::INT AS frames, 0 AS depth")
def a13(spark, sf):
    e = table(spark, sf, "events")
    t = e.select("event_type").distinct().select(F.col("event_type").alias("role"), F.concat(F.lit("/t/"), "event_type").alias("name"))
    path = _folder(spark, "manifest")
    sinks.json_document(sinks.manifest_document(t, version="2", num_rgb_frames=e.count()), path)
    return tables.read_manifest(spark, path).select(F.size("topics").alias("topics"), "version", F.col("num_rgb_frames").alias("frames"), F.col("num_depth_frames").alias("depth"))


def _poses(spark, sf):
    e = table(spark, sf, "events")
    eye = F.array(*[F.lit(x) for x in (1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0)])
    return e.select(F.col("event_id").alias("frame_id"), (micros("ts") * 1000).alias("ts_ns"), eye.alias("R"), F.array(F.col("value"), F.lit(1.0), F.lit(2.0)).alias("t"))


@REGISTRY.add("b03_tum_lines", "SELECT printf('%.6f %.6f 1.000000 2.000000 0.000000 0.000000 0.000000 1.000000', epoch_us(ts) * 1000 / 1e9, value) AS value FROM events")
def b03(spark, sf):
    return sinks.tum_lines(_poses(spark, sf), ts="ts_ns")


@REGISTRY.add("b04_trajectory_table", "SELECT event_id AS frame_id, value AS tx, 1.0::DOUBLE AS ty, 2.0::DOUBLE AS tz, 1.0::DOUBLE AS r00, -value AS cx FROM events")
def b04(spark, sf):
    return sinks.trajectory_table(_poses(spark, sf), matrices=True, centres=True).select("frame_id", "tx", "ty", "tz", "r00", "cx")


@REGISTRY.add("b05_kitti_lines", "SELECT printf('1.000000 0.000000 0.000000 %.6f 0.000000 1.000000 0.000000 1.000000 0.000000 0.000000 1.000000 2.000000', value) AS value FROM events")
def b05(spark, sf):
    return sinks.kitti_lines(_poses(spark, sf), order="frame_id")


@REGISTRY.add("b08_report", "SELECT (SELECT count(*) FROM nation) AS num_cameras, (SELECT count(*) FROM supplier) AS num_images, (SELECT count(*) FROM orders) AS num_points, 1.5::DOUBLE AS scale")
def b08(spark, sf):
    return sinks.report(table(spark, sf, "nation"), table(spark, sf, "supplier"), table(spark, sf, "orders"), spark.range(1).select(F.lit(1.5).alias("scale")))


@REGISTRY.add("b09_processed_recording", "SELECT event_type AS topic, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT '/pose', count(*) FROM events UNION ALL SELECT '/summary', 1")
def b09(spark, sf):
    m = table(spark, sf, "events").select(F.col("event_type").alias("topic"), (micros("ts") * 1000).alias("ts_ns"), F.lit("event").alias("msgtype"), F.col("props").cast("binary").alias("payload"))
    path = _folder(spark, "recording")
    sinks.write_recording(sinks.processed_recording(m, _poses(spark, sf).select("ts_ns", "frame_id", "t"), topic="/pose", msgtype="Pose", summary_topic="/summary"), path)
    return tables.read_messages(spark, path).groupBy("topic").agg(F.count("*").alias("n"))


@REGISTRY.add("b13_scale_report", "SELECT round(median(value), 6) AS median, round(stddev_pop(value), 6) AS std, count(*) AS n, round((SELECT sum(value) FROM (SELECT value FROM events ORDER BY event_id LIMIT 100)), 6) AS first_sum FROM events")
def b13(spark, sf):
    r = sinks.scale_report(table(spark, sf, "events"), order="event_id", value="value")
    return r.select(r6("median").alias("median"), r6("std").alias("std"), "n", r6(F.aggregate("values", F.lit(0.0), lambda s, v: s + v)).alias("first_sum"))


@REGISTRY.add("n01_keyframe_selection")
def n01(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label", F.transform("embedding", lambda v: v.cast("double")).alias("v"))
    return keyframes.select_keyframes(e, by=["label"], order="vec_id", vector="v", rule=keyframes.Rule(min_similarity=0.05, max_gap=5)).select("vec_id", "label")


@REGISTRY.add(
    "n02_event_time_keyframes",
    """WITH RECURSIVE w AS (SELECT (max(epoch_us(ts)) // 1000 - 600000) * 1000 AS passed FROM events),
e AS (SELECT user_id, event_id, epoch_us(ts) AS us, cos(value) AS x, sin(value) AS y, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events, w WHERE epoch_us(ts) <= passed),
f AS (SELECT user_id, event_id, i, us, x, y, 0 AS gap, true AS chosen FROM e WHERE i = 1
  UNION ALL SELECT n.user_id, n.event_id, n.i, n.us, CASE WHEN s THEN n.x ELSE n.lx END, CASE WHEN s THEN n.y ELSE n.ly END, CASE WHEN s THEN 0 ELSE n.gap END, s FROM (
    SELECT e.*, f.x AS lx, f.y AS ly, f.gap + 1 AS gap, e.us - f.us > 86400000000 OR f.gap + 1 >= 10 OR e.x * f.x + e.y * f.y < 0.75 AS s FROM f JOIN e ON e.user_id = f.user_id AND e.i = f.i + 1) n)
SELECT user_id, event_id FROM f WHERE chosen""",
)
def n02(spark, sf):
    """The events as a stream, in event time: what the watermark has passed at its end."""
    static = table(spark, sf, "events")
    stream = spark.readStream.schema(static.schema).parquet(f"{sf}/events.parquet*").select("user_id", "event_id", F.timestamp_micros(micros("ts")).alias("ts"), F.array(F.cos("value"), F.sin("value")).alias("v"))
    rule = keyframes.Rule(min_similarity=0.75, max_gap=10)
    chosen = keyframes.stream_keyframes(stream, by=["user_id"], time="ts", order=["event_id"], vector="v", rule=rule, lateness="10 minutes", idle=86400)
    return keyframes.finished(chosen.select("user_id", "event_id"))
