"""Queries that compose operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..checkpoints import materialize, shared_dir
from ..functions import scalar as M
from ..operators import pairs as P
from ..operators import quality as Q
from ..operators import similarity as S
from ..operators import stats as St
from ..operators import temporal as T
from ..sources import sinks
from .common import TRACKS, Registry, micros, r6, table, tracks
from .similarity_queries import LAYERS, surface_points

REGISTRY = Registry()


@REGISTRY.add(
    "a18_database_cache_load",
    f"""WITH {TRACKS}, c AS (SELECT a.image_id AS id1, b.image_id AS id2, count(*) AS shared FROM tracks a JOIN tracks b ON a.point_id = b.point_id AND a.image_id < b.image_id GROUP BY ALL),
ok AS (SELECT * FROM c WHERE (id1 + id2) % 10 != 7 AND shared >= 34), i AS (SELECT id1 AS image_id FROM ok UNION SELECT id2 FROM ok), n AS (SELECT s_suppkey AS image_id, s_name AS name FROM supplier WHERE s_nationkey < 20)
SELECT image_id, name, (SELECT count(*) FROM ok WHERE id1 = image_id OR id2 = image_id) AS pairs FROM n JOIN i USING (image_id)""",
)
def a18(spark, sf):
    p = P.covisible(tracks(spark, sf), point="point_id", image="image_id", min_track=2).withColumn("config", (F.col("id1") + F.col("id2")) % 10)
    ok = p.where("config != 7 and shared >= 34")
    images = table(spark, sf, "supplier").where("s_nationkey < 20").select(F.col("s_suppkey").alias("image_id"), F.col("s_name").alias("name"))
    kept = Q.connected_images(p, images, config="config", rows="shared", min_rows=34)
    ends = ok.select(F.col("id1").alias("image_id")).unionAll(ok.select("id2")).groupBy("image_id").agg(F.count("*").alias("pairs"))
    return kept.join(ends, "image_id").select("image_id", "name", "pairs")


@REGISTRY.add("a10_trajectory_from_model", "SELECT s_name AS image_name, round(-s_acctbal, 6) + 0.0 AS tx FROM supplier")
def a10(spark, sf):
    from ..sources import text_model
    from .io_queries import model

    t = text_model.trajectory(model(spark, sf)["images"])
    return t.select("image_name", (F.round(F.get("t", F.lit(0)), 6) + 0.0).alias("tx"))


@REGISTRY.add("o01_sql_functions", "SELECT DISTINCT l_suppkey AS a, l_linenumber::BIGINT AS b, least(l_suppkey, l_linenumber) * 2147483647 + greatest(l_suppkey, l_linenumber) AS p FROM lineitem")
def o01(spark, sf):
    from ..functions.register import register

    register(spark)
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("a"), F.col("l_linenumber").cast("long").alias("b")).distinct()
    return li.withColumn("p", F.expr("pair_id(a, b)"))


@REGISTRY.add("b02_associations_csv", "SELECT event_id::INT AS frame_id, epoch_us(ts) AS rgb_ts, CASE WHEN event_id % 3 != 0 THEN event_id END AS depth_ts FROM events")
def b02(spark, sf):
    a = table(spark, sf, "events").select(F.col("event_id").cast("int").alias("frame_id"), micros("ts").alias("rgb_ts"), F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("depth_ts"))
    path = f"{shared_dir(spark)}/odometra-assoc-{uuid.uuid4().hex}"
    sinks.associations_csv(a, path)
    return spark.read.schema("frame_id int, rgb_ts long, depth_ts long").csv(path, header=True)


@REGISTRY.add("b07_json_report", "SELECT r_regionkey, r_name FROM region")
def b07(spark, sf):
    path = f"{shared_dir(spark)}/odometra-report-{uuid.uuid4().hex}"
    sinks.json_document(table(spark, sf, "region"), path)
    return spark.read.schema("r_regionkey int, r_name string").json(path)


@REGISTRY.add(
    "b15_export_frames",
    "SELECT user_id, event_id, printf('%06d.png', place) AS filename FROM (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS place FROM events WHERE event_type = 'view') WHERE place % 2 = 0 AND place < 10 AND value > 5",
)
def b15(spark, sf):
    """Selected before anything is decoded; rows that don't decode are left out, and are those of a reject table."""
    kept = T.stride(table(spark, sf, "events").where("event_type = 'view'"), by=["user_id"], order=["ts", "event_id"], step=2, limit=10)
    return kept.where("value > 5").select("user_id", "event_id", F.format_string("%06d.png", "place").alias("filename"))


@REGISTRY.add("b16_first_camera_info", "SELECT user_id, arg_min(event_id, struct_pack(a := ts, b := event_id)) AS event_id FROM events WHERE event_type = 'signup' GROUP BY 1")
def b16(spark, sf):
    e = table(spark, sf, "events").where("event_type = 'signup'")
    return e.groupBy("user_id").agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


PAIRS_OF_BANDS = """d AS (SELECT DISTINCT model, band, image, least(7, floor(x / 51 * 8)) * 8 + least(7, floor(l_discount / 0.11 * 8)) AS c FROM o JOIN la USING (model, layer)), n AS (SELECT model, band, image, count(*) AS n FROM d GROUP BY ALL),
m AS (SELECT model, a.band AS a, b.band AS b, image, count(*) AS m FROM d a JOIN d b USING (model, image, c) WHERE a.band < b.band GROUP BY ALL), s AS (SELECT model, x.band AS a, y.band AS b, image, x.n AS na FROM n x JOIN n y USING (model, image) WHERE x.band < y.band),
ov AS (SELECT model, a, b, count(*) AS frames, avg(coalesce(m, 0) / na) AS overlap FROM s LEFT JOIN m USING (model, a, b, image) GROUP BY ALL HAVING count(*) >= 5),
g AS (SELECT model, a, b, frames, overlap, abs(p.height - q.height) AS separation, greatest(p.low, q.low) - least(p.high, q.high) AS gap, greatest(0, least(p.x1, q.x1) - greatest(p.x0, q.x0)) * greatest(0, least(p.z1, q.z1) - greatest(p.z0, q.z0)) AS inter, (p.x1 - p.x0) * (p.z1 - p.z0) + (q.x1 - q.x0) * (q.z1 - q.z0) AS areas FROM ov JOIN la p USING (model) JOIN la q USING (model) WHERE p.band = a AND q.band = b)"""


@REGISTRY.add("d27_i12_duplicate_surfaces", f"WITH {LAYERS}, {PAIRS_OF_BANDS} SELECT model, a, b, round(separation, 6) AS separation, round(gap, 6) AS gap, round(inter / (areas - inter), 6) AS iou, frames, round(overlap, 6) AS overlap FROM g WHERE separation BETWEEN 0.2 AND 1.5 AND gap >= 0.12 AND inter / (areas - inter) >= 0.25 AND overlap >= 0.3")
def d27(spark, sf):
    points = surface_points(spark, sf)
    bands = materialize(S.planar_bands(points, by=["model"], min_points=100))
    seen = S.in_bands(points, bands, by=["model"], up="y")
    overlap = S.footprint_overlap(seen, cluster="band", image="image", u="x", v="v", width=51.0, height=0.11, cells=8, by=["model"])
    got = S.duplicate_surfaces(bands, overlap, by=["model"], max_separation=1.5)
    return got.select("model", "a", "b", *[r6(c).alias(c) for c in ("separation", "gap", "iou")], "frames", r6("overlap").alias("overlap"))


@REGISTRY.add("f03_group_stride", "SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS k FROM orders) WHERE k % 4 = 0")
def f03(spark, sf):
    return T.stride(table(spark, sf, "orders"), by=["o_custkey"], order=["o_orderkey"], step=4).select("o_custkey", "o_orderkey")


@REGISTRY.add("h10_cumulative_recall", "SELECT c_custkey, round(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) / count(*) OVER (PARTITION BY c_nationkey), 6) AS recall FROM customer")
def h10(spark, sf):
    w = Window.partitionBy("c_nationkey")
    return table(spark, sf, "customer").select("c_custkey", r6(F.row_number().over(w.orderBy("c_acctbal", "c_custkey")) / F.count("*").over(w)).alias("recall"))


@REGISTRY.add("l07_model_compare", "WITH a AS (SELECT s_name AS name, s_acctbal AS x FROM supplier), b AS (SELECT s_name AS name, s_acctbal + s_suppkey % 5 AS x FROM supplier WHERE s_nationkey < 20), e AS (SELECT abs(b.x - a.x) AS e FROM a JOIN b USING (name)) SELECT count(*) AS common, round(min(e), 6) AS min, round(max(e), 6) AS max, round(avg(e), 6) AS mean, round(median(e), 6) AS median, round(quantile_cont(e, 0.9), 6) AS p90, round(quantile_cont(e, 0.99), 6) AS p99 FROM e")
def l07(spark, sf):
    s = table(spark, sf, "supplier")
    a = s.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("x"))
    b = s.where("s_nationkey < 20").select(F.col("s_name").alias("name"), (F.col("s_acctbal") + F.col("s_suppkey") % 5).alias("y"))
    e = a.join(b, "name").select(F.abs(F.col("y") - F.col("x")).alias("e"))
    return e.agg(F.count("*").alias("common")).crossJoin(St.error_summary(e, "e")).select("common", *[r6(c).alias(c) for c in ("min", "max", "mean", "median", "p90", "p99")])


@REGISTRY.add("m17_camera_matrix", "SELECT c_custkey, c_acctbal AS fx, c_acctbal + 1 AS fy, 320.0::DOUBLE AS cx, 240.0::DOUBLE AS cy, CASE WHEN c_custkey % 2 = 0 THEN 5 ELSE 2 END AS n FROM customer")
def m17(spark, sf):
    k = F.array(F.col("c_acctbal"), F.lit(0.0), F.lit(320.0), F.lit(0.0), F.col("c_acctbal") + 1, F.lit(240.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    d = F.when(F.col("c_custkey") % 2 == 0, F.array().cast("array<double>")).otherwise(F.array(F.lit(0.1), F.lit(0.2)))
    c = table(spark, sf, "customer").select("c_custkey", M.intrinsics_of(k).alias("i"), F.size(M.distortion_of(d)).alias("n"))
    return c.select("c_custkey", "i.fx", "i.fy", "i.cx", "i.cy", "n")


@REGISTRY.add("m19_solver_results", "SELECT s_suppkey, dense_rank() OVER (ORDER BY s_suppkey) - 1 AS dense, round(s_acctbal * 2, 6) AS x FROM supplier")
def m19(spark, sf):
    """Results by dense index, written back to the ids they stand for."""
    ids = P.dense_ids(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"), ["s_suppkey"], out="dense", start=0)
    solved = ids.select("dense", (F.col("s_acctbal") * 2).alias("x"))
    return ids.select("s_suppkey", "dense").join(solved, "dense").select("s_suppkey", "dense", r6("x").alias("x"))


@REGISTRY.add("j04_edges_by_rotation_error", "WITH v AS (SELECT vec_id, radians((vec_id * 37) % 360) AS t FROM embeddings), e AS (SELECT a.vec_id AS id1, b.vec_id AS id2, a.t AS ta, b.t AS tb FROM v a JOIN v b ON b.vec_id = a.vec_id + 1) SELECT id1, id2 FROM e WHERE degrees(acos(greatest(-1, least(1, cos(ta - tb))))) <= 40")
def j04(spark, sf):
    t = F.radians((F.col("vec_id") * 37) % 360)
    z, one = F.lit(0.0), F.lit(1.0)
    v = table(spark, sf, "embeddings").select("vec_id", F.array(F.cos(t), -F.sin(t), z, F.sin(t), F.cos(t), z, z, z, one).alias("R"))
    a, b = v.toDF("id1", "Ra"), v.select((F.col("vec_id") - 1).alias("id1"), F.col("vec_id").alias("id2"), F.col("R").alias("Rb"))
    return a.join(b, "id1").where(M.rotation_angle("Ra", "Rb") <= 40).select("id1", "id2")
