"""Queries on time-ordered tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import temporal as T
from .common import STEPS, TRAJ, Registry, micros, r6, table, trajectories

REGISTRY = Registry()
MINUTE = 60_000_000
SLOW = 0.0002


def _stream(spark, sf, kind):
    return table(spark, sf, "events").where(F.col("event_type") == kind).select("event_id", "user_id", micros("ts").alias("us"))


@REGISTRY.add(
    "d01_nearest_asof_join",
    """WITH l AS (SELECT event_id, epoch_us(ts) AS us FROM events WHERE event_type = 'view'),
r AS (SELECT epoch_us(ts) AS us FROM events WHERE event_type = 'click'),
p AS (SELECT max(r.us) AS t, l.event_id, l.us FROM l LEFT JOIN r ON r.us <= l.us GROUP BY ALL),
n AS (SELECT min(r.us) AS t, l.event_id, l.us FROM l LEFT JOIN r ON r.us > l.us GROUP BY ALL),
b AS (SELECT p.event_id, p.us, CASE WHEN n.t IS NULL OR p.us - p.t <= n.t - p.us THEN p.t ELSE n.t END AS t FROM p JOIN n USING (event_id))
SELECT event_id AS frame_id, us AS left_us, CASE WHEN abs(t - us) <= 600000000 THEN t END AS matched_us,
  CASE WHEN abs(t - us) <= 600000000 THEN abs(t - us) END AS delta_us FROM b""",
)
def d01(spark, sf):
    left = _stream(spark, sf, "view").select(F.col("event_id").alias("frame_id"), F.col("us").alias("left_us"))
    return T.nearest_asof(left, _stream(spark, sf, "click"), left_ts="left_us", right_ts="us", tolerance=10 * MINUTE, out_ts="matched_us", out_delta="delta_us")


@REGISTRY.add(
    "d02_nearest_asof_by_key",
    """WITH l AS (SELECT event_id, user_id, epoch_us(ts) AS us FROM events WHERE event_type = 'purchase'),
r AS (SELECT user_id, epoch_us(ts) AS us FROM events WHERE event_type = 'view'),
c AS (SELECT l.event_id, l.user_id, l.us, r.us AS t, row_number() OVER (PARTITION BY l.event_id ORDER BY abs(r.us - l.us), r.us) AS k FROM l LEFT JOIN r USING (user_id))
SELECT event_id, user_id, CASE WHEN abs(t - us) <= 21600000000 THEN t END AS info_us FROM c WHERE k = 1""",
)
def d02(spark, sf):
    got = T.nearest_asof(_stream(spark, sf, "purchase"), _stream(spark, sf, "view"), left_ts="us", right_ts="us", by=["user_id"], tolerance=360 * MINUTE, out_ts="info_us")
    return got.select("event_id", "user_id", "info_us")


@REGISTRY.add(
    "d03_rekey_by_time",
    """WITH a AS (SELECT o_orderdate AS d, max(o_orderkey) AS k FROM orders GROUP BY 1)
SELECT l_orderkey, l_linenumber, k AS o_orderkey FROM lineitem JOIN a ON l_shipdate = d""",
)
def d03(spark, sf):
    assoc = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return T.rekey_by_time(items, assoc, item_ts="l_shipdate", assoc_ts="o_orderdate", key="o_orderkey", order="o_orderkey").select("l_orderkey", "l_linenumber", "o_orderkey")


@REGISTRY.add("d04_time_lookup_missing", "SELECT count(*) AS n, count(*) FILTER (o_orderkey IS NULL) AS missing, count(o_orderdate) AS found FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'O') o ON l_orderkey = o_orderkey")
def d04(spark, sf):
    times = table(spark, sf, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("k"), "o_orderdate")
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"))
    return T.lookup_times(rows, times, key="k", ts="o_orderdate").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderdate").isNull()).alias("missing"), F.count("o_orderdate").alias("found"))


@REGISTRY.add(
    "c03_stride_sample",
    """SELECT user_id, event_id, place FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS place FROM events) WHERE place % 5 = 0""",
)
def c03(spark, sf):
    return T.stride(table(spark, sf, "events"), by=["user_id"], order=["ts", "event_id"], step=5).select("user_id", "event_id", "place")


@REGISTRY.add(
    "c04_stride_with_early_stop",
    """SELECT user_id, event_id, place FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS place FROM events) WHERE place % 3 = 0 AND place < 20""",
)
def c04(spark, sf):
    return T.stride(table(spark, sf, "events"), by=["user_id"], order=["ts", "event_id"], step=3, limit=20).select("user_id", "event_id", "place")


@REGISTRY.add("h01_step_length", f"WITH {STEPS} SELECT traj_id, frame_id, round(step, 6) AS step FROM sp")
def h01(spark, sf):
    return T.steps(trajectories(spark, sf), by=["traj_id"], order="ts_ns").select("traj_id", "frame_id", r6("step").alias("step"))


@REGISTRY.add("h02_step_speed", f"WITH {STEPS} SELECT traj_id, frame_id, idx, round(step, 6) AS step, round(speed, 9) AS speed FROM sp")
def h02(spark, sf):
    s = T.steps(trajectories(spark, sf), by=["traj_id"], order="ts_ns", ts="ts_ns")
    return s.select("traj_id", "frame_id", "idx", r6("step").alias("step"), F.round("speed", 9).alias("speed"))


@REGISTRY.add(
    "h03_step_rotation",
    f"""WITH {TRAJ}, a AS (SELECT *, radians(frame_id % 360) AS t FROM traj),
b AS (SELECT *, lag(t) OVER (PARTITION BY traj_id ORDER BY ts_ns) AS p FROM a)
SELECT traj_id, frame_id, CASE WHEN p IS NOT NULL THEN round(degrees(acos(greatest(-1, least(1, (2 * (cos(t) * cos(p) + sin(t) * sin(p)) + 1 - 1) / 2)))), 3) END AS angle FROM b""",
)
def h03(spark, sf):
    t = F.radians(F.col("frame_id") % 360)
    z, one = F.lit(0.0), F.lit(1.0)
    rot = F.array(F.cos(t), -F.sin(t), z, F.sin(t), F.cos(t), z, z, z, one)
    got = T.rotation_steps(trajectories(spark, sf).withColumn("R", rot), by=["traj_id"], order="ts_ns", rotation="R")
    return got.select("traj_id", "frame_id", F.round("angle", 3).alias("angle"))


@REGISTRY.add(
    "h04_rolling_median",
    f"""WITH {TRAJ} SELECT traj_id, frame_id, round(median(x) OVER (PARTITION BY traj_id ORDER BY ts_ns ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING), 6) AS smooth FROM traj""",
)
def h04(spark, sf):
    got = T.rolling_median(trajectories(spark, sf), by=["traj_id"], order="ts_ns", value="x", half=5, out="smooth")
    return got.select("traj_id", "frame_id", r6("smooth").alias("smooth"))


CANDIDATES = f"""{TRAJ}, s AS (SELECT *, median(x) OVER (w ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS smooth, row_number() OVER w - 1 AS idx, count(*) OVER (PARTITION BY traj_id) AS n FROM traj WINDOW w AS (PARTITION BY traj_id ORDER BY ts_ns)),
m AS (SELECT *, median(smooth) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS before, median(smooth) OVER (w ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS after FROM s WINDOW w AS (PARTITION BY traj_id ORDER BY ts_ns)),
c AS (SELECT *, coalesce(idx >= 5 AND idx < n - 5 AND before > 0 AND (after / before > 1.5 OR after / before < 1 / 1.5), false) AS candidate FROM m)"""


@REGISTRY.add("h05_before_after_medians", f"WITH {CANDIDATES} SELECT traj_id, frame_id, round(before, 6) AS before, round(after, 6) AS after, candidate FROM c")
def h05(spark, sf):
    c = T.regime_candidates(trajectories(spark, sf), by=["traj_id"], order="ts_ns", value="x")
    return c.select("traj_id", "frame_id", r6("before").alias("before"), r6("after").alias("after"), "candidate")


@REGISTRY.add("h06_ordinal_rank", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1 AS rank FROM orders")
def h06(spark, sf):
    return T.stride(table(spark, sf, "orders"), by=["o_orderpriority"], order=["o_orderdate", "o_orderkey"], step=1).select("o_orderkey", F.col("place").alias("rank"))


@REGISTRY.add("h07_argmax_first_tie", f"WITH {STEPS} SELECT traj_id, idx FROM (SELECT traj_id, idx, row_number() OVER (PARTITION BY traj_id ORDER BY step DESC, idx) AS k FROM sp WHERE step IS NOT NULL) WHERE k = 1")
def h07(spark, sf):
    s = T.steps(trajectories(spark, sf), by=["traj_id"], order="ts_ns").where("step is not null")
    return s.groupBy("traj_id").agg(F.min_by("idx", F.struct(-F.col("step"), F.col("idx"))).alias("idx"))


@REGISTRY.add("h08_leading_frames", f"WITH {STEPS} SELECT traj_id, count(*) FILTER (idx < 2) AS leading, count(*) AS n FROM sp GROUP BY 1")
def h08(spark, sf):
    s = T.steps(trajectories(spark, sf), by=["traj_id"], order="ts_ns")
    return s.groupBy("traj_id").agg(F.count_if(F.col("idx") < 2).alias("leading"), F.count("*").alias("n"))


SEGMENTS = f"{STEPS}, sg AS (SELECT *, coalesce(sum(CASE WHEN speed > {SLOW} THEN 1 ELSE 0 END) OVER (PARTITION BY traj_id ORDER BY ts_ns), 0)::BIGINT AS segment FROM sp)"


def _segments(spark, sf):
    return T.speed_segments(trajectories(spark, sf), by=["traj_id"], order="ts_ns", ts="ts_ns", max_speed=SLOW)


@REGISTRY.add("i01_speed_jump_segments", f"WITH {SEGMENTS} SELECT traj_id, frame_id, segment FROM sg")
def i01(spark, sf):
    return _segments(spark, sf).select("traj_id", "frame_id", "segment")


@REGISTRY.add("i02_majority_segment", f"WITH {SEGMENTS}, n AS (SELECT traj_id, segment, count(*) AS n FROM sg GROUP BY ALL) SELECT traj_id, segment, n, row_number() OVER (PARTITION BY traj_id ORDER BY n DESC, segment) = 1 AS majority FROM n")
def i02(spark, sf):
    return T.segment_sizes(_segments(spark, sf), by=["traj_id"])


VERDICT = f"""{SEGMENTS}, n AS (SELECT traj_id, segment, count(*) AS n FROM sg GROUP BY ALL),
mj AS (SELECT *, row_number() OVER (PARTITION BY traj_id ORDER BY n DESC, segment) = 1 AS majority FROM n),
nd AS (SELECT a.traj_id, a.segment, min((a.x - b.x)^2 + (a.y - b.y)^2 + (a.z - b.z)^2) AS d2 FROM sg a JOIN sg b USING (traj_id) JOIN mj ON mj.traj_id = b.traj_id AND mj.segment = b.segment AND mj.majority WHERE a.segment != b.segment GROUP BY ALL),
v AS (SELECT mj.*, majority OR coalesce(d2 <= 4.0, false) AS merged FROM mj LEFT JOIN nd USING (traj_id, segment)),
u AS (SELECT *, sum(CASE WHEN merged THEN n ELSE 0 END) OVER (PARTITION BY traj_id) >= 3.0 * sum(CASE WHEN merged THEN 0 ELSE n END) OVER (PARTITION BY traj_id) AS resolved FROM v)"""


@REGISTRY.add("i03_disconnected_segments", f"WITH {VERDICT} SELECT sg.traj_id, frame_id, segment, merged, resolved, merged OR NOT resolved AS kept FROM sg JOIN u USING (traj_id, segment)")
def i03(spark, sf):
    got = T.filter_disconnected(_segments(spark, sf), by=["traj_id"])
    return got.select("traj_id", "frame_id", "segment", "merged", "resolved", "kept")


@REGISTRY.add("d25_segment_distance", f"WITH {VERDICT} SELECT traj_id, segment, merged FROM u WHERE NOT majority")
def d25(spark, sf):
    got = T.filter_disconnected(_segments(spark, sf), by=["traj_id"])
    return got.where("not majority").select("traj_id", "segment", "merged").distinct()


@REGISTRY.add(
    "i04_fragmentation",
    f"""WITH {VERDICT} SELECT traj_id, count(*) FILTER (NOT merged) AS apart, round(sum(CASE WHEN merged THEN 0 ELSE n END) / sum(n), 6) AS share,
  bool_or(NOT resolved) AND sum(CASE WHEN merged THEN 0 ELSE n END) / sum(n) > 0.05 AS severe FROM u GROUP BY 1""",
)
def i04(spark, sf):
    got = T.filter_disconnected(_segments(spark, sf), by=["traj_id"])
    share = F.count_if(~F.col("merged")) / F.count("*")
    apart = F.count_distinct(F.when(~F.col("merged"), F.col("segment")))
    return got.groupBy("traj_id").agg(apart.alias("apart"), r6(share).alias("share"), (F.bool_or(~F.col("resolved")) & (share > 0.05)).alias("severe"))


@REGISTRY.add(
    "i05_scale_regime_segments",
    f"""WITH RECURSIVE {CANDIDATES}, k AS (SELECT traj_id, idx FROM c WHERE candidate AND n >= 10),
a AS (SELECT traj_id, 0::BIGINT AS idx FROM (SELECT DISTINCT traj_id FROM k) UNION
  SELECT * FROM (SELECT a.traj_id, min(k.idx) AS idx FROM a JOIN k ON k.traj_id = a.traj_id AND k.idx - a.idx >= 10 GROUP BY a.traj_id, a.idx))
SELECT c.traj_id, c.frame_id, (SELECT count(*) FROM a WHERE a.traj_id = c.traj_id AND a.idx > 0 AND a.idx <= c.idx)::BIGINT AS segment FROM c""",
)
def i05(spark, sf):
    return T.regime_segments(trajectories(spark, sf), by=["traj_id"], order="ts_ns", value="x").select("traj_id", "frame_id", "segment")


@REGISTRY.add(
    "h09_segment_boundaries",
    f"WITH {SEGMENTS} SELECT traj_id, segment, arg_min(frame_id, ts_ns) AS first_frame, arg_max(frame_id, ts_ns) AS last_frame FROM sg GROUP BY ALL",
)
def h09(spark, sf):
    b = T.boundary_rows(_segments(spark, sf), by=["traj_id"], order="ts_ns", columns=["frame_id"])
    return b.select("traj_id", "segment", F.col("first.frame_id").alias("first_frame"), F.col("last.frame_id").alias("last_frame"))


@REGISTRY.add(
    "e17_trajectory_plausibility",
    f"""WITH {STEPS}, g AS (SELECT traj_id, count(*) AS n, sqrt((max(x) - min(x))^2 + (max(y) - min(y))^2 + (max(z) - min(z))^2) AS diagonal, coalesce(sum(step), 0) AS path, max(step) AS max_step FROM sp GROUP BY 1),
h AS (SELECT traj_id, idx AS max_step_at FROM (SELECT traj_id, idx, row_number() OVER (PARTITION BY traj_id ORDER BY step DESC NULLS LAST, idx) AS k FROM sp) WHERE k = 1)
SELECT traj_id, n, round(diagonal, 6) AS diagonal, round(path, 6) AS path, round(max_step, 6) AS max_step, max_step_at, round(path / diagonal, 6) AS ratio, path / diagonal > 15 AS severe FROM g JOIN h USING (traj_id)""",
)
def e17(spark, sf):
    p = T.plausibility(trajectories(spark, sf), by=["traj_id"], order="ts_ns", ts="ts_ns")
    return p.select("traj_id", "n", r6("diagonal").alias("diagonal"), r6("path").alias("path"), r6("max_step").alias("max_step"), "max_step_at", r6("ratio").alias("ratio"), "severe")


@REGISTRY.add(
    "e18_scene_metadata",
    f"""WITH {STEPS}, g AS (SELECT traj_id, count(*) AS n, coalesce(sum(step), 0) AS length, (max(ts_ns) - min(ts_ns)) / 1e9 AS duration, avg(speed) AS avg_speed, max(speed) AS max_speed, stddev_pop(speed) AS std_speed,
  max(x) - min(x) AS ex, max(y) - min(y) AS ey, max(z) - min(z) AS ez FROM sp GROUP BY 1),
h AS (SELECT traj_id, idx AS top FROM (SELECT traj_id, idx, row_number() OVER (PARTITION BY traj_id ORDER BY speed DESC NULLS LAST, idx) AS k FROM sp WHERE speed IS NOT NULL) WHERE k = 1)
SELECT traj_id, n, round(length, 6) AS length, round(duration, 6) AS duration, round(avg_speed, 9) AS avg_speed, round(max_speed, 9) AS max_speed, round(std_speed, 9) AS std_speed, top AS max_speed_at, round(ex * ey * ez, 6) AS volume, top - 1 < 2 AS leading FROM g LEFT JOIN h USING (traj_id)""",
)
def e18(spark, sf):
    m = T.scene_metadata(trajectories(spark, sf), by=["traj_id"], order="ts_ns", ts="ts_ns")
    return m.select("traj_id", "n", r6("length").alias("length"), r6("duration").alias("duration"), *[F.round(c, 9).alias(c) for c in ("avg_speed", "max_speed", "std_speed")], "max_speed_at", r6("volume").alias("volume"), "leading")
