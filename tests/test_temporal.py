import random

import pytest
from pyspark.sql import functions as F

from odometra.operators import temporal as T


def times(spark, values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "ts long, ord long")


def asof(spark, left, right, tolerance):
    got = T.nearest_asof(times(spark, left), times(spark, right), left_ts="ts", right_ts="ts", tolerance=tolerance, right_order="ord").collect()
    return {(r.ts, r.ord): r.matched_ts for r in got}


def test_close_streams_match(spark):
    left = [1_000_000_000, 1_033_000_000, 1_066_000_000]
    got = asof(spark, left, [t + 1_000_000 for t in left], 50_000_000)
    assert sorted(got.values()) == [t + 1_000_000 for t in left]


def test_far_streams_do_not(spark):
    assert list(asof(spark, [1_000_000_000], [2_000_000_000], 33_000_000).values()) == [None]


def test_no_right_rows(spark):
    assert list(asof(spark, [5], [], 3).values()) == [None]


def test_tie_goes_to_the_first_right_row(spark):
    # 8 and 12 are as near to 10; input order decides
    assert asof(spark, [10], [12, 8], 5) == {(10, 0): 12}
    assert asof(spark, [10], [8, 12], 5) == {(10, 0): 8}


def test_asof_against_brute_force(spark):
    rng = random.Random(3)
    for tolerance in (1, 7, 50):
        left, right = [rng.randrange(-300, 300) for _ in range(80)], [rng.randrange(-300, 300) for _ in range(60)]
        want = {}
        for i, t in enumerate(left):
            d, o = min((abs(r - t), k) for k, r in enumerate(right))
            want[(t, i)] = right[o] if d <= tolerance else None
        assert asof(spark, left, right, tolerance) == want


def poses(spark, rows):
    return spark.createDataFrame([("a", *r) for r in rows], "traj string, frame int, ts long, x double, y double, z double")


def walk(n, step=0.05, start=0.0, at=0):
    return [(at + i, (at + i) * 1_000_000_000, start + i * step, 0.0, 0.0) for i in range(n)]


SEGMENT = {"by": ["traj"], "order": "frame", "ts": "ts"}


def test_slow_walk_is_one_segment(spark):
    assert T.speed_segments(poses(spark, walk(10)), **SEGMENT).agg(F.max("segment")).first()[0] == 0


def test_unknown_and_still_times_do_not_break(spark):
    rows = [(0, 0, 0.0, 0.0, 0.0), (1, None, 90.0, 0.0, 0.0), (2, None, 0.0, 0.0, 0.0), (3, 5, 50.0, 0.0, 0.0), (4, 5, 99.0, 0.0, 0.0)]
    assert T.speed_segments(poses(spark, rows), **SEGMENT).agg(F.max("segment")).first()[0] == 0


def test_minority_segment_is_dropped(spark):
    seg = T.speed_segments(poses(spark, walk(11) + walk(40, start=100.0, at=11)), **SEGMENT)
    got = T.filter_disconnected(seg, by=["traj"])
    assert got.where("kept").count() == 40 and got.where("resolved").count() == 51


def test_comparable_segments_are_left(spark):
    seg = T.speed_segments(poses(spark, walk(11) + walk(30, start=100.0, at=11)), **SEGMENT)
    got = T.filter_disconnected(seg, by=["traj"])
    assert got.where("kept").count() == 41 and got.where("resolved").count() == 0


def test_near_minority_is_merged(spark):
    rows = walk(5) + [(5 + i, (5 + i) * 1_000_000_000, 0.1 + (50 if i == 0 else 0), 0.0, 0.0) for i in range(8)]
    got = T.filter_disconnected(T.speed_segments(poses(spark, rows), **SEGMENT), by=["traj"])
    assert got.groupBy("segment").agg(F.first("merged").alias("m")).where("m").count() >= 2


def test_regime_change_is_found_near_the_middle(spark):
    series = spark.createDataFrame([("a", i, 0.62 if i < 60 else 3.05) for i in range(120)], "traj string, frame int, ratio double")
    got = T.regime_segments(series, by=["traj"], order="frame", value="ratio")
    first = got.where("segment = 1").agg(F.min("frame")).first()[0]
    assert got.agg(F.max("segment")).first()[0] == 1 and abs(first - 60) <= 5


@pytest.mark.parametrize("values", [[1.0 + (i % 3) * 0.01 for i in range(80)], [1.0, 9.0]])
def test_flat_or_short_series_is_one_regime(spark, values):
    series = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "traj string, frame int, ratio double")
    assert T.regime_segments(series, by=["traj"], order="frame", value="ratio").agg(F.max("segment")).first()[0] == 0


def test_plausibility(spark):
    straight = T.plausibility(poses(spark, walk(21, 0.5)), by=["traj"], order="frame", ts="ts").first()
    assert straight.ratio == pytest.approx(1.0) and not straight.severe
    jumps = [(i, i * 10**9, 12.0 * (i % 2), 0.0, 0.0) for i in range(60)]
    assert T.plausibility(poses(spark, jumps), by=["traj"], order="frame", ts="ts").first().severe
    one = T.plausibility(poses(spark, walk(1)), by=["traj"], order="frame", ts="ts").first()
    assert one.ratio == 0 and not one.severe


def test_scene_metadata(spark):
    m = T.scene_metadata(poses(spark, walk(5, 1.0)), by=["traj"], order="frame", ts="ts").first()
    assert (m.length, m.duration, m.avg_speed, m.n) == (4.0, 4.0, 1.0, 5)


def test_stride_and_early_stop(spark):
    rows = spark.range(20).select(F.lit("a").alias("k"), F.col("id"))
    got = T.stride(rows, by=["k"], order=["id"], step=3, limit=10)
    assert sorted(r.id for r in got.collect()) == [0, 3, 6, 9]


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_partitions_do_not_matter(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = asof(spark, list(range(0, 500, 7)), list(range(3, 500, 11)), 4)
        assert sum(v is not None for v in got.values()) == sum(any(abs(r - t) <= 4 for r in range(3, 500, 11)) for t in range(0, 500, 7))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
