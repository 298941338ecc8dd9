import pytest
from pyspark.sql import functions as F

from odometra.functions.register import register
from odometra.operators import similarity as S
from odometra.plans import flow


def frames(spark, rows):
    return spark.createDataFrame(rows, "frame_id int, ts_ns long, filename string")


def test_synchronise(spark):
    colour = frames(spark, [(0, 1000, "000000.png"), (15, 2000, "000015.png"), (30, 9000, "000030.png")])
    depth = frames(spark, [(0, 1010, "d0"), (1, 1990, "d1"), (2, 50000, "d2")])
    a, keyed = flow.synchronise(colour, depth, tolerance=50)
    assert {r.frame_id: (r.depth_ts, r.delta) for r in a.collect()} == {0: (1010, 10), 15: (1990, 10), 30: (None, None)}
    assert {r.frame_id: r.filename for r in keyed.collect()} == {0: "d0", 15: "d1"}
    a, keyed = flow.synchronise(colour, depth.limit(0), depth, tolerance=50, info_tolerance=20)
    assert {r.frame_id: (r.depth_ts, r.camera_info_ts) for r in a.collect()} == {0: (None, 1010), 15: (None, 1990), 30: (None, None)}
    assert keyed.count() == 0


def test_scale_and_check(spark):
    rows = [("good", i, i * 10**9, 0.1 * i, 0.0, 0.0) for i in range(40)] + [("bad", i, i * 10**9, 30.0 * (i % 2), 0.0, 0.0) for i in range(40)]
    poses = spark.createDataFrame(rows, "traj string, frame int, ts long, x double, y double, z double")
    scales = spark.createDataFrame([("good", 2.0)], "traj string, scale double")
    kept, report = flow.scale_and_check(poses, scales, by=["traj"], order="frame", ts="ts")
    got = {r.traj: r for r in report.collect()}
    assert got["good"].ok and got["good"].length == pytest.approx(0.2 * 39) and not got["bad"].ok
    assert kept.where("traj = 'good'").agg(F.max("x")).first()[0] == pytest.approx(7.8)
    assert all(r.ok for r in flow.scale_and_check(poses, scales, by=["traj"], order="frame", ts="ts", override=True)[1].collect())


def test_method_dispatch(spark):
    pairs = spark.createDataFrame([("m", float(i + 1), float(i % 3), 1.0, 2.0 * (i + 1), 2.0 * (i % 3), 2.0) for i in range(30)], "k string, a double, b double, c double, x double, y double, z double")
    for method in ("median", "umeyama", "ransac"):
        assert S.estimate_scale(pairs, method=method, cam=["a", "b", "c"], world=["x", "y", "z"], by=["k"]).first().scale == pytest.approx(2.0)
    with pytest.raises(ValueError):
        S.estimate_scale(pairs, method="huber", cam=["a", "b", "c"], world=["x", "y", "z"], by=["k"])


def test_sql_functions(spark):
    names = register(spark)
    assert "pair_id" in names
    r = spark.sql("SELECT pair_first(pair_id(9, 4)) AS a, pair_second(pair_id(9, 4)) AS b, huber_weight(2D, 1D) AS w, frame_number('x/000015.png') AS f").first()
    assert (r.a, r.b, r.w, r.f) == (4, 9, 0.5, 15)
    assert [x.gap for x in spark.sql("SELECT gap FROM quadratic_offsets(4) ORDER BY gap").collect()] == [1, 2, 4, 8]
    assert spark.sql("SELECT * FROM pixel_grid(4, 6, 2)").count() == 6
