import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from odometra.functions import scalar as M
from odometra.operators import evaluation as E
from odometra.operators import graph as G
from odometra.operators import pairs as P
from odometra.operators import quality as Q
from odometra.operators import similarity as S
from odometra.operators import stats as St
from odometra.operators import topics as T


def pairs_of(df):
    return sorted((r.id1, r.id2) for r in df.collect())


def test_pair_generators(spark):
    items = spark.range(5).select(F.col("id").alias("image_id"))
    assert len(pairs_of(P.exhaustive(items, "image_id"))) == 10
    assert pairs_of(P.sequential(items, key="image_id", order=["image_id"], overlap=2)) == [(0, 1), (0, 2), (1, 2), (1, 3), (2, 3), (2, 4), (3, 4)]
    assert pairs_of(P.sequential(items, key="image_id", order=["image_id"], overlap=3, quadratic=True)) == [(0, 1), (0, 2), (0, 4), (1, 2), (1, 3), (2, 3), (2, 4), (3, 4)]
    chain = spark.createDataFrame([(0, 1), (1, 2), (2, 3)], "id1 long, id2 long")
    assert pairs_of(P.transitive(chain)) == [(0, 2), (1, 3)]
    assert pairs_of(P.transitive(chain, rounds=2)) == [(0, 2), (0, 3), (1, 3)]


def test_loop_filter(spark):
    p = spark.createDataFrame([(0, 1, 5, 10), (0, 9, 29, 30), (0, 8, 40, 200), (0, 7, 40, None), (0, 6, 40, 0)], "id1 long, id2 long, inliers int, matches int")
    ranks = spark.range(10).select(F.col("id").alias("image_id"), F.col("id").alias("rank"))
    got = P.loop_filter(P.classify_pairs(p, ranks, key="image_id", overlap=5), inliers="inliers", matches="matches")
    assert {r.id2: r.keep for r in got.collect()} == {1: True, 9: False, 8: False, 7: True, 6: False}


def test_knn_blocks(spark, monkeypatch):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 4))
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "k long, v array<double>")
    monkeypatch.setattr(P, "KNN_BLOCK", 16)
    got = {(r.query, r["rank"]): r.neighbor for r in P.knn(rows, rows, key="k", vector="v", k=3).collect()}
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    assert got == {(i, k + 1): int(j) for i in range(60) for k, j in enumerate(np.argsort(d[i], kind="stable")[:3])}


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 8), (5, 5), *[(100, 100 + i) for i in range(1, 40)]], "id1 long, id2 long")
    got = {r.node: r.component for r in G.connected_components(edges, nodes=spark.createDataFrame([(5,)], "n long")).collect()}
    assert got[3] == 1 and got[8] == 7 and got[5] == 5 and got[139] == 100
    ranked = {r.node: r["rank"] for r in G.ranked_components(G.connected_components(edges), 3).collect()}
    assert ranked[120] == 0 and ranked[2] == 1 and ranked[7] == -1
    empty = spark.createDataFrame([], "id1 long, id2 long")
    assert G.connected_components(empty).count() == 0


def test_long_path_component(spark):
    path = spark.range(200).select(F.col("id").alias("id1"), (F.col("id") + 1).alias("id2"))
    assert {r.component for r in G.connected_components(path).collect()} == {0}


def kruskal(edges):
    parent, tree = {}, []

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for w, a, b in sorted((-w, a, b) for a, b, w in edges):
        if find(a) != find(b):
            parent[find(a)] = find(b)
            tree.append((a, b, -w))
    return sorted(tree)


def test_spanning_forest_is_kruskals(spark):
    rng = np.random.default_rng(1)
    edges = {(int(min(a, b)), int(max(a, b))): int(w) for a, b, w in rng.integers(0, 25, (90, 3)) if a != b}
    rows = [(a, b, w) for (a, b), w in edges.items()]
    got = sorted((r.id1, r.id2, r.weight) for r in G.spanning_forest(spark.createDataFrame(rows, "id1 long, id2 long, weight long")).collect())
    assert got == kruskal(rows)


def test_tracks(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (10, 11), (11, 12), (12, 13)], "id1 long, id2 long")
    f = spark.createDataFrame([(1, 1, 0.0, 0.0), (2, 2, 0.0, 0.0), (3, 3, 0.0, 0.0), (10, 1, 0.0, 0.0), (11, 2, 0.0, 0.0), (12, 3, 0.0, 0.0), (13, 1, 8.0, 8.0)], "node long, image long, x double, y double")
    got = {r.track for r in G.establish_tracks(edges, f, max_distance=10.0, min_images=3).collect()}
    assert got == {1}  # the other has two places 11.3 apart in one image
    assert {r.track for r in G.establish_tracks(edges, f, max_distance=12.0, min_images=3).collect()} == {1, 10}


def test_quality_filters(spark):
    obs = spark.createDataFrame([(1, 1, 0.5), (1, 2, 1.5), (1, 3, 9.0), (2, 1, 0.1), (2, 2, 9.0), (3, 1, 0.1)], "p long, i long, e double")
    got = Q.drop_large_errors(obs, point="p", error="e", max_error=2.0).collect()
    assert sorted((r.p, r.i, r.mean_error) for r in got) == [(1, 1, 1.0), (1, 2, 1.0)]
    assert Q.drop_short_tracks(obs, point="p", min_length=2).select("p").distinct().count() == 2
    rays = spark.createDataFrame([(1, 1.0, 0.0, 0.0), (1, math.cos(0.1), math.sin(0.1), 0.0), (2, 1.0, 0.0, 0.0), (2, 1.0, 0.0, 0.0), (3, 0.0, 1.0, 0.0)], "p long, x double, y double, z double")
    assert {r.p for r in Q.drop_small_angles(rays, point="p", rays=["x", "y", "z"], min_angle=2.0).collect()} == {1}


def test_similarity_recovers_known_transform(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=(100, 3))
    q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    q *= np.sign(np.linalg.det(q))
    b = 3.0 * a @ q.T + np.array([1.0, -2.0, 0.5])
    df = spark.createDataFrame([("m", *map(float, x), *map(float, y)) for x, y in zip(a, b, strict=True)], "k string, a0 double, a1 double, a2 double, b0 double, b1 double, b2 double")
    fit = S.similarity_fit(df, source=["a0", "a1", "a2"], target=["b0", "b1", "b2"], by=["k"])
    r = fit.first()
    assert r.scale == pytest.approx(3.0) and np.allclose([r[f"r{i}"] for i in range(9)], q.ravel()) and np.allclose([r.t0, r.t1, r.t2], [1, -2, 0.5])
    assert S.fit_quality(df, fit, source=["a0", "a1", "a2"], target=["b0", "b1", "b2"], by=["k"]).first().n == 100


def test_scale_estimates(spark):
    rng = np.random.default_rng(2)
    a = rng.uniform(0.5, 2.0, (100, 3))
    noisy = a * 2.5 * rng.normal(1, 0.01, (100, 1))
    noisy[:10] *= 4
    df = spark.createDataFrame([("m", *map(float, x), *map(float, y)) for x, y in zip(a, noisy, strict=True)], "k string, a0 double, a1 double, a2 double, b0 double, b1 double, b2 double")
    m = S.scale_by_median(df, cam=["a0", "a1", "a2"], world=["b0", "b1", "b2"], by=["k"]).first()
    assert m.scale == pytest.approx(2.5, rel=0.05) and 0.5 < m.inlier_ratio < 1
    r = S.scale_by_ransac(df, cam=["a0", "a1", "a2"], world=["b0", "b1", "b2"], by=["k"], order=["a0"]).first()
    assert r.scale == pytest.approx(2.5, rel=0.05) and r.inliers >= 85
    few = S.scale_by_median(df.limit(2), cam=["a0", "a1", "a2"], world=["b0", "b1", "b2"], by=["k"]).first()
    assert (few.scale, few.confidence) == (1.0, 0.0)


def bands_by_definition(xyz, width=0.05, most=0.5, least=300, residual=0.10, level=0.85):
    """Windows of bins over all points, each fitted anew by singular values."""
    y = xyz[:, 1]
    n = max(1, math.ceil((y.max() - y.min()) / width))
    bins = np.clip(np.digitize(y, np.linspace(y.min(), y.max(), n + 1)) - 1, 0, n - 1)
    out, b = [], 0
    while b < n:
        best, size = None, 1
        while (bins == b).any() and size <= round(most / width) and b + size <= n:
            some = xyz[(bins >= b) & (bins < b + size)]
            if len(some) >= least:
                normal = np.linalg.svd(some - some.mean(axis=0))[2][-1]
                if ((some - some.mean(axis=0)) @ normal).std() <= residual and abs(normal[1]) >= level:
                    best = (len(some), some[:, 1].min(), some[:, 1].max(), some[:, 1].mean())
                elif best:
                    break
            size += 1
        out += [best] if best else []
        b += size if best else 1
    return out


def test_planar_bands(spark):
    rng = np.random.default_rng(0)
    for k in range(4):
        layers = [np.c_[rng.uniform(0, 10, 600), h + 0.03 * rng.normal(size=600), rng.uniform(0, 8, 600)] for h in (0.0, 0.4, 1.3, 3.0)[: k + 1]]
        wall = np.c_[rng.uniform(0, 0.1, 500), rng.uniform(0, 3, 500), rng.uniform(0, 8, 500)]
        xyz = np.concatenate([*layers, wall])
        df = spark.createDataFrame([("m", *map(float, p)) for p in xyz], "k string, x double, y double, z double").repartition(5)
        got = S.planar_bands(df, by=["k"]).orderBy("band").collect()
        want = bands_by_definition(xyz)
        assert [r.n for r in got] == [w[0] for w in want] and len(want) >= 1
        assert np.allclose([(r.low, r.high, r.height) for r in got], [w[1:] for w in want])
    flat = spark.createDataFrame([("m", 1.0, 2.0, 3.0)] * 400, "k string, x double, y double, z double")
    assert S.planar_bands(flat, by=["k"]).count() == 0  # no height at all


def test_duplicate_surfaces(spark):
    """One floor isn't flagged, the same floor twice is, and neither are bands that touch or lie beside each other."""
    rng = np.random.default_rng(1)

    def scene(name, layers):
        points, obs = [], []
        for height, shift in layers:
            for _ in range(500):
                x, z = rng.uniform(0, 5), rng.uniform(0, 5)
                points.append((name, len(points), x + shift, height + 0.01 * rng.normal(), z))
                obs += [(name, i, x / 5 * 600, z / 5 * 460, points[-1][1]) for i in range(6)]
        return points, obs

    scenes = {"one": [(0.0, 0)], "two": [(0.0, 0), (0.6, 0)], "near": [(0.0, 0), (0.12, 0)], "beside": [(0.0, 0), (0.6, 20.0)]}
    points, obs = map(list, zip(*[scene(k, v) for k, v in scenes.items()], strict=True))
    p = spark.createDataFrame([x for part in points for x in part], "m string, point long, x double, y double, z double")
    o = spark.createDataFrame([x for part in obs for x in part], "m string, image long, u double, v double, point long")
    bands = S.planar_bands(p, by=["m"])
    seen = o.join(S.in_bands(p, bands, by=["m"], up="y").select("m", "point", "band"), ["m", "point"])
    overlap = S.footprint_overlap(seen, cluster="band", image="image", u="u", v="v", width=640.0, height=480.0, by=["m"])
    got = S.duplicate_surfaces(bands, overlap, by=["m"]).collect()
    assert [(r.m, r.a, r.b, r.frames) for r in got] == [("two", 0, 1, 6)] and got[0].separation == pytest.approx(0.6, abs=0.01) and got[0].iou > 0.9


def test_chained_transforms_keep_the_motion_between_segments(spark):
    rng = np.random.default_rng(5)

    def turn():
        q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
        return q * np.sign(np.linalg.det(q))

    segments = [(rng.uniform(0.5, 2), turn(), rng.normal(size=3), rng.normal(size=3), rng.normal(size=3), turn(), turn()) for _ in range(6)]
    rows = [("m", k, s, *map(float, r.ravel()), *map(float, (*t, *first, *last))) for k, (s, r, t, first, last, _, _) in enumerate(segments)]
    names = ", ".join([f"r{i} double" for i in range(9)] + [f"{c}{i} double" for c in "tfl" for i in range(3)])
    got = S.chain_transforms(spark.createDataFrame(rows, f"m string, seg int, scale double, {names}"), by=["m"], order="seg", first=["f0", "f1", "f2"], last=["l0", "l1", "l2"]).orderBy("seg").collect()
    chain = None  # pose by pose: the own fit, then the rigid motion that restores the step between boundary poses
    for (s, r, t, first, last, r_first, r_last), g in zip(segments, got, strict=True):
        if chain is None:
            chain = (s, r, t)
        else:
            (s0, r0, t0), (last0, r_last0) = chain, before
            pose, place = r0 @ r_last0, s0 * r0 @ last0 + t0
            target, goal = pose @ r_last0.T @ r_first, pose @ r_last0.T @ (first - last0) + place
            extra = target @ (r @ r_first).T
            chain = (s, extra @ r, extra @ t + goal - extra @ (s * r @ first + t))
        before = (last, r_last)
        assert g.scale == pytest.approx(chain[0]) and np.allclose([g[f"r{i}"] for i in range(9)], chain[1].ravel()) and np.allclose([g[f"t{i}"] for i in range(3)], chain[2])


def test_ransac_scale_by_definition(spark):
    rng = np.random.default_rng(9)
    rows, want = [], {}
    for k, n in (("many", 80), ("some", 5), ("two", 2), ("none", 4)):
        cam, world = np.abs(rng.normal(size=n)) + 0.1, None
        world = cam * np.where(rng.random(n) < 0.7, 1.7, rng.uniform(0.2, 5, n))
        cam[0] = 0 if n > 3 else cam[0]
        cam = cam * 0 if k == "none" else cam
        rows += [(k, i, float(a), float(b)) for i, (a, b) in enumerate(zip(cam, world, strict=True))]
        valid = (cam > 0) & (world > 0)
        best = (1.0, 0)
        if n >= 3 and valid.any():
            ratio, draw = world[valid] / cam[valid], np.random.default_rng(42)
            for _ in range(1000):
                c = np.median(ratio[draw.choice(len(ratio), min(3, len(ratio)), replace=False)])
                m = int((np.abs(ratio - c) / c < 0.05).sum())
                best = (c, m) if m > best[1] else best
        want[k] = (best[0], best[1], int(valid.sum()) if n >= 3 else 0)
    df = spark.createDataFrame(rows, "k string, i int, a double, b double").repartition(4)
    got = {r.k: (r.scale, r.inliers, r.n) for r in S.scale_by_ransac(df, cam=["a"], world=["b"], by=["k"], order=["i"]).collect()}
    assert {k: v[1:] for k, v in got.items()} == {k: v[1:] for k, v in want.items()}
    assert all(got[k][0] == pytest.approx(want[k][0]) for k in want)


def test_statistics(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", 5.0)] * 4, "k string, v double")
    m = {r.k: (r["median"], r.mad) for r in St.median_mad(df, "v", ["k"]).collect()}
    assert m == {"a": (3.0, 1.0), "b": (5.0, 0.0)}
    kept = St.mad_inliers(df, "v", ["k"])
    assert kept.where("k = 'a'").count() == 4 and kept.where("k = 'b'").count() == 4
    h = {(r.k, r.bin): r.n for r in St.histogram(df, "v", 4, ["k"]).collect()}
    assert h["a", 0] == 4 and h["a", 3] == 1 and h["b", 2] == 4 and sum(h.values()) == 9
    a, b = St.irls_line(spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2 + 1 + F.when(F.col("id") == 7, 500).otherwise(0)).cast("double").alias("y")), "x", "y")
    assert a == pytest.approx(2.0, abs=0.1) and b == pytest.approx(1.0, abs=2.0)


def test_recall_auc(spark):
    df = spark.createDataFrame([("a", float(e)) for e in (1, 2, 3, 50)], "k string, e double")
    got = {r.threshold: (r.recall, r.auc) for r in E.recall_auc(df, error="e", thresholds=[5.0, 0.5], by=["k"]).collect()}
    e, r = np.array([0, 1, 2, 3, 5]), np.array([0, 0.25, 0.5, 0.75, 0.75])
    assert got[5.0][0] == 75 and got[5.0][1] == pytest.approx(100 * np.trapezoid(r, e) / 5)
    assert got[0.5] == (0, 0)


def test_edge_errors(spark):
    t, f = spark.createDataFrame([(1, 2), (2, 3)], "id1 long, id2 long"), spark.createDataFrame([(1, 2, 3.0), (5, 6, 1.0)], "id1 long, id2 long, d double")
    got = {(r.id1, r.id2): (r.side, r.error) for r in E.edge_errors(t, f, error=F.col("d")).collect()}
    assert got == {(1, 2): ("both", 3.0), (2, 3): ("missed", 180.0), (5, 6): ("extra", 180.0)}


def test_scalars(spark):
    one = spark.range(1)
    q = F.array(*[F.lit(x) for x in (math.cos(math.pi / 4), 0.0, 0.0, math.sin(math.pi / 4))])
    r = one.select(M.rotation_of(q).alias("r")).first().r
    assert np.allclose(r, [0, -1, 0, 1, 0, 0, 0, 0, 1])
    back = one.select(M.quaternion_of(M.rotation_of(q)).alias("q")).first().q
    assert np.allclose(back, [0, 0, math.sin(math.pi / 4), math.cos(math.pi / 4)])
    f = one.select(*[M.compressed_format(F.lit(s)).alias(n) for n, s in (("a", "16UC1; png compressed "), ("b", "rgb8; jpeg compressed bgr8"), ("c", "jpg"), ("d", ""))]).first()
    assert (f.a.encoding, f.a.codec, f.b.codec, f.c.codec, f.d.codec) == ("16UC1", "png", "jpeg", "jpeg", None)
    assert one.select(M.iso_utc(F.lit(1_700_000_000_123_456_789)).alias("t")).first().t == "2023-11-14T22:13:20.123456+00:00"
    p = one.select(M.pair_id(F.lit(2_000_000_000), F.lit(7)).alias("p")).select(M.pair_first("p").alias("a"), M.pair_second("p").alias("b")).first()
    assert (p.a, p.b) == (7, 2_000_000_000)
    x, y, z = M.to_ecef(F.lit(48.0), F.lit(11.0), F.lit(500.0))
    g = one.select(M.from_ecef(x, y, z).alias("g")).first().g
    assert (g.lat, g.lon) == (pytest.approx(48.0), pytest.approx(11.0)) and g.alt == pytest.approx(500.0, abs=1e-6)


def test_topics(spark):
    rows = [("/cam/depth/image/compressed", "sensor_msgs/CompressedImage", 1), ("/cam/color/image/compressed", "sensor_msgs/CompressedImage", 1), ("/colorful/image", "sensor_msgs/Image", 1)]
    got = T.classify(spark.createDataFrame(rows, "name string, msgtype string, msgcount int"))
    assert {r.name: r.role for r in got.collect()} == {"/cam/depth/image/compressed": "depth", "/cam/color/image/compressed": "rgb", "/colorful/image": "other"}
    best = {r.role: r.name for r in T.best_topics(got, {"rgb": "/mine"}).collect()}
    assert best == {"rgb": "/mine", "depth": "/cam/depth/image/compressed"}


def test_track_selection_by_definition(spark):
    rng = np.random.default_rng(3)
    for budget, most in ((0, None), (1, None), (2, 7), (5, None)):
        tracks = {p: sorted(map(int, rng.choice(8, rng.integers(1, 6)))) for p in range(30)}
        counts, left, want = dict.fromkeys({i for x in tracks.values() for i in x}, 0), None, []
        left = len(counts)
        for _, p in sorted(((len(x), p) for p, x in tracks.items()), reverse=True):
            if most is not None and len(want) >= most:
                break
            if any(counts[i] <= budget for i in tracks[p]):
                for i in tracks[p]:
                    left -= counts[i] == budget
                    counts[i] += 1
                want.append(p)
                if left == 0:
                    break
        df = spark.createDataFrame([("m", p, i) for p, x in tracks.items() for i in x], "m string, p long, i long")
        assert sorted(r.point for r in T.select_tracks(df, point="p", image="i", budget=budget, max_tracks=most, by=["m"]).collect()) == sorted(want)


def test_redundant_points_by_definition(spark):
    """Each time the point of the largest gain, all gains taken anew."""
    rng = np.random.default_rng(4)
    for least in (0.0, 0.2, 0.6):
        seen = {p: [(int(i), float(x), float(y)) for i, x, y in zip(rng.choice(4, 3), rng.uniform(-1, 11, 3), rng.uniform(0, 5, 3), strict=True)] for p in range(25)}
        tile = lambda o: (o[0], min(max(int(8 * o[1] / 10), 0), 7), min(max(int(8 * o[2] / 5), 0), 7))
        held, left = {}, set(seen)
        while left:
            gain, p = max((sum(1 / math.sqrt(1 + held.get(tile(o), 0)) - 1 / math.sqrt(2 + held.get(tile(o), 0)) for o in sorted(seen[q], key=tile)), q) for q in left)
            if gain <= least:
                break
            left.remove(p)
            for o in seen[p]:
                held[tile(o)] = held.get(tile(o), 0) + 1
        df = spark.createDataFrame([("m", p, *o) for p, x in seen.items() for o in x], "m string, p long, i long, x double, y double")
        got = T.redundant_points(df, point="p", image="i", x="x", y="y", width=10.0, height=5.0, min_gain=least, by=["m"]).collect()
        assert {r.point for r in got} == left


def test_indexed_neighbours(spark):
    rng = np.random.default_rng(6)
    middle = rng.normal(size=(30, 16)) * 3
    x = middle[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    asks = df.where("id % 100 = 0")
    exact = {(r.query, r.neighbor) for r in P.knn(asks, df, key="id", vector="v", k=10).collect()}
    d = ((x[::100, None] - x[None]) ** 2).sum(axis=2)
    assert exact == {(100 * i, int(j)) for i, row in enumerate(d) for j in np.argsort(row)[1:11]}
    found = {(r.query, r.neighbor) for r in P.indexed_knn(asks, df, key="id", vector="v", k=10).collect()}
    assert len(found & exact) >= 0.9 * len(exact) and len(found) == len(exact)
    centres = P.train_cells(df, key="id", vector="v", cells=7)
    assert {(r.query, r.neighbor) for r in P.indexed_knn(asks, df, key="id", vector="v", k=10, centres=centres, probes=7).collect()} == exact
    assert P.indexed_knn(asks.limit(0), df.limit(0), key="id", vector="v", k=3).count() == 0


def test_dense_ids(spark):
    rows = spark.range(100).select((F.col("id") * 37 % 1000).alias("k")).repartition(7)
    got = P.dense_ids(rows, ["k"]).orderBy("k").collect()
    assert [r.dense_id for r in got] == list(range(1, 101))


def test_rooted_forest_against_a_walk(spark):
    import random


    for seed in range(2):
        rng = random.Random(seed)
        n = 40
        # 25 begins another tree
        edges = [(i, rng.randrange(25 * (i > 25) if seed else i - 1, i)) for i in range(1, n) if i != 25]
        df = spark.createDataFrame([e if rng.random() < 0.5 else e[::-1] for e in edges], "id1 long, id2 long")
        near = {}
        for u, v in edges:
            near.setdefault(u, set()).add(v)
            near.setdefault(v, set()).add(u)

        def walk(root):
            out, front = {root: (root, 0, root)}, [root]
            for u in front:
                for v in near.get(u, ()):
                    if v not in out:
                        out[v] = (u, out[u][1] + 1, root)
                        front.append(v)
            return out

        got = {r.node: (r.parent, r.depth, r.root) for r in G.rooted_forest(df).collect()}
        assert got == walk(0) | walk(25)
        roots = spark.createDataFrame([(7,), (9,)], "node long")
        one = {r.node: (r.parent, r.depth, r.root) for r in G.rooted_forest(df, roots=roots.where("node = 9")).collect()}
        assert one == {k: (None, None, None) for k in range(n) if k in near} | walk(9)
        nodes = spark.createDataFrame([(99,), (3,), (100,)], "node long")
        both = {r.node: (r.parent, r.depth, r.root) for r in G.rooted_forest(df, roots=roots.union(nodes.where("node = 99")), nodes=nodes).collect()}
        assert both == {k: (None, None, None) for k in (*near, 100)} | walk(7) | {99: (99, 0, 99)}
    assert G.rooted_forest(df.limit(0)).count() == 0
    ring = spark.createDataFrame([(0, 1), (1, 2), (2, 0), (2, 3)], "id1 long, id2 long")
    with pytest.raises(ValueError, match="cycle"):
        G.rooted_forest(ring)


def test_a_path_of_100000_nodes_is_rooted_in_logarithmic_rounds(spark, monkeypatch):
    written, kept = [], G.materialize
    monkeypatch.setattr(G, "materialize", lambda df: written.append(1) or kept(df))
    n = 100_000
    path = spark.range(n - 1).select(((F.col("id") * 7919 + 13) % n).alias("id1"), (((F.col("id") + 1) * 7919 + 13) % n).alias("id2"))
    got = G.rooted_forest(path, roots=spark.createDataFrame([(13,)], "node long"))
    place = F.pmod((F.col("node") - 13) * 17679, F.lit(n))  # 17679 * 7919 = 1 (mod 100000)
    row = got.agg(F.count("*").alias("n"), F.count_if(F.col("depth") != place).alias("wrong"), F.max("depth").alias("deepest"), F.count_if(F.col("parent") == F.col("node")).alias("tops")).first()
    assert (row.n, row.wrong, row.deepest, row.tops) == (n, 0, n - 1, 1)
    assert len(written) < 30


def test_watermarks(spark):
    """Planted marks in the border under noise and other matches, against scenes, one shift in the middle, and border matches without a shift."""
    import random

    rng, rows, want = random.Random(6), [], {}
    edge = lambda: rng.choice([(rng.uniform(0, 60), rng.uniform(0, 480)), (rng.uniform(0, 640), rng.uniform(420, 480))])
    anywhere = lambda: (rng.uniform(0, 640), rng.uniform(0, 480))
    for k in range(40):
        kind = k % 4
        shift = (rng.uniform(-3, 3), rng.uniform(-3, 3))
        for _ in range(30 + 2000 * (k == 4)):
            if kind in (0, 3) and rng.random() < 0.9:
                x, y = edge()
            else:
                x, y = anywhere()
            if kind == 0 or kind == 1:
                moved = (x + shift[0] + rng.gauss(0, 0.7), y + shift[1] + rng.gauss(0, 0.7)) if rng.random() < 0.95 else anywhere()
            else:
                moved = edge() if kind == 3 else anywhere()
            rows.append((k, x, y, *moved, 640, 480, 640, 480))
        want[k] = kind == 0
    df = spark.createDataFrame(rows, "pair long, x1 double, y1 double, x2 double, y2 double, width1 int, height1 int, width2 int, height2 int")
    got = {r.pair: r for r in Q.watermarks(df, ["pair"]).collect()}
    assert {k: r.watermark for k, r in got.items()} == want
    for k, r in got.items():
        mine = [x for x in rows if x[0] == k]
        outside = lambda x, y: not (80 <= x <= 560 and 80 <= y <= 400)
        assert r.border_ratio == pytest.approx(sum(outside(*x[1:3]) and outside(*x[3:5]) for x in mine) / len(mine))
        if r.shift_ratio is not None:
            near = sum((x[3] - x[1] - r.dx) ** 2 + (x[4] - x[2] - r.dy) ** 2 <= 16 for x in mine)
            most = max(sum((x[3] - x[1] - a) ** 2 + (x[4] - x[2] - b) ** 2 <= 16 for x in mine) for a, b in [(y[3] - y[1], y[4] - y[2]) for y in mine[:60]])
            assert r.shift_ratio == pytest.approx(near / len(mine)) and near >= 0.95 * most - 1
    assert Q.watermarks(df.limit(0), ["pair"]).count() == 0


def test_least_absolute_deviations_against_all_corners(spark):
    """The best x goes through as many rows as it has parts: all such corners are tried."""
    import itertools

    rng = np.random.default_rng(4)
    groups = {}
    for g in range(6):
        k, n = 2, 9 + g
        a = np.c_[np.ones(n), rng.normal(size=n) * 2]
        b = a @ rng.normal(size=k) + rng.normal(size=n) * 0.05 + (rng.random(n) < 0.2) * 8
        groups[g] = (a, b)
    rows = [(g, *map(float, r), float(y)) for g, (a, b) in groups.items() for r, y in zip(a, b, strict=True)]
    rows += [(50, 1.0, 2.0, 3.0), (51, 1.0, 2.0, 3.0), (51, 2.0, 4.0, 1.0), (52, None, 1.0, 1.0), (0, 1.0, None, 9.0)]
    df = spark.createDataFrame(rows, "g long, p double, q double, y double")
    got = {r.g: r for r in St.least_absolute(df, by=["g"], features=["p", "q"], target="y", relative=1e-4, absolute=1e-6, rounds=60, alpha=1.5, rho=1.0).collect()}
    assert set(got) == {*groups, 50, 51} and got[50].x is None and got[51].x is None
    for g, (a, b) in groups.items():
        best = min(np.abs(a @ np.linalg.solve(a[list(c)], b[list(c)]) - b).sum() for c in itertools.combinations(range(len(b)), 2))
        assert best - 1e-9 <= got[g].loss <= 1.02 * best + 1e-3 and np.abs(a @ np.array(got[g].x) - b).sum() == pytest.approx(got[g].loss)
    assert St.least_absolute(df.limit(0), by=["g"], features=["p", "q"], target="y").count() == 0


def test_progressive_draws_follow_their_definition(spark):
    """Chum and Matas' growth function, written out with exact numbers."""
    from fractions import Fraction

    for total, sample, draws in ((30, 3, 1000), (12, 4, 200000), (9, 2, 50)):
        worth = Fraction(draws)
        for i in range(sample):
            worth *= Fraction(sample - i, total - i)
        pool, until, want = sample, 1, []
        for t in range(1, 301):
            if t == until and pool < total:
                more = worth * (pool + 1) / (pool + 1 - sample)
                until, worth, pool = until + math.ceil(float(more - worth)), more, pool + 1
            want.append((pool, until >= t))
        pools, newest = St.progressive_pools(total, sample, 300, draws)
        assert list(zip(pools.tolist(), newest.tolist(), strict=True)) == want
    places = St.progressive_draws(100, 3, 400, 1)
    pools, newest = St.progressive_pools(100, 3, 400)
    assert all(len(set(p)) == 3 for p in places.tolist()) and all(max(p) <= n for p, n in zip(places.tolist(), pools.tolist(), strict=True))
    assert (places == St.progressive_draws(100, 3, 400, 1)).all() and St.progressive_draws(2, 3, 4, 1).tolist() == [[0, 1]] * 4
    # ratios in order of quality: the good ones first, most of all others wrong
    rows = [(0, i, 1.0, 2.0 + 0.001 * (i % 5)) for i in range(12)] + [(0, i, 1.0, 3.0 + i * 0.37) for i in range(12, 150)]
    df = spark.createDataFrame(rows, "g long, i long, c double, w double")
    got = S.scale_by_ransac(df, cam=["c"], world=["w"], by=["g"], order=["i"], rounds=5, sampler="progressive").first()
    assert got.scale == pytest.approx(2.0, abs=0.01) and got.inliers == 12 and got.n == 150
    with pytest.raises(ValueError):
        S.scale_by_ransac(df, cam=["c"], world=["w"], by=["g"], order=["i"], sampler="other")


def test_wide_points_against_all_pairs(spark):
    rng = np.random.default_rng(9)
    rows, want = [], {a: set() for a in (1.5, 40.0, 90.0, 120.0)}
    for p in range(150):
        n, spread = int(rng.integers(1, 9)), float(rng.choice([0.01, 0.02, 0.4, 1.0, 3.0]))
        v = np.array([0.0, 0.0, 1.0]) + rng.normal(size=(n, 3)) * spread
        v /= np.linalg.norm(v, axis=1)[:, None]
        if p == 7:
            v = np.array([[1.0, 0, 0], [-1.0, 0, 0]])
        rows += [(p, *map(float, r)) for r in v]
        angles = np.degrees(np.arccos(np.clip(v @ v.T, -1, 1)))
        for a, found in want.items():
            if len(v) > 1 and angles.max() >= a:
                found.add(p)
    df = spark.createDataFrame(rows, "p long, x double, y double, z double")
    for a, found in want.items():
        assert {r.p for r in Q.drop_small_angles(df, point="p", rays=["x", "y", "z"], min_angle=a).select("p").distinct().collect()} == found, a


def test_mutual_matches_through_the_index(spark):
    rng = np.random.default_rng(10)
    base = rng.normal(size=(1500, 16))
    left = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(base)], "k long, v array<double>")
    right = spark.createDataFrame([(10_000 + i, (r + rng.normal(size=16) * 0.15).tolist()) for i, r in enumerate(base[:1000])], "k long, v array<double>")
    exact = {(r.left, r.right) for r in P.mutual_matches(left, right, key="k", vector="v", max_distance=2.0).collect()}
    found = {(r.left, r.right) for r in P.mutual_matches(left, right, key="k", vector="v", max_distance=2.0, probes=8).collect()}
    assert len(exact) > 900 and len(found & exact) >= 0.9 * len(exact)
    assert {(r.left, r.right) for r in P.mutual_matches(left, right, key="k", vector="v", max_distance=2.0, probes=1024).collect()} == exact


def test_selections_by_connected_parts_are_those_of_whole_models(spark):
    rng = np.random.default_rng(12)
    # points of a part share its images; two models, of which one has tracks without a common image
    rows = [(m, 100 * part + p, 10 * part + int(i), float(rng.uniform(0, 10)), float(rng.uniform(0, 5))) for m in "ab" for part in range(4 if m == "a" else 1) for p in range(18) for i in rng.choice(4, int(rng.integers(1, 4)), replace=False)]
    df = spark.createDataFrame(rows, "m string, p long, i long, x double, y double")
    for most in (None, 7, 25):
        plain, split = ({(r.m, r.point) for r in T.select_tracks(df, point="p", image="i", budget=2, max_tracks=most, by=["m"], split=s).collect()} for s in (False, True))
        assert plain == split and plain
    plain, split = ({(r.m, r.point) for r in T.redundant_points(df, point="p", image="i", x="x", y="y", width=10.0, height=5.0, min_gain=0.35, by=["m"], split=s).collect()} for s in (False, True))
    assert plain == split and plain


def test_pairs_within_a_key_in_parts(spark):
    rows = [("hub", i) for i in range(57)] + [("a", i) for i in (3, 9, 4)] + [("one", 5)]
    df = spark.createDataFrame(rows, "k string, i long")
    want = {(k, x, y) for k, x in rows for k2, y in rows if k == k2 and x < y}
    for together in (5, 2048):
        got = [(r.k, r.id1, r.id2) for r in P.pairs_within(df, "k", "i", together).collect()]
        assert len(got) == len(want) and set(got) == want
