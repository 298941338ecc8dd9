"""Cases that a review of larger tables found: loops, far ranks, small angles, joins that must not be broadcast, dear pairs."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from odometra.operators import graph as G
from odometra.operators import pairs as P
from odometra.operators import quality as Q
from odometra.operators import retrieval as R
from odometra.operators import spatial as S
from odometra.operators import stats as St
from odometra.operators import temporal as T
from odometra.operators import topics as T2
from odometra.plans import QUERIES, model_queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_double_only_so_often(spark):
    gaps = [5, 6, 10, 15, 40, 2560, 5120, 5 * 2**29]
    pairs = spark.createDataFrame([(0, g) for g in gaps], "id1 long, id2 long")
    ranks = spark.createDataFrame([(g, g) for g in [0, *gaps]], "image_id long, rank long")
    kept = lambda **k: sorted(r.gap for r in P.classify_pairs(pairs, ranks, key="image_id", overlap=5, **k).where("sequential").collect())
    assert kept(doublings=9) == [5, 10, 40, 2560]
    assert kept() == [5, 10, 40, 2560, 5120, 5 * 2**29]


def test_loops_count_where_they_are_asked_for(spark):
    edges = spark.createDataFrame([(1, 1), (1, 2), (3, 3), (4, 5)], "id1 long, id2 long")
    both = lambda **k: sorted(map(tuple, G.symmetric(edges, **k).collect()))
    assert both() == [(1, 2), (2, 1), (4, 5), (5, 4)]
    assert both(loops=True) == [(1, 1), (1, 2), (2, 1), (3, 3), (4, 5), (5, 4)]
    assert sorted(map(tuple, G.degrees(edges, loops=True).collect())) == [(1, 2), (2, 1), (3, 1), (4, 1), (5, 1)]
    assert sorted(map(tuple, G.two_view_observations(edges, loops=True).collect())) == [(3, 3), (4, 5)]


def write(spark, folder, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_order_edges_may_be_loops(spark, tmp_path):
    sf = write(spark, tmp_path, orders=spark.createDataFrame([(100000 + 7919, 1), (7, 1)], "o_custkey long, o_orderkey long"))
    loop, other = 100000 + 7919, 7
    assert sorted(map(tuple, QUERIES["j11_symmetric_adjacency"](spark, sf).collect())) == sorted([(loop, loop), (loop, other), (other, loop)])
    assert dict(map(tuple, QUERIES["j09_degrees"](spark, sf).collect())) == {loop: 2, other: 1}
    alone = write(spark, tmp_path / "alone", orders=spark.createDataFrame([(loop, 1)], "o_custkey long, o_orderkey long"))
    assert [tuple(r) for r in QUERIES["j01_j02_connected_components"](spark, alone).collect()] == [(loop, loop)]
    assert [tuple(r) for r in QUERIES["j10_two_view_observations"](spark, alone).collect()] == [(loop, loop)]


def test_wide_points_among_thousands_of_images(spark, tmp_path):
    rows = [(1, 10, 69), (2, 10, 70), (3, 5, 365), (4, 4000, 4059), (5, 3940, 4000), (6, 200, 20), (7, 9, 9)]
    li = spark.createDataFrame([(p, image, n + 1, 0.01, 25.0, 1.0) for p, *images in rows for n, image in enumerate(images)], "l_orderkey long, l_suppkey long, l_linenumber int, l_discount double, l_quantity double, l_extendedprice double")
    sf = write(spark, tmp_path, lineitem=li)
    for name in ("l02_small_angles", "l05_composite_filter"):
        assert {r.point for r in QUERIES[name](spark, sf).collect()} == {2, 3, 5, 6}, name


def test_very_small_angles(spark):
    ray = lambda p, a: (p, math.cos(a), math.sin(a), 0.0)
    rays = spark.createDataFrame([ray(1, 1.0), ray(1, 1.0 + 2e-9), ray(2, 1.0), ray(2, 1.0 + 0.5e-9)], "p long, x double, y double, z double")
    got = Q.drop_small_angles(rays, point="p", rays=["x", "y", "z"], min_angle=math.degrees(1e-9))
    assert {r.p for r in got.collect()} == {1}


def test_cells_of_a_radius_are_not_broadcast(spark):
    poses = spark.createDataFrame([("a", i, i * 10**9, float(i % 7), 0.0, 0.0, i // 50) for i in range(200)], "traj string, frame long, ts long, x double, y double, z double, segment int")
    joined = [P.revisits(poses, by=["traj"], key="frame", ts="ts", xyz=["x", "y", "z"], radius=1.0, min_gap=10), T.filter_disconnected(poses, by=["traj"])]
    for df in joined:
        assert "BroadcastHashJoin" not in plan(df) and "SortMergeJoin" in plan(df)
        df.collect()
        assert "BroadcastHashJoin" not in plan(df)


def test_scores_by_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(v)}" for v in rng.zipf(1.4, int(rng.integers(0, 40))) if v < 200) for _ in range(120)]
    texts[40:44] = [texts[10] + " w1 w2 w3"] * 4  # ties
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for name, size in (("QUERY_BLOCK", 4), ("DOC_BLOCK", 30), ("HITS", 50)):
        monkeypatch.setattr(R, name, size)
    p = R.postings(docs, id_col="doc_id", text_col="text")
    w = R.idf_weights(p, len(texts))
    got = lambda **k: {(r.query, r.doc): r.score for r in R.scores(p.where("doc % 10 = 0"), p, w, R.normalisers(p, w), **k).collect()}
    tf = [pd.Series(t.split(), dtype=object).value_counts() for t in texts]
    df = pd.concat([pd.Series(1, index=t.index) for t in tf]).groupby(level=0).sum()
    idf = np.log(len(texts) / df)
    norm = [1 / math.sqrt(s) if (s := (t * idf[t.index] ** 2).sum()) > 0 else 0.0 for t in tf]
    want = {}
    for q in range(0, len(texts), 10):
        for d in range(len(texts)):
            if len(both := [x for x in tf[q].index.intersection(tf[d].index) if idf[x] > 0]):
                want[q, d] = sum(tf[q][x] * math.sqrt(tf[d][x]) * idf[x] ** 2 for x in both) * norm[q] * norm[d]
    full = got()
    assert full.keys() == want.keys() and all(abs(full[k] - v) < 1e-9 for k, v in want.items())
    some = got(top=6)
    ranked = lambda s: sorted(((q, -round(v, 9), d) for (q, d), v in s.items() if q != d))
    first = lambda s: pd.DataFrame(ranked(s)).groupby(0).head(5).values.tolist()
    assert first(some) == first(want) and len(some) < len(full)


def test_votes_of_a_word_are_dealt(spark, monkeypatch):
    f = spark.range(60).select(F.floor(F.col("id") / 3).alias("image"), F.col("id").alias("feature"), (F.col("id") % 2).alias("word"), (F.col("id") * 37 % 64).alias("bits"))
    w = spark.createDataFrame([(0, 1.5), (1, 0.5)], "word long, idf double")
    votes = lambda: {(r.query, r.image): round(r.score, 9) for r in R.hamming_votes(f.where("image < 5"), f, w, sigma=4.0).collect()}
    whole = votes()
    monkeypatch.setattr(R, "VOTERS", 4)
    assert votes() == whole and len(whole) > 50


def shuffled(spark, action):
    """Records that the stages of an action wrote for shuffles, and its result."""
    store, nothing = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    total = lambda: sum(s.shuffleWriteRecords() for s in (lambda l: (l.apply(i) for i in range(l.size())))(store.stageList(None, False, False, nothing, None)))  # noqa: E731, E741
    before = total()
    found = action()
    return total() - before, found


def test_transitive_pairs_meet_at_one_neighbour_only(spark, monkeypatch):
    rng = np.random.default_rng(5)
    edges = {(int(a), int(b)) for a, b in rng.integers(0, 60, (150, 2))} | {(7, k) for k in range(0, 60, 2)} | {(3, 3), (8, 8)}
    near = {n: {a if b == n else b for a, b in edges if n in (a, b)} - {n} for n in range(60)}
    want = sorted({(a, c) for m in near for a in near[m] for c in near[m] if a < c and c not in near[a]})
    df = spark.createDataFrame([*edges, (5, 4), (4, 5)] if {(4, 5), (5, 4)} & edges else list(edges), "id1 long, id2 long")
    for light in (0, 4, 6, 100):
        monkeypatch.setattr(P._second_neighbours, "__defaults__", (light,))
        assert sorted(map(tuple, P.transitive(df).collect())) == want, light


def test_transitive_pairs_of_light_nodes_are_not_shuffled(spark):
    df = spark.range(1500).select(F.col("id").alias("id1"), (10_000 + F.col("id") % 5).alias("id2"))
    records, n = shuffled(spark, lambda: P.transitive(df).count())
    assert n == 5 * 300 * 299 // 2 and records < 40_000


def test_rounds_of_a_spanning_forest_shrink(spark):
    n = 400
    edges = spark.range(n * n).select(F.floor(F.col("id") / n).alias("id1"), (F.col("id") % n).alias("id2"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("weight")).where("id1 < id2")
    records, found = shuffled(spark, lambda: G.spanning_forest(edges).count())
    assert found == n - 1 and records < 100_000


def test_selections_take_numbers_and_no_objects(spark):
    """A model's observations reach its task as flat columns, not as lists of structs; order of points, ties and nulls as before."""
    rng = np.random.default_rng(11)
    rows = [(int(k), None if i == 0 else int(i), float(v)) for k, i, v in zip(rng.integers(0, 80, 500), rng.integers(0, 9, 500), rng.random(500), strict=True)]
    df = spark.createDataFrame(rows, "p long, i long, x double")
    tracks = T2.select_tracks(df, point="p", image="i", budget=5)
    pruned = T2.redundant_points(df, point="p", image="i", x="x", y="x", width=1.0, height=1.0, min_gain=0.2)
    for got in (tracks, pruned):
        assert "FlatMapGroupsInArrow" in plan(got) and "collect_list" not in plan(got)
    seen = {}
    for p, i, v in sorted(rows, key=lambda r: (r[0], r[1] or -1, r[2])):
        seen.setdefault(p, []).append((i or -1, int(v * 8) * 9))
    held, left = {}, set(seen)
    gain = lambda p: sum(1 / math.sqrt(n + 1) - 1 / math.sqrt(n + 2) for n in (held.get(o, 0) for o in sorted(seen[p])))
    while left and (best := max((gain(p), p) for p in left))[0] > 0.2:
        left.remove(best[1])
        for o in seen[best[1]]:
            held[o] = held.get(o, 0) + 1
    assert sorted(r.point for r in pruned.collect()) == sorted(left)
    images = {p: [i for i, _ in o if i != -1] for p, o in seen.items()}
    many, want = dict.fromkeys(range(1, 9), 0), []
    for p in sorted(images, key=lambda p: (len(images[p]), p), reverse=True):
        if any(many[i] <= 5 for i in images[p]):
            want.append(p)
            for i in images[p]:
                many[i] += 1
    assert sorted(r.point for r in tracks.collect()) == sorted(want)


def test_rounds_of_least_absolute_deviations_write_no_rows(spark, monkeypatch):
    write, written = St.materialize, []
    monkeypatch.setattr(St, "materialize", lambda df: written.append("z" in df.columns) or write(df))
    df = spark.range(40).select((F.col("id") % 2).alias("g"), F.lit(1.0).alias("p"), F.col("id").cast("double").alias("q"), F.pmod(F.xxhash64("id"), F.lit(97)).cast("double").alias("y"))
    got = St.least_absolute(df, by=["g"], features=["p", "q"], target="y", relative=1e-12, absolute=1e-12, rounds=7).collect()
    assert [r.rounds for r in got] == [7, 7] and not any(r.converged for r in got)
    assert sum(written) == 2  # at first and after WRITTEN rounds


def test_transitive_correspondences_shuffle_no_pairs(spark, monkeypatch):
    rng = np.random.default_rng(4)
    edges = {(int(a), int(b)) for a, b in rng.integers(0, 90, (120, 2))} | {(7, 7)}
    near = {n: {a if b == n else b for a, b in edges if n in (a, b)} - {n} for n in range(90)}
    df, start = spark.createDataFrame(list(edges), "id1 long, id2 long"), spark.createDataFrame([(n,) for n in (*range(0, 90, 4), 4, 1000)], "c long")
    for cells, reads, depth in ((G.CELLS, G.READS, 0), (G.CELLS, G.READS, 1), (G.CELLS, G.READS, 2), (64, 16, 2), (256, 32, 3), (G.CELLS, G.READS, 4)):
        monkeypatch.setattr(G, "CELLS", cells), monkeypatch.setattr(G, "READS", reads)
        want = set()
        for o in range(0, 90, 4):
            ball = {o}
            for _ in range(depth):
                ball |= {m for n in ball for m in near[n]}
            want |= {(o, n) for n in ball - {o}}
        assert sorted(map(tuple, G.transitive_correspondences(df, start, depth).collect())) == sorted(want), (cells, depth)
    monkeypatch.undo()
    hub = spark.range(1500).select(F.col("id").alias("id1"), (10_000 + F.col("id") % 5).alias("id2"))
    records, n = shuffled(spark, lambda: G.transitive_correspondences(hub, spark.range(1500).toDF("c"), 3).count())
    assert n == 1500 * 300 and records < 60_000


def test_votes_work_out_a_match_once_and_keep_the_best_before_the_shuffle(spark, tmp_path):
    rows = [(i, i * 7 % 60, i % 11, i % 7 + 1, float(i % 50), (i % 10) / 100) for i in range(300)]
    sf = write(spark, tmp_path, lineitem=spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double"))
    shown = plan(QUERIES["k06_votes"](spark, sf))
    assert shown.count("COS(") == 1 and "decimal" not in shown and "WindowGroupLimit" in shown
    exact = {k / 10 for k in range(11, 92, 10)}
    assert {r.scale2 for r in model_queries.feature_matches(spark, sf).select("scale2").collect()} == exact


def test_verification_sorts_no_matches(spark, monkeypatch):
    m = spark.range(200).select((F.col("id") % 2).alias("query"), F.lit(0).alias("image"), *[(F.col("id") * k % 97).cast("double").alias(c) for k, c in ((3, "x1"), (5, "y1"), (3, "x2"), (5, "y2"))], *[F.lit(v).alias(c) for v, c in ((1.0, "scale1"), (0.0, "angle1"), (1.0, "scale2"), (0.0, "angle2"))])
    before, shown = S.materialize, []
    monkeypatch.setattr(S, "materialize", lambda df: shown.append(plan(df)) or before(df))
    got = S.vote_and_verify(m, ["query", "image"]).collect()
    assert sorted((r.query, r.matches, r.inliers) for r in got) == [(0, 100, 100), (1, 100, 100)]
    assert not any("SortAggregate" in p for p in shown)


def test_postings_shuffle_texts_and_not_words(spark):
    docs = spark.range(300).select("id", F.expr("concat_ws(' ', transform(sequence(1, 200), k -> concat('w', k * id % 1009)))").alias("t")).unionByName(spark.createDataFrame([(0, "w0 extra"), (9, None)], "id long, t string"))
    records, n = shuffled(spark, lambda: R.postings(docs, id_col="id", text_col="t").count())
    assert n > 50_000 and records < 1_000
    assert R.postings(docs, id_col="id", text_col="t").where("doc = 0").orderBy("word").collect() == [(0, "extra", 1), (0, "w0", 201)]


def test_least_absolute_deviations_to_the_end(spark, monkeypatch):
    """Of all corners the least, also where a task takes few rows at once, rows repeat, lie on one line or have outliers."""
    rng, rows = np.random.default_rng(8), []
    for g, n in ((0, 60), (1, 61), (2, 40), (3, 50), (4, 2), (5, 1)):
        q = rng.integers(0, 6, n).astype(float) if g == 2 else rng.normal(size=n)
        y = 3 - 2 * q + (rng.standard_cauchy(n) if g != 3 else np.where(np.arange(n) < 30, 0.0, rng.normal(size=n)))
        y = np.round(y) if g == 2 else y
        rows += [(g, 1.0, float(a), float(b)) for a, b in zip(q, y, strict=True)] * (3 if g == 1 else 1)
    df = spark.createDataFrame([*rows, (0, None, 1.0, 1.0), (0, 1.0, 1.0, None)], "g int, p double, q double, y double")
    for undecided in (St.UNDECIDED, 8):
        monkeypatch.setattr(St, "UNDECIDED", undecided), monkeypatch.setattr(St, "GROWS", 2)
        got = {r.g: r for r in St.least_absolute_exact(df, by=["g"], features=["p", "q"], target="y").collect()}
        assert got.keys() == set(range(6)) and got[5].x is None and not got[5].converged
        for g in range(5):
            a, b = np.array([r[1:3] for r in rows if r[0] == g]), np.array([r[3] for r in rows if r[0] == g])
            corners = [np.linalg.solve(a[[i, j]], b[[i, j]]) for i in range(len(a)) for j in range(i) if abs(np.linalg.det(a[[i, j]])) > 1e-12]
            least = min(np.abs(a @ x - b).sum() for x in corners)
            assert got[g].converged and abs(got[g].loss - least) <= 1e-9 * max(1, least), (g, undecided)
            assert abs(np.abs(a @ got[g].x - b).sum() - least) <= 1e-9 * max(1, least)
    assert St.least_absolute_exact(df.limit(0), by=["g"], features=["p", "q"], target="y").count() == 0


def test_least_absolute_deviations_of_the_query_end(spark, tmp_path):
    rows = [(f, s, float(i % 50 + 1), float(900 + i * 7919 % 90_000)) for i in range(240) for f, s in [("AB"[i % 2], "O")]]
    sf = write(spark, tmp_path, lineitem=spark.createDataFrame(rows, "l_returnflag string, l_linestatus string, l_quantity double, l_extendedprice double"))
    got = QUERIES["e38_least_absolute"](spark, sf).collect()
    assert len(got) == 2 and all(r.converged for r in got)
    for r in got:
        a, b = np.array([(1.0, q / 50) for f, _, q, _ in rows if f == r.l_returnflag]), np.array([p / 100_000 for f, _, _, p in rows if f == r.l_returnflag])
        corners = [np.linalg.solve(a[[i, j]], b[[i, j]]) for i in range(len(a)) for j in range(i) if a[i, 1] != a[j, 1]]
        assert abs(r.loss - min(np.abs(a @ x - b).sum() for x in corners)) < 2e-6


def test_light_nodes_come_once_to_each_meeting(spark, monkeypatch):
    """Dealt into parts or not, each pair once; rows go to a meeting once and not on either side of a join."""
    rng = np.random.default_rng(6)
    edges = sorted({(int(a), 1000 + int(b)) for a, b in zip(rng.integers(0, 90, 260), rng.integers(0, 12, 260), strict=True)} | {(0, 3), (3, 1002)})
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b), near.setdefault(b, set()).add(a)
    want = sorted({(a, c) for m in near for a in near[m] for c in near[m] if a < c and c not in near[a]})
    df = spark.createDataFrame(edges, "id1 long, id2 long")
    for flagged in (P.FLAGGED, 7):
        monkeypatch.setattr(P, "FLAGGED", flagged)
        assert sorted(map(tuple, P.transitive(df).collect())) == want, flagged
    monkeypatch.undo()
    hub = spark.range(1500).select(F.col("id").alias("id1"), (10_000 + F.col("id") % 5).alias("id2"))
    shown = plan(P.transitive(hub))
    assert "FlatMapGroupsInArrow" in shown and "arrays_overlap" not in shown
    records, n = shuffled(spark, lambda: P.transitive(hub).count())
    assert n == 5 * 300 * 299 // 2 and records < 20_000


def test_every_document_has_its_top_matches(spark, tmp_path):
    texts = [" ".join(f"w{(i * k) % 23 + k % 3}" for k in range(1, 12)) for i in range(40)]
    sf = write(spark, tmp_path, documents=spark.createDataFrame([(7 * i + 1, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got = QUERIES["f08_d17_top_matches"](spark, sf).collect()
    assert {r.query for r in got} == {7 * i + 1 for i in range(40)} and all(r.query != r.doc for r in got)
    assert sorted(r["rank"] for r in got) == sorted([1, 2, 3, 4, 5] * 40)


def test_scores_stay_where_the_documents_are(spark, monkeypatch):
    """Blocks of queries are sent to the documents: what is shuffled doesn't grow with their number."""
    docs = spark.range(200).select("id", F.expr("concat_ws(' ', transform(sequence(1, 30), k -> concat('w', k * id % 101)))").alias("t"))
    p = R.postings(docs, id_col="id", text_col="t").localCheckpoint()
    w = R.idf_weights(p, 200).localCheckpoint()
    n, found = R.normalisers(p, w), []
    for block in (200, 8):
        monkeypatch.setattr(R, "QUERY_BLOCK", block)
        found.append(shuffled(spark, lambda: {(r.query, r.doc): round(r.score, 9) for r in R.scores(p, p, w, n).collect()}))
    assert found[0][1] == found[1][1] and found[1][0] < found[0][0] * 1.1
    assert "FlatMapCoGroups" not in plan(R.scores(p, p, w, n))


def test_transitive_correspondences_are_packed(spark, monkeypatch):
    """Lists of few and of many nodes, in several chunks and groups, and rows where ids are far apart, give the same pairs."""
    rng = np.random.default_rng(14)
    edges = {(int(a), int(b)) for a, b in rng.integers(0, 300, (260, 2))} | {(7, k) for k in range(0, 300, 3)}
    near = {n: {a if b == n else b for a, b in edges if n in (a, b)} - {n} for n in range(300)}
    want = set()
    for o in range(0, 300, 5):
        ball = {o}
        for _ in range(3):
            ball |= {m for n in ball for m in near[n]}
        want |= {(o, n) for n in ball - {o}}
    df, start = spark.createDataFrame(list(edges), "id1 long, id2 long"), spark.createDataFrame([(o,) for o in range(0, 300, 5)], "c long")
    assert "bits" in plan(G.transitive_correspondences(df, start, 3))
    for chunk, few, packed, sparse in ((1 << 16, 1 << 11, 1 << 14, 64), (64, 3, 20, 64), (64, 4, 1000, 0)):
        for name, size in (("CHUNK", chunk), ("FEW", few), ("PACKED", packed), ("SPARSE", sparse)):
            monkeypatch.setattr(G, name, size)
        assert sorted(map(tuple, G.transitive_correspondences(df, start, 3).collect())) == sorted(want), chunk


def test_lists_of_very_many_nodes_are_flags():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    ids = [np.unique(rng.integers(0, G.CHUNK, n)) for n in (3, 60_000, 2_500, 1, 70_000, 2_047)]
    for i in ids:
        bits = G._flags(i)
        assert len(bits) == (G.CHUNK // 8 if len(i) >= G.FEW else 2 * len(i)) and (G._unflagged(bits) == i).all()
    right = pa.table({"m": [50, 10, 20, 30, 60, 40], "h": pa.array([4] * 6, pa.int32()), "bits": pa.array(map(G._flags, ids), pa.binary())})
    by = dict(zip(right["m"].to_pylist(), ids, strict=True))
    lists = [[10, 50], [50, 30], [7], [10, 20, 60, 40, 99], [40, 30, 50], [20]]
    left = pa.table({"a": range(100, 106), "ms": pa.array(lists, pa.list_(pa.int64()))})
    got = {r["m"]: set(G._unflagged(r["bits"]).tolist()) for r in G._ored((pa.scalar(0), pa.scalar(4)), left, right).to_pylist()}
    want = {100 + k: {int(x) for m in ms if m in by for x in by[m]} for k, ms in enumerate(lists)}
    assert got == {k: v for k, v in want.items() if v}
