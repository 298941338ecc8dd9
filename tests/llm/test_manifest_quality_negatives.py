"""Merkle manifests, the quality classifier and hard negatives against plain versions of them."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from odometra.llm import hardneg, merkle, quality

# -- Merkle manifest -------------------------------------------------------------------


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(leaves):
    out = [list(leaves)]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path_of(levels, i):
    out = []
    for nodes in levels[:-1]:
        first = i // 8 * 8
        out.append((nodes[first:i], nodes[i + 1 : first + 8]))
        i //= 8
    return out


def manifest_by_hand(rows):
    """rows: (doc_id, source, lang, n_chars, text). Results in any order."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    key = lambda r: ((r[0] is not None, r[0] or 0), leaf_of(r))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {lang: levels_of([leaf_of(r) for r in sorted(trees[lang], key=key)]) for lang in order}
    top = levels_of([built[lang][-1][0] for lang in order])
    out = []
    for place, lang in enumerate(order):
        for i, r in enumerate(sorted(trees[lang], key=key)):
            path = path_of(built[lang], i) + path_of(top, place)
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                node = leaf_of((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            else:
                node = leaf_of(r)
            for left, right in path:
                node = h(*left, node, *right)
            out.append((r[0], leaf_of(r), built[lang][-1][0], top[-1][0], h(*[x for left, right in path for x in (*left, *right)]), node, node == top[-1][0]))
    return sorted(out, key=str)


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def manifest_rows(n, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["s1", None, "é"]), rng.choice(["en"] * 6 + ["de", None, "", "fr"]), rng.choice([None, i]), rng.choice([None, "", f"Text {i} É", "same", "a:b"])) for i in range(n)]
    return rows + [(n, "s1", "alone", 1, "Only ONE"), (None, "s", "en", 1, "No Id"), (3, "twice", "en", 2, "Other"), (3, "twice", "en", 2, "Other")]


@pytest.mark.parametrize("n", [0, 5, 700])
def test_manifest_by_hand(spark, tmp_path, monkeypatch, n):
    rows = manifest_rows(n, n)
    spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS + ", place int, tree string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in merkle.op11_merkle_manifest(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == manifest_by_hand(rows)
    monkeypatch.setattr(merkle, "BLOCK", 8)  # more rounds of blocks
    monkeypatch.setattr(merkle, "LEVELS", 1)
    got = [tuple(r) for r in merkle.op11_merkle_manifest(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == manifest_by_hand(rows)


def test_manifest_of_few_rows(spark, tmp_path):
    for k, rows in enumerate([[], [(1, None, None, None, None)], [(7, "s", "en", 3, "ABC" * 300_000)]]):
        path = str(tmp_path / str(k))
        spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
        assert sorted((tuple(r) for r in merkle.op11_merkle_manifest(spark, path).collect()), key=str) == manifest_by_hand(rows)


def test_changes_show(spark):
    df = spark.createDataFrame([(i, "en" if i % 3 else "de", f"t{i}") for i in range(40)], "id long, lang string, t string")
    leaves = df.select("id", "lang", merkle.leaf_digest(F.col("id"), F.col("t")).alias("leaf"), merkle.leaf_digest(F.col("id"), F.lit("other")).alias("wrong"))
    rows = merkle.manifest(leaves, leaf="leaf", tree="lang", order=["id"], carry=["id", "wrong"]).select("root", merkle.fold(F.col("leaf"), F.col("path")).alias("right"), merkle.fold(F.col("wrong"), F.col("path")).alias("wrong")).collect()
    assert len(rows) == 40 and all(r.right == r.root != r.wrong for r in rows) and len({r.root for r in rows}) == 1


# -- quality ---------------------------------------------------------------------------


def good_text(rng):
    return " ".join(rng.choice("the of and to river stone walks slowly green house under bridge morning light people".split()) + rng.choice(["", "", "", ".", ","]) for _ in range(rng.randrange(30, 120)))


def bad_text(rng):
    kind = rng.randrange(3)
    if kind == 0:
        w = [rng.choice("buy now cheap stone river".split()) for _ in range(4)]
        return " ".join(x for x in w for _ in range(rng.randrange(8, 20)))
    if kind == 1:
        return " ".join(w.upper() + "!!" for w in good_text(rng).split())
    return " | ".join(good_text(rng).split())


def quality_tables(spark, tmp_path, n=400):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(n):
        y = int(rng.random() < 0.75)
        docs.append((i, good_text(rng) if y else bad_text(rng)))
        if i % 4:
            labels.append((i, y))
    docs += [(5000, None), (5001, ""), (5002, " \n"), (None, good_text(rng)), (7, good_text(rng)), (5003, good_text(rng) + " word" * 400_000), (5004, "x" * 2_000_000)]
    labels += [(5000, 0), (None, 1), (5001, None), (8, 1), (9999, 1)]
    spark.createDataFrame([(*d, 0.5, 3) for d in docs], "doc_id long, text string, score double, held_out int").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    return docs, dict(labels)


def test_quality_of_held_out_documents(spark, tmp_path):
    docs, labels = quality_tables(spark, tmp_path)
    first = quality.op12_quality_classifier(spark, str(tmp_path)).collect()
    assert len(first) == len(docs) and first[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in first)
    tested = [(r.predicted, labels[r.doc_id]) for r in first if r.held_out and labels.get(r.doc_id) is not None and r.doc_id < 400]
    assert len(tested) > 40 and sum(p == y for p, y in tested) / len(tested) > 0.95
    # labels of held-out rows change nothing, and reruns agree
    spark.createDataFrame([(i, 1 - y if y is not None and i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels.items()], "doc_id long, quality int").write.parquet(str(tmp_path / "b" / "labels.parquet"))
    spark.read.parquet(str(tmp_path / "documents.parquet")).repartition(2).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    again = quality.op12_quality_classifier(spark, str(tmp_path / "b")).collect()
    assert sorted(((str(r.doc_id), round(r.score, 9)) for r in again)) == sorted(((str(r.doc_id), round(r.score, 9)) for r in first))


def test_quality_without_rows_or_labels(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    vectors = quality.word_vectors(docs)
    assert {r.score for r in quality.score(docs, vectors, quality.learn(docs, labels, vectors)).collect()} == {0.5}
    nothing = quality.word_vectors(docs.limit(0))
    assert quality.score(docs.limit(0), nothing, quality.learn(docs.limit(0), labels, nothing)).count() == 0
    one = quality.learn(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), vectors)
    assert all(math.isfinite(r.score) for r in quality.score(docs, vectors, one).collect())


def test_word_vectors_are_the_sums_of_neighbours(spark):
    texts = ["a b c a d", "b", None, "", "c c, c", "e a b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = quality.word_vectors(df)
    buckets, signs = quality._Buckets(), quality.index_vectors().astype(int)
    sums = np.zeros((quality.BUCKETS, quality.WIDTH + 1), np.int64)
    for t in texts:
        ids = [buckets[m] for m in quality._TOKEN.findall(t or "")]
        for i, b in enumerate(ids):
            sums[b, -1] += 1
            for j in range(max(0, i - 2), min(len(ids), i + 3)):
                if j != i:
                    sums[b, :-1] += signs[ids[j]]
    want = quality.Vectors(sums)
    assert np.array_equal(got.vectors, want.vectors) and np.array_equal(got.weights, want.weights)


def test_pooling_in_pieces_is_pooling_at_once(monkeypatch):
    rng = random.Random(0)
    text, buckets = " ".join(good_text(rng) for _ in range(20)), quality._Buckets()
    ids = np.concatenate(list(quality.tokens(text, buckets)))
    vectors = quality.Vectors(np.random.default_rng(0).integers(0, 50, (quality.BUCKETS, quality.WIDTH + 1)))
    whole = vectors.pooled(text, buckets)
    monkeypatch.setattr(quality, "AT_ONCE", 256)
    assert np.array_equal(np.concatenate(list(quality.tokens(text, buckets))), ids)
    assert np.allclose(vectors.pooled(text, buckets)[: 3 * quality.WIDTH + 3], whole[: 3 * quality.WIDTH + 3], atol=1e-5)


def test_the_network_learns_and_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, quality.FEATURES))
    x[:, 10:] *= 0.01
    x[:, 10:] += x[:, :1]
    p = 1 / (1 + np.exp(-(3 * x[:, 0] - 2 * np.maximum(0, x[:, 1]) + 1)))
    y = (rng.random(4000) < p).astype(float)
    net = quality.Network(x[:3000], y[:3000])
    s = net.scores(x[3000:])
    assert np.corrcoef(s, p[3000:])[0, 1] > 0.9 and abs(s.mean() - y[3000:].mean()) < 0.06


# -- hard negatives --------------------------------------------------------------------


def mined_by_hand(rows, asks, positives=5, negatives=5):
    """rows: (id, label, vector of whole numbers); each position is a row of its own."""
    out, width = [], max((len(v) for _, _, v in rows), default=0)
    full = [(i, lab, list(v) + [0] * (width - len(v))) for i, lab, v in rows]
    for k, (a, label, v) in enumerate(full):
        if a not in asks:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w, strict=True)), i, lab) for j, (i, lab, w) in enumerate(full) if j != k)
        for s, i, _ in [x for x in scored if x[2] == label][:positives]:
            p = -s
            fits = [x for x in scored if x[2] != label and 80 * p <= -100 * x[0] <= 100 * p][:negatives]
            out += [(a, i, rank + 1, n, p, -t) for rank, (t, n, _) in enumerate(fits)]
    return sorted(map(tuple, out))


def mined(spark, rows, asks, **options):
    df = spark.createDataFrame([(i, lab, [float(x) for x in v]) for i, lab, v in rows], "id long, label long, v array<double>")
    got = hardneg.mine(df, spark.createDataFrame([(a,) for a in asks], "id long"), **options)
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got.collect())


def test_hard_negatives_by_hand(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "BLOCK", 16)  # many blocks, so that rounds skip most of them
    monkeypatch.setattr(hardneg, "ASKING", 4)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 12)) * 100
    rows = [(i, int(rng.integers(4)), np.floor(centres[i % 8] + rng.normal(size=12) * 40).astype(int).tolist()) for i in range(300)]
    rows += [(1000 + i, 1, [7] * 12) for i in range(40)] + [(2000 + i, 2, [7] * 12) for i in range(9)]  # copies, and copies with another label
    rows += [(3000, 1, [0] * 12), (3001, 2, [0] * 12), (3002, 3, [-50] * 12), (3003, 3, [-50] * 5), (3004, 9, [1] * 12)]
    rows += [rows[5], rows[5], (rows[8][0], 0, rows[9][2])]  # repeated rows, and an id with two vectors
    asks = [0, 5, 8, 17, 100, 1000, 1039, 2003, 3000, 3001, 3002, 3004, 77777]
    assert mined(spark, rows, asks) == mined_by_hand(rows, set(asks))
    assert mined(spark, rows[:60], [0, 5, 8], positives=2, negatives=3) == mined_by_hand(rows[:60], {0, 5, 8}, 2, 3)


def test_hard_negatives_of_little(spark, tmp_path):
    assert mined(spark, [], [0]) == [] and mined(spark, [(0, 1, [1, 2])], [0]) == []
    assert mined(spark, [(0, 1, []), (1, 1, []), (2, 2, [])], [0]) == [(0, 1, 1, 2, 0, 0)]
    rows = [(0, [0.5, 0.25], 1, "x"), (100, [0.5, None], 1, "x"), (200, None, 1, "x"), (300, [float("nan"), 1.0], 1, "x"), (400, [float("inf"), 1.0], 1, "x"), (500, [0.5, 0.5], None, "x"), (None, [0.5, 0.5], 1, "x"), (1, [0.5, 0.2], 2, "x"), (2, [0.4, 0.2], 1, "x")]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rank string").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = [tuple(r) for r in hardneg.op13_hard_negatives(spark, str(tmp_path)).collect()]
    # 0 is divisible by 7, so that its label becomes 2
    assert got == [(0, 1, 1, 2, 128 * 128 + 64 * 51, 128 * 102 + 64 * 51)]
