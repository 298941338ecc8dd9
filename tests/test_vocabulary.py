"""Vocabulary trees: the assignment against plain loops, and the error against flat cells."""

import math

import numpy as np
from test_findings import shuffled

from odometra.operators import pairs as P
from odometra.operators import vocabulary as V


def test_a_vocabulary_tree(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 16))[rng.integers(0, 60, 1500)] * 3 + rng.normal(size=(1500, 16)) * 0.5
    df = spark.createDataFrame([*((i, r.tolist()) for i, r in enumerate(x)), (5000, None)], "k long, v array<double>")
    tree = V.train_vocabulary(df, key="k", vector="v", dims=16, branching=8, depth=2, rounds=6)
    centres = {}
    for r in tree.collect():
        centres.setdefault((r.level, r.node), {})[r.child] = np.array(r.centre)
    assert all(len(c) <= 64 and all(k // 64 == node for k in c) for (_, node), c in centres.items()) and 60 <= sum(len(c) for (level, _), c in centres.items() if level) <= 68
    words = {r.key: (r.word, r.d2) for r in V.assign_words(df, tree, key="k", vector="v", depth=2, beam=1).collect()}
    assert set(words) == set(range(1500))
    for i, v in enumerate(x):
        node = 0
        for level in range(2):
            node = min(centres[level, node], key=lambda c: (((centres[level, node][c] - v) ** 2).sum(), c))
        assert words[i][0] == node
    wide = {r.key: (r.word, r.d2) for r in V.assign_words(df, tree, key="k", vector="v", depth=2, beam=3).collect()}
    assert all(wide[i][1] <= words[i][1] for i in wide)
    words, n = wide, len({w for w, _ in wide.values()})
    flat = P._cell_distances(x, P.train_cells(df.where("v is not null"), key="k", vector="v", cells=n)).min(axis=1).sum()
    assert n > 50 and sum(d for _, d in words.values()) < flat


def test_small_and_equal_vectors(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)] + [(9, [3.0, 4.0])], "k long, v array<double>")
    tree = V.train_vocabulary(df, key="k", vector="v", dims=2, branching=3, depth=2, rounds=2)
    words = {r.key: (r.word, r.d2) for r in V.assign_words(df, tree, key="k", vector="v", depth=2).collect()}
    assert len({words[i] for i in range(5)}) == 1 and words[9] != words[0] and all(d == 0 for _, d in words.values())
    empty = V.train_vocabulary(df.limit(0), key="k", vector="v", dims=2, depth=1, branching=2, rounds=1)
    assert empty.count() == 0 and V.assign_words(df.limit(0), empty, key="k", vector="v", depth=1).count() == 0


def test_no_vectors_are_shuffled(spark):
    x = np.random.default_rng(3).normal(size=(12000, 4))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "k long, v array<double>")

    def words():
        tree = V.train_vocabulary(df, key="k", vector="v", dims=4, branching=3, depth=2, rounds=2, polish=1)
        return V.assign_words(df, tree, key="k", vector="v", depth=2).count()

    records, n = shuffled(spark, words)
    assert n == 12000 and records < 6000


def test_trees_that_are_sent_or_joined_are_the_same(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(20, 6))[rng.integers(0, 20, 600)] * 3 + rng.normal(size=(600, 6)), 1)
    odd = [(1000, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1001, [math.nan] * 6), (1002, [math.inf] + [0.0] * 5), (1003, [1.0, 2.0]), (1004, []), (1005, None)]
    df = spark.createDataFrame([*((i, r.tolist()) for i, r in enumerate(np.concatenate([x, x[:100]]))), *odd], "k long, v array<double>").repartition(3)
    found = []
    for limit in (V.TREE_BYTES, 0):
        monkeypatch.setattr(V, "TREE_BYTES", limit)
        tree = V.train_vocabulary(df, key="k", vector="v", dims=6, branching=3, depth=2, rounds=2, polish=1)
        words = {r.key: (r.word, r.d2) for r in V.assign_words(df, tree, key="k", vector="v", depth=2).collect()}
        assert set(words) == {*range(700), *range(1000, 1005)} and all(words[k] == (None, None) for k in range(1000, 1005))
        found.append(({(r.level, r.node, r.child): r.centre for r in tree.collect()}, words))
    (sent, a), (joined, b) = found
    assert set(sent) == set(joined) and all(np.allclose(sent[k], joined[k], rtol=1e-12, atol=1e-12) for k in sent)
    assert all(a[k][0] == b[k][0] and math.isclose(a[k][1], b[k][1], rel_tol=1e-9, abs_tol=1e-12) for k in range(700))
    monkeypatch.undo()
    none = V.train_vocabulary(df.limit(0), key="k", vector="v", dims=6, depth=2, branching=3, rounds=1)
    assert {(r.word, r.d2) for r in V.assign_words(df, none, key="k", vector="v", depth=2).collect()} == {(None, None)}
