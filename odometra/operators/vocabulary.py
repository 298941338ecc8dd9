"""Vocabulary trees: hierarchical k-means of descriptors, all nodes of a level trained at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..checkpoints import discard, materialize
from ..shipping import ship_package

#: Nodes that a search keeps on each level.
BEAM = 3

#: Centres of a search up to so many bytes go to every task; larger trees are joined with the vectors, level by level.
TREE_BYTES = 16 << 20

#: No child.
NONE = np.iinfo(np.int64).max


def _squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def _whole(v: Column) -> Column:
    """No component is null, NaN or infinite."""
    return F.forall(v, lambda x: F.abs(x) < float("inf"))


def _listed(centres: DataFrame) -> DataFrame:
    """(of, children): the children of a node in one row, at most as many as it branches into."""
    return centres.groupBy(F.col("node").alias("of")).agg(F.collect_list(F.struct("child", "centre")).alias("children"))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of every centre (row) to every vector (column of x), summed component by component as _squared_distance does."""
    if x.shape[1] * len(centres) < 256:
        return np.cumsum((x.T - centres[:, None, :]) ** 2, axis=2)[:, :, -1]
    total = np.zeros((len(centres), x.shape[1]))
    for a, c in zip(x, centres.T, strict=True):
        off = a - c[:, None]
        off *= off
        total += off
    return total


def _alike(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each number with its places."""
    order = np.argsort(numbers, kind="stable")
    for places in np.split(order, np.flatnonzero(np.diff(numbers[order])) + 1):
        yield int(numbers[places[0]]), places


def _searched(x: np.ndarray, nodes: np.ndarray, levels: list[dict], beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, d2) of the rows of x: from its node, on every level the `beam` nearest children of the nodes kept so far go on; ties to the smaller child."""
    columns, kept, d2 = np.ascontiguousarray(x.T), [nodes], np.full(len(x), np.inf)
    for level, children in enumerate(levels):
        width = max((len(c) for c, _ in children.values()), default=1)
        far, who = np.full((len(kept) * width, len(x)), np.inf), np.full((len(kept) * width, len(x)), NONE)
        for k, at in enumerate(kept):
            for node, places in _alike(at):
                if node in children:
                    names, centres = children[node]
                    far[k * width : k * width + len(names), places] = _distances(columns[:, places], centres)
                    who[k * width : k * width + len(names), places] = names[:, None]
        kept = []
        for k in range(beam if level < len(levels) - 1 else 1):
            least = far.min(axis=0)
            kept.append(np.where(far == least, who, NONE).min(axis=0))
            if k == 0:
                d2 = least
            gone = who == kept[-1]
            far[gone], who[gone] = np.inf, NONE
    return kept[0], d2


def _vectors(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(whole, x): which vectors of a column are `dims` finite numbers, and those, a row each."""
    whole = np.array(pc.equal(pc.list_value_length(column), dims).fill_null(False))
    x = (column if whole.all() else column.filter(pa.array(whole))).flatten().to_numpy(zero_copy_only=False).reshape(whole.sum(), dims)
    finite = np.isfinite(x).all(axis=1)
    whole[whole] = finite
    return whole, x if finite.all() else x[finite]


def _nearest_few(best: dict[bytes, float], x: np.ndarray, at: np.ndarray, most: int) -> dict[bytes, float]:
    """The `most` different vectors with the least `at`, each with its least, of those in best and the rows of x."""
    found, last = dict(best), np.inf
    new: set[bytes] = set()
    for i in np.argsort(at, kind="stable"):
        if len(new) >= most and at[i] > last:
            break
        if (v := (x[i] + 0.0).tobytes()) not in new:  # no -0.0, which Spark takes for 0.0
            new.add(v)
            last = at[i]
            found[v] = min(found.get(v, np.inf), float(at[i]))
    return dict(sorted(found.items(), key=lambda f: (f[1], np.frombuffer(f[0]).tolist()))[:most])


def _few(tree: DataFrame) -> bool:
    return 8 * (tree.agg(F.sum(F.size("centre"))).first()[0] or 0) <= TREE_BYTES


def _kept(df: DataFrame, few: bool) -> DataFrame:
    """df worked out: a table of few rows stays with the driver, as its next step needs it there, others are written."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema) if few else materialize(df)


class _Search:
    """What a search finds in a tree of (level, node, child, centre) for vectors (key, v, node), each from its node on.

    A tree of few centres (at most TREE_BYTES) is sent to the tasks, which then give what they found for
    all their vectors together: no vector is shuffled. A larger one is joined on the nodes, so that
    neither centres nor vectors are ever in one place.
    """

    def __init__(self, tree: DataFrame, depth: int, few: bool, beam: int = 1) -> None:
        self.tree, self.depth, self.beam, self.sent, self.dims = tree, depth, beam, None, 0
        if not few:
            return
        ship_package(tree.sparkSession)
        levels = [{} for _ in range(depth)]
        for r in tree.collect():
            levels[r["level"]].setdefault(r["node"], []).append((r["child"], r["centre"]))
            self.dims = len(r["centre"])
        self.sent = tree.sparkSession.sparkContext.broadcast([{node: (np.array([c for c, _ in of]), np.array([c for _, c in of])) for node, of in level.items()} for level in levels])

    def close(self) -> None:
        """What was made with this search has been written."""
        if self.sent is not None:
            self.sent.destroy()

    def words(self, held: DataFrame) -> DataFrame:
        """(key, v, node, word, d2); word and d2 are null where a vector isn't finite, is of another length or meets no child."""
        if self.sent is None:
            return self._joined(held)
        sent, dims, beam = self.sent, self.dims, self.beam

        def run(batches):
            for b in batches:
                whole, x = _vectors(b.column("v"), dims)
                word, d2 = np.full(len(whole), NONE), np.zeros(len(whole))
                if len(x):
                    word[whole], d2[whole] = _searched(x, b.column("node").to_numpy()[whole], sent.value, beam)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("key", "v", "node")), pa.array(word, mask=word == NONE), pa.array(d2, mask=word == NONE)], ["key", "v", "node", "word", "d2"])

        rows = held.select("key", "v", "node")
        return rows.mapInArrow(run, StructType([*rows.schema, StructField("word", LongType()), StructField("d2", DoubleType())]))

    def means(self, held: DataFrame, dims: int) -> DataFrame:
        """(of, mean): the mean of the vectors of each word."""
        if self.sent is None:
            return self._joined(held).groupBy(F.col("word").alias("of")).agg(F.array(*[F.avg(F.get("v", F.lit(i))) for i in range(dims)]).alias("mean"))
        sent, beam = self.sent, self.beam

        def run(batches):
            sums: dict[int, np.ndarray] = {}
            counts: dict[int, int] = {}
            for b in batches:
                whole, x = _vectors(b.column("v"), dims)
                if len(x):
                    for word, places in _alike(_searched(x, b.column("node").to_numpy()[whole], sent.value, beam)[0]):
                        sums[word] = sums.get(word, 0.0) + x[places].sum(axis=0)
                        counts[word] = counts.get(word, 0) + len(places)
            sums.pop(NONE, None)
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int64()), pa.array([counts[w] for w in sums], pa.int64()), pa.array(list(sums.values()), pa.list_(pa.float64()))], ["of", "n", "sums"])

        parts = held.select("v", "node").mapInArrow(run, "of long, n long, sums array<double>")
        return parts.groupBy("of").agg(F.array(*[F.sum(F.get("sums", F.lit(i))) / F.sum("n") for i in range(dims)]).alias("mean"))

    def far(self, held: DataFrame, weight: Column, most: int) -> DataFrame:
        """(node, v, at): of each node the `most` different vectors, or more of them, with the least weight / d2; those at a distance of 0 are left out."""
        if self.sent is None:
            return self._joined(held).where("d2 > 0").groupBy("node", "v").agg(F.min(weight / F.col("d2")).alias("at"))
        sent, dims, beam = self.sent, self.dims, self.beam

        def run(batches):
            best: dict[int, dict[bytes, float]] = {}
            for b in batches:
                whole, x = _vectors(b.column("v"), dims)
                if len(x):
                    nodes, weights = (b.column(c).to_numpy()[whole] for c in ("node", "weight"))
                    _, d2 = _searched(x, nodes, sent.value, beam)
                    for node, places in _alike(nodes):
                        if len(places := places[d2[places] > 0]):
                            best[node] = _nearest_few(best.get(node, {}), x[places], weights[places] / d2[places], most)
            rows = [(node, v, at) for node, of in best.items() for v, at in of.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([np.frombuffer(r[1]) for r in rows], pa.list_(pa.float64())), pa.array([r[2] for r in rows], pa.float64())], ["node", "v", "at"])

        parts = held.select("v", "node", weight.alias("weight")).mapInArrow(run, "node long, v array<double>, at double")
        return parts.groupBy("node", "v").agg(F.min("at").alias("at"))

    def _joined(self, held: DataFrame) -> DataFrame:
        at = held.select("key", "v", "node", F.array(F.struct(F.lit(0.0).alias("d2"), F.col("node").alias("child"))).alias("kept"))
        for level in range(self.depth):
            listed = _listed(self.tree.where(F.col("level") == level))
            found = []
            for k in range(1 if level == 0 else self.beam):
                node, name = F.get("kept", F.lit(k))["child"], f"children{k}"
                at = at.withColumn(f"node{k}", node).join(listed.withColumnRenamed("children", name), F.col(f"node{k}") == F.col("of"), "left").drop("of")
                found.append(F.coalesce(F.transform(name, lambda c: F.struct(_squared_distance(F.col("v"), c["centre"]).alias("d2"), c["child"].alias("child"))), F.array().cast("array<struct<d2:double,child:bigint>>")))
            at = at.select("key", "v", "node", F.slice(F.array_sort(F.concat(*found)), 1, self.beam).alias("kept"))
        best = F.get("kept", F.lit(0))
        good = _whole(F.col("v")) & best["d2"].isNotNull()
        return at.select("key", "v", "node", F.when(good, best["child"]).alias("word"), F.when(good, best["d2"]).alias("d2"))


#: Children that a node may have, as a multiple of the branching.
WIDEST = 8


def _quotas(held: DataFrame, level: int, branching: int, few: bool) -> DataFrame:
    """(of, quota): the level's branching^(level + 1) children dealt to its nodes by their share of the error."""
    mean = held.groupBy("node").agg(F.count("*").alias("n"), F.sum("d2").alias("error"))
    whole = _kept(mean, few)
    total = whole.agg(F.sum("error").alias("all"))
    share = F.when(F.col("all") > 0, F.col("error") / F.col("all")).otherwise(0.0)
    return whole.crossJoin(F.broadcast(total)).select(F.col("node").alias("of"), F.greatest(F.lit(1), F.least(F.round(share * branching ** (level + 1)), F.lit(WIDEST * branching))).cast("int").alias("quota"))


def _one_level(centres: DataFrame) -> DataFrame:
    return centres.select(F.lit(0).alias("level"), "node", "child", "centre")


def _first_centres(held: DataFrame, quotas: DataFrame, branching: int, seed: int, few: bool) -> DataFrame:
    """(node, child, centre): vectors of each node drawn with a weight of their squared distance to those drawn before.

    -ln(u) / d2, with u by the hash of the key, is smallest at a vector with that probability.
    Each of `branching` passes draws an equal part of what a node may still have.
    """
    u = lambda j: (F.pmod(F.xxhash64(F.lit(seed + j), "key"), F.lit(1 << 40)) + 1) / float((1 << 40) + 1)
    centres = search = None
    for j in range(branching):
        if centres is None:
            least = _kept(held.groupBy("node").agg(F.min(u(j)).alias("least")), few)
            drawn = held.join(least, "node").where(u(j) == F.col("least")).groupBy("node").agg(F.min("v").alias("v")).withColumn("place", F.lit(0))
        else:
            have = quotas.join(centres.groupBy("node").agg(F.count("*").cast("int").alias("have")), F.col("of") == F.col("node")).select("of", "have", F.ceil((F.col("quota") - F.col("have")) / (branching - j)).cast("int").alias("more"))
            search = _Search(_one_level(centres), 1, few)
            far = search.far(held, -F.ln(u(j)), WIDEST * branching)
            ranked = far.withColumn("n", F.row_number().over(Window.partitionBy("node").orderBy("at", "v"))).where(F.col("n") <= WIDEST * branching)
            drawn = ranked.join(have, F.col("node") == F.col("of")).where("n <= more").select("node", "v", (F.col("have") + F.col("n") - 1).alias("place"))
        new = drawn.select("node", (F.col("node") * (WIDEST * branching) + F.col("place")).alias("child"), F.col("v").alias("centre"))
        following = _kept(new if centres is None else centres.unionByName(new), few)
        if centres is not None:
            discard(centres)
            search.close()
        centres = following
    return centres


def _moved(held: DataFrame, centres: DataFrame, search: _Search, dims: int, few: bool) -> DataFrame:
    """The centres at the means of the vectors that the search brings to them; one without any stays."""
    means = search.means(held, dims)
    moved = _kept(centres.join(means, F.col("child") == F.col("of"), "left").select("node", "child", F.coalesce("mean", "centre").alias("centre")), few)
    search.close()
    return moved


def train_vocabulary(rows: DataFrame, *, key: str, vector: str, dims: int, branching: int = 10, depth: int = 2, rounds: int = 8, polish: int = 3, beam: int = BEAM, seed: int = 7) -> DataFrame:
    """(level, node, child, centre): a tree of centres with about branching^depth leaves, the words.

    Level by level, the vectors of each node are split by k-means into children, of which a
    level has branching^(level + 1) in all and a node by its share of the error. Centres begin as vectors drawn one after the other, far ones more likely (k-means++); each
    draw and each round is one aggregate over all vectors for all nodes of the level together,
    combined before the shuffle. A child that loses all its vectors keeps its centre. child = node * WIDEST * branching +
    place, so that the leaves' numbers are words. In `polish` further rounds the leaves move to the means
    of the vectors that a search over the whole tree brings to them. Null vectors, those with null or
    non-finite components and those of another length than `dims` take no part; an empty table has no centres.
    """
    v = F.col(vector).cast("array<double>")
    held = rows.where((F.size(v) == dims) & _whole(v)).select(F.col(key).alias("key"), v.alias("v"), F.lit(0).cast("long").alias("node"), F.lit(1.0).alias("d2"))
    held, tree, total, few = materialize(held), None, 0, True
    for level in range(depth):
        quotas = _kept(_quotas(held, level, branching, few), few)
        total += quotas.agg(F.sum("quota")).first()[0] or 0
        few = 8 * dims * total <= TREE_BYTES
        centres = _first_centres(held, quotas, branching, seed + 1000 * level, few)
        for _ in range(rounds):
            following = _moved(held, centres, _Search(_one_level(centres), 1, few), dims, few)
            discard(centres)
            centres = following
        at_level = centres.select(F.lit(level).alias("level"), "node", "child", "centre")
        tree = at_level if tree is None else tree.unionByName(at_level)
        if level < depth - 1:
            search = _Search(_one_level(centres), 1, few)
            below = materialize(search.words(held).select("key", "v", F.col("word").alias("node"), "d2"))
            search.close()
            discard(held)
            held = below
    inner, leaves = tree.where(F.col("level") < depth - 1), centres
    whole = lambda: inner.unionByName(leaves.select(F.lit(depth - 1).alias("level"), "node", "child", "centre"))
    for _ in range(polish):
        leaves = _moved(held.withColumn("node", F.lit(0).cast("long")), leaves, _Search(whole(), depth, few, beam), dims, few)
    discard(held)
    return whole()


def assign_words(rows: DataFrame, tree: DataFrame, *, key: str, vector: str, depth: int, beam: int = BEAM) -> DataFrame:
    """(key, word, d2): the nearest leaf that a search with `beam` nodes a level finds; with 1 it goes to the nearest child on every level. Null vectors have no row; others that training leaves out have a null word."""
    held = rows.where(F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"), F.lit(0).cast("long").alias("node"))
    return _Search(tree, depth, _few(tree), beam).words(held).select("key", "word", "d2")
