"""Operators on pairs of rows: pair generation, neighbours, matching, covisibility."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import materialize
from ..functions.scalar import pair_id
from ..shipping import ship_package


def ranked(items: DataFrame, *, order: Sequence[str], by: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """Ordinal place of each row in its group, from 0; without groups, by range-sorted parts."""
    if not by:
        return dense_ids(items, order, out=out, start=0)
    return items.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)


def exhaustive(items: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Each unordered pair of keys once: (by, id1, id2). The output is all pairs; for catalogues of bounded size."""
    a, b = items.select(*by, F.col(key).alias("id1")), items.select(*by, F.col(key).alias("id2"))
    return (a.join(b, list(by)) if by else a.crossJoin(b)).where("id1 < id2")


def sequential(items: DataFrame, *, key: str, order: Sequence[str], by: Sequence[str] = (), overlap: int = 10, quadratic: bool = False) -> DataFrame:
    """Pairs of each row and those 1..overlap (or 2^0..2^(overlap-1)) places after it in its group.

    The window is turned into an equi-join: each row emits the places it pairs with.
    """
    r = ranked(items, order=order, by=by)
    offsets = F.array(*[F.lit(2**i if quadratic else i + 1).cast("int") for i in range(overlap)])
    a = r.select(*by, F.col(key).alias("id1"), F.explode(F.transform(offsets, lambda o: F.col("rank") + o)).alias("rank"))
    b = r.select(*by, F.col(key).alias("id2"), "rank")
    return a.join(b, [*by, "rank"]).select(*by, "id1", "id2")


def classify_pairs(pairs: DataFrame, ranks: DataFrame, *, key: str, overlap: int, quadratic: bool = True, doublings: int | None = None) -> DataFrame:
    """sequential: the ranks differ by at most overlap, or by overlap * 2^k; else the pair closes a loop.

    k goes up to doublings, by default without end.
    """
    r = ranks.select(F.col(key).alias("__k"), F.col("rank").alias("__r"))
    both = pairs.join(r.toDF("id1", "rank1"), "id1").join(r.toDF("id2", "rank2"), "id2")
    gap = F.abs(F.col("rank2") - F.col("rank1"))
    near = gap <= overlap
    if quadratic:
        step = (gap % overlap == 0) & (F.bit_count(F.floor(gap / overlap)) == 1)
        near = near | (step if doublings is None else step & (gap <= overlap * 2**doublings))
    return both.withColumn("gap", gap).withColumn("sequential", near)


def loop_filter(pairs: DataFrame, *, inliers: str, matches: str, min_inliers: int = 30, min_ratio: float = 0.35) -> DataFrame:
    """keep per classified pair: loop pairs need both inliers and an inlier share; missing matches count as inliers."""
    total = F.coalesce(F.col(matches), F.col(inliers))
    ratio = F.when(total > 0, F.col(inliers) / total).otherwise(0.0)
    return pairs.withColumn("ratio", ratio).withColumn("keep", F.col("sequential") | ~((F.col(inliers) < min_inliers) | (ratio < min_ratio)))


#: Items of a key that one task pairs with as many others.
TOGETHER = 2048


def pairs_within(items: DataFrame, key: str, item: str, together: int = TOGETHER, carry: Sequence[str] = ()) -> DataFrame:
    """(key, id1, id2) with id1 < id2: all pairs of the distinct items (key, item) of a key; columns to carry come as c_1 and c_2.

    The items of a key with more than `together` are dealt into parts by their hash, and each
    pair of parts is a join key of its own, so that no task has more than about together^2
    pairs, however many items a key has. The pairs themselves are the result.
    """
    return _meetings(items, None, key, item, together, carry).where("id1 < id2")


def _parts_of(items: DataFrame, key: str, together: int = TOGETHER) -> DataFrame:
    """(key, __k): the number of parts that a key's items are dealt into."""
    return items.groupBy(key).agg(F.ceil(F.count("*") / together).cast("int").alias("__k"))


def _meetings(items: DataFrame, second: Column | None, key: str, item: str, together: int = TOGETHER, carry: Sequence[str] = ()) -> DataFrame:
    """(key, id1, id2, carried) of each item of a key with each one that the condition `second` holds for, dealt as in pairs_within.

    Items that come with their key's number of parts, __k, aren't counted again.
    """
    dealt = (items if "__k" in items.columns else items.join(_parts_of(items, key, together), key)).withColumn("__own", F.pmod(F.xxhash64(item), F.col("__k")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("__k") - 1)).alias("__other")
    a = dealt.select(key, F.col(item).alias("id1"), F.col("__own").alias("__a"), *[F.col(c).alias(f"{c}_1") for c in carry], others).withColumnRenamed("__other", "__b")
    b = dealt if second is None else dealt.where(second)
    b = b.select(key, F.col(item).alias("id2"), F.col("__own").alias("__b"), *[F.col(c).alias(f"{c}_2") for c in carry], others).withColumnRenamed("__other", "__a")
    return a.join(b, [key, "__a", "__b"]).select(key, "id1", "id2", *[f"{c}_{side}" for c in carry for side in (1, 2)])


#: Neighbours up to which a node takes their list along.
LIGHT = 32


#: Items of a key that meet as many others in one task, as a matrix of flags.
FLAGGED = 4096


def _light_pairs(key: tuple, rows: pa.Table) -> pa.Table:
    """(id1, id2) of the nodes of one meeting: those whose least common neighbour is mid and that aren't neighbours."""
    mid, first, second = (k.as_py() for k in key)
    order = np.argsort(rows["near"].to_numpy())
    near, part, lists = rows["near"].to_numpy()[order], rows["own"].to_numpy()[order], rows["all"].combine_chunks().take(pa.array(order))
    # a flag per ordered pair: taken where not yet ruled out
    free = np.triu(np.ones((len(near), len(near)), bool), 1)
    if first != second:
        free &= part[:, None] != part[None, :]
    who, other = np.repeat(np.arange(len(near)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
    at = np.searchsorted(near, other).clip(max=len(near) - 1)
    linked = near[at] == other
    free[who[linked], at[linked]] = False
    lower = other < mid
    who, other = who[lower], other[lower]
    by = np.argsort(other, kind="stable")
    who, other = who[by], other[by]
    ends = np.flatnonzero(np.diff(other, prepend=other[:1] - 1, append=other[-1:] + 1))
    for a, b in zip(ends[:-1][np.diff(ends) > 1], ends[1:][np.diff(ends) > 1], strict=True):
        free[np.ix_(who[a:b], who[a:b])] = False
    per = np.count_nonzero(free, axis=1)
    return pa.table({"id1": np.repeat(near, per), "id2": near[np.flatnonzero(free) - np.repeat(np.arange(len(near)) * len(near), per)]})


def _second_neighbours(known: DataFrame, light: int = LIGHT) -> DataFrame:
    """(id1, id2), id1 < id2, once each: nodes with a common neighbour that aren't neighbours, of distinct edges (id1 < id2).

    A node with few neighbours takes their list along. Two such nodes are paired at the least
    of their common neighbours only, and not if one is on the other's list, so that their
    pairs are neither shuffled nor compared: the nodes at a neighbour, or of two of its parts of FLAGGED nodes, come
    once to one task, which rules pairs out in a matrix of flags. Pairs with a node of many neighbours are made
    unique by a shuffle, which grows with these alone. ids are whole numbers.
    """
    ship_package(known.sparkSession)
    both = materialize(known.select(F.col("id1").alias("mid"), F.col("id2").alias("near")).unionByName(known.select(F.col("id2").alias("mid"), F.col("id1").alias("near"))))
    degrees = materialize(both.groupBy("near").agg((F.count("*") > light).alias("heavy")))
    few = both.join(degrees.where("not heavy").select("near"), "near", "left_semi")
    # only neighbours of very many nodes have parts, which are few and known before the lists are shuffled, once
    parts = materialize(_parts_of(few, "mid", FLAGGED).where("__k > 1"))
    listed = few.groupBy("near").agg(F.collect_list("mid").alias("all")).select("near", "all", F.explode("all").alias("mid"))
    dealt = listed.join(parts, "mid", "left").withColumn("__k", F.coalesce("__k", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("near"), F.col("__k")).cast("int"))
    dealt = dealt.select("mid", "near", "own", "all", F.explode(F.sequence(F.lit(0), F.col("__k") - 1)).alias("other"))
    kind = known.schema["id1"].dataType.simpleString()
    paired = dealt.select("mid", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "near", "own", "all").groupBy("mid", "a", "b").applyInArrow(_light_pairs, f"id1 {kind}, id2 {kind}")
    many = both.join(degrees.where("heavy").select("near"), "near", "left_semi").select("mid").distinct()
    marked = both.join(many, "mid", "left_semi").join(degrees, "near")
    some = _meetings(marked, F.col("heavy"), "mid", "near", carry=["heavy"]).where("id1 < id2 or (id1 > id2 and not heavy_1)")
    some = some.select(F.least("id1", "id2").alias("id1"), F.greatest("id1", "id2").alias("id2")).distinct()
    return paired.unionByName(some.join(known, ["id1", "id2"], "left_anti"))


def transitive(pairs: DataFrame, rounds: int = 1) -> DataFrame:
    """New pairs (a, c) with (a, b) and (b, c) present and (a, c) not; each round starts from all pairs so far."""
    known = materialize(pairs.select(F.least("id1", "id2").alias("id1"), F.greatest("id1", "id2").alias("id2")).where("id1 < id2").distinct())
    new = None
    for k in range(rounds):
        near = _second_neighbours(known)
        if k + 1 < rounds:
            near = materialize(near)
            known = known.unionByName(near)
        new = near if new is None else new.unionByName(near)
    return known.limit(0) if new is None else new


def within_radius(a: DataFrame, b: DataFrame, *, xyz: Sequence[str], radius: float, id_a: str, id_b: str, by: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """Pairs (by, id_a, id_b, d2) at most radius apart, by an equi-join on grid cells of the radius; columns to carry come as c_a and c_b.

    A sort-merge join: the planner's estimate of the left side doesn't count its 27 cells a row,
    and a broadcast of it passes the driver.
    """
    n = len(xyz)
    shifts = [[]]
    for _ in range(n):
        shifts = [[*s, d] for s in shifts for d in (-1, 0, 1)]
    cell = [F.floor(F.col(c) / radius) for c in xyz]
    moves = F.explode(F.array(*[F.struct(*[(cell[i] + d).alias(f"c{i}") for i, d in enumerate(s)]) for s in shifts])).alias("__c")
    left = a.select(*by, F.col(id_a).alias("id_a"), *[F.col(c).alias(f"{c}_a") for c in carry], *[F.col(c).alias(f"__a{i}") for i, c in enumerate(xyz)], moves).select("*", *[F.col(f"__c.c{i}").alias(f"__k{i}") for i in range(n)])
    right = b.select(*by, F.col(id_b).alias("id_b"), *[F.col(c).alias(f"{c}_b") for c in carry], *[F.col(c).alias(f"__b{i}") for i, c in enumerate(xyz)], *[c.alias(f"__k{i}") for i, c in enumerate(cell)])
    d2 = sum(((F.col(f"__a{i}") - F.col(f"__b{i}")) * (F.col(f"__a{i}") - F.col(f"__b{i}")) for i in range(n)), F.lit(0.0))
    return left.join(right.hint("merge"), [*by, *[f"__k{i}" for i in range(n)]]).withColumn("d2", d2).where(F.col("d2") <= radius * radius).select(*by, "id_a", "id_b", "d2", *[f"{c}_{side}" for c in carry for side in "ab"])


def revisits(poses: DataFrame, *, by: Sequence[str], key: str, ts: str, xyz: Sequence[str], radius: float, min_gap: float) -> DataFrame:
    """Pairs of poses of a trajectory within radius whose times differ by min_gap seconds or more."""
    pairs = within_radius(poses, poses, xyz=xyz, radius=radius, id_a=key, id_b=key, by=by, carry=[ts]).where("id_a < id_b")
    return pairs.where(F.abs(F.col(f"{ts}_b") - F.col(f"{ts}_a")) / 1e9 >= min_gap).select(*by, "id_a", "id_b", F.sqrt("d2").alias("distance"))


#: Rows of the searched table that one block holds.
KNN_BLOCK = 4096


def _nearest(pdf: pd.DataFrame, k: int, exclude_self: bool) -> pd.DataFrame:
    """The k nearest of the other rows for each row that asks; products of matrices find a few more candidates, whose distances are then exact."""
    a, b = pdf[pdf["asks"]].sort_values("key"), pdf[~pdf["asks"]].sort_values("key")
    out: list[pd.DataFrame] = []
    if len(a) and len(b):
        y, ids = np.stack(b["v"]), b["key"].to_numpy()
        own = (y * y).sum(axis=1)
        for first in range(0, len(a), 512):
            part = a.iloc[first : first + 512]
            x = np.stack(part["v"])
            rough = own - 2 * x @ y.T
            slack = 1e-9 * (own.max() + (x * x).sum(axis=1).max() + 1)  # products round; what is as near but for that stays a candidate
            for i, name in enumerate(part["key"]):
                most = min(k + exclude_self, len(b)) - 1
                near = np.flatnonzero(rough[i] <= np.partition(rough[i], most)[most] + slack)
                d2 = ((y[near] - x[i]) ** 2).sum(axis=1)
                if exclude_self:
                    near, d2 = near[ids[near] != name], d2[ids[near] != name]
                best = np.lexsort((ids[near], d2))[:k]
                out.append(pd.DataFrame({"query": name, "neighbor": ids[near[best]], "d2": d2[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query": [], "neighbor": [], "d2": []}).astype({"query": "int64", "neighbor": "int64", "d2": "float64"})


def knn(queries: DataFrame, rows: DataFrame, *, key: str, vector: str, k: int, max_distance: float | None = None, min_neighbors: int = 0, exclude_self: bool = True) -> DataFrame:
    """The k nearest rows (L2) of each query: (query, neighbor, d2, rank); ties to the smaller key.

    Rows are dealt into blocks of a fixed size and queries into groups; a task compares one
    group with one block as a matrix product and emits at most k per query, which are
    combined afterwards. Neighbours beyond max_distance go, but for the first min_neighbors.
    """
    ship_package(queries.sparkSession)
    n_rows, n_queries = rows.count(), queries.count()
    blocks, groups = max(1, -(-n_rows // KNN_BLOCK)), max(1, -(-n_queries // KNN_BLOCK))
    dense = lambda: F.transform(vector, lambda v: v.cast("double")).alias("v")
    q = queries.select(F.col(key).alias("key"), dense(), F.lit(True).alias("asks"), F.pmod(F.xxhash64(key), F.lit(groups)).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
    r = rows.select(F.col(key).alias("key"), dense(), F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.pmod(F.xxhash64(key), F.lit(blocks)).alias("b"))

    some = q.unionByName(r).groupBy("g", "b").applyInPandas(lambda pdf: _nearest(pdf, k, exclude_self), "query long, neighbor long, d2 double")
    out = some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("d2", "neighbor"))).where(F.col("rank") <= k)
    if max_distance is not None:
        out = out.where((F.col("rank") <= min_neighbors) | (F.col("d2") <= max_distance * max_distance))
    return out


#: Rows that train the cells of an index, cells at most, and rounds of training.
INDEX_SAMPLE, INDEX_CELLS, INDEX_ROUNDS = 20_000, 1024, 10


def train_cells(rows: DataFrame, *, key: str, vector: str, cells: int | None = None, sample: int = INDEX_SAMPLE, seed: int = 7) -> np.ndarray:
    """Centres of a partition index, by k-means on a bounded sample of rows (those of the smallest key hashes); at most INDEX_CELLS of them."""
    picked = rows.select(F.transform(vector, lambda v: v.cast("double")).alias("v"), F.xxhash64(F.lit(seed), key).alias("h"), F.col(key).alias("k")).orderBy("h", "k").limit(sample).collect()
    if not picked:
        return np.zeros((0, 0))
    x = np.array([r["v"] for r in picked])
    n = min(cells or max(1, round(math.sqrt(len(x)))), INDEX_CELLS, len(x))
    centres = x[np.random.default_rng(seed).choice(len(x), n, replace=False)]
    for _ in range(INDEX_ROUNDS):
        nearest = _cell_distances(x, centres).argmin(axis=1)
        for k in range(n):
            if (mine := x[nearest == k]).size:
                centres[k] = mine.mean(axis=0)
    return centres


def _cell_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)


def indexed_knn(queries: DataFrame, rows: DataFrame, *, key: str, vector: str, k: int, centres: np.ndarray | None = None, probes: int = 8, exclude_self: bool = True) -> DataFrame:
    """The k nearest rows (L2) among those of each query's `probes` nearest cells: (query, neighbor, d2, rank); ties to the smaller key.

    Every row is indexed, in the cell of its nearest centre. A cell with more than KNN_BLOCK
    rows is dealt into blocks, each of which a query visits, so no cell is one task. Distances
    are exact; only cells that aren't visited can hold missed neighbours. With as many probes
    as cells the result is that of knn().
    """
    ship_package(queries.sparkSession)
    centres = train_cells(rows, key=key, vector=vector) if centres is None else centres
    if not len(centres):
        return knn(queries, rows, key=key, vector=vector, k=k, exclude_self=exclude_self)
    held = queries.sparkSession.sparkContext.broadcast(centres)
    visits = min(probes, len(centres))

    def dealt(df: DataFrame, n: int) -> DataFrame:
        def run(batches):
            for pdf in batches:
                if len(pdf):
                    order = np.argsort(_cell_distances(np.stack(pdf["v"]), held.value), axis=1, kind="stable")[:, :n]
                    pdf["cells"] = list(order.astype(np.int32))
                    yield pdf

        dense = df.select(F.col(key).alias("key"), F.transform(vector, lambda v: v.cast("double")).alias("v"))
        return dense.mapInPandas(run, "key long, v array<double>, cells array<int>").select("key", "v", F.explode("cells").alias("cell"))

    indexed = materialize(dealt(rows, 1))
    blocks = indexed.groupBy("cell").agg(F.ceil(F.count("*") / KNN_BLOCK).cast("int").alias("blocks"))
    r = indexed.join(blocks, "cell").select("key", "v", F.lit(False).alias("asks"), "cell", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("b"))
    q = dealt(queries, visits).join(blocks, "cell").select("key", "v", F.lit(True).alias("asks"), "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"))
    some = q.unionByName(r).groupBy("cell", "b").applyInPandas(lambda pdf: _nearest(pdf, k, exclude_self), "query long, neighbor long, d2 double")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("d2", "neighbor"))).where(F.col("rank") <= k)


def mutual_matches(left: DataFrame, right: DataFrame, *, key: str, vector: str, ratio: float = 0.8, max_distance: float = 0.7, cross_check: bool = True, probes: int | None = None) -> DataFrame:
    """(left, right, distance): nearest neighbours that pass the ratio and distance tests, and are each other's best.

    Exact by default, every block of one side against every block of the other. With probes,
    neighbours come from an index of either side, of which each vector visits so many cells.
    """

    def nearest(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
        if probes is None:
            return knn(queries, rows, key=key, vector=vector, k=k, exclude_self=False)
        return indexed_knn(queries, rows, key=key, vector=vector, k=k, probes=probes, exclude_self=False)

    forward = nearest(left, right, 2)
    pairs = forward.groupBy("query").agg(F.min_by("neighbor", "rank").alias("best"), F.min("d2").alias("d1"), F.max(F.when(F.col("rank") == 2, F.col("d2"))).alias("d2"))
    good = pairs.where((F.sqrt("d1") <= max_distance) & (F.col("d2").isNull() | (F.sqrt("d1") < ratio * F.sqrt("d2"))))
    out = good.select(F.col("query").alias("left"), F.col("best").alias("right"), F.sqrt("d1").alias("distance"))
    if cross_check:
        back = nearest(right, left, 1).select(F.col("query").alias("right"), F.col("neighbor").alias("left"))
        out = out.join(back, ["left", "right"], "left_semi")
    return out


def covisible(tracks: DataFrame, *, point: str, image: str, min_track: int = 3, min_shared: int = 1) -> DataFrame:
    """(id1, id2, shared): images that see min_shared or more common points of tracks of min_track or more images.

    Pairs are made within a point's track, long ones in parts, and counted before the shuffle
    on the pair.
    """
    t = tracks.select(F.col(point).alias("p"), F.col(image).alias("i")).distinct()
    n = t.groupBy("p").agg(F.count("*").alias("n")).where(F.col("n") >= min_track)
    pairs = pairs_within(t.join(n.select("p"), "p", "left_semi"), "p", "i")
    return pairs.groupBy("id1", "id2").agg(F.count("*").alias("shared")).where(F.col("shared") >= min_shared)


def associate_points(source: DataFrame, target: DataFrame, *, image: str, slot: str, point: str) -> DataFrame:
    """For each source point the target point that most of its observations share: (src, tgt, votes); ties to the smaller.

    Observations meet on (image, slot). votes counts from 0, as a first hit only opens a count.
    """
    s = source.select(image, slot, F.col(point).alias("src"))
    t = target.select(image, slot, F.col(point).alias("tgt"))
    votes = s.join(t, [image, slot]).groupBy("src", "tgt").agg((F.count("*") - 1).alias("votes"))
    best = votes.groupBy("src").agg(F.max_by(F.struct("tgt", "votes"), F.struct("votes", -F.col("tgt"))).alias("b"))
    return best.select("src", "b.tgt", "b.votes")


def box_overlap(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Intersection over union of boxes (x0, z0, x1, z1)."""
    w = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
    return F.when(union > 0, w * h / F.when(union > 0, union)).otherwise(0.0)


def merge_databases(a: DataFrame, b: DataFrame, *, name: str) -> DataFrame:
    """(source, old_id, name, new_id) of two catalogues (image_id, name) as one, ids dense in order of source and old id.

    Names must not be in both; `shared_names` gives those that are.
    """
    both = a.select(F.lit(1).alias("source"), F.col("image_id").alias("old_id"), F.col(name).alias("name")).unionByName(b.select(F.lit(2).alias("source"), F.col("image_id").alias("old_id"), F.col(name).alias("name")))
    return dense_ids(both, ["source", "old_id"], out="new_id")


def dense_ids(rows: DataFrame, order: Sequence[str], out: str = "dense_id", start: int = 1) -> DataFrame:
    """Consecutive ids in an order, without one task that sees all rows: range-sorted parts, each from its offset."""
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = rows.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id())
    parts = materialize(parts)
    sizes = parts.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return parts.join(F.broadcast(before), "__part").withColumn(out, (F.col("__before") + place - 1 + start).cast("long")).drop("__part", "__before")


def running_sum(rows: DataFrame, order: Sequence[str], value: str | Sequence[str], out: str | Sequence[str]) -> DataFrame:
    """Sums of columns up to each row in an order, the row included, by range-sorted parts as in dense_ids; rows equal in the order have no set place."""
    values, outs = ([value], [out]) if isinstance(value, str) else (list(value), list(out))
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = materialize(rows.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()))
    sums = parts.groupBy("__part").agg(*[F.sum(v).alias(f"__s{i}") for i, v in enumerate(values)])
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("__part", *[F.coalesce(F.sum(f"__s{i}").over(earlier), F.lit(0)).alias(f"__before{i}") for i in range(len(values))])
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = parts.join(F.broadcast(before), "__part").select("*", *[(F.col(f"__before{i}") + F.sum(v).over(inside)).alias(o) for i, (v, o) in enumerate(zip(values, outs, strict=True))])
    return summed.drop("__part", *[f"__before{i}" for i in range(len(values))])


def shared_names(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    return a.select(name).intersect(b.select(name))


def remap_pairs(pairs: DataFrame, ids: DataFrame, source: int) -> DataFrame:
    """Pairs of one source under the merged ids, with their pair id; the smaller id first."""
    m = ids.where(F.col("source") == source)
    both = pairs.join(m.select(F.col("old_id").alias("id1"), F.col("new_id").alias("n1")), "id1").join(m.select(F.col("old_id").alias("id2"), F.col("new_id").alias("n2")), "id2")
    return both.select(F.least("n1", "n2").alias("id1"), F.greatest("n1", "n2").alias("id2"), pair_id("n1", "n2").alias("pair_id"))
