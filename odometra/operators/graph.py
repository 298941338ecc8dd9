"""Graph operators: components, spanning trees, tracks, degrees, edge filters."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checkpoints import discard, materialize
from ..shipping import ship_package
from .pairs import dense_ids, running_sum


def symmetric(edges: DataFrame, a: str = "id1", b: str = "id2", loops: bool = False) -> DataFrame:
    """Each edge in both directions, once; loops, which are the same both ways, only if asked for."""
    e = edges if loops else edges.where(F.col(a) != F.col(b))
    return e.select(F.col(a).alias("src"), F.col(b).alias("dst")).unionByName(e.select(F.col(b).alias("src"), F.col(a).alias("dst"))).distinct()


def connected_components(edges: DataFrame, a: str = "id1", b: str = "id2", nodes: DataFrame | None = None, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest id reachable; nodes without edges, if given, are their own.

    Large-star and small-star steps in turn: per vertex a minimum (combined before the
    shuffle) and one join that a vertex with very many edges cannot make uneven, because both
    sides are plain exchanges. Edges are written out after each step and never collected.
    Raises if the components aren't finished after `rounds`.
    """
    e = materialize(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.where("u > m").select("u", F.col("m").alias("v"))).where("u > v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        following = materialize(large.join(down, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v"))).distinct())
        discard(e, least)
        e = following
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components aren't finished after {rounds} rounds")
    roots = e.groupBy("u").agg(F.min("v").alias("component"))
    tops = e.select(F.col("v").alias("u")).distinct().join(roots, "u", "left_anti").select("u", F.col("u").alias("component"))
    found = roots.unionByName(tops).withColumnRenamed("u", "node")
    if nodes is not None:
        alone = nodes.toDF("node").distinct().join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
        found = found.unionByName(alone)
    return found


def ranked_components(components: DataFrame, min_size: int = 1) -> DataFrame:
    """(node, component, size, rank): components by size, the largest 0, of equals the smaller id first; below min_size -1."""
    n = components.groupBy("component").agg(F.count("*").alias("size"))
    big = dense_ids(n.where(F.col("size") >= min_size).withColumn("__neg", -F.col("size")), ["__neg", "component"], out="rank", start=0)
    return components.join(n.join(big.select("component", "rank"), "component", "left"), "component").select("node", "component", "size", F.coalesce("rank", F.lit(-1).cast("long")).alias("rank"))


def largest_component(components: DataFrame) -> DataFrame:
    """Nodes of the largest component, the smaller id of equals."""
    top = components.groupBy("component").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "component").limit(1)
    return components.join(top, "component", "left_semi").select("node")


def edges_within(edges: DataFrame, nodes: DataFrame, a: str = "id1", b: str = "id2") -> DataFrame:
    """Edges with both ends in nodes."""
    n = nodes.toDF("__n")
    return edges.join(n, F.col(a) == F.col("__n"), "left_semi").join(n, F.col(b) == F.col("__n"), "left_semi")


def spanning_forest(edges: DataFrame, *, a: str = "id1", b: str = "id2", weight: str = "weight", largest: bool = True, rounds: int = 40) -> DataFrame:
    """Edges (id1, id2, weight) of a maximum (or minimum) spanning forest; ties to the smaller pair of ids.

    Boruvka: in each round every component takes its best outgoing edge; components at least
    halve, so the rounds are a logarithm of the vertices. Between two components only the best
    edge goes on to the next round, so that rounds shrink quickly, and components are those of
    the edges that were just taken.
    """
    side = -1 if largest else 1
    e = edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("id1"), F.greatest(a, b).alias("id2"), F.col(weight).alias("weight")).groupBy("id1", "id2").agg((F.max if largest else F.min)("weight").alias("weight"))
    # c1, c2: the components that an edge joins, at first its ends
    crossing = materialize(e.select(F.col("id1").alias("c1"), F.col("id2").alias("c2"), F.struct((F.col("weight") * side).alias("w"), "id1", "id2", "weight").alias("r")))
    tree = []
    for _ in range(rounds):
        edge = F.struct("r", "c1", "c2")
        out = crossing.select(F.col("c1").alias("c"), edge.alias("e")).unionByName(crossing.select(F.col("c2").alias("c"), edge.alias("e")))
        best = materialize(out.groupBy("c").agg(F.min("e").alias("e")).select("e.r.id1", "e.r.id2", "e.r.weight", "e.c1", "e.c2").distinct())
        if best.isEmpty():
            break
        tree.append(best.select("id1", "id2", "weight"))
        labels = materialize(connected_components(best, "c1", "c2"))
        l1, l2 = labels.toDF("c1", "n1"), labels.toDF("c2", "n2")
        left = crossing.join(l1, "c1").join(l2, "c2").where("n1 != n2").groupBy(F.least("n1", "n2").alias("c1"), F.greatest("n1", "n2").alias("c2")).agg(F.min("r").alias("r"))
        following = materialize(left)
        discard(crossing, labels)
        crossing = following
    else:
        raise RuntimeError(f"the forest isn't finished after {rounds} rounds")
    return reduce(DataFrame.unionByName, tree) if tree else crossing.select("r.id1", "r.id2", "r.weight")


def rooted_forest(edges: DataFrame, *, a: str = "id1", b: str = "id2", roots: DataFrame | None = None, nodes: DataFrame | None = None) -> DataFrame:
    """(node, parent, depth, root) of a forest's edges; a root is its own parent, at depth 0.

    roots: (node), the smallest of a tree's counts; by default each tree's smallest id. Nodes
    of trees without a root, and nodes without edges that aren't roots, have nulls. Raises
    ValueError if the edges have a cycle within reach of a root.

    By the Euler tour: every edge is two arcs, the arc after (u, v) is that from v to the
    neighbour that follows u, and the tour is cut before the root's first arc. Pointer
    doubling gives each arc its distance from the end, so rounds grow with the logarithm of
    the arcs, however deep the tree is; the earlier arc of an edge leads down. Depths are
    running sums over the tour. Neighbours follow one another in a range-sorted numbering of
    all arcs, so that no node's neighbours meet in one task.
    """
    e = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    arcs = materialize(dense_ids(both, ["u", "v"], out="k", start=0))
    everyone = arcs.select(F.col("u").alias("node")).distinct()
    if nodes is not None:
        everyone = everyone.unionByName(nodes.toDF("node")).distinct()
    tops = None if roots is None else materialize(roots.toDF("node").where("node is not null").distinct())
    if tops is None:
        parts = connected_components(edges, a, b, nodes=nodes)
        tops = parts.select(F.col("component").alias("node")).distinct()
    elif tops.count() > 1:
        parts = connected_components(edges, a, b, nodes=nodes).join(tops, "node")
        tops = parts.groupBy("component").agg(F.min("node").alias("node")).select("node").unionByName(tops.join(everyone, "node", "left_anti"))
    tops = materialize(tops)
    ends = materialize(arcs.groupBy("u").agg(F.min("k").alias("first"), F.max("k").alias("last")))
    starts = ends.join(tops, F.col("u") == F.col("node")).select(F.col("first").alias("start"), F.col("node").alias("root"))
    back = arcs.select(F.col("u").alias("v"), F.col("v").alias("u"), F.col("k").alias("back"))
    paired = arcs.join(back, ["u", "v"]).join(ends.select(F.col("u").alias("v"), "first", "last"), "v")
    following = F.when(F.col("back") < F.col("last"), F.col("back") + 1).otherwise(F.col("first"))
    paired = materialize(paired.select("k", "u", "v", "back", following.alias("next")))
    cut = paired.join(starts, F.col("next") == F.col("start"), "left")
    # to: the arc that steps lead to, and root where that is the last of a tour
    ranked = materialize(cut.select("k", F.when(F.col("root").isNull(), F.col("next")).alias("to"), "root", F.lit(0).cast("long").alias("steps")))
    ranked = _rank(ranked, arcs.count())
    place = ranked.where("root is not null").select("k", "root", "steps")
    toured = paired.join(place, "k").join(place.select(F.col("k").alias("back"), F.col("steps").alias("back_steps")), "back", "left")
    toured = materialize(toured.select("u", "v", "root", "steps", F.col("back_steps").isNull().alias("open"), F.when(F.col("steps") > F.col("back_steps"), 1).otherwise(-1).alias("step")))
    if not toured.where("open").isEmpty():
        raise ValueError("the edges have a cycle")
    deep = running_sum(toured.withColumn("from_end", -F.col("steps")), ["root", "from_end"], "step", "depth").where("step = 1")
    found = deep.select(F.col("v").alias("node"), F.col("u").alias("parent"), F.col("depth").cast("long").alias("depth"), "root")
    own = tops.select("node", F.col("node").alias("parent"), F.lit(0).cast("long").alias("depth"), F.col("node").alias("root"))
    found = materialize(found.unionByName(own))
    nothing = F.lit(None).cast(arcs.schema["u"].dataType)
    rest = everyone.join(found.select("node"), "node", "left_anti")
    return found.unionByName(rest.select("node", nothing.alias("parent"), F.lit(None).cast("long").alias("depth"), nothing.alias("root")))


def _rank(ranked: DataFrame, arcs: int) -> DataFrame:
    """Pointer doubling of (k, to, root, steps): after r rounds a pointer spans 2^r arcs; what isn't at an end then is on a circle."""
    for _ in range(max(1, arcs).bit_length() + 1):
        on = ranked.where("to is not null")
        ahead = ranked.select(F.col("k").alias("to"), F.col("to").alias("next"), F.col("root").alias("next_root"), F.col("steps").alias("more"))
        moved = on.join(ahead, "to").select("k", F.col("next").alias("to"), F.col("next_root").alias("root"), (F.col("steps") + F.col("more") + 1).alias("steps"))
        following = materialize(ranked.where("to is null").unionByName(moved))
        discard(ranked)
        ranked = following
        if ranked.where("to is not null").isEmpty():
            break
    return ranked


def degrees(edges: DataFrame, a: str = "id1", b: str = "id2", loops: bool = False) -> DataFrame:
    """(node, degree): distinct neighbours; a node with a loop is a neighbour of its own, if loops count."""
    return symmetric(edges, a, b, loops).groupBy("src").agg(F.count("*").alias("degree")).withColumnRenamed("src", "node")


def two_view_observations(edges: DataFrame, a: str = "id1", b: str = "id2", loops: bool = False) -> DataFrame:
    """Edges whose both ends have no other edge; loops are edges only if they count."""
    d = degrees(edges, a, b, loops).where("degree = 1")
    return edges_within(edges, d.select("node"), a, b)


#: Pairs of a left and a right node that one task of a composition may find, and pairs of either side that it reads.
CELLS, READS = 1 << 25, 1 << 21


def _composed(left: pa.Table, right: pa.Table) -> pa.Table:
    """(a, cs): for each a of left (a, m) the distinct c of right (m, c) that share an m with it."""
    starts, a = np.unique(left["a"].to_numpy(), return_inverse=True)
    ends, c = np.unique(right["c"].to_numpy(), return_inverse=True)
    mids, m = np.unique(right["m"].to_numpy(), return_inverse=True)
    some, sizes = [ends[:0]], np.zeros(len(starts), "int32")
    if len(starts) and len(mids):
        many = np.bincount(m)
        c, begin = c[np.argsort(m, kind="stable")], np.cumsum(many) - many
        order = np.argsort(a, kind="stable")
        a, by = a[order], left["m"].to_numpy()[order]
        at = np.searchsorted(mids, by).clip(max=len(mids) - 1)
        a, at = a[mids[at] == by], at[mids[at] == by]
        rows = max(1, READS * 4 // len(ends))
        for first in range(0, len(starts), rows):
            part = slice(*np.searchsorted(a, [first, first + rows]))
            reached = np.zeros((min(rows, len(starts) - first), len(ends)), bool)
            upto = np.cumsum(many[at[part]])
            cuts = np.searchsorted(upto, np.arange(READS, upto[-1] if len(upto) else 0, READS), side="right")
            for x, y in zip([0, *cuts], [*cuts, len(upto)], strict=True):
                mine = at[part][x:y]
                n = many[mine]
                hit = np.repeat(begin[mine] - np.cumsum(n) + n, n) + np.arange(n.sum())
                reached[np.repeat(a[part][x:y] - first, n), c[hit]] = True
            some.append(ends[np.nonzero(reached)[1]])
            sizes[first : first + rows] = reached.sum(axis=1)
    return pa.table({"a": starts, "cs": pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype("int32"), np.concatenate(some))})


def _compose(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, c), once each, of the pairs (a, m) and (m, c).

    Groups of a meet blocks of c, each in one task, which sees all ways from one to the other.
    So what is shuffled are the pairs given, once per part of the other side, and never the
    pairs found; a task finds about CELLS of them at most.
    """
    ship_package(left.sparkSession)
    size = lambda df, c: df.agg(F.count("*"), F.approx_count_distinct(c)).first()
    (nl, na), (nr, nc) = size(left, "a"), size(right, "c")
    parts = max(1, na * nc / CELLS)
    groups = max(1, -(-nl // READS), round(math.sqrt(parts * nl / max(1, nr))))
    blocks = max(1, -(-nr // READS), math.ceil(parts / groups))
    own = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    dealt = left.select("a", "m", own("a", groups).alias("g"), every(blocks).alias("b")).groupBy("g", "b").cogroup(right.select("m", "c", every(groups).alias("g"), own("c", blocks).alias("b")).groupBy("g", "b"))
    found = dealt.applyInArrow(_composed, f"a {left.schema['a'].dataType.simpleString()}, cs array<{right.schema['c'].dataType.simpleString()}>")
    return found.select("a", F.explode("cs").alias("c"))


#: Ids of a chunk, which a list of nodes keeps as flags where it has FEW or more of them; left nodes of one task; and
#: how many times as far as nodes ids may reach for that.
CHUNK, FEW, PACKED, SPARSE = 1 << 16, 1 << 11, 1 << 14, 64


def _flags(ids: np.ndarray) -> bytes:
    """Ids of a chunk as 16-bit numbers, or as a flag each if they are many."""
    if len(ids) < FEW:
        return ids.astype("<u2").tobytes()
    flags = np.zeros(CHUNK, bool)
    flags[ids] = True
    return np.packbits(flags, bitorder="little").tobytes()


def _unflagged(bits: bytes) -> np.ndarray:
    if len(bits) < CHUNK // 8:
        return np.frombuffer(bits, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))


def _packed(pairs: DataFrame) -> DataFrame:
    """(m, h, bits) of the pairs (m, c): the c of a chunk h in one value."""
    ship_package(pairs.sparkSession)
    listed = pairs.groupBy("m", F.floor(F.col("c") / CHUNK).cast("int").alias("h")).agg(F.collect_list(F.pmod("c", F.lit(CHUNK)).cast("int")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"m": batch["m"], "h": batch["h"], "bits": pa.array([_flags(v.values.to_numpy()) for v in batch["ids"]], pa.binary())})

    return listed.mapInArrow(run, f"m {pairs.schema['m'].dataType.simpleString()}, h int, bits binary")


def _unpacked(packed: DataFrame) -> DataFrame:
    """(m, c) of _packed(), list by list and without a shuffle."""
    kind = packed.schema["m"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some, n, m = [], 0, batch["m"]
            for k, (h, bits) in enumerate(zip(batch["h"].to_numpy(), batch["bits"], strict=True)):
                some.append(_unflagged(bits.as_py()).astype("int64") + int(h) * CHUNK)
                n += len(some[-1])
                if n >= READS or k + 1 == batch.num_rows:
                    ends = np.cumsum([0, *map(len, some)]).astype("int32")
                    yield pa.record_batch({"m": m.slice(k + 1 - len(some), len(some)), "cs": pa.ListArray.from_arrays(ends, np.concatenate(some))})
                    some, n = [], 0

    return packed.mapInArrow(run, f"m {kind}, cs array<bigint>").select("m", F.explode("cs").alias("c"))


def _ored(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """(m, h, bits): for each a of left (a, ms) the ids of chunk h that its ms have in right (m, h, bits)."""
    right = right.take(np.argsort(right["m"].to_numpy()))
    mids, bits = right["m"].to_numpy(), right["bits"].combine_chunks()
    sizes = pc.binary_length(bits).to_numpy()
    data = np.frombuffer(b"".join(bits.to_pylist()), np.uint8)
    large = sizes == CHUNK // 8
    whole = np.repeat(large, sizes)
    los, rows = data[~whole].view("<u2"), data[whole].reshape(-1, CHUNK // 8)
    many = np.where(large, 0, sizes // 2).astype("int64")
    begin, place = np.cumsum(many) - many, np.cumsum(large) - 1
    lists = left["ms"].combine_chunks()
    a, by = np.repeat(np.arange(left.num_rows), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
    at = np.searchsorted(mids, by).clip(max=max(0, len(mids) - 1))
    known = mids[at] == by if len(mids) else np.zeros(len(by), bool)
    a, at = a[known], at[known]
    which, out = [], []
    for first in range(0, left.num_rows, 256):
        n = min(256, left.num_rows - first)
        part = slice(*np.searchsorted(a, [first, first + n]))
        ra, ma = a[part] - first, at[part]
        reached = np.zeros((n, CHUNK), bool)
        upto = np.cumsum(many[ma])
        cuts = np.searchsorted(upto, np.arange(READS, upto[-1] if len(upto) else 0, READS), side="right")
        for x, y in zip([0, *cuts], [*cuts, len(upto)], strict=True):
            k = many[ma[x:y]]
            reached[np.repeat(ra[x:y], k), los[np.repeat(begin[ma[x:y]] - np.cumsum(k) + k, k) + np.arange(k.sum())]] = True
        flags = np.packbits(reached, axis=1, bitorder="little")
        dense = large[ma]
        rd, md = ra[dense], place[ma[dense]]
        for row in np.unique(rd):
            mine = md[slice(*np.searchsorted(rd, [row, row + 1]))]
            for x in range(0, len(mine), 1024):
                flags[row] |= np.bitwise_or.reduce(rows[mine[x : x + 1024]], axis=0)
        for row, count in enumerate(np.bitwise_count(flags).sum(axis=1)):
            if count:
                which.append(first + row)
                out.append(flags[row].tobytes() if count >= FEW else _unflagged(flags[row].tobytes()).astype("<u2").tobytes())
    return pa.table({"m": left["a"].take(pa.array(which, pa.int64())), "h": pa.array([key[1].as_py()] * len(out), pa.int32()), "bits": pa.array(out, pa.binary())})


def _compose_packed(left: DataFrame, right: DataFrame) -> DataFrame:
    """_packed() pairs (a, c), once each, of the pairs (a, m) and packed pairs (m, c).

    Groups of a meet the chunks of c, each in one task. What is shuffled are lists of the left
    side, once per chunk, and packed lists of the right, once per group, never pairs; a task finds PACKED * CHUNK flags at most.
    """
    lists = materialize(left.groupBy("a").agg(F.collect_list("m").alias("ms")))
    groups = max(1, -(-lists.count() // PACKED))
    hs = [r.h for r in right.select("h").distinct().collect()] or [0]
    chunks, parts = F.array(*map(F.lit, hs)), 2 * groups * len(hs)
    l = lists.select("a", "ms", F.pmod(F.xxhash64("a"), F.lit(groups)).alias("g"), F.explode(chunks).alias("h"))  # noqa: E741
    r = right.select("m", "h", "bits", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"))
    # lists are small beside the work on them, so as many tasks as given, and not as their size asks for
    l, r = l.repartition(parts, "g", "h"), r.repartition(parts, "g", "h")  # noqa: E741
    return l.groupBy("g", "h").cogroup(r.groupBy("g", "h")).applyInArrow(_ored, f"m {left.schema['a'].dataType.simpleString()}, h int, bits binary")


def transitive_correspondences(edges: DataFrame, start: DataFrame, depth: int, a: str = "id1", b: str = "id2") -> DataFrame:
    """(origin, node) pairs reachable from start in at most depth steps, without the origin itself.

    What is reachable is composed from its far end: the neighbours of all nodes up to depth - 1
    steps away, themselves included, then what their neighbours reach by these, and so on. The
    pairs are the result and grow with the square of a hub's neighbours; until then they are
    lists of flags or 16-bit numbers, see _compose_packed(), or rows, see _compose(), where ids
    aren't whole numbers or reach SPARSE times as far as there are nodes.
    """
    origins = start.toDF("origin").distinct()
    if depth < 1:
        return origins.select("origin", F.col("origin").alias("node")).limit(0)
    step = materialize(symmetric(edges, a, b))
    nodes, steps = origins.select(F.col("origin").alias("src")), []
    for k in range(depth):
        steps.append(materialize(step.join(nodes, "src", "left_semi")))
        nodes = steps[-1].select(F.col("dst").alias("src")).distinct()
    last = steps.pop().toDF("m", "c")
    if steps:
        last = last.unionByName(last.select("m", F.col("m").alias("c")).distinct())
    packed = False
    if steps and step.schema["dst"].dataType.simpleString() == "bigint":
        low, high, n = step.agg(F.min("dst"), F.max("dst"), F.approx_count_distinct("dst")).first()
        packed = low is not None and low >= 0 and high <= SPARSE * max(n, CHUNK) and high < CHUNK * (1 << 31)
    if packed:
        last = materialize(_packed(last))
    for k, s in enumerate(reversed(steps)):
        last = _compose_packed(s.toDF("a", "m"), last) if packed else _compose(s.toDF("a", "m"), last).toDF("m", "c")
        if k + 1 < len(steps):
            last = materialize(last)
    if packed:
        last = _unpacked(last)
    return last.toDF("origin", "node").where("node != origin")


def strong_clusters(edges: DataFrame, *, weight: str, threshold: float, min_size: int = 1, nodes: DataFrame | None = None) -> DataFrame:
    """Components over edges of weight >= threshold, the largest first; small ones -1."""
    return ranked_components(connected_components(edges.where(F.col(weight) >= threshold), nodes=nodes), min_size)


def establish_tracks(matches: DataFrame, features: DataFrame, *, max_distance: float, min_images: int) -> DataFrame:
    """(track, node): observations joined over matches (id1, id2); features: node, image, x, y.

    A track with two observations in one image further apart than max_distance is dropped,
    and so is one that is in fewer than min_images images. The farthest pair per image is
    bounded by its box, so only tracks that a box can't clear are compared pair by pair.
    """
    t = connected_components(matches).select(F.col("component").alias("track"), "node").join(features, "node")
    boxes = t.groupBy("track", "image").agg(F.count("*").alias("n"), (F.max("x") - F.min("x")).alias("w"), (F.max("y") - F.min("y")).alias("h"))
    unclear = boxes.where((F.col("n") > 1) & (F.sqrt(F.col("w") * F.col("w") + F.col("h") * F.col("h")) > max_distance))
    sure = unclear.where(F.greatest("w", "h") > max_distance).select("track")
    ask = unclear.where(F.greatest("w", "h") <= max_distance).select("track", "image")
    some = t.join(ask, ["track", "image"], "left_semi")
    p, q = some.select("track", "image", F.col("x").alias("x1"), F.col("y").alias("y1")), some.select("track", "image", F.col("x").alias("x2"), F.col("y").alias("y2"))
    far = (F.col("x1") - F.col("x2")) * (F.col("x1") - F.col("x2")) + (F.col("y1") - F.col("y2")) * (F.col("y1") - F.col("y2")) > max_distance * max_distance
    bad = sure.unionByName(p.join(q, ["track", "image"]).where(far).select("track")).distinct()
    images = boxes.groupBy("track").agg(F.count("*").alias("images")).where(F.col("images") >= min_images)
    return t.join(bad, "track", "left_anti").join(images, "track", "left_semi").select("track", "node")
