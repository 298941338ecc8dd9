"""Hard negatives by one-dimensional distance keys (operator 13).

A row's score is its inner product with the anchor. With one more component, sqrt(M^2 - |x|^2)
for rows (M: the longest row) and 0 for anchors, high scores are small distances: d^2 =
|a|^2 + M^2 - 2 score. Every row goes to its nearest pivot and is stored sorted by (pivot,
distance to the pivot), cut into blocks of equal size. A row within r of an anchor that is d
from a pivot has a key in [d - r, d + r], so a round visits only blocks that overlap these
intervals and that no round before did, compares them as matrix products, and keeps the best
few per anchor. A search ends when the k-th best found is no farther than r: nothing that
wasn't visited can be better. Positives are searched first; their scores then bound the
annulus in which their negatives lie.

Copies of a vector with the same label are one class, of which only the smallest ids can be
among the first; this loses nothing, and no vector that a third of all rows share is compared
more than once. Anchors of one class are searched once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.pairs import dense_ids
from .common import discard, materialize, ship_package, table

#: Rows of a block, and anchors that one task compares with a block at once.
BLOCK, ASKING = 1024, 512
#: Pivots at most, rows per pivot in the sample that places them, rounds of placing, and cells of keys a pivot.
PIVOTS, SAMPLE, ROUNDS, CELLS = 512, 16, 8, 64
#: A radius grows by these factors where too few rows were found, the first time and later.
GROWTH = (1.3, 2.0)
#: Relative room for rounding in distances.
SLACK = 1e-9


def _matrix(vectors, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    if all(len(v) == width for v in vectors):
        return np.array(list(vectors), np.float64).reshape(len(vectors), width)
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (x * x).sum(axis=1)[:, None] - 2 * x @ y.T + (y * y).sum(axis=1)))


def place_pivots(x: np.ndarray, n: int) -> np.ndarray:
    """k-means on a bounded sample; any points would give right results."""
    pivots = x[np.random.default_rng(13).choice(len(x), n, replace=False)]
    for _ in range(ROUNDS):
        nearest = _distances(x, pivots).argmin(axis=1)
        for k in range(n):
            if (mine := x[nearest == k]).size:
                pivots[k] = mine.mean(axis=0)
    return pivots


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def classes_of(rows: DataFrame, most: int) -> DataFrame:
    """(class, label, v, ids): rows of one vector and label with their `most` smallest ids, in order."""
    keyed = rows.withColumn("class", F.md5(F.concat_ws(",", F.col("label").cast("string"), F.concat_ws(",", F.transform("v", lambda x: x.cast("string")))).cast("binary")))
    first = keyed.withColumn("n", F.row_number().over(Window.partitionBy("class").orderBy("id"))).where(F.col("n") <= most)
    return first.groupBy("class").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.array_sort(F.collect_list("id")).alias("ids"))


class Index:
    """Rows sorted by (pivot, distance) in blocks, a directory of the blocks, and the pivots."""

    def __init__(self, classes: DataFrame) -> None:
        spark = classes.sparkSession
        ship_package(spark)
        square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
        n, self.width, most = classes.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max(square), F.lit(0.0))).first()
        self.longest = most**0.5
        pivots = max(1, min(PIVOTS, round(n**0.5 / 2)))
        # a hash sample of about that many rows, whatever the table's size
        some = classes.where(F.pmod(F.xxhash64("class"), F.lit(max(n, 1))) < SAMPLE * pivots).select("class", "v").collect() if n else []
        x = self._augmented(_matrix([r["v"] for r in sorted(some, key=lambda r: r["class"])], self.width), most)
        self.pivots = spark.sparkContext.broadcast(place_pivots(x, min(pivots, len(x))) if len(x) else np.zeros((1, self.width + 1)))
        held, width, augmented = self.pivots, self.width, self._augmented

        def keyed(batches):
            for pdf in batches:
                v = _matrix(pdf["v"], width)
                d = _distances(augmented(v, most), held.value)
                nearest = d.argmin(axis=1)
                yield pd.DataFrame({"class": pdf["class"], "label": pdf["label"], "ids": pdf["ids"], "vector": [r.tobytes() for r in v], "pivot": nearest.astype(np.int32), "key": d[np.arange(len(v)), nearest]})

        keyed_rows = materialize(classes.mapInPandas(keyed, "class string, label long, ids array<long>, vector binary, pivot int, key double"))
        numbered = materialize(dense_ids(keyed_rows, ["pivot", "key", "class"], out="number", start=0))
        discard(keyed_rows)
        firsts = numbered.groupBy(F.col("pivot").alias("of")).agg(F.min("number").alias("first"), F.min("key").alias("low"), F.max("key").alias("high"))
        #: a row a pivot
        self.spans = {r["of"]: (r["low"], r["high"]) for r in firsts.collect()}
        block = F.expr(f"(number - first) div {BLOCK}")
        self.rows = materialize(numbered.join(F.broadcast(firsts), F.col("pivot") == F.col("of")).select("class", "label", "ids", "vector", "pivot", "key", block.alias("block")))
        discard(numbered)
        blocks = self.rows.groupBy("pivot", "block").agg(F.min("key").alias("from"), F.max("key").alias("to"))
        self.directory = materialize(blocks.withColumn("c0", self._cell(F.col("from"))).withColumn("cell", F.explode(F.sequence("c0", self._cell(F.col("to"))))))

    @staticmethod
    def _augmented(v: np.ndarray, most: float) -> np.ndarray:
        return np.hstack([v, np.sqrt(np.maximum(0.0, most - (v * v).sum(axis=1)))[:, None]])

    def _cell(self, key: Column) -> Column:
        width = max((high for _, high in self.spans.values()), default=0.0) / CELLS or 1.0
        return F.floor(key / width).cast("int")

    def intervals(self, asking: DataFrame) -> DataFrame:
        """(class, pivot, d) of anchors (class, vector, radius): pivots with keys within the radius."""
        held, width, spans = self.pivots, self.width, self.spans

        def run(batches):
            low, high = (np.array([spans.get(k, (np.inf, -np.inf))[i] for k in range(len(held.value))]) for i in (0, 1))
            for pdf in batches:
                v = np.frombuffer(b"".join(pdf["vector"]), np.float64).reshape(len(pdf), width)
                d = _distances(np.hstack([v, np.zeros((len(v), 1))]), held.value)
                r = pdf["radius"].to_numpy()[:, None]
                rows, pivots = np.nonzero((d - r <= high) & (d + r >= low))
                out = pdf.drop(columns=["vector"]).iloc[rows].reset_index(drop=True)
                yield out.assign(pivot=pivots.astype(np.int32), d=d[rows, pivots], low=low[pivots], high=high[pivots])

        kept = [f for f in asking.schema.fields if f.name != "vector"]
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", pivot int, d double, low double, high double"
        return asking.mapInPandas(run, schema)

    def visits(self, asking: DataFrame) -> DataFrame:
        """(class, pivot, block) that overlap the radius of anchors (class, vector, radius, before, beyond).

        Blocks that overlapped the radius before (null: none) are left out, and those whose
        rows are all nearer than beyond.
        """
        near = self.intervals(asking.select("class", "vector", "radius", "before", "beyond"))
        lo = F.greatest(F.col("d") - F.col("radius"), F.col("beyond") - F.col("d"), F.col("low"))
        hi = F.least(F.col("d") + F.col("radius"), F.col("high"))
        near = near.withColumn("lo", lo).withColumn("hi", hi).where("lo <= hi")
        near = near.withColumn("q0", self._cell(F.col("lo"))).withColumn("cell", F.explode(F.sequence("q0", self._cell(F.col("hi")))))
        met = near.join(self.directory, ["pivot", "cell"])
        # of the cells that both reach, the first
        met = met.where((F.col("cell") == F.greatest("q0", "c0")) & (F.col("to") >= F.col("lo")) & (F.col("from") <= F.col("hi")))
        seen = F.col("before").isNotNull() & (F.col("to") >= F.greatest(F.col("d") - F.col("before"), F.col("beyond") - F.col("d"))) & (F.col("from") <= F.col("d") + F.col("before"))
        return met.where(~F.coalesce(seen, F.lit(False))).select("class", "pivot", "block")

    def compare(self, asking: DataFrame, best, schema: str) -> DataFrame:
        """best(scores, anchors, rows) of all anchors with each block that they visit, anchors taken ASKING at once."""
        width = self.width
        visits = materialize(self.visits(asking))
        chunks = visits.groupBy("pivot", "block").agg(F.ceil(F.count("*") / ASKING).cast("int").alias("chunks"))
        dealt = visits.join(chunks, ["pivot", "block"]).withColumn("chunk", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
        left = dealt.select("class", "pivot", "block", "chunk").join(asking.drop("radius", "before", "beyond"), "class")
        right = self.rows.join(chunks, ["pivot", "block"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks", "key")

        def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            x = np.frombuffer(b"".join(a["vector"]), np.float64).reshape(len(a), width)
            y = np.frombuffer(b"".join(b["vector"]), np.float64).reshape(len(b), width)
            return best(x @ y.T, a, b)

        keys = ["pivot", "block", "chunk"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, schema)


def _first(scores: np.ndarray, ids: list, k: int) -> list[tuple[float, int]]:
    """The first k of (score, id) by score, ties by the smaller id, of rows with the ids of their classes."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= kth)
        scores, ids = scores[keep], [ids[i] for i in keep]
    return sorted(((-s, i) for s, some in zip(scores.tolist(), ids, strict=True) for i in some))[:k]


def _positives(k: int):
    def best(scores: np.ndarray, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out, labels, ids = [], b["label"].to_numpy(), list(b["ids"])
        by_label = {x: np.flatnonzero(labels == x) for x in set(labels.tolist())}
        for row, name, label in zip(scores, a["class"], a["label"], strict=True):
            if (same := by_label.get(label)) is not None:
                out += [(name, -s, i) for s, i in _first(row[same], [ids[j] for j in same], k)]
        return pd.DataFrame(out, columns=["class", "score", "id"]).astype({"score": "int64", "id": "int64"})

    return best


def _negatives(k: int, low: int, high: int):
    def best(scores: np.ndarray, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out, labels, ids = [], b["label"].to_numpy(), list(b["ids"])
        for row, name, label, wanted in zip(scores, a["class"], a["label"], a["wanted"], strict=True):
            other = np.flatnonzero((labels != label) & (100 * row <= high * max(wanted)) & (100 * row >= low * min(wanted)))
            if not len(other):
                continue
            there = row[other]
            for t in wanted:
                fit = np.flatnonzero((100 * there >= low * t) & (100 * there <= high * t))
                out += [(name, t, -s, i) for s, i in _first(there[fit], [ids[other[j]] for j in fit], k)]
        return pd.DataFrame(out, columns=["class", "wanted", "score", "id"]).astype({"wanted": "int64", "score": "int64", "id": "int64"})

    return best


def _kept(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(index: Index, asking: DataFrame, by: list[str], k: int, best, schema: str, needed) -> DataFrame:
    """Rounds of growing radius until needed(asking, found) leaves none: the best k of each group `by`, with rank.

    asking: (class, vector, radius, before, beyond, ...). needed gives those still asking with
    the radius of the next round.
    """
    found = None
    while True:
        new = index.compare(asking, best, schema)
        following = materialize(_kept(new if found is None else found.drop("rank").unionByName(new), by, k))
        if found is not None:
            discard(found)
        found, before = following, asking
        asking = materialize(needed(asking, found))
        discard(before)
        if asking.isEmpty():
            return found


def mine(rows: DataFrame, anchors: DataFrame, *, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    rows: (id long, label long, v array<double>, whole numbers whose inner products stay below
    2^53, so that all scores are exact), anchors: the ids that ask. An anchor's positives are the
    first `positives` other rows of its label, and each has the first `negatives` rows of other
    labels with low * positive_score <= 100 * negative_score <= high * positive_score; high
    scores first, ties by the smaller id. A negative positive score has no such rows. Rows that
    repeat are rows of their own; an anchor leaves itself out once. Shorter vectors count as
    filled up with zeros. A positive without a negative, and an anchor without a positive, give
    no rows; empty tables give none.
    """
    most = max(positives + 1, negatives)
    classes = materialize(classes_of(rows, most))
    index = Index(classes)
    held = rows.join(anchors.select(F.col("id").alias("anchor")).distinct(), F.col("id") == F.col("anchor")).select("id", "label", "v")
    own = F.md5(F.concat_ws(",", F.col("label").cast("string"), F.concat_ws(",", F.transform("v", lambda x: x.cast("string")))).cast("binary"))
    held = materialize(held.select("id", own.alias("class")))
    longest = index.longest
    asked = index.rows.join(held.select("class").distinct(), "class", "left_semi").select("class", "label", "vector", "pivot", "key")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    norms = classes.select("class", square.alias("square"))
    asked = materialize(asked.join(norms, "class"))

    def reach(score: Column) -> Column:
        """The distance of a score."""
        return F.sqrt(F.greatest(F.lit(0.0), F.col("square") + longest**2 - 2 * score)) * (1 + SLACK) + SLACK

    everything = (F.sqrt("square") + longest) * (1 + SLACK) + SLACK

    def more_positives(asking: DataFrame, found: DataFrame) -> DataFrame:
        last = found.groupBy("class").agg(F.count("*").alias("n"), F.min("score").alias("worst")).withColumnRenamed("class", "of")
        state = asking.join(last, F.col("class") == F.col("of"), "left")
        enough = F.coalesce(F.col("n"), F.lit(0)) >= positives + 1
        following = F.when(enough, reach(F.col("worst"))).otherwise(F.least(everything, F.col("radius") * F.when(F.col("before").isNull(), GROWTH[0]).otherwise(GROWTH[1]) + 1))
        state = state.withColumn("next", following).where((F.col("radius") < F.col("next")) & (F.col("radius") < everything))
        return state.select("class", "label", "vector", "square", F.col("next").alias("radius"), F.col("radius").alias("before"), "beyond")

    # an anchor's own row has its key: the ball of its nearest pivot around it is a first guess
    first = asked.select("class", "label", "vector", "square", (F.col("key") + 1).alias("radius"), F.lit(None).cast("double").alias("before"), F.lit(0.0).alias("beyond"))
    near = _search(index, materialize(first), ["class"], positives + 1, _positives(positives + 1), "class string, score long, id long", more_positives)
    wanted = near.where("score >= 0").groupBy("class").agg(F.array_sort(F.collect_set("score")).alias("wanted")).withColumnRenamed("class", "of")
    second = asked.join(wanted, F.col("class") == F.col("of")).select("class", "label", "vector", "square", "wanted", reach(F.element_at("wanted", 1) * high / 100).alias("radius"), F.lit(None).cast("double").alias("before"), (reach(F.element_at("wanted", -1) * high / 100) * (1 - 3 * SLACK) - 3 * SLACK).alias("beyond"))

    def more_negatives(asking: DataFrame, found: DataFrame) -> DataFrame:
        last = found.groupBy("class", "wanted").agg(F.count("*").alias("n"), F.min("score").alias("worst")).select(F.col("class").alias("of"), F.col("wanted").alias("t"), "n", "worst")
        each = asking.select("class", "square", "radius", "before", F.explode("wanted").alias("target"))
        state = each.join(last, (F.col("class") == F.col("of")) & (F.col("target") == F.col("t")), "left")
        floor = reach(F.col("target") * low / 100)
        following = F.when(F.coalesce(F.col("n"), F.lit(0)) >= negatives, reach(F.col("worst"))).otherwise(F.when(F.col("before").isNull(), F.least(floor, F.col("radius") * 1.05 + 1)).otherwise(floor))
        open_ = state.withColumn("next", following).where((F.col("radius") < F.col("next")) & (F.col("radius") < floor))
        grown = open_.groupBy(F.col("class").alias("open")).agg(F.max("next").alias("next"))
        return asking.join(grown, F.col("class") == F.col("open")).select("class", "label", "vector", "square", "wanted", F.col("next").alias("radius"), F.col("radius").alias("before"), "beyond")

    hard = _search(index, materialize(second), ["class", "wanted"], negatives, _negatives(negatives, low, high), "class string, wanted long, score long, id long", more_negatives)
    listed = near.groupBy(F.col("class").alias("of")).agg(F.array_sort(F.collect_list(F.struct("rank", "score", "id"))).alias("near"))
    pairs = held.join(listed, F.col("class") == F.col("of"))
    own_place = F.array_position(F.transform("near", lambda x: x["id"]), F.col("id"))
    others = F.filter("near", lambda x, i: (i + 1) != F.col("own"))
    pairs = pairs.withColumn("own", own_place).select(F.col("id").alias("anchor_id"), "class", F.explode(F.slice(others, 1, positives)).alias("p"))
    pairs = pairs.select("anchor_id", "class", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    hard = hard.select(F.col("class").alias("of"), "wanted", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.join(hard, (F.col("class") == F.col("of")) & (F.col("positive_score") == F.col("wanted"))).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without an id take no part."""
    rows = table(spark, sf_dir, "embeddings").where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double"))
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("v"))
    return mine(rows, rows.where("id % 100 = 0"))


ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (SELECT p.*, s.other AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other)::INT AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
