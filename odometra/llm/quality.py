"""Quality classifier on random-indexing word vectors (operator 12).

Every token (a word, or a run of other characters) has a random index vector of +1 and -1.
A word's vector is the sum of the index vectors of its neighbours over the whole corpus,
kept by hash bucket, so that the table has one size whatever the vocabulary: all tokens
count, rare ones share buckets. Partitions sum whole numbers and pass on one row per run of
buckets that they met; those rows are summed as they stream by, so that results don't depend
on the order and no group is held whole.

A document is pooled from its tokens' vectors, common words weighing less: the mean of the
whole text, and the extremes over its segments, so that a bad part shows in a long text. The
sum of index vectors themselves tells how often tokens repeat. A two-layer network is fitted
on a bounded sample of labelled rows, and the temperature of its probabilities on a part of
the sample that it hasn't seen.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_in_pandas, materialize, ship_package, table

#: Hash buckets of words, components of a vector, and neighbours on either side.
BUCKETS, WIDTH, REACH = 1 << 15, 64, 2
#: Buckets of one row of partial sums.
RUN = 512
#: Tokens of a segment, and tokens that are looked at at once.
SEGMENT, AT_ONCE = 64, 1 << 16
#: Labelled rows that the network is fitted on, about; they are drawn by the hash of their id.
SAMPLE = 20_000
#: Share of a token in the corpus at which it weighs half.
COMMON = 1e-3
#: Hidden units, passes over the sample, rows of a step, step size and decay of weights; share of the sample that calibrates.
HIDDEN, EPOCHS, STEP_ROWS, RATE, DECAY, HELD = 32, 40, 256, 2e-3, 1e-4, 0.2

_TOKEN = re.compile(r"\w+|[^\w\s]+")
FEATURES = 3 * WIDTH + 7


class _Buckets(dict):
    """Bucket of a token; long tokens aren't remembered, and all are forgotten at a fixed number."""

    def __missing__(self, token: str) -> int:
        value = xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass")) % BUCKETS
        if len(token) <= 64:
            if len(self) > 500_000:
                self.clear()
            self[token] = value
        return value


def tokens(text: str | None, buckets: dict) -> Iterator[np.ndarray]:
    """Buckets of the tokens of a whole text, at most AT_ONCE at a time."""
    if not text:
        return
    if len(text) <= AT_ONCE:
        found = _TOKEN.findall(text)
        yield np.fromiter(map(buckets.__getitem__, found), np.int32, len(found))
        return
    matches = _TOKEN.finditer(text)
    while len(part := np.fromiter((buckets[m[0]] for _, m in zip(range(AT_ONCE), matches)), np.int32)):
        yield part


@lru_cache(maxsize=1)
def index_vectors() -> np.ndarray:
    """A row of +1 and -1 for each bucket, and one of zeros."""
    signs = np.random.default_rng(12).integers(0, 2, (BUCKETS, WIDTH), dtype=np.int8) * 2 - 1
    return np.vstack([signs, np.zeros((1, WIDTH), np.int8)])


class Sums:
    """Sums of neighbours' index vectors by bucket, with the number of tokens as a last column."""

    def __init__(self) -> None:
        self.sums = np.zeros((BUCKETS, WIDTH + 1), np.int64)

    def add(self, ids: np.ndarray) -> None:
        """ids: buckets of texts in order, with REACH times BUCKETS before and after each text."""
        near = index_vectors()[ids]
        n = len(ids) - 2 * REACH
        total = np.zeros((n, WIDTH), np.int8)
        for k in range(2 * REACH + 1):
            if k != REACH:
                total += near[k : k + n]
        middle = ids[REACH : REACH + n]
        order = np.argsort(middle, kind="stable")
        ordered = middle[order]
        starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        known = ordered[starts]
        sums = np.add.reduceat(total[order], starts, axis=0, dtype=np.int64)
        real = known < BUCKETS
        self.sums[known[real], :WIDTH] += sums[real]
        self.sums[known[real], WIDTH] += np.diff(np.r_[starts, len(ordered)])[real]

    def rows(self) -> Iterator[tuple[int, bytes]]:
        """(run, sums) of the runs of buckets that have any."""
        for first in range(0, BUCKETS, RUN):
            if (part := self.sums[first : first + RUN]).any():
                yield first // RUN, part.tobytes()


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums, buckets, gap = Sums(), _Buckets(), np.full(REACH, BUCKETS, np.int32)
    held, n = [gap], 0
    for pdf in batches:
        for text in pdf["text"]:
            for part in tokens(text, buckets):
                held.append(part)
                n += len(part)
                if n >= AT_ONCE:
                    ids = np.concatenate([*held, gap])
                    sums.add(ids)
                    # of a long text the last tokens are the next part's neighbours; they count as the text's edge once
                    held, n = [gap], 0
            held.append(gap)
    if n:
        sums.add(np.concatenate([*held, gap]))
    found = list(sums.rows())
    yield pd.DataFrame({"run": np.array([r for r, _ in found], np.int32), "sums": [s for _, s in found]})


def _add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[int, np.ndarray] = {}
    for pdf in batches:
        for run, sums in zip(pdf["run"], pdf["sums"], strict=True):
            part = np.frombuffer(sums, np.int64)
            total[run] = total[run] + part if run in total else part
    yield pd.DataFrame({"run": np.array(list(total), np.int32), "sums": [x.tobytes() for x in total.values()]})


class Vectors:
    """Word vectors by bucket (float32) with what each bucket weighs."""

    def __init__(self, sums: np.ndarray) -> None:
        count = sums[:, WIDTH].astype(np.float64)
        total = count.sum()
        mean = sums[:, :WIDTH] / np.maximum(1.0, count)[:, None]
        if total:
            mean -= (count @ mean) / total
        size = np.sqrt((mean * mean).sum(axis=1))[:, None]
        self.weights = (COMMON / (COMMON + count / max(1.0, total))).astype(np.float32)
        self.vectors = (mean / np.maximum(size, 1e-9)).astype(np.float32)

    def pooled(self, text: str | None, buckets: dict) -> np.ndarray:
        """Features of a whole text: mean, largest and smallest component over segments, size, repetition in all and close by."""
        out = np.zeros(FEATURES, np.float32)
        total, weight, n = np.zeros(WIDTH), 0.0, 0
        repeated, most, sum_ = np.zeros(WIDTH), 0.0, 0.0
        high, low, segments = np.full(WIDTH, -np.inf), np.full(WIDTH, np.inf), 0
        alike, most_alike = 0, 0.0
        for ids in tokens(text, buckets):
            if not len(ids):
                continue
            starts = np.arange(0, len(ids), SEGMENT)
            w = self.weights[ids]
            sums = np.add.reduceat(self.vectors[ids] * w[:, None], starts, axis=0)
            ws = np.add.reduceat(w, starts)
            signs = np.add.reduceat(index_vectors()[ids], starts, axis=0, dtype=np.int32).astype(np.float64)
            sizes = np.diff(np.r_[starts, len(ids)])
            means = sums / ws[:, None]
            again = (signs * signs).sum(axis=1) / (WIDTH * sizes * sizes)
            near = np.zeros(len(ids), bool)
            for k in range(1, REACH + 1):
                near[k:] |= ids[k:] == ids[:-k]
            near_sums = np.add.reduceat(near, starts, dtype=np.int64)
            alike, most_alike = alike + int(near_sums.sum()), max(most_alike, float((near_sums / np.maximum(sizes, SEGMENT // 4)).max()))
            if len(sizes) > 1 and sizes[-1] < SEGMENT // 2:  # a short rest is no segment of its own
                means, again = means[:-1], again[:-1]
            high, low = np.maximum(high, means.max(axis=0)), np.minimum(low, means.min(axis=0))
            most, sum_, segments = max(most, again.max()), sum_ + again.sum(), segments + len(again)
            total, weight, repeated, n = total + sums.sum(axis=0), weight + ws.sum(), repeated + signs.sum(axis=0), n + len(ids)
        if n:
            out[:WIDTH], out[WIDTH : 2 * WIDTH], out[2 * WIDTH : 3 * WIDTH] = total / weight, high, low
            out[3 * WIDTH :] = np.log1p(n), (repeated @ repeated) / (WIDTH * n * n), most, sum_ / segments, weight / n, alike / n, most_alike
        return out


def word_vectors(docs: DataFrame, *, text_col: str = "text") -> Vectors:
    """Vectors from all texts. What passes through the driver is the table of buckets, of a fixed size."""
    spark = docs.sparkSession
    ship_package(spark)
    partial = docs.select(F.col(text_col).alias("text")).where("text is not null").mapInPandas(_count, "run int, sums binary")
    summed = materialize(partial.repartition(BUCKETS // RUN, "run").mapInPandas(_add_up, "run int, sums binary"))
    sums = np.zeros((BUCKETS, WIDTH + 1), np.int64)
    for r in summed.toLocalIterator():
        sums[r["run"] * RUN : (r["run"] + 1) * RUN] = np.frombuffer(r["sums"], np.int64).reshape(RUN, WIDTH + 1)
    return Vectors(sums)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits)) if len(y) else 0.0


class Network:
    """Two layers on standardised features, and a temperature; without labels every score is 0.5."""

    def __init__(self, x: np.ndarray, y: np.ndarray, *, seed: int = 12) -> None:
        self.temperature, self.fitted = 1.0, len(y) > 0
        if not self.fitted:
            return
        self.mean, self.std = x.mean(axis=0), x.std(axis=0) + 1e-6
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(y))
        n_held = int(HELD * len(y)) if len(y) >= 10 else 0
        held, rows = order[:n_held], order[n_held:]
        z = self._standard(x)
        share = np.clip(y[rows].mean(), 1e-3, 1 - 1e-3)
        self.parts = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN), np.array([np.log(share / (1 - share))])]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.parts]
        best, step = (np.inf, [p.copy() for p in self.parts]), 0
        for _ in range(EPOCHS):
            rng.shuffle(rows)
            for first in range(0, len(rows), STEP_ROWS):
                step += 1
                some = rows[first : first + STEP_ROWS]
                for p, g, (m, v) in zip(self.parts, self._gradients(z[some], y[some]), moments, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + DECAY * p)
            checked = held if n_held else rows
            if (loss := _loss(self._logits(z[checked]), y[checked])) < best[0]:
                best = (loss, [p.copy() for p in self.parts])
        self.parts = best[1]
        if n_held:
            logits = self._logits(z[held])
            self.temperature = float(min(np.geomspace(0.25, 8, 141), key=lambda t: _loss(logits / t, y[held])))

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.std, -8, 8)

    def _logits(self, z: np.ndarray) -> np.ndarray:
        w, b, u, c = self.parts
        return np.maximum(0.0, z @ w + b) @ u + c[0]

    def _gradients(self, z: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        w, b, u, c = self.parts
        inner = z @ w + b
        hidden = np.maximum(0.0, inner)
        d = (_sigmoid(hidden @ u + c[0]) - y) / len(y)
        back = d[:, None] * u * (inner > 0)
        return [z.T @ back, back.sum(axis=0), hidden.T @ d, np.array([d.sum()])]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self._logits(self._standard(x)) / self.temperature) if self.fitted else np.full(len(x), 0.5)


def learn(docs: DataFrame, labels: DataFrame, vectors: Vectors, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Network:
    """The network of labelled documents: about `sample` of them, drawn by the hash of their id.

    Rows without an id or a label teach nothing; of several labels of one id the largest
    counts, and of several texts of one id one.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).alias("of"), F.col(label_col).cast("double").alias("y")).where("of is not null and y is not null").groupBy("of").agg(F.max("y").alias("y"))
    n = known.count()
    drawn = known.where(F.pmod(F.xxhash64(F.lit("sample"), "of"), F.lit(max(n, 1))) < sample)
    held = spark.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets = _Buckets()
        for pdf in batches:
            yield pd.DataFrame({"of": pdf["of"], "y": pdf["y"], "x": [held.value.pooled(t, buckets).tobytes() for t in pdf["text"]]})

    # the drawn labels are bounded by the sample: a row of two numbers each
    rows = docs.select(F.col(id_col).alias("of"), F.col(text_col).alias("text")).join(F.broadcast(drawn), "of")
    got = rows.select("of", "y", "text").mapInPandas(run, "of long, y double, x binary").groupBy("of").agg(F.max("y").alias("y"), F.min("x").alias("x")).collect()
    got.sort(key=lambda r: r["of"])
    x = np.frombuffer(b"".join(r["x"] for r in got), np.float32).reshape(len(got), FEATURES).astype(np.float64)
    return Network(x, np.array([r["y"] for r in got]))


def score(docs: DataFrame, vectors: Vectors, network: Network, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text, a row per input row; no shuffle. Null and empty texts have no tokens and get the score of that."""
    held = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets = _Buckets()
        vectors, network = held.value
        for pdf in batches:
            x = np.array([vectors.pooled(t, buckets) for t in pdf["text"]], np.float64).reshape(len(pdf), FEATURES)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": network.scores(x)})

    return map_in_pandas(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, score double")


#: Score from which a document counts as good.
GOOD = 0.3


def held_out(id_column):
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word vectors come from all texts, labels from rows that aren't held out. A null doc_id isn't held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    vectors = word_vectors(docs)
    network = learn(docs, labels.where(~held_out(F.col("doc_id"))), vectors)
    out = score(docs, vectors, network)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= GOOD, 1).otherwise(0).alias("predicted"))
