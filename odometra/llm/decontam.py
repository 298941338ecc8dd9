"""Benchmark decontamination by SimHash of item-sized windows (operator 4).

A benchmark item of m shingles is sought in windows of m shingles. Windows that hold no
shingle of an item have similarity 0 with it, so fingerprints are taken of the windows
around shared shingles only; nothing is lost. A shingle weighs as often as it occurs, in
items and windows alike: neither repeated nor templated items, nor the number of passes,
change a similarity. A window's fingerprint is the sign of the sum of its shingles' bits,
from running sums over the text (whole numbers, so the layout of a text changes nothing;
taken in pieces, so that long items and windows need no more memory than short ones).

The multi-index cuts 448 bits into 28 blocks of 16. Of two fingerprints that differ in at
most 55 bits some block differs in at most one, so looking up each block's value and its 16
neighbours finds all items within that radius, and among unrelated items 0.7 % of them. Two
bags of similarity 0.8 differ in 68 of 448 bits on average, beyond the radius; still some
block differs in at most one bit with probability 0.9999, and all that the blocks return is
verified by the exact similarity of shingle bags.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHashes, give_back, map_in_pandas, materialize, mix, shingle_run, ship_package, table

BLOCKS = 28
#: Bits in which two fingerprints may differ to be found for certain.
RADIUS = 2 * BLOCKS - 1
#: Windows whose fingerprints are taken at once.
WINDOWS = 512
#: Shingles whose bits are spread out at once, in windows and items of any length.
PIECE = 4096
#: Items that one broadcast index holds; a larger benchmark is taken in several passes.
ITEMS_AT_ONCE = 20_000
#: Code points of item text that one index holds.
CHARS_AT_ONCE = 20_000_000
#: Equal items can't be dealt apart by their hash; beyond so many parts a part may hold more copies than the bound.
MOST_PASSES = 4096

_WORD = re.compile(r"\w+")


def word_hashes(text: str | None, hashes: dict) -> np.ndarray:
    """Hashes of the words (letters, digits, underscores; lower case) of a whole text."""
    found = _WORD.findall((text or "").lower())
    return np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))


_LANES = np.random.default_rng(4).integers(1, 2**62, BLOCKS // 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_NEIGHBOURS = np.array([0, *(1 << b for b in range(16))], np.uint16)


def signs(x: np.ndarray) -> np.ndarray:
    """Bits of shingles as plus and minus a weight, a row of 16 * BLOCKS each.

    A shingle's weight is one of 8 to 15, by its hash: with equal weights a few shingles often
    sum to 0, all such bits fall on one side, and unrelated items get alike.
    """
    weight = (mix(x) >> np.uint64(61)).astype(np.int8) + np.int8(8)
    return (np.unpackbits(mix(x[:, None] * _LANES).view(np.uint8), axis=1).astype(np.int8) * 2 - 1) * weight[:, None]


def total(x: np.ndarray) -> np.ndarray:
    """Sum of the shingles' bits, PIECE of them at a time."""
    return sum((signs(x[k : k + PIECE]).sum(axis=0, dtype=np.int64) for k in range(0, len(x), PIECE)), np.zeros(16 * BLOCKS, np.int64))


def window_sums(x: np.ndarray, starts: np.ndarray, m: int) -> np.ndarray:
    """Bit sums of the windows of m shingles from each start (in order); only sums between ends of windows are kept."""
    cuts = np.unique(np.concatenate([starts, starts + m]))
    sums = np.zeros((len(cuts), 16 * BLOCKS), np.int32)
    for low in range(int(cuts[0]), int(cuts[-1]), PIECE):
        high = min(low + PIECE, int(cuts[-1]))
        first, end = np.searchsorted(cuts, [low, high], "right")
        running = np.cumsum(signs(x[low:high]), axis=0, dtype=np.int32)
        sums[first:end] += running[cuts[first:end] - low - 1]
        sums[end:] += running[-1]
    return sums[np.searchsorted(cuts, starts + m)] - sums[np.searchsorted(cuts, starts)]


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """Fingerprints, as BLOCKS values of 16 bits each, of rows of bit sums."""
    return np.packbits(sums > 0, axis=1).view(np.uint16)


class Blocks:
    """Multi-index of fingerprints: for each block, the values in order and whose they are."""

    def __init__(self, items: list[int], prints: np.ndarray) -> None:
        self.items = np.array(items)
        order = np.argsort(prints, axis=0, kind="stable")
        self.values, self.owners = np.take_along_axis(prints, order, axis=0).T.copy(), order.T.copy()

    def near(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows of marks, items) that share a block but for one bit, each pair once; all within RADIUS are among them."""
        n = len(self.items)
        found = []
        for k in range(BLOCKS):
            wanted = marks[:, k, None] ^ _NEIGHBOURS
            low, high = np.searchsorted(self.values[k], wanted, "left"), np.searchsorted(self.values[k], wanted, "right")
            hits = (high - low).sum(axis=1)
            if not hits.any():
                continue
            count = (high - low).ravel()
            starts = np.repeat(low.ravel() - np.cumsum(count) + count, count)
            found.append(np.repeat(np.arange(len(marks)), hits) * n + self.owners[k][starts + np.arange(len(starts))])
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pairs = np.unique(np.concatenate(found))
        return pairs // n, self.items[pairs % n]


class Index:
    """Items by shingle, and multi-index Hamming blocks by window size."""

    def __init__(self, items: list[tuple[int, str]], size: int) -> None:
        hashes = WordHashes()
        self.size, self.items, self.bags = size, [], []
        for item, text in items:
            words = word_hashes(text, hashes)
            if len(words):
                n = min(size, len(words))
                self.items.append((item, n, shingle_run(words, n)))
        by_size: dict[tuple[int, int], list[int]] = defaultdict(list)
        sizes_of: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for i, (_, n, x) in enumerate(self.items):
            self.bags.append(Counter(x.tolist()))
            by_size[n, len(x)].append(i)
            for g in self.bags[-1]:
                sizes_of[n][g].add(len(x))
        self.blocks = {k: Blocks(v, np.stack([self.mark(i) for i in v])) for k, v in by_size.items()}
        self.sorted = {n: np.array(sorted(d), np.uint64) for n, d in sizes_of.items()}
        #: windows' sizes that a shingle calls for, by its place in sorted; equal ones are one object
        one: dict[tuple[int, ...], tuple[int, ...]] = {}
        self.sizes = {n: [one.setdefault(t, t) for g in self.sorted[n].tolist() for t in [tuple(sorted(d[g]))]] for n, d in sizes_of.items()}
        self.filters = {}
        for n, x in self.sorted.items():
            seen = np.zeros(1 << 20, bool)
            seen[(x & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.filters[n] = seen

    def mark(self, item: int) -> np.ndarray:
        return fingerprints(total(self.items[item][2])[None])[0]

    def similarity(self, item: int, window: np.ndarray) -> float:
        """Jaccard of shingle bags: a shingle weighs as often as it occurs."""
        a, b = self.bags[item], Counter(window.tolist())
        both = sum(min(n, b[g]) for g, n in a.items() if g in b)
        return both / (a.total() + b.total() - both)

    def search(self, words: np.ndarray, least: float) -> dict[int, tuple[float, int, int]]:
        """item: (similarity, first word, end word) of the most similar window; the first of equals."""
        best: dict[int, tuple[float, int, int]] = {}
        for n, known in self.sorted.items():
            x = shingle_run(words, n)
            maybe = np.flatnonzero(self.filters[n][(x & np.uint64((1 << 20) - 1)).astype(np.int64)])
            if not len(maybe):
                continue
            place = np.minimum(np.searchsorted(known, x[maybe]), len(known) - 1)
            same = known[place] == x[maybe]
            calls: dict[tuple[int, ...], list[int]] = defaultdict(list)
            for p, k in zip(maybe[same].tolist(), place[same].tolist(), strict=True):
                calls[self.sizes[n][k]].append(p)
            places: dict[int, list[int]] = defaultdict(list)
            for sizes, ps in calls.items():
                for m in sizes:
                    places[m] += ps
            for m, ps in places.items():
                m_ = min(m, len(x))  # a text shorter than the item is one window
                starts = window_starts(np.array(sorted(ps)), m_, len(x))
                for first in range(0, len(starts), WINDOWS):
                    some = starts[first : first + WINDOWS]
                    for low, high in stretches(some, m_):
                        part = some[low:high]
                        rows, items = self.blocks[n, m].near(fingerprints(window_sums(x, part, m_)))
                        for w, i in zip(rows.tolist(), items.tolist(), strict=True):
                            s = int(part[w])
                            value = self.similarity(i, x[s : s + m_])
                            if value >= least and (i not in best or (-value, s) < (-best[i][0], best[i][1])):
                                best[i] = (value, s, s + m_ + n - 1)
        return best


def window_starts(places: np.ndarray, m: int, n: int) -> np.ndarray:
    """First shingles of the windows of m of n shingles that hold one of the places (in order)."""
    low, high = np.maximum(0, places - m + 1), np.minimum(places, n - m) + 1
    low[1:] = np.maximum(low[1:], high[:-1])  # each window once
    count = np.maximum(0, high - low)
    return np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())


def stretches(starts: np.ndarray, m: int) -> list[tuple[int, int]]:
    """Windows whose starts lie at most m apart, as (from, to): running sums span no wider gap."""
    cut = np.flatnonzero(np.diff(starts) > m) + 1
    return list(zip([0, *cut.tolist()], [*cut.tolist(), len(starts)], strict=True))


class Items:
    """What a pass broadcasts: items, of which each worker builds the index once."""

    def __init__(self, items: list[tuple[int, str]], words: int) -> None:
        self.items, self.words = items, words

    def index(self) -> Index:
        if "built" not in self.__dict__:
            self.built = Index(self.items, self.words)
        return self.built

    def __getstate__(self) -> dict:
        return {"items": self.items, "words": self.words}


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", words: int = 5, similarity: float = 0.8, items_at_once: int = ITEMS_AT_ONCE, chars_at_once: int = CHARS_AT_ONCE) -> DataFrame:
    """Benchmark items found in documents: (doc_id, item_id, similarity, first_word, end_word).

    A row for each document and item of which some window of the item's size has a
    similarity of `similarity` or more, with the most similar window. Null and empty texts and
    items without a word match nothing; items of fewer than `words` words are one shingle,
    and a text shorter than an item is one window. Repeated rows repeat their matches; an
    empty table on either side gives no rows.

    The index is broadcast only up to items_at_once items and chars_at_once code points;
    beyond, items are dealt into as many passes over the documents as it takes. Each pass is
    written and its broadcast given up before the next begins.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out, parts = None, ItemParts(benchmark, item_col, item_text_col, items_at_once, chars_at_once)
    for p in range(parts.count):
        held = parts.broadcast(p, words)

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            index, hashes = held.value.index(), WordHashes()
            for pdf in batches:
                got = []
                for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                    for i, (value, first, end) in sorted(index.search(word_hashes(text, hashes), similarity).items()):
                        got.append((doc, index.items[i][0], value, first, end))
                yield pd.DataFrame(got, columns=["doc_id", "item_id", "similarity", "first_word", "end_word"]).astype({"item_id": "int64", "similarity": "float64", "first_word": "int64", "end_word": "int64"})

        found = map_in_pandas(named, run, "doc_id long, item_id long, similarity double, first_word long, end_word long")
        if parts.count > 1:
            found = materialize(found)
            held.destroy()
        out = found if out is None else out.unionByName(found)
    return out


class ItemParts:
    """Items dealt by hash into the fewest parts, doubled, of which each is within the bounds.

    Rows without id or text are left out. A single item beyond the bound of code points is a
    part's only large one.
    """

    def __init__(self, benchmark: DataFrame, item_col: str, item_text_col: str, items_at_once: int, chars_at_once: int) -> None:
        self.items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).where("text is not null and item_id is not null")
        self.count = 1
        while True:
            large = self.part().alias("part")
            sizes = self.items.groupBy(large).agg(F.count("*").alias("n"), F.sum(F.least(F.length("text"), F.lit(chars_at_once // 2))).alias("chars"))
            if sizes.where((F.col("n") > items_at_once) | (F.col("chars") > chars_at_once)).isEmpty() or self.count >= MOST_PASSES:
                return
            self.count *= 2

    def part(self) -> Column:
        return F.pmod(F.xxhash64("item_id", "text"), F.lit(self.count))

    def broadcast(self, p: int, words: int) -> Broadcast:
        rows = self.items.where(self.part() == p).collect()
        return self.items.sparkSession.sparkContext.broadcast(Items(sorted((r["item_id"], r["text"]) for r in rows), words))


def clean_rows(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", words: int = 5, similarity: float = 0.8, items_at_once: int = ITEMS_AT_ONCE, chars_at_once: int = CHARS_AT_ONCE) -> DataFrame:
    """docs, with all columns, without the rows that contaminated() finds; no shuffle. Passes as there."""
    ship_package(docs.sparkSession)
    parts = ItemParts(benchmark, item_col, item_text_col, items_at_once, chars_at_once)
    for p in range(parts.count):
        held = parts.broadcast(p, words)
        docs = docs.where(~_leaks(held, similarity)(F.col(text_col)))
        if parts.count > 1:
            docs = materialize(docs)
            held.destroy()
    return docs


def _leaks(held: Broadcast, similarity: float):
    @F.pandas_udf("boolean")
    def leaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, hashes = held.value.index(), WordHashes()
        for texts in batches:
            yield pd.Series([bool(index.search(word_hashes(t, hashes), similarity)) for t in texts], dtype=bool)
            del texts
        hashes.clear()
        give_back()

    return leaks


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
