"""Language identification by cross-parsing against suffix automata (operator 5).

A bounded sample of labelled documents per language, as running text, becomes a suffix
automaton. A text is parsed against each language from left to right, across words: each
phrase is the longest match with the labelled text. Fewer phrases, normalised by log2 of
the labelled length and the text's length, mean a lower cross-entropy; the language with
the fewest wins. What is parsed is lower case, with one blank for whatever stands between
two runs of letters.
"""

from __future__ import annotations

import gc
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, map_in_pandas, ship_package, table

#: Bounds of the labelled rows that are learned, per language: documents, taken whole, and their code points.
SAMPLE_DOCS, SAMPLE_CHARS = 96, 20_000
UNDETERMINED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


class SuffixAutomaton:
    """Of one text; a state is the dictionary of its steps, from characters to states."""

    def __init__(self, text: str) -> None:
        self.root: dict[str, dict] = {}
        states, link, size, last = [self.root], [-1], [0], 0
        number = {id(self.root): 0}

        def new(steps: dict, length: int, suffix: int) -> int:
            states.append(steps)
            size.append(length)
            link.append(suffix)
            number[id(steps)] = len(states) - 1
            return len(states) - 1

        for c in text:
            cur = new({}, size[last] + 1, 0)
            p = last
            while p >= 0 and c not in states[p]:
                states[p][c] = states[cur]
                p = link[p]
            if p >= 0:
                q = number[id(states[p][c])]
                if size[p] + 1 == size[q]:
                    link[cur] = q
                else:
                    copy = new(dict(states[q]), size[p] + 1, link[q])
                    link[q] = link[cur] = copy
                    old = states[q]
                    while p >= 0 and states[p].get(c) is old:
                        states[p][c] = states[copy]
                        p = link[p]
            last = cur

    def phrases(self, text: str) -> int:
        """Phrases of the cross-parsing; an unseen character is one of its own."""
        root = at = self.root
        n = 0
        for c in text:
            to = at.get(c)
            if to is None:
                if at is not root:  # the phrase ends before c
                    n += 1
                    to = root.get(c)
                if to is None:
                    n += 1
                    at = root
                    continue
            at = to
        return n + (at is not root)


def running(text: str) -> str:
    """Runs of letters in lower case with a blank around each; empty without letters."""
    found = _LETTERS.findall(text.lower())
    return f" {' '.join(found)} " if found else ""


class Identifier:
    """learned: (language, labelled running text), from the most to the fewest labelled rows."""

    def __init__(self, learned: tuple[tuple[str, str], ...]) -> None:
        self.languages = [k for k, _ in learned]
        self.automata = [SuffixAutomaton(t) for _, t in learned]
        self.scale = [math.log2(len(t) + 1) for _, t in learned]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: how much longer the second best parse is, from 0.5 (as long) to 1; 0 for und."""
        said = running(text or "")
        if not said or not self.languages:
            return UNDETERMINED, 0.0
        costs = sorted((a.phrases(said) * s, k) for k, (a, s) in enumerate(zip(self.automata, self.scale, strict=True)))
        best, second = costs[0], costs[1] if len(costs) > 1 else (math.inf, 0)
        return self.languages[best[1]], 1.0 if second[0] == math.inf else second[0] / (best[0] + second[0])


@lru_cache(maxsize=1)
def identifier_of(learned: tuple[tuple[str, str], ...]) -> Identifier:
    found = Identifier(learned)
    gc.freeze()  # its many states are never garbage
    return found


def learn(rows: DataFrame, *, id_col: str, text_col: str, lang_col: str, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> tuple[tuple[str, str], ...]:
    """Labelled text per language, of a sample by hash of the id; rows without label or text teach nothing.

    Every language is learned, from whole documents in the order of the hash: at most
    sample_docs of them, and as many as sample_chars code points hold. A language all of
    whose documents are longer is learned from its shortest one.
    """
    usable = rows.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(F.col("lang").isNotNull() & F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    fits = F.length("text") <= sample_chars
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(fits).alias("fit"), F.min(F.when(~fits, F.length("text"))).alias("shortest")).orderBy(F.col("n").desc(), "lang").collect()
    if not sizes:
        return ()
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, 1.5 * sample_docs / r["fit"]) if r["fit"] else 0.0)])
    place: Column = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 30)) / float(1 << 30)
    placed = usable.withColumn("place", place)
    drawn = placed.where(fits & (F.col("place") < share[F.col("lang")])).select("lang", "place", "text")
    sample: dict[str, list[tuple[float, str]]] = {}
    for r in drawn.orderBy("place", "text").limit(2 * sample_docs * len(sizes)).collect():
        sample.setdefault(r["lang"], []).append((r["place"], r["text"]))
    if alone := [r for r in sizes if r["lang"] not in sample]:  # no document of theirs fits, or the draw took none
        best = F.create_map(*[F.lit(x) for r in alone for x in (r["lang"], r["shortest"] if not r["fit"] else -1)])
        wanted = placed.where(F.col("lang").isin([r["lang"] for r in alone])).where(fits | (F.length("text") == best[F.col("lang")]))
        for r in wanted.groupBy("lang").agg(F.min(F.struct("place", "text")).alias("x")).collect():
            sample[r["lang"]] = [(r["x"]["place"], r["x"]["text"])]
    learned = []
    for lang in (r["lang"] for r in sizes):
        taken, chars = [], 0
        for _, text in sorted(sample[lang])[:sample_docs]:
            if not taken or chars + len(text) <= sample_chars:
                taken.append(running(text).strip())
                chars += len(text)
        if said := " ".join(filter(None, taken)):
            learned.append((lang, f" {said} "))
    return tuple(learned)


def identify(docs: DataFrame, learned: tuple[tuple[str, str], ...], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text, a row per input row; no shuffle.

    und with score 0 for null, empty and letterless texts, or if nothing was learned. Equal
    costs go to the language with the most labelled rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        who = identifier_of(held.value)
        for pdf in batches:
            got = [who.predict(t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "lang_pred": [x for x, _ in got], "score": [s for _, s in got]})

    return map_in_pandas(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, lang_pred string, score double")


def predictor(spark: SparkSession, learned: tuple[tuple[str, str], ...]):
    """A function of a text column that gives struct(lang, score), for use where rows keep their columns."""
    ship_package(spark)
    held = spark.sparkContext.broadcast(learned)

    @F.pandas_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        who = identifier_of(held.value)
        for texts in batches:
            yield pd.DataFrame([who.predict(t) for t in texts], columns=["lang", "score"])
            del texts
        give_back()

    return predict


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = learn(docs.where(~held_out(F.col("doc_id"))), id_col="doc_id", text_col="text", lang_col="lang")
    return identify(docs, learned).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
