"""Token counts by count-only Viterbi over a unigram vocabulary (operator 3).

An Aho-Corasick automaton lists every vocabulary piece that ends at each place of a word;
dynamic programming carries the best score and its piece count from left to right. Words
are what the Metaspace rule splits a text into (spaces become U+2581, one is put in front,
and a piece never spans two words), so equal words have equal counts: each worker remembers
counts of words, in a table of fixed size. Tie rule of the unigram model: among equal scores
the piece that starts first stays. Pieces match by type: normal ones at their score, those the
user defined at the highest score for each of their bytes less 0.1, others never. A character that no single-character piece covers may be
taken as unknown at the lowest normal score less 10, and counts as one piece for each UTF-8 byte
(byte fallback) or, without byte pieces, one for a run of unknowns.
"""

from __future__ import annotations

import math
import struct
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_in_pandas, table

#: Vocabulary file, a parameter; read by each worker, never copied here.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBER = 200_000
NORMAL, USER_DEFINED = 1, 4


def _fields(data: bytes) -> Iterator[tuple[int, int, object]]:
    """Fields of a protobuf message: (number, wire type, value)."""

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = data[i]
            value |= (b & 127) << shift
            i, shift = i + 1, shift + 7
            if b < 128:
                return value, i

    i = 0
    while i < len(data):
        key, i = varint(i)
        number, wire = key >> 3, key & 7
        if wire == 0:
            value, i = varint(i)
        elif wire == 2:
            n, i = varint(i)
            value, i = data[i : i + n], i + n
        elif wire == 5:
            value, i = struct.unpack("<f", data[i : i + 4])[0], i + 4
        else:
            value, i = struct.unpack("<d", data[i : i + 8])[0], i + 8
        yield number, wire, value


def read_vocabulary(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, type) of a sentencepiece model file, in order of id."""
    out = []
    with open(path, "rb") as f:
        for number, _, value in _fields(f.read()):
            if number == 1:
                got = {n: v for n, _, v in _fields(value)}
                out.append((got.get(1, b"").decode("utf-8"), got.get(2, 0.0), got.get(3, NORMAL)))
    return out


class UnigramCounter:
    """Piece counts of texts; vocabulary: (piece, score, type)."""

    def __init__(self, vocabulary: list[tuple[str, float, int]]) -> None:
        names = {p for p, _, _ in vocabulary}
        # control, byte and unused pieces never match text; lowest and highest score are those of normal pieces
        normal = [s for _, s, kind in vocabulary if kind == NORMAL]
        self.unknown = min(normal, default=0.0) - UNKNOWN_PENALTY
        top = max(normal, default=0.0)
        scores = {p: s for p, s, kind in vocabulary if kind == NORMAL}
        scores |= {p: len(p.encode("utf-8")) * top - 0.1 for p, _, kind in vocabulary if kind == USER_DEFINED}
        self.bytes = all(f"<0x{b:02X}>" in names for b in range(256))
        self.seen: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()

    def word(self, word: str) -> int:
        """Pieces of the best-scored cut of one word.

        Matches come by their end, the longest first: the earliest start keeps a tie.
        """
        n = len(word)
        best, count, unknown = [0.0] + [-math.inf] * n, [0] * (n + 1), [False] * (n + 1)

        def take_unknown(at: int) -> None:
            s = best[at] + self.unknown
            if s > best[at + 1]:
                more = len(word[at].encode("utf-8", "surrogatepass")) if self.bytes else not unknown[at]
                best[at + 1], count[at + 1], unknown[at + 1] = s, count[at] + more, True

        done, single = -1, True
        for last, (size, score) in self.automaton.iter(word):
            if last != done:
                if not single:
                    take_unknown(done)
                for at in range(done + 1, last):
                    take_unknown(at)
                done, single = last, False
            if size == 1:
                single = True
            start = last + 1 - size
            s = best[start] + score
            if s > best[last + 1]:
                best[last + 1], count[last + 1] = s, count[start] + 1
        if not single:
            take_unknown(done)
        for at in range(done + 1, n):
            take_unknown(at)
        return count[n]

    def words(self, text: str) -> list[str]:
        """A space begins a word; so does the text itself."""
        if not text:
            return []
        text = text.replace(" ", SPACE)
        if text[0] != SPACE:
            text = SPACE + text
        return [SPACE + w for w in text[1:].split(SPACE)]

    def count(self, text: str) -> int:
        total = 0
        for word, n in Counter(self.words(text)).items():
            pieces = self.seen.get(word)
            if pieces is None:
                if len(self.seen) >= REMEMBER:
                    self.seen.clear()
                pieces = self.word(word)
                if len(word) <= 64:
                    self.seen[word] = pieces
            total += n * pieces
        return total


@lru_cache(maxsize=2)
def counter_of(path: str) -> UnigramCounter:
    return UnigramCounter(read_vocabulary(path))


def count_tokens(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_chars, n_tokens) of every whole text, a row per input row.

    Null and empty texts have no tokens. No shuffle; the file must be at the same path on
    every worker. Memory is bounded by the longest text and the table of remembered words.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = counter_of(vocabulary)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_chars": [len(t or "") for t in pdf["text"]], "n_tokens": [counter.count(t or "") for t in pdf["text"]]})

    return map_in_pandas(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, n_chars long, n_tokens long")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
