"""Line dedup by prefix doubling over line-ID sequences (operator 9).

Every line is a position in its document's sequence of line IDs. Prefix doubling ranks, at
level k, the 2^k lines that begin at a position: the rank at level k + 1 is made of the two
ranks at level k that lie 2^k apart. Positions of equal rank at a level are one interval of
the suffix array whose longest common prefix is 2^k lines or more, so intervals are the
groups of equal rank, and the order between different intervals, which nothing here reads,
is that of 128-bit hashes. Positions whose rank occurs once leave: nothing that begins with
an unrepeated run repeats.

A run counts from `min_words` words. The shortest such run from a position forward, and the
one backward, have a length fixed by their own lines, so equal runs have equal lengths and
are found by two overlapping ranks of one level, and doubling stops at the longest of them.
That loses nothing: of a later copy of any repeated run, a line outside the first copy lies in
a shortest run, which occurs wherever the longer one does, and outside the first copy of that
one too. So what the intervals of all depths delete is what those of the shortest runs delete.
The tests hold this against a suffix array with its longest common prefixes and all intervals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, row_key, table, unused_name

#: Words that a run of lines needs to count as a passage.
MIN_WORDS = 50


def _name(*parts: Column) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def _repeated(ranks: DataFrame) -> DataFrame:
    """Positions whose rank occurs twice or more."""
    twice = materialize(ranks.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2"))
    return ranks.join(twice, ["h1", "h2"], "left_semi")


def line_table(docs: DataFrame) -> DataFrame:
    """(row, doc_id, line, h1, h2, words) of (row, doc_id, text): lines with a word, numbered among themselves; at is the place in the text."""
    split = docs.where(F.col("text").isNotNull()).select("row", "doc_id", F.posexplode(F.split("text", "\n")).alias("at", "text"))
    trimmed = F.trim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    lines = split.select("row", "doc_id", "at", trimmed.alias("text")).where("text != ''")
    h1, h2 = _name(F.col("text"))
    return lines.select("row", "doc_id", "at", h1.alias("h1"), h2.alias("h2"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))


def repeated_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """(row, at) of the lines to delete."""
    by_doc = Window.partitionBy("row").orderBy("at")
    lines = materialize(line_table(docs))
    # written, so that the join can split a line that a third of all rows hold
    again = materialize(lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2", F.lit(1).alias("again")))
    # only stretches of repeated lines can hold a repeated run; a stretch ends at a line that occurs once
    marked = (
        lines.join(again, ["h1", "h2"], "left")
        .withColumn("line", F.dense_rank().over(by_doc))
        .withColumn("stretch", F.sum(F.when(F.col("again").isNull(), 1).otherwise(0)).over(by_doc))
        .withColumn("seen", F.lag("at").over(by_doc).eqNullSafe(F.col("at")))  # of a row that repeats in full
        .where("again = 1 and not seen")
    )
    stretch = Window.partitionBy("row", "stretch")
    level = materialize(
        marked.withColumn("total", F.sum("words").over(stretch))
        .withColumn("upto", F.sum("words").over(stretch.orderBy("line")))
        .where(F.col("total") >= min_words)
        .select("row", "doc_id", "at", "line", "stretch", "h1", "h2", (F.col("upto") - F.col("words")).alias("before"), "upto")
    )

    # the shortest run of min_words or more from each line, forward to the first line whose running
    # sum is far enough, and backward likewise; ends (kind 0) and begins (kind 1) are merged by sum
    def merged(end_key: Column, begin_key: Column) -> DataFrame:
        return level.select("row", "doc_id", "stretch", "line", F.lit(0).alias("kind"), end_key.alias("key")).unionByName(level.select("row", "doc_id", "stretch", "line", F.lit(1).alias("kind"), begin_key.alias("key")))

    down = stretch.orderBy(F.col("key").desc(), "kind", F.col("line").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    forward = merged(F.col("upto"), F.col("before") + min_words).withColumn("end", F.last(F.when(F.col("kind") == 0, F.col("line")), ignorenulls=True).over(down))
    up = stretch.orderBy("key", F.col("kind").desc(), "line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    backward = merged(F.col("upto") - min_words, F.col("before")).withColumn("begin", F.last(F.when(F.col("kind") == 1, F.col("line")), ignorenulls=True).over(up))
    runs = forward.where("kind = 1 and end is not null").select("row", "doc_id", F.col("line").alias("begin"), "end").unionByName(backward.where("kind = 0 and begin is not null").select("row", "doc_id", "begin", F.col("line").alias("end")))
    runs = materialize(runs.distinct().withColumn("length", (F.col("end") - F.col("begin") + 1).cast("int")))

    longest = runs.agg(F.max("length")).first()[0] or 0
    ranks, spans, k = level.select("row", "line", "h1", "h2"), None, 0
    while longest >= 2**k:
        mine = runs.where((F.col("length") >= 2**k) & (F.col("length") < 2 ** (k + 1)))
        head = ranks.select("row", F.col("line").alias("begin"), F.col("h1").alias("a1"), F.col("h2").alias("a2"))
        tail = ranks.select("row", (F.col("line") + 2**k - 1).alias("end"), F.col("h1").alias("b1"), F.col("h2").alias("b2"))
        h1, h2 = _name(F.col("length"), F.col("a1"), F.col("a2"), F.col("b1"), F.col("b2"))
        named = mine.join(head, ["row", "begin"]).join(tail, ["row", "end"]).select("row", "doc_id", "begin", "end", h1.alias("h1"), h2.alias("h2"))
        spans = named if spans is None else spans.unionByName(named)
        if longest >= 2 ** (k + 1):
            next_half = ranks.select("row", (F.col("line") - 2**k).alias("line"), F.col("h1").alias("n1"), F.col("h2").alias("n2"))
            h1, h2 = _name(F.col("h1"), F.col("h2"), F.col("n1"), F.col("n2"))
            ranks = _repeated(materialize(ranks.join(next_half, ["row", "line"]).select("row", "line", h1.alias("h1"), h2.alias("h2"))))
        k += 1
    if spans is None:
        return level.select("row", "at").limit(0)
    spans = materialize(spans)
    order = F.struct("doc_id", "row", "begin")
    first = materialize(spans.groupBy("h1", "h2").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1"))
    later = spans.join(first, ["h1", "h2"]).where(order > F.col("first"))
    # of a copy that overlaps the first one, the lines of the first stay
    begin = F.when(F.col("row") == F.col("first.row"), F.greatest("begin", F.col("first.begin") + F.col("end") - F.col("begin") + 1)).otherwise(F.col("begin"))
    dead = later.select("row", begin.alias("begin"), "end").distinct().select("row", F.explode(F.sequence("begin", "end")).alias("line")).distinct()
    return level.join(dead, ["row", "line"], "left_semi").select("row", "at")


def with_deduped(docs: DataFrame, out: str, *, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """docs, with all columns, and out: struct(text, n_lines, n_removed)."""
    row = row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    dead_row, dead_at = unused_name("dead_row", docs), unused_name("dead_at", docs)
    dead = repeated_lines(docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), min_words)
    dead = dead.groupBy(F.col("row").alias(dead_row)).agg(F.collect_set("at").alias(dead_at))
    joined = docs.join(dead, row == F.col(dead_row), "left")
    text, gone = F.col(f"`{text_col}`"), F.col(dead_at)
    lines = F.split(text, "\n")
    alive = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    left = F.array_join(F.transform(alive, lambda i: F.get(lines, i)), "\n")
    result = F.struct(
        F.when(gone.isNull(), text).otherwise(left).alias("text"),
        F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_removed"),
    )
    return joined.withColumn(out, result).drop(dead_row, dead_at)


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Texts without later copies of repeated line runs: (doc_id, text, n_lines, n_removed).

    A run of whole lines with min_words words or more in all that occurs again, in the same
    document or another, stays where it is first by (doc_id, text hash, line) and goes
    elsewhere; lines of that first copy stay even where a later copy overlaps it. Lines are equal after trimming ASCII white space; lines without a word never
    break or count in a run and stay. Null text stays null with 0 lines; rows repeated in
    full are one document and keep the same lines; an empty table gives no rows.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_deduped(named, "out", id_col="doc_id", text_col="text", min_words=min_words).select("doc_id", "out.text", "out.n_lines", "out.n_removed")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))
