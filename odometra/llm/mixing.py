"""Mixing sources to target weights (operator 7, DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, table


def source_targets(sizes: DataFrame, total: Column, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """Targets by water level: (source, source_size, n, target).

    Sources by code point, null last, weigh weights in turn and share the total; a
    target stops at max_epochs times its source, and what is over is shared anew by
    weight. In order of cap per weight those that stop are a prefix, so two running sums
    replace the rounds. One row a source: the only windows that see every source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    s = sizes.withColumn("w", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    full = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before, whole = full.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    s = (
        s.withColumn("total", total)
        .withColumn("num", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("den", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn("stops", F.col("cap") * F.col("den") <= F.col("num") * F.col("w"))
    )
    s = s.withColumn("num", F.col("total") - F.coalesce(F.sum(F.when(F.col("stops"), F.col("cap"))).over(whole), F.lit(0))).withColumn("den", F.sum(F.when(~F.col("stops"), F.col("w"))).over(whole))
    return s.select("source", "source_size", "n", F.when(F.col("stops"), F.col("cap").cast("double")).otherwise((F.col("w") * F.col("num")) / F.col("den")).alias("target"))


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, row: Column | None = None) -> DataFrame:
    """Words to take of every document so that sources meet their weights.

    Each document gets a hash-random key (MD5 of its id). Within a source, documents are
    range-sorted by key into about sqrt(n) ranges; running sums over ranges and inside a
    range give each document's place, and the source is cut at its exact budget: whole
    epochs first, then documents in key order until the words are used up, the document
    at the cut in part. No range grows beyond about sqrt(n) rows, so a source with a
    third of all rows is spread over many tasks.

    Returns (doc_id, source, size, source_size, target, taken), a row per input row, and
    row, where a key of the input row is given, to join by.
    Null text has size 0 and is never taken; a null source is one source, the last;
    equal ids are ordered by size; an empty table gives an empty result; reruns agree.
    """
    sized = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("key"),
            *([] if row is None else [row.alias("row")]),
        )
    )
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    targets = source_targets(per_source, F.sum("source_size").over(Window.partitionBy()), weights, max_epochs)
    plan = materialize(
        targets.withColumn("budget", F.floor(F.col("target") + 0.5))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
        .withColumn("ranges", F.ceil(F.sqrt("n")).cast("long"))
        .withColumnRenamed("source", "plan_source")
    )
    placed = sized.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).withColumn("range", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("ranges") / F.lit(2.0**32)))
    per_range = placed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    starts = per_range.select(
        F.col("source").alias("start_source"),
        F.col("range").alias("start_range"),
        F.coalesce(F.sum("range_size").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
    )
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = local.join(starts, F.col("source").eqNullSafe(F.col("start_source")) & (F.col("range") == F.col("start_range")))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("start") - F.col("local")))
    return joined.select("doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"), *([] if row is None else ["row"]))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, source_size * 3 AS cap,
             sum(source_size) OVER () AS total FROM s),
l AS (SELECT *, total - coalesce(sum(cap) OVER b, 0) AS num, sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS den FROM w
      WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
p AS (SELECT *, cap * den <= num * w AS stops FROM l),
q AS (SELECT source, source_size,
             CASE WHEN stops THEN cap::DOUBLE
                  ELSE (w * (total - coalesce(sum(CASE WHEN stops THEN cap END) OVER (), 0)))::DOUBLE
                       / (sum(CASE WHEN NOT stops THEN w END) OVER ())::DOUBLE END AS target FROM p),
r AS (SELECT *, floor(target + 0.5)::BIGINT AS budget,
             CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS epochs FROM q),
c AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT c.doc_id, c.size, r.source_size, r.target,
       (r.epochs * c.size + greatest(0, least(c.size, r.budget - r.epochs * r.source_size - c.before)))::BIGINT AS taken
FROM c JOIN r ON c.source IS NOT DISTINCT FROM r.source
"""
