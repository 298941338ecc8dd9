"""A training corpus from raw documents: five stages, each an operator of odometra.llm.

Every stage takes (spark, docs, sf_dir) and keeps rows whole: extra columns pass through,
names that clash with an operator's own included. Between stages the documents are written
as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odometra.llm import decontam, langid, linedup, mixing, neardup
from odometra.llm.common import discard, materialize, row_key, table, unused_name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: null, empty and letterless texts. The column lang only teaches."""
    learned = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))), id_col="doc_id", text_col="text", lang_col="lang")
    predict = langid.predictor(spark, learned)
    return docs.where(predict(F.col("text"))["lang"] != langid.UNDETERMINED)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of repeated line runs; a document of which no word is left goes. n_chars follows the text."""
    name = unused_name("line_dedup", docs)
    done = linedup.with_deduped(docs, name, id_col="doc_id", text_col="text", min_words=linedup.MIN_WORDS)
    removed, text = F.col(name)["n_removed"] > 0, F.col(name)["text"]
    done = done.where(~removed | text.rlike(r"[^\x20\x09-\x0D]")).withColumn("text", text)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(removed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])


def minhash_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates (five-word shingles, 0.8) the smallest doc_id stays; rows without an id stay."""
    found = neardup.near_duplicates(docs, words=5, percent=80)
    name = unused_name("gone", docs)
    gone = found.where("doc_id != component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontam.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with size, source_size, target and taken as a struct (taken: words, repeats counted).

    It is named mix, or mix_ and so on where documents have that column. Rows repeated in full are joined by one key and each say what the most taken of them says.
    """
    row, name, key = row_key(F.col("doc_id"), F.col("source"), F.col("text")), unused_name("mix", docs), unused_name("mix_row", docs)
    mixed = mixing.mix_sources(docs, row=row).where("taken > 0").groupBy(F.col("row").alias(key)).agg(F.max(F.struct("taken", "size", "source_size", "target")).alias(name))
    return docs.join(mixed, row == F.col(key)).drop(key)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_neardup", minhash_neardup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
]

#: SQL can express neither the language model's predictions nor the sketches; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        following = materialize(stage(spark, docs, sf_dir))
        discard(docs)
        docs = following
    return STAGES[-1][1](spark, docs, sf_dir)
