"""Exact dedup by progressive refinement (operator 8, DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, table

#: Code points that the second step hashes.
PREFIX = 256


def copy_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX) -> DataFrame:
    """Groups of two or more equal texts (A-Z lower-cased): (text_sha256, keep_id, group_size).

    Three steps, each on the survivors of the one before: rows of a shared length; of these,
    rows of a shared hash of the first `prefix` code points too; and only of these the hash
    of the whole text. Counts and the largest id are combined before each shuffle, so a group
    with a third of all rows reaches a task as one row per partition.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.length(text).alias("len"))
    same_length = materialize(rows.groupBy("len").agg(F.count("*").alias("n")).where("n > 1").select("len"))
    rows = rows.join(same_length, "len", "left_semi")
    headed = rows.withColumn("head", F.xxhash64(ascii_lower(F.substring("text", 1, prefix))))
    same_head = materialize(headed.groupBy("len", "head").agg(F.count("*").alias("n")).where("n > 1").select("len", "head"))
    rest = headed.join(same_head, ["len", "head"], "left_semi")
    full = F.sha2(ascii_lower(F.col("text")).cast("binary"), 256).alias("text_sha256")
    return rest.groupBy("len", "head", full).agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1").select("text_sha256", "keep_id", "group_size")


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX) -> DataFrame:
    """One row per input row: (doc_id, keep_id, group_size, kept, text_sha256).

    Null text equals empty text. Of equal texts the largest id stays; rows that repeat an
    id as well all count in group_size and all say kept. Null ids never stay unless a whole
    group has none; then keep_id is null and kept is true. An empty table gives no rows.
    text_sha256 is a column of the result, so it is hashed for every row here; what is equal
    is decided by copy_groups alone.
    """
    groups = copy_groups(docs, id_col=id_col, text_col=text_col, prefix=prefix).withColumnRenamed("text_sha256", "group_sha256")
    hashed = docs.select(F.col(id_col).alias("doc_id"), F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).cast("binary"), 256).alias("text_sha256"))
    out = hashed.join(groups, F.col("text_sha256") == F.col("group_sha256"), "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
