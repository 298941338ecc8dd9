"""CSV, JSON and Parquet sources with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalar import frame_number


def read_timestamps(spark: SparkSession, path: str) -> DataFrame:
    """(frame_id, ts_ns, filename) of a timestamps CSV; the frame number is in the file name."""
    t = spark.read.schema(schemas.TIMESTAMPS_CSV).csv(path, header=True)
    return t.select(frame_number("filename").alias("frame_id"), F.col("timestamp_ns").alias("ts_ns"), "filename")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest JSON document; missing fields take their defaults."""
    m = spark.read.schema(schemas.MANIFEST).json(path, multiLine=True)
    none = F.create_map().cast("map<string,string>")
    return m.withColumn("version", F.coalesce("version", F.lit("1"))).withColumn("topics", F.coalesce("topics", none)).withColumn("settings", F.coalesce("settings", none)).withColumn("num_rgb_frames", F.coalesce("num_rgb_frames", F.lit(0))).withColumn("num_depth_frames", F.coalesce("num_depth_frames", F.lit(0)))


def read_messages(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    """Messages of a recording kept as Parquet partitioned by topic; one topic reads its partition only."""
    m = spark.read.parquet(path)
    return m if topic is None else m.where(F.col("topic") == topic)


def topic_list(messages: DataFrame) -> DataFrame:
    return messages.groupBy("topic").agg(F.first("msgtype").alias("msgtype"), F.count("*").alias("msgcount"), F.min("ts_ns").alias("start_ns"), F.max("ts_ns").alias("end_ns"))
