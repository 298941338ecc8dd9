"""Driver tables seen as the operators' domain tables, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries and their SQL by name."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def put(query: Query) -> Query:
            self.queries[name] = query
            if sql:
                self.oracles[name] = sql
            return query

        return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(column):
    """Published figures have six decimals: sums of doubles depend on their order."""
    return F.round(column, 6)


def micros(ts: str):
    """Microseconds since 1970 of a timestamp without time zone, whatever the session's zone."""
    second = F.expr(f"extract(SECOND FROM {ts})")
    return (F.unix_date(F.to_date(ts)).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60) * 1_000_000 + (second * 1_000_000).cast("long")


def trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trajectory per user: an event is a pose, its place made of value and id."""
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    return e.select(
        F.col("user_id").alias("traj_id"),
        i.alias("frame_id"),
        (F.col("value") / 10).alias("x"),
        (((i * 37) % 101) / 10).alias("y"),
        (((i * 53) % 89) / 10).alias("z"),
        (micros("ts") * 1000).alias("ts_ns"),
    )


TRAJ = """traj AS (SELECT user_id AS traj_id, event_id AS frame_id, value / 10 AS x, ((event_id * 37) % 101) / 10 AS y,
  ((event_id * 53) % 89) / 10 AS z, epoch_us(ts) * 1000 AS ts_ns FROM events)"""

STEPS = (
    TRAJ
    + """, st AS (SELECT *, row_number() OVER w - 1 AS idx, (ts_ns - lag(ts_ns) OVER w) / 1e9 AS dt,
  sqrt((x - lag(x) OVER w)^2 + (y - lag(y) OVER w)^2 + (z - lag(z) OVER w)^2) AS step FROM traj WINDOW w AS (PARTITION BY traj_id ORDER BY ts_ns)),
sp AS (SELECT *, CASE WHEN dt > 0 THEN step / dt END AS speed FROM st)"""
)


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points seen by images: an order is a point, a supplier an image; both ids once."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("point_id"), F.col("l_suppkey").alias("image_id")).distinct()


TRACKS = "tracks AS (SELECT DISTINCT l_orderkey AS point_id, l_suppkey AS image_id FROM lineitem)"
