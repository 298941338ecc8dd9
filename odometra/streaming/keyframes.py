"""Keyframe selection: a fold over time that remembers the last selected row, on streams and on tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..checkpoints import shared_dir
from ..shipping import ship_package


@dataclass(frozen=True)
class Rule:
    """Select the first row, a row without enough features, one `max_gap` rows after the last selected, or one unlike it."""

    min_similarity: float = 0.75
    max_gap: int = 30
    min_features: int = 1

    def select(self, vector: np.ndarray, last: np.ndarray | None, gap: int) -> bool:
        if last is None or not len(last) or np.count_nonzero(vector) < self.min_features or gap >= self.max_gap:
            return True
        size = float(np.linalg.norm(vector) * np.linalg.norm(last))
        return size == 0 or float(vector @ last) / size < self.min_similarity


@dataclass
class Series:
    """Where a fold stands: the last selected vector, the rows since, and the time of the last row."""

    last: np.ndarray | None = None
    gap: int = 0
    time: int | None = None

    def take(self, vector, time: int | None, rule: Rule, idle: int | None) -> bool:
        """Whether the next row is selected. More than `idle` after the row before, the series begins anew."""
        if idle is not None and self.time is not None and time - self.time > idle:
            self.last, self.gap = None, 0
        v = np.zeros(0) if vector is None else np.asarray(vector, float)
        self.time, self.gap = time, self.gap + 1
        if chosen := rule.select(v, self.last, self.gap):
            self.last, self.gap = v, 0
        return chosen


#: Microseconds since 1970 of a row's event time, whatever the session's time zone.
_MICROS = "__us"


def select_keyframes(rows: DataFrame, *, by: Sequence[str], order: str | Sequence[str], vector: str, rule: Rule = Rule(), time: str | None = None, idle: float | None = None) -> DataFrame:
    """Selected rows of each group's series, all columns. A series is one group: the fold needs its order.

    With idle, a row whose time is more than so many seconds after the row before begins the
    series anew. Null vectors have no features.
    """
    ship_package(rows.sparkSession)
    keys, schema = [order] if isinstance(order, str) else list(order), rows.schema
    limit = None if idle is None else round(idle * 1e6)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, series = pdf.sort_values(keys, kind="stable"), Series()
        times = pdf[_MICROS] if limit is not None else [None] * len(pdf)
        return pdf[[series.take(v, t, rule, limit) for v, t in zip(pdf[vector], times, strict=True)]][schema.names]

    return (rows if limit is None else rows.withColumn(_MICROS, F.unix_micros(time))).groupBy(*by).applyInPandas(run, schema)


class KeyframeProcessor(StatefulProcessor):
    """Rows wait in state until the watermark has passed them, and are then folded in the order of their time.

    State of a key: waiting rows (list, an entry per batch of rows as one Arrow stream, so that
    rows aren't written and read one by one), and where its fold stands (value). A timer is set at
    the first waiting row; when it fires, all rows up to the watermark are folded, and the
    next timer is set. With nothing waiting and the watermark more than idle behind the last
    row, the key's state is cleared.
    """

    def __init__(self, schema: T.StructType, order: Sequence[str], vector: str, rule: Rule, idle: int) -> None:
        self.schema, self.order, self.vector, self.rule, self.idle = schema, list(order), vector, rule, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", T.StructType([T.StructField("rows", T.BinaryType())]))
        self.series = handle.getValueState("series", T.StructType([T.StructField("last", T.ArrayType(T.DoubleType())), T.StructField("gap", T.LongType()), T.StructField("time", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for pdf in rows:
            if len(pdf):
                pdf.columns = self.schema.names  # on the way here some names are replaced
                self.waiting.appendValue((_packed(pdf),))
                first = int(pdf[_MICROS].min()) if first is None else min(first, int(pdf[_MICROS].min()))
        if first is not None:
            self._wake(first)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = _unpacked([bytes(r[0]) for r in self.waiting.get()], self.schema.names)
        ready = rows[rows[_MICROS] <= passed].sort_values([_MICROS, *self.order], kind="stable")
        later = rows[rows[_MICROS] > passed]
        series = Series()
        if (held := self.series.get()) is not None:
            last, gap, time = held
            series = Series(np.asarray(last, float), gap, time)
        chosen = [series.take(v, int(t), self.rule, self.idle) for v, t in zip(ready[self.vector], ready[_MICROS], strict=True)]
        if len(later):
            self.waiting.put([(_packed(later),)])
            self._wake(int(later[_MICROS].min()))
        elif len(ready):
            self.waiting.clear()
        if not len(later) and (series.time is None or series.time + self.idle < passed):
            self.series.clear()
        elif series.time is not None:
            self.series.update(([float(x) for x in series.last], series.gap, series.time))
            self._wake(series.time + self.idle + 1000)
        if any(chosen):
            yield ready[chosen].drop(columns=[_MICROS]).reset_index(drop=True)

    def _wake(self, micros: int) -> None:
        self.handle.registerTimer(-(-micros // 1000))

    def close(self) -> None:
        return


def _packed(rows: pd.DataFrame) -> bytes:
    """Rows as one value of the state."""
    table, out = pa.Table.from_pandas(rows, preserve_index=False).replace_schema_metadata(), pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as stream:
        stream.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(parts: list[bytes], names: Sequence[str]) -> pd.DataFrame:
    tables = [pa.ipc.open_stream(p).read_all() for p in parts]
    return pa.concat_tables(tables, promote_options="permissive").to_pandas() if tables else pd.DataFrame(columns=list(names))


#: The state store that list states and timers need.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_keyframes(rows: DataFrame, *, by: Sequence[str], time: str, vector: str, order: Sequence[str] = (), rule: Rule = Rule(), lateness: str = "10 seconds", idle: float = 3600.0) -> DataFrame:
    """select_keyframes on a stream, in event time: rows may come in any order within `lateness`.

    The result is that of the table of all rows that aren't late, up to the watermark, in the
    order of time and then of the columns `order`; rows later than the watermark are dropped,
    as are rows without a time. State is dropped `idle` seconds of event time after a key's
    last row, where the series ends by definition. Sets the session's state store to RocksDB.
    """
    spark = rows.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    timed = rows.where(F.col(time).isNotNull()).withColumn(_MICROS, F.unix_micros(time)).withWatermark(time, lateness)
    processor = KeyframeProcessor(timed.schema, order, vector, rule, round(idle * 1e6))
    return timed.groupBy(*by).transformWithStateInPandas(processor, rows.schema, "Append", "EventTime")


def finished(stream: DataFrame) -> DataFrame:
    """What a stream in append mode gives for all input that is there now, as a table in the shared folder."""
    spark = stream.sparkSession
    path = f"{shared_dir(spark)}/odometra-{uuid.uuid4().hex}"
    query = stream.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def stream_nearest_asof(left: DataFrame, right: DataFrame, *, left_ts: str, right_ts: str, key: Sequence[str], id_col: str, tolerance: str, lateness: str) -> DataFrame:
    """Nearest right time within tolerance of each left row, as a stream-stream outer join.

    Both sides carry watermarks, so state is dropped once no row within tolerance can come;
    a left row without a match is emitted with null then.
    """
    lt = left.withWatermark(left_ts, lateness)
    rt = right.select(*[F.col(k).alias(f"__{k}") for k in key], F.col(right_ts).alias("__ts")).withWatermark("__ts", lateness)
    near = (F.col("__ts") >= F.col(left_ts) - F.expr(f"INTERVAL {tolerance}")) & (F.col("__ts") <= F.col(left_ts) + F.expr(f"INTERVAL {tolerance}"))
    for k in key:
        near = near & (F.col(k) == F.col(f"__{k}"))
    joined = lt.join(rt, near, "leftOuter")
    gap = F.abs(F.unix_micros("__ts") - F.unix_micros(left_ts))
    return joined.groupBy(*key, id_col, left_ts).agg(F.min(F.when(F.col("__ts").isNotNull(), F.struct(gap.alias("delta_us"), F.col("__ts").alias("matched")))).alias("best")).select(*key, id_col, left_ts, "best.matched", "best.delta_us")
