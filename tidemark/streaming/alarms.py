"""Alarms for consumers that stop reading: raised after a time without progress, cleared by the next progress.

The clock is the stream's event time, so that a consumer's silence shows by what the others read. A consumer's state
is the stretches of its progress that are still in question, each without a pause longer than the limit; a timer fires
when the watermark passes the end of such a pause, or the progress that ends it. Nothing is decided before the
watermark has passed it, so rows that arrive out of order, by up to ``delay``, do not change what is told, and the
state of a consumer is a few stretches whatever its rate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.session import require_utc
from tidemark.streaming.exact import _PROVIDER, ROCKSDB

RAISED, CLEARED = "raised", "cleared"
_TOLD = "consumer string, kind string, last_progress long, at long"


def stretches(low: np.ndarray, high: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Intervals merged wherever the pause between them is no longer than ``limit``, in order."""
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    first = np.ones(len(low), bool)
    first[1:] = low[1:] - high[:-1] > limit
    return low[first], high[np.append(first[1:], True)]


def _folded(limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A consumer's stretches in each Arrow batch instead of its rows, so that a busy one does not travel."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pd.DataFrame({"consumer": batch.column("consumer").to_pylist(), "at": batch.column("at").to_numpy(zero_copy_only=False)})
            names, lows, highs = [], [], []
            for name, at in rows.groupby("consumer")["at"]:
                low, high = stretches(at.to_numpy(), at.to_numpy(), limit)
                names += [name] * len(low)
                lows.append(low), highs.append(high)
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.concatenate(lows)), pa.array(np.concatenate(highs))], names=["consumer", "low", "high"])

    return fold


class Silence(StatefulProcessor):
    """The open stretches of one consumer, and whether the pause after the first has been told."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        fields = [("stretches", T.BinaryType()), ("raised", T.BooleanType()), ("due", T.LongType())]
        self.state = handle.getValueState("open", T.StructType([T.StructField(n, t) for n, t in fields]))

    def _load(self) -> tuple[np.ndarray, np.ndarray, bool, int | None]:
        if not self.state.exists():
            return np.zeros(0, np.int64), np.zeros(0, np.int64), False, None
        data, raised, due = self.state.get()
        low, high = np.frombuffer(bytes(data), "<i8").reshape(2, -1)
        return low, high, raised, due

    def _save(self, low: np.ndarray, high: np.ndarray, raised: bool, old: int | None) -> None:
        """Keep the state; of its timers only the next one stands. ``old`` is the one to replace."""
        due: int | None = None
        if not raised:
            due = self._millis(high[0] + self.limit)
        elif len(low) > 1:
            due = self._millis(low[1])
        if old is not None and old != due:
            self.handle.deleteTimer(old)
        if due is not None and old != due:
            self.handle.registerTimer(due)
        self.state.update((np.stack([low, high]).astype("<i8").tobytes(), raised, due))

    @staticmethod
    def _millis(micros: int) -> int:
        return -(-int(micros) // 1_000)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        """Add stretches; what they decide is told by the timers."""
        low, high, raised, due = self._load()
        for frame in rows:
            low = np.concatenate([low, frame["low"].to_numpy(np.int64)])
            high = np.concatenate([high, frame["high"].to_numpy(np.int64)])
            low, high = stretches(low, high, self.limit)
        if len(low):
            self._save(low, high, raised, due)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        """Tell of every pause that the watermark has passed, and of the progress that ended it."""
        now = timerValues.getCurrentWatermarkInMs()
        low, high, raised, due = self._load()
        told = []
        while True:
            if not raised and self._millis(high[0] + self.limit) <= now:
                raised = True
                told.append((RAISED, high[0], high[0] + self.limit))
            elif raised and len(low) > 1 and self._millis(low[1]) <= now:
                told.append((CLEARED, high[0], low[1]))
                low, high, raised = low[1:], high[1:], False
            else:
                break
        # The timer that fired is removed by Spark afterwards.
        fired = expiredTimerInfo.getExpiryTimeInMs()
        self._save(low, high, raised, None if due == fired else due)
        if told:
            kinds, lasts, ats = zip(*told)
            yield pd.DataFrame({"consumer": key[0], "kind": kinds, "last_progress": lasts, "at": ats})

    def close(self) -> None:
        pass


def silences(progress: DataFrame, consumer: str, at: str, limit_seconds: int = 86_400, delay_seconds: int = 3_600) -> DataFrame:
    """``consumer, kind, last_progress, at`` for a stream of progress ``(consumer, at)``.

    ``raised``: no progress for ``limit_seconds`` after ``last_progress``, at which instant ``at`` the limit was
    reached. ``cleared``: the first progress after that, at ``at``. Both are told once the stream's
    watermark, ``delay_seconds`` behind the newest progress of anyone, has passed them. Progress that comes still
    later does not count; rows without a consumer or an instant are none.
    """
    limit = limit_seconds * 1_000_000
    kind = progress.schema[consumer].dataType
    rows = progress.select(F.col(consumer).cast("string").alias("consumer"), F.unix_micros(at).alias("at")).where("consumer IS NOT NULL AND at IS NOT NULL")
    folded = rows.mapInArrow(_folded(limit), "consumer string, low long, high long")
    timed = folded.withColumn("_clock", F.timestamp_micros("high")).withWatermark("_clock", f"{delay_seconds} seconds")
    told = timed.groupBy("consumer").transformWithStateInPandas(Silence(limit), _TOLD, "Append", "EventTime")
    return told.select(
        F.col("consumer").cast(kind).alias(consumer), "kind", F.timestamp_micros("last_progress").alias("last_progress"), F.timestamp_micros("at").alias("at")
    )


def stream_silences(
    progress: DataFrame, consumer: str, at: str, path: str, state: str, limit_seconds: int = 86_400, delay_seconds: int = 3_600
) -> StreamingQuery:
    """Append the alarms of what a stream has available now to Parquet files below ``path``."""
    spark = progress.sparkSession
    require_utc(spark)
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        told = silences(progress, consumer, at, limit_seconds, delay_seconds)
        writer = told.writeStream.format("parquet").outputMode("append").option("checkpointLocation", state)
        return writer.trigger(availableNow=True).start(path)
    finally:
        spark.conf.set(_PROVIDER, before)


def read_silences(rows: DataFrame, consumer: str) -> DataFrame:
    """One row per pause from the alarms: ``consumer, last_progress, raised_at, cleared_at``, the last null while it lasts."""
    told = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("at")))
    return rows.groupBy(consumer, "last_progress").agg(told(RAISED).alias("raised_at"), told(CLEARED).alias("cleared_at"))
