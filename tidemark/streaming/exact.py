"""Exactly-once change streams with bounded state.

``deduplicate`` remembers every identity for ever, or loses what comes late. Here the state holds the identities of a
recent stretch of event time only; a row that is older than its state is looked up among the rows already committed,
first in a Bloom filter of its date, then, if that says maybe, exactly. So nothing is lost, nothing passes twice, and
the state does not grow with the stream.

Identities are dealt into buckets by hash. A bucket keeps, for each slot of event time, the 128-bit hashes of its
identities, and the newest instant it has seen; slots that lie ``within`` behind that instant expire. Whether a row
is late depends only on its own bucket, which sees all deliveries of it, so the answer cannot change between them.

Every micro-batch is a folder of its own, written whole or again; folders of later batches are ignored by a batch
that is run again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.contract import UPDATED_AT
from tidemark.functions.canonical import utc_date
from tidemark.session import require_utc, written

BUCKETS = 64
#: 64-bit words of a date's Bloom filter, and bits that an identity sets in its one word.
WORDS, BITS = 1 << 16, 5
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_TASKS = "spark.sql.shuffle.partitions"
#: Partitions of the state for each bucket, at most: enough that two buckets seldom share one.
TASKS_PER_BUCKET = 6
_DATE = "_date"


def identity(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes; a null is told from its neighbours."""
    parts = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return [F.xxhash64(*parts, F.lit(1)).alias("high"), F.xxhash64(*parts, F.lit(2)).alias("low")]


def _as_text(field: T.StructField) -> Column:
    """A column as text: pandas has no integers with nulls, and cuts no text short."""
    own = F.col(field.name)
    if isinstance(field.dataType, T.BinaryType):
        return F.base64(own)
    if isinstance(field.dataType, T.StructType | T.ArrayType | T.MapType):
        return F.to_json(F.struct(own.alias("x")), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return own.cast("string")


def _from_text(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.unbase64(text)
    if isinstance(kind, T.StructType | T.ArrayType | T.MapType):
        shape = T.StructType([T.StructField("x", kind)])
        return F.from_json(text, shape, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})["x"]
    return text.cast(kind)


def _once_per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of an identity from each Arrow batch, so that one delivered very often does not travel."""
    for batch in batches:
        if batch.num_rows:
            hashes = pd.DataFrame({c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("high", "low", "at")})
            yield batch.filter(pa.array(~hashes.duplicated().to_numpy()))


class Seen(StatefulProcessor):
    """The identities of one bucket that are not older than ``keep`` microseconds, in slots of ``width``."""

    def __init__(self, width: int, keep: int, columns: int):
        self.width, self.keep, self.columns = width, keep, [f"c{i}" for i in range(columns)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", T.StructType([T.StructField("at", T.LongType())]))
        self.slots = handle.getMapState(
            "slots", T.StructType([T.StructField("slot", T.LongType())]), T.StructType([T.StructField("identities", T.BinaryType())])
        )

    def _held(self, slot: int) -> set[bytes]:
        if not self.slots.containsKey((slot,)):
            return set()
        data = bytes(self.slots.getValue((slot,))[0])
        return {data[i : i + 16] for i in range(0, len(data), 16)}

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        newest = self.newest.get()[0] if self.newest.exists() else None
        horizon = None if newest is None else (newest - self.keep) // self.width
        held: dict[int, set[bytes]] = {}
        late: set[bytes] = set()  # the instant is part of an identity, so its name tells the slot too
        for frame in rows:
            if frame.empty:
                continue
            slots = (frame["at"] // self.width).tolist()
            names = frame[["high", "low"]].to_numpy().astype(">i8").tobytes()
            kept, settled = [], []
            for i, slot in enumerate(slots):
                name = names[16 * i : 16 * i + 16]
                if horizon is not None and slot < horizon:
                    if name not in late:
                        late.add(name)
                        kept.append(i), settled.append(False)
                    continue
                known = held.get(slot)
                if known is None:
                    known = held[slot] = self._held(slot)
                if name not in known:
                    known.add(name)
                    kept.append(i), settled.append(True)
            newest = max(frame["at"].max(), newest if newest is not None else frame["at"].max())
            out = frame.iloc[kept][self.columns].copy()
            out["settled"] = settled
            yield out
        if newest is None:
            return
        newest = int(newest)
        horizon = (newest - self.keep) // self.width
        for slot, known in held.items():
            if slot >= horizon:
                self.slots.updateValue((slot,), (b"".join(sorted(known)),))
        for (slot,) in list(self.slots.keys()):
            if slot < horizon:
                self.slots.removeKey((slot,))
        self.newest.update((newest,))

    def close(self) -> None:
        pass


def first_seen(changes: DataFrame, columns: Sequence[str], keep_seconds: int, slots: int = 24, buckets: int = BUCKETS) -> DataFrame:
    """``changes`` (a stream) once per identity, with ``_settled``: false for rows older than the state, to be looked up.

    ``columns`` name the identity, to which ``updated_at`` belongs; the state holds at most
    ``slots + 1`` entries a bucket.
    """
    width = max(1, keep_seconds * 1_000_000 // slots)
    fields = changes.schema.fields
    at = F.coalesce(F.unix_micros(UPDATED_AT), F.lit(-(1 << 62))).alias("at")
    rows = changes.select(*identity([*columns, UPDATED_AT]), at, *(_as_text(f).alias(f"c{i}") for i, f in enumerate(fields)))
    rows = rows.withColumn("bucket", F.pmod("high", F.lit(buckets)).cast("int"))
    rows = rows.mapInArrow(_once_per_task, rows.schema)
    texts = ", ".join(f"c{i} string" for i in range(len(fields)))
    seen = Seen(width, width * slots, len(fields))
    out = rows.groupBy("bucket").transformWithStateInPandas(seen, f"{texts}, settled boolean", "Append", "None")
    typed = [_from_text(F.col(f"c{i}"), f.dataType).alias(f.name) for i, f in enumerate(fields)]
    return out.select(*typed, F.col("settled").alias("_settled"))


def _word(columns: Sequence[str], words: int) -> list[Column]:
    """The place of an identity in its date's filter, and the bits it sets there."""
    high, low = identity([*columns, UPDATED_AT])
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(low, 6 * i).bitwiseAND(63).cast("int"))
    mask = bit(0)
    for i in range(1, BITS):
        mask = mask.bitwiseOR(bit(i))
    return [F.pmod(high, F.lit(words)).alias("_word"), mask.alias("_mask")]


class ExactLog:
    """The committed rows of a stream below ``root``, their dates' Bloom filters, and the batches that wrote them."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, columns: Sequence[str], words: int = WORDS):
        self.spark, self.root, self.schema, self.columns, self.words = spark, root.rstrip("/"), schema, list(columns), words

    def _table(self, name: str, schema: T.StructType, before: int | None) -> DataFrame:
        whole = T.StructType([*schema.fields, T.StructField("_batch", T.LongType()), T.StructField(_DATE, T.StringType())])
        path = f"{self.root}/{name}"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], whole)
        rows = self.spark.read.schema(whole).parquet(path)
        return rows if before is None else rows.where(F.col("_batch") < before)

    def rows(self, before: int | None = None) -> DataFrame:
        """All rows, or those of the batches before one."""
        return self._table("rows", self.schema, before)

    def filters(self, before: int | None = None) -> DataFrame:
        return self._table("filters", T.StructType([T.StructField("_word", T.LongType()), T.StructField("_mask", T.LongType())]), before)

    def unknown(self, late: DataFrame, batch: int) -> DataFrame:
        """The rows of ``late`` that no earlier batch committed.

        Only the filters and rows of their dates are read, and of those rows only the identities. A row
        that its date's filter does not hold is new without any look at the rows.
        """
        dates = [r[0] for r in late.select(_DATE).distinct().collect()]  # dates, not rows
        if not dates:
            return late
        chosen = F.col(_DATE).isin([d for d in dates if d is not None])
        chosen = chosen | F.col(_DATE).isNull() if None in dates else chosen
        names = [*self.columns, UPDATED_AT]
        probes = late.select("*", *_word(self.columns, self.words), identity(names)[0].alias("_high"))
        filters = self.filters(batch).where(chosen).groupBy(F.col("_word").alias("_w"), F.col(_DATE).alias("_d")).agg(F.bit_or("_mask").alias("_m"))
        # Numbers come first in both conditions: a sort by them seldom compares the rest.
        place = (F.col("_word") == F.col("_w")) & F.col(_DATE).eqNullSafe(F.col("_d"))
        holds = F.coalesce(F.col("_m").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False)).alias("_maybe")
        looked = written(probes.join(filters, place, "left").select(*late.columns, "_high", holds), "looked")
        known = self.rows(batch).where(chosen).select(
            identity(names)[0].alias("_h"), F.col(_DATE).alias("_d"), *(F.col(c).alias(f"_k{i}") for i, c in enumerate(names))
        )
        same = (F.col("_high") == F.col("_h")) & F.col(_DATE).eqNullSafe(F.col("_d"))
        for i, c in enumerate(names):
            same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
        unmatched = looked.where("_maybe").join(known, same, "left_anti")
        return looked.where("NOT _maybe").unionByName(unmatched).drop("_maybe", "_high")

    def commit(self, batch: DataFrame, batch_id: int) -> None:
        """Append what of a micro-batch of :func:`first_seen` is new."""
        rows = written(batch.withColumn(_DATE, utc_date(F.col(UPDATED_AT))), "batch", self.spark)
        new = rows.where("_settled").unionByName(self.unknown(rows.where("NOT _settled"), batch_id)).drop("_settled")
        new.write.mode("overwrite").partitionBy(_DATE).parquet(f"{self.root}/rows/_batch={batch_id}")
        # The batch's own folder is what the filters are made from, so that both always agree.
        own = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(_DATE, T.StringType())])).parquet(f"{self.root}/rows/_batch={batch_id}")
        words = own.select(_DATE, *_word(self.columns, self.words)).groupBy(_DATE, "_word").agg(F.bit_or("_mask").alias("_mask"))
        words.write.mode("overwrite").partitionBy(_DATE).parquet(f"{self.root}/filters/_batch={batch_id}")


def exactly_once(
    changes: DataFrame,
    columns: Sequence[str],
    root: str,
    state: str,
    keep_seconds: int = 86_400,
    slots: int = 24,
    buckets: int = BUCKETS,
    words: int = WORDS,
) -> StreamingQuery:
    """Append every change of a stream to ``root`` once, whatever is delivered again and however late; what is available now.

    Of two contents of one identity in a batch one stays. Null keys and instants are values like
    any other here.
    """
    spark = changes.sparkSession
    require_utc(spark)
    log = ExactLog(spark, root, changes.schema, columns, words)
    # Each partition of the state opens and commits a store in every batch, and there is no more in them than the buckets.
    tasks = min(int(spark.conf.get(_TASKS)), TASKS_PER_BUCKET * buckets)
    before = {key: spark.conf.get(key) for key in (_PROVIDER, _TASKS)}
    spark.conf.set(_PROVIDER, ROCKSDB)
    spark.conf.set(_TASKS, str(tasks))
    try:
        once = first_seen(changes, columns, keep_seconds, slots, buckets)
        writer = once.writeStream.foreachBatch(log.commit).option("checkpointLocation", state)
        return writer.trigger(availableNow=True).start()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
