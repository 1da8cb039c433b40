"""Commit windows of a stream: each closed window once, late rows beside them, open ones as bounded state.

The sums of a window (rows and digest lanes) do not depend on order and add up, so the state of an open window is one
row of partial sums. A micro-batch adds its own to those of the batch before; windows that end ``delay`` behind the
newest instant seen are published and leave the state. Rows of windows already published go to a side output and are
never lost: added to the published sums they give what a batch over everything gives.

Every batch writes folders of its own, whole or again, and reads only those of the batch before, so a batch that is run
again comes to the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.contract import UPDATED_AT, Contract
from tidemark.functions.digest import lane_columns, lane_parts, with_lanes
from tidemark.operators.identity import identity_hash
from tidemark.session import written

_PARTS = [f"lane{lane}_{part}" for lane in range(4) for part in range(3)]
_SUMS = ", ".join(["window_start timestamp", "row_count long", *(f"{p} long" for p in _PARTS)])
CLOSED, OPEN, LATE, MARKS = "closed", "open", "late", "marks"


class WindowLog:
    """The windows of one table's stream below ``root``; ``width`` and ``delay`` in seconds."""

    def __init__(self, spark: SparkSession, root: str, contract: Contract, width: int = 120, delay: int = 3_600):
        self.spark, self.root, self.contract, self.width, self.delay = spark, root.rstrip("/"), contract, width, delay

    def _read(self, name: str, schema: str | T.StructType, batch: int | None = None) -> DataFrame:
        """One batch's part of an output, or all of them."""
        path = f"{self.root}/{name}" if batch is None else f"{self.root}/{name}/_batch={batch}"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", path).parquet(path)
        return rows.drop("_batch")

    def _sums(self, rows: DataFrame) -> DataFrame:
        """Partial sums of each window."""
        key = F.col(self.contract.key).cast("bigint")
        keyed = rows.select(F.window(UPDATED_AT, f"{self.width} seconds")["start"].alias("window_start"), key.alias("pk"), UPDATED_AT)
        hashed = with_lanes(keyed, identity_hash(self.contract.name, F.col("pk"), F.col(UPDATED_AT)))
        return hashed.groupBy("window_start").agg(F.count("*").alias("row_count"), *lane_parts())

    @staticmethod
    def _added(sums: DataFrame) -> DataFrame:
        return sums.groupBy("window_start").agg(F.sum("row_count").alias("row_count"), *(F.sum(p).alias(p) for p in _PARTS))

    def newest(self, batch: int) -> int | None:
        """The newest instant, in seconds, that the batches up to this one have seen."""
        row = self._read(MARKS, "newest long", batch).agg(F.max("newest")).first()
        return row[0]

    def commit(self, batch: DataFrame, batch_id: int) -> None:
        """Publish the windows that a micro-batch closes; set its late rows aside."""
        rows = written(batch.select(*self.contract.column_names), "windows")
        before = self.newest(batch_id - 1)
        end = F.unix_seconds(F.window(UPDATED_AT, f"{self.width} seconds")["end"])
        placed = F.col(UPDATED_AT).isNotNull()
        late = F.lit(False) if before is None else F.coalesce(end <= before - self.delay, F.lit(False))
        rows.where(late | ~placed).write.mode("overwrite").parquet(f"{self.root}/{LATE}/_batch={batch_id}")
        seen = rows.agg(F.max(F.unix_seconds(UPDATED_AT))).first()[0]
        newest = max((x for x in (seen, before) if x is not None), default=None)
        sums = self._added(self._sums(rows.where(placed & ~late)).unionByName(self._read(OPEN, _SUMS, batch_id - 1)))
        sums = written(sums, "window-sums")
        over = F.lit(False) if newest is None else F.unix_seconds("window_start") + self.width <= newest - self.delay
        sums.where(over).write.mode("overwrite").parquet(f"{self.root}/{CLOSED}/_batch={batch_id}")
        sums.where(~over).write.mode("overwrite").parquet(f"{self.root}/{OPEN}/_batch={batch_id}")
        # The mark comes last: a batch without one has not ended, and is run again before the next begins.
        self.spark.range(1).select(F.lit(newest).cast("long").alias("newest")).write.mode("overwrite").parquet(f"{self.root}/{MARKS}/_batch={batch_id}")

    def closed(self) -> DataFrame:
        """``window_start, row_count, lane0 ... lane3`` of the windows published, each once."""
        return self._read(CLOSED, _SUMS).select("window_start", "row_count", *lane_columns())

    def open(self, batch: int) -> DataFrame:
        """The state after a batch: the partial sums of the windows still open."""
        return self._read(OPEN, _SUMS, batch)

    def late(self) -> DataFrame:
        """The rows that came after their window was published, and those without an instant."""
        return self._read(LATE, self.contract.schema)

    def whole(self, last_batch: int) -> DataFrame:
        """Published, open and late together: the windows of everything that has arrived."""
        late = self._sums(self.late().where(F.col(UPDATED_AT).isNotNull()))
        sums = self._added(self._read(CLOSED, _SUMS).unionByName(self.open(last_batch)).unionByName(late))
        return sums.select("window_start", "row_count", *lane_columns())


def stream_windows(rows: DataFrame, log: WindowLog, state: str) -> StreamingQuery:
    """Publish the windows of what a stream has available now."""
    return rows.writeStream.foreachBatch(log.commit).option("checkpointLocation", state).trigger(availableNow=True).start()
