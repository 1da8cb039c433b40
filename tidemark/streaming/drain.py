"""Incremental runs driven by Structured Streaming instead of by polling."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from tidemark.checkpoint import HighWaterMark
from tidemark.contract import UPDATED_AT, Contract
from tidemark.errors import ContractError, RunInProgress
from tidemark.functions.canonical import utc_date
from tidemark.operators.delta import past
from tidemark.plans.commits import Claim, CommitLog
from tidemark.plans.sync import Clock, SyncOptions, publish
from tidemark.session import written
from tidemark.sources.published import read_lake
from tidemark.sources.tables import TableSource

#: How long a batch waits for another run on the same root to end, in seconds.
PATIENCE = 3_600


def claimed(log: CommitLog, clock: Clock, options: SyncOptions, patience: float = PATIENCE) -> Claim:
    """A claim on the next run, after recovery; another run's live claim is waited for."""
    until = time.monotonic() + patience
    while True:
        try:
            log.recover(clock(), stale_after=options.stale_after)
            return log.claim(clock())
        except RunInProgress:
            if time.monotonic() >= until:
                raise
            time.sleep(0.5)


def unrepeated(batch: DataFrame, contract: Contract) -> DataFrame:
    """``batch`` with one row for each ``(updated_at, pk)``.

    Of two contents at one position the one with the larger hash stays: a batch that is run again
    chooses alike. Rows that cannot be placed are kept, for the row checks to judge. Each task
    keeps one row of a position before the shuffle, so one delivered very often does not pile up.
    """
    position = [contract.key, UPDATED_AT]
    placed = F.col(contract.key).isNotNull() & F.col(UPDATED_AT).isNotNull()
    rank = F.row_number().over(Window.partitionBy(*position).orderBy(F.xxhash64(*batch.columns).desc()))
    once = batch.where(placed).withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    return once.unionByName(batch.where(~placed))


def unpublished(batch: DataFrame, root: str, contract: Contract, mark: HighWaterMark) -> DataFrame:
    """The rows of a micro-batch that the lake does not hold yet, each once.

    Rows past the mark cannot be in it. Rows at or before the mark are late ones or ones delivered
    again, also by a query that lost its state; they are compared with the lake, by key and instant,
    on just the dates they touch. Repeats are dropped once, into a copy: a batch is read and sorted in
    one go, whatever is asked of it afterwards.
    """
    rows = written(unrepeated(batch.select(*contract.column_names), contract), "once")
    fresh = rows.where(F.coalesce(past(mark, contract.key), F.lit(True)))
    old = rows.where(F.coalesce(~past(mark, contract.key), F.lit(False)))
    dates = {r.date for r in old.select(utc_date(F.col(UPDATED_AT)).alias("date")).distinct().collect()}
    if not dates:
        return fresh
    known = read_lake(batch.sparkSession, root, contract, dates=dates)
    keys = known.select(F.col(contract.key).alias("_key"), F.col(UPDATED_AT).alias("_at"))
    same = (old[contract.key] == F.col("_key")) & (old[UPDATED_AT] == F.col("_at"))
    return fresh.unionByName(old.join(keys, same, "left_anti"))


def batch_publisher(
    source: TableSource, root: str, options: SyncOptions, clock: Clock
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that publishes each micro-batch as one run.

    The source's offsets decide what is new, not the mark: arrival need not follow ``updated_at``.
    A batch delivered again is recognised by its query and number, which the commit that published
    it carries; anything else that comes twice is compared with the lake. The mark only ever rises,
    so late rows lie behind it: consumers that page by position read them with ``late_rows``.
    """
    contract = source.contract

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = CommitLog(spark, root)
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        claim = claimed(log, clock, options)
        try:
            last = log.latest()
            seen: dict[str, Any] = dict(last.origin.get("streams", {})) if last else {}
            done = seen.get(contract.name)
            if isinstance(done, dict) and done["query"] == query and done["batch"] >= batch_id:
                return
            before = log.checkpoint([contract.name])
            rows = {contract.name: unpublished(batch, root, contract, before.mark(contract.name))}
            origin = {"streams": {**seen, contract.name: {"query": query, "batch": batch_id}}}
            publish(spark, root, claim, rows, (contract,), before, options, clock, origin=origin)
        finally:
            claim.release()

    return run


def stream_sync(
    source: TableSource,
    root: str,
    state: str,
    every: str | None = None,
    options: SyncOptions | None = None,
    clock: Clock = lambda: datetime.now(UTC),
) -> StreamingQuery:
    """Publish a streaming source: what is available now, or continuously with ``every``.

    ``state`` is the streaming checkpoint folder, shared by all executors. One query serves one
    table; the marks of the others are carried along unchanged.
    """
    if not source.frame.isStreaming:
        raise ContractError(f"{source.contract.name} is not a streaming source")
    options = options or SyncOptions()
    writer = source.frame.writeStream.foreachBatch(batch_publisher(source, root, options, clock))
    writer = writer.option("checkpointLocation", state)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def drain(source: TableSource, root: str, state: str, **kwargs: Any) -> None:
    """Publish everything available now and return."""
    stream_sync(source, root, state, **kwargs).awaitTermination()


def drain_all(sources: Sequence[TableSource], root: str, state: str, **kwargs: Any) -> None:
    """Publish what is available of several tables, one after the other, in the order given."""
    for source in sources:
        drain(source, root, f"{state}/{source.contract.name}", **kwargs)
