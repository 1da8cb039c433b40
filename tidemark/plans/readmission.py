"""Publishing rows that had been set aside and have been mended in the source since."""

from __future__ import annotations

from dataclasses import replace
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import UPDATED_AT, Contract
from tidemark.operators.delta import upto
from tidemark.operators.validate import violation
from tidemark.plans.commits import CommitLog
from tidemark.plans.sync import Clock, SyncOptions, publish
from tidemark.session import require_utc, written
from tidemark.sources.published import COPIES, set_aside_log
from tidemark.sources.tables import TableSource
from tidemark.streaming.drain import unpublished
from tidemark.streaming.exact import identity

# What a row set aside had lost: its instant, its key, or both.
_LOST = {1: (True, False), 2: (False, True), 3: (True, True)}


def _payload(contract: Contract, lost: int) -> Column:
    """The kind of loss and two hashes of the columns that it left sound."""
    at, key = _LOST[lost]
    sound = [c for c in contract.column_names if not (at and c == UPDATED_AT) and not (key and c == contract.key)]
    return F.struct(F.lit(lost).alias("lost"), *identity(sound))


def _flat(payload: str) -> list[Column]:
    return [F.col(f"{payload}.{name}").alias(f"_{name}") for name in ("high", "low", "lost")]


def mended(rows: DataFrame, aside: DataFrame, contract: Contract) -> DataFrame:
    """The sound ones of ``rows`` that equal a row of ``aside`` in all columns which that one had not lost.

    Only the losses that occur are tried. Hashes are 64-bit pairs, of which ``aside`` sends each once; they are
    columns of their own, hash first, for a struct is sorted far more slowly.
    """
    at, key = F.col(UPDATED_AT).isNull(), F.coalesce(F.col(contract.key) < 0, F.lit(True))
    lost = F.when(at & key, 3).when(key, 2).when(at, 1)
    owned = F.coalesce(*(F.when(lost == kind, _payload(contract, kind)) for kind in _LOST))
    wanted = aside.select(owned.alias("_payload")).where("_payload IS NOT NULL").select(*_flat("_payload")).distinct()
    wanted = written(wanted, "payloads")
    kinds = sorted(r[0] for r in wanted.select("_lost").distinct().collect())  # three at most
    if not kinds:
        return rows.limit(0)
    tried = rows.where(violation(contract).isNull()).withColumn("_payload", F.explode(F.array(*(_payload(contract, kind) for kind in kinds))))
    return tried.select(*rows.columns, *_flat("_payload")).join(wanted, ["_high", "_low", "_lost"], "left_semi").select(*rows.columns)


def readmit(
    spark: SparkSession, source: TableSource, root: str, options: SyncOptions | None = None, clock: Clock = lambda: datetime.now(UTC)
) -> int:
    """Publish, once, the mended rows that ``sync`` will not pick up since they lie behind the mark; returns how many.

    The source is read as a whole, so the same commit closes every row set aside that it no longer has:
    mended, whichever run published it, or gone. Mended rows past the mark are left to ``sync``. Late
    rows that were never set aside are not admitted, unless they equal one that was but for what it
    had lost. Running it again publishes nothing.
    """
    require_utc(spark)
    options, contract = replace(options or SyncOptions(), quarantine=True), source.contract
    contract.require(source.frame)
    log = CommitLog(spark, root)
    log.recover(clock(), stale_after=options.stale_after)
    claim = log.claim(clock())
    try:
        last, before = log.latest(), log.checkpoint([contract.name])
        mark, rows = before.mark(contract.name), source.frame.select(*contract.column_names)
        aside = set_aside_log(spark, root, contract).where(f"{COPIES} > 0")
        admitted = unpublished(mended(rows.where(upto(mark, contract.key)), aside, contract), root, contract, mark)
        bad = rows.where(violation(contract).isNotNull())
        origin = last.origin if last else None
        facts, _ = publish(spark, root, claim, {contract.name: admitted.unionByName(bad)}, (contract,), before, options, clock, origin, whole=True)
        return facts.counts[contract.name]
    finally:
        claim.release()
