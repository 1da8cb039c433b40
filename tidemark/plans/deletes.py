"""Publishing deletes of a source that does not tell of them."""

from __future__ import annotations

from dataclasses import replace
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.contract import Contract
from tidemark.errors import ContractError
from tidemark.operators.changes import OP
from tidemark.operators.consumer import as_of_state
from tidemark.operators.ranges import deleted, tombstones
from tidemark.plans.commits import CommitLog
from tidemark.plans.sync import Clock, SyncOptions, publish
from tidemark.session import require_utc, written
from tidemark.sources.published import read_lake
from tidemark.sources.tables import TableSource


def with_op(source: TableSource) -> TableSource:
    """The source with an ``op`` column, so that its lake can carry deletes."""
    contract = source.contract
    if OP in contract.column_names:
        return source
    logged = Contract(contract.name, contract.key, (*contract.columns, (OP, "text")), contract.directory, contract.tenant)
    return replace(source, frame=source.frame.withColumn(OP, F.lit("upsert")), contract=logged)


def sync_deletes(
    spark: SparkSession, source: TableSource, root: str, options: SyncOptions | None = None, clock: Clock = lambda: datetime.now(UTC)
) -> int:
    """Publish a delete for every key that the lake's state has and the source has lost; returns how many.

    The source is compared as a whole, by a digest tree over its keys. Rows that are new in the
    source are left to ``sync``. A key that comes back must come with a later instant.
    """
    require_utc(spark)
    options, contract = options or SyncOptions(), source.contract
    if OP not in contract.column_names:
        raise ContractError(f"{contract.name}: deletes need an {OP!r} column, see with_op")
    log = CommitLog(spark, root)
    log.recover(clock(), stale_after=options.stale_after)
    claim = log.claim(clock())
    try:
        state = as_of_state(read_lake(spark, root, contract), contract)
        gone = written(tombstones(deleted(source.frame, state, contract), contract), "deletes")
        count = gone.count()
        if count:
            before = log.checkpoint([contract.name])
            publish(spark, root, claim, {contract.name: gone}, (contract,), before, options, clock)
        return count
    finally:
        claim.release()
