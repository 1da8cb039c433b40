"""What a consumer asks of the change log: the next page, or the table as it stood."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checkpoint import HighWaterMark, from_iso
from tidemark.contract import UPDATED_AT, Contract
from tidemark.errors import ContractError
from tidemark.functions.canonical import iso_utc
from tidemark.operators.changes import OP, latest_per_key
from tidemark.operators.delta import past
from tidemark.plans.commits import CommitLog
from tidemark.sources.published import last_date_of_page, read_lake


def changes_since(log_rows: DataFrame, contract: Contract, cursor: HighWaterMark, page: int) -> DataFrame:
    """The next ``page`` changes past ``cursor``, in order. Each task keeps its first ``page`` rows."""
    return log_rows.where(past(cursor, contract.key)).orderBy(UPDATED_AT, contract.key).limit(page)


def next_cursor(page_rows: DataFrame, contract: Contract, cursor: HighWaterMark) -> HighWaterMark:
    """Where the page ended; the same cursor if it was empty."""
    last = (
        page_rows.agg(F.max(F.struct(F.col(UPDATED_AT), F.col(contract.key).alias("pk"))).alias("last"))
        .select(iso_utc(F.col(f"last.{UPDATED_AT}")).alias("at"), F.col("last.pk").alias("pk"))
        .first()
    )
    return cursor if last["at"] is None else HighWaterMark(last["at"], int(last["pk"]))


def read_changes_since(
    spark: SparkSession, root: str, contract: Contract, cursor: HighWaterMark, page: int
) -> DataFrame:
    """:func:`changes_since` on the committed lake.

    Reads the cursor's date and as many later ones as hold a page, by the row counts in the
    commit log; a consumer far behind does not scan everything it has yet to see.
    """
    first = cursor.at[:10]
    last = last_date_of_page(CommitLog(spark, root).live_leaves(), contract, first, page)
    rows = read_lake(spark, root, contract, first_date=first, last_date=last)
    return changes_since(rows, contract, cursor, page)


def as_of_state(log_rows: DataFrame, contract: Contract, moment: HighWaterMark | None = None) -> DataFrame:
    """The table as of a position in the log; tombstones drop their key."""
    if moment is not None:
        log_rows = log_rows.where(~past(moment, contract.key))
    state = latest_per_key(log_rows, contract)
    if OP in log_rows.columns:
        state = state.where(F.col(OP) != "delete")
    return state.select(*contract.column_names)


def read_as_of(
    spark: SparkSession, root: str, contract: Contract, seq: int | None = None, at: datetime | None = None
) -> DataFrame:
    """The table as published by commit ``seq``, or by the last commit no later than ``at``."""
    if at is not None:
        reached = [c.seq for c in CommitLog(spark, root).history() if from_iso(c.committed_at) <= at]
        if not reached:
            raise ContractError(f"nothing retained was committed by {at.isoformat()}")
        seq = reached[-1]
    return as_of_state(read_lake(spark, root, contract, as_of=seq), contract)
