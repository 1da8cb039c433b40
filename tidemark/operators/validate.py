"""Row checks: what makes a row unpublishable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import UPDATED_AT, Contract


def violation(contract: Contract) -> Column:
    """Why a row cannot be published, or null."""
    key = F.col(contract.key)
    return (
        F.when(F.col(UPDATED_AT).isNull(), F.lit("updated_at is missing"))
        .when(key.isNull(), F.lit("key is missing"))
        .when(key < 0, F.lit("key is negative"))
    )


def comes_back(contract: Contract) -> Column:
    """Whether every delta has the row, because it cannot be placed."""
    return F.col(UPDATED_AT).isNull() | F.col(contract.key).isNull()


def invalid_rows(rows: DataFrame, contract: Contract) -> DataFrame:
    return rows.withColumn("reason", violation(contract)).where("reason IS NOT NULL")


def checked(rows: DataFrame, contract: Contract) -> DataFrame:
    """The same rows; evaluating an invalid one fails the job."""
    reason = violation(contract)
    guard = F.when(reason.isNotNull(), F.raise_error(F.concat(F.lit(f"{contract.name}: "), reason)).cast("bigint"))
    names = [F.col(c) for c in contract.column_names if c != contract.key]
    guarded = rows.select(F.coalesce(guard, F.col(contract.key).cast("bigint")).alias(contract.key), *names)
    return guarded.select(*contract.column_names)


def quarantine_split(rows: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantined)``; the quarantined rows carry the reason. Together they are all rows."""
    good = rows.where(violation(contract).isNull())
    return good, invalid_rows(rows, contract)
