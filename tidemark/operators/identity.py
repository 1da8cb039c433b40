"""Row identities: what a run id is derived from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import UPDATED_AT, Contract
from tidemark.functions.canonical import canonical_text, iso_utc


def identity_text(table: str, pk: Column, updated_at: Column) -> Column:
    """Canonical JSON of ``{pk, table, updated_at}``; none of the values needs escaping per row."""
    head, middle = '{"pk":', f',"table":{canonical_text(table)},"updated_at":"'
    return F.concat(F.lit(head), pk.cast("string"), F.lit(middle), iso_utc(updated_at), F.lit('"}'))


def identity_hash(table: str, pk: Column, updated_at: Column) -> Column:
    return F.sha2(identity_text(table, pk, updated_at), 256)


def row_identities(rows: DataFrame, contract: Contract) -> DataFrame:
    """``(pk, table, updated_at)``; a projection, so the input's order is kept."""
    return rows.select(
        F.col(contract.key).cast("bigint").alias("pk"),
        F.lit(contract.name).alias("table"),
        iso_utc(F.col(UPDATED_AT)).alias(UPDATED_AT),
    )
