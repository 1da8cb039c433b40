"""Tables that carry a tenant column; their lake is written and read like any other, by ``sync`` and ``read_lake``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contract import UPDATED_AT
from tidemark.functions.canonical import utc_date


def tenant_partitions(rows: DataFrame, tenant: str) -> DataFrame:
    """Rows per tenant and UTC date."""
    return (
        rows.groupBy(F.col(tenant).alias("tenant_id"), F.to_date(UPDATED_AT).alias("day"))
        .agg(F.count("*").alias("row_count"))
        .select("tenant_id", utc_date(F.col("day")).alias("event_date"), "row_count")
    )
