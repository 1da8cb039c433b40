"""Aggregates over deltas: counts, touched dates, advanced marks.

Every function takes the deltas of all tables of a run at once and reads two columns of each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.checkpoint import Checkpoint
from tidemark.contract import UPDATED_AT, Contract
from tidemark.functions.canonical import iso_utc, utc_date
from tidemark.functions.digest import lane_parts, with_lanes
from tidemark.operators.identity import identity_hash

Deltas = Mapping[str, DataFrame]


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def positions(deltas: Deltas, contracts: Sequence[Contract]) -> DataFrame:
    """``(table_ordinal, table, updated_at, pk)`` of every delta row."""
    return _stack(
        [
            deltas[c.name].select(
                F.lit(i).alias("table_ordinal"),
                F.lit(c.name).alias("table"),
                UPDATED_AT,
                F.col(c.key).cast("bigint").alias("pk"),
            )
            for i, c in enumerate(contracts)
        ]
    )


def delta_counts(deltas: Deltas, contracts: Sequence[Contract]) -> DataFrame:
    """Rows per table; a table without changes counts zero."""
    return _stack(
        [
            deltas[c.name].agg(F.count("*").alias("delta_row_count")).select(
                F.lit(i).alias("table_ordinal"), F.lit(c.name).alias("table"), "delta_row_count"
            )
            for i, c in enumerate(contracts)
        ]
    )


def partition_counts(deltas: Deltas, contracts: Sequence[Contract]) -> DataFrame:
    """Rows per table and UTC date, combined on the map side."""
    return (
        positions(deltas, contracts)
        .groupBy("table_ordinal", "table", F.to_date(UPDATED_AT).alias("day"))
        .agg(F.count("*").alias("row_count"))
        .select("table_ordinal", "table", utc_date(F.col("day")).alias("date"), "row_count")
    )


def touched_partitions(deltas: Deltas, contracts: Sequence[Contract]) -> DataFrame:
    """The dates each delta touches, in table and date order. One row per table and date.

    ``position`` counts them from 1 over all tables; dates and tables are few, rows are not.
    """
    position = F.row_number().over(Window.orderBy("table_ordinal", "date")).alias("position")
    dates = partition_counts(deltas, contracts).select("table_ordinal", "table", "date", position)
    return dates.orderBy("position")


def digests(deltas: Deltas, contracts: Sequence[Contract]) -> DataFrame:
    """One row per table: count, greatest position and digest lanes, in a single pass.

    Aggregated without grouping keys, table by table: the greatest ``(updated_at, pk)`` is a
    struct, which Spark would otherwise sort by the grouping key to aggregate.
    """
    per_table = []
    for i, c in enumerate(contracts):
        rows = deltas[c.name].select(UPDATED_AT, F.col(c.key).cast("bigint").alias("pk"))
        hashed = with_lanes(rows, identity_hash(c.name, F.col("pk"), F.col(UPDATED_AT)))
        per_table.append(
            hashed.agg(
                F.count("*").alias("delta_row_count"),
                F.count_if(F.col(UPDATED_AT).isNull() | F.col("pk").isNull() | (F.col("pk") < 0)).alias("invalid"),
                F.max(F.struct(UPDATED_AT, "pk")).alias("last"),
                *lane_parts(),
            ).select(
                F.lit(i).alias("table_ordinal"),
                F.lit(c.name).alias("table"),
                "*",
                iso_utc(F.col(f"last.{UPDATED_AT}")).alias("last_at"),
                F.col("last.pk").alias("last_pk"),
            ).drop("last")
        )
    return _stack(per_table)


def checkpoint_advance(deltas: Deltas, contracts: Sequence[Contract], before: Checkpoint) -> DataFrame:
    """The mark after each delta: its greatest position, or the old mark if it is empty."""
    per_table = []
    for c in contracts:
        mark = before.mark(c.name)
        old = F.struct(mark.at_column.alias(UPDATED_AT), F.lit(mark.pk).cast("bigint").alias("pk"))
        per_table.append(
            deltas[c.name]
            .agg(F.max(F.struct(F.col(UPDATED_AT), F.col(c.key).cast("bigint").alias("pk"))).alias("last"))
            .select(F.lit(c.name).alias("table"), F.coalesce("last", old).alias("last"))
            .select("table", iso_utc(F.col(f"last.{UPDATED_AT}")).alias(UPDATED_AT), F.col("last.pk").alias("last_pk"))
        )
    return _stack(per_table)
