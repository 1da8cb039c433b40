"""Incremental scan: the rows of a table beyond its high-water mark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.checkpoint import HighWaterMark
from tidemark.contract import UPDATED_AT, Contract
from tidemark.session import scratch_root
from tidemark.sources.tables import TableSource


def past(mark: HighWaterMark, key: str, updated_at: str = UPDATED_AT) -> Column:
    """Strictly beyond ``mark`` in ``(updated_at, pk)`` order: ties are neither skipped nor repeated.

    Written as OR rather than as a comparison of structs, because only this form is pushed
    into the scan.
    """
    at, pk = F.col(updated_at), F.col(key)
    return (at > mark.at_column) | ((at == mark.at_column) & (pk > mark.pk))


def upto(mark: HighWaterMark, key: str, updated_at: str = UPDATED_AT) -> Column:
    """At or before ``mark``; the complement of :func:`past`."""
    at, pk = F.col(updated_at), F.col(key)
    return (at < mark.at_column) | ((at == mark.at_column) & (pk <= mark.pk))


def delta(source: TableSource, after: HighWaterMark, until: HighWaterMark | None = None, unplaced: bool = False) -> DataFrame:
    """Contract columns of the rows in ``(after, until]``. A narrow plan: scan, filter, project.

    Rows without an instant, or without a key at the mark's instant, cannot be placed. With
    ``unplaced`` they are part of the delta, for the row checks to find; a source whose instants
    have to be cast then filters after the scan, since a null test on a cast is not pushed.
    """
    contract, rows = source.contract, source.frame
    beyond = past(after, contract.key)
    if unplaced:
        beyond = beyond | F.col(UPDATED_AT).isNull() | F.col(contract.key).isNull()
    rows = rows.where(beyond)
    if until is not None:
        rows = rows.where(upto(until, contract.key))
    if source.date_column:
        day = F.col(source.date_column)
        recent = day >= F.to_date(after.at_column)
        rows = rows.where(recent | day.isNull() if unplaced else recent)
        if until is not None:
            rows = rows.where(F.col(source.date_column) <= F.to_date(until.at_column))
    return rows.select(*contract.column_names)


def ordered(rows: DataFrame, contract: Contract) -> DataFrame:
    """Total order ``(updated_at, pk)`` over the whole frame, by range shuffle."""
    return rows.orderBy(UPDATED_AT, contract.key)


_IN_RANGE_BITS = 33


def numbered(rows: DataFrame, contract: Contract, name: str = "row_number") -> DataFrame:
    """``rows`` with their position in the total order, from 1. No task sees more than one range.

    The sorted ranges are written once, each row with its place in its range, so that a second
    look cannot cut them elsewhere; the rows in earlier ranges, one number per range, are added.
    """
    spark, path = rows.sparkSession, scratch_root(rows.sparkSession, "numbered")
    placed = ordered(rows, contract).withColumn("_place", F.monotonically_increasing_id())
    placed.write.parquet(path)
    written = spark.read.schema(placed.schema).parquet(path)
    in_range = written.withColumn("_range", F.shiftright("_place", _IN_RANGE_BITS))
    sizes = in_range.groupBy("_range").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_place").bitwiseAND((1 << _IN_RANGE_BITS) - 1) + 1
    return in_range.join(offsets, "_range").select(*rows.columns, number.alias(name))
