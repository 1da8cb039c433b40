"""Comparing two versions of a table by a digest tree over key ranges.

A level cuts the keys into ranges of a power of two and sums, for each range, the rows and the lanes of their hashes.
Sums do not depend on order, are combined on the map side, and are equal where the rows are. The comparison
descends: only ranges whose sums differ are cut finer, and only rows of ranges that still differ at the end are
shuffled. Two versions of which little has changed so cost scans and sums, not a shuffle of both.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import UPDATED_AT, Contract
from tidemark.operators.changes import OP
from tidemark.operators.quality import snapshot_diff
from tidemark.session import written

#: Each level cuts a range into this power of two; rows that are few enough to compare as they are.
LEVEL_BITS, ENOUGH = 12, 100_000
_PARTS = 3
_PART_BITS = 22


@dataclass(frozen=True)
class Level:
    """What one level of a comparison found."""

    shift: int
    ranges: int
    rows: int


def _row_lanes(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row, in parts whose sums are exact up to 2**41 rows."""
    parts = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    hashes = [F.xxhash64(*parts, F.lit(seed)) for seed in (1, 2)]
    mask = (1 << _PART_BITS) - 1
    return [F.shiftright(h, _PART_BITS * p).bitwiseAND(mask).alias(f"l{i}_{p}") for i, h in enumerate(hashes) for p in range(_PARTS)]


_LANES = [f"l{i}_{p}" for i in range(2) for p in range(_PARTS)]


def range_sums(rows: DataFrame, key: str, columns: Sequence[str], shift: int) -> DataFrame:
    """``range, rows`` and lane sums of each range of ``2 ** shift`` keys; a null key has a range of its own."""
    hashed = rows.select(F.shiftright(F.col(key).cast("long"), shift).alias("range"), *_row_lanes(columns))
    return hashed.groupBy("range").agg(F.count("*").alias("rows"), *(F.sum(c).alias(c) for c in _LANES))


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """``range, rows`` (of both sides) of the ranges whose sums are not the same."""
    sums = ["rows", *_LANES]
    minus = right.select("range", F.col("rows").alias("both"), *((-F.col(c)).alias(c) for c in sums))
    balance = left.select("range", F.col("rows").alias("both"), *sums).unionByName(minus).groupBy("range")
    balance = balance.agg(F.sum("both").alias("both"), *(F.sum(c).alias(c) for c in sums))
    unequal = " OR ".join(f"{c} <> 0" for c in sums)
    return balance.where(unequal).select("range", F.col("both").alias("rows"))


def _inside(rows: DataFrame, key: str, ranges: DataFrame, shift: int, low: int | None, high: int | None) -> DataFrame:
    """The rows whose key lies in one of ``ranges``; their outermost bounds reach the scan."""
    if low is not None:
        bounds = (F.col(key) >= low << shift) & (F.col(key) <= (high << shift) + (1 << shift) - 1)
        rows = rows.where(bounds | F.col(key).isNull())
    wanted = ranges.select(F.col("range").alias("_range"))
    return rows.join(wanted, F.shiftright(F.col(key).cast("long"), shift).eqNullSafe(F.col("_range")), "left_semi")


def narrowed(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str] | None = None, enough: int = ENOUGH, bits: int = LEVEL_BITS
) -> tuple[DataFrame, DataFrame, list[Level]]:
    """The rows of both sides in the ranges where ``columns`` differ, and what each level found.

    Descends until the ranges hold ``enough`` rows at most, or single keys, or until a level no
    longer halves them.
    """
    columns = columns or left.columns
    span = [side.agg(F.min(key).alias("a"), F.max(key).alias("b")).first() for side in (left, right)]
    ends = [x for s in span for x in s if x is not None]
    shift = max(0, (max(ends) - min(ends)).bit_length() - bits) if ends else 0
    levels: list[Level] = []
    inner = (left, right)
    while True:
        ranges = written(differing(*(range_sums(side, key, columns, shift) for side in inner)), "ranges")
        found = ranges.agg(F.count("*").alias("n"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.min("range").alias("a"), F.max("range").alias("b")).first()
        levels.append(Level(shift, found["n"], found["rows"]))
        inner = tuple(_inside(side, key, ranges, shift, found["a"], found["b"]) for side in (left, right))
        stalled = len(levels) > 1 and 2 * levels[-1].rows > levels[-2].rows
        if found["rows"] <= enough or shift == 0 or stalled:
            return (*inner, levels)
        shift = max(0, shift - bits)


def tree_diff(expected: DataFrame, actual: DataFrame, key: str, enough: int = ENOUGH, bits: int = LEVEL_BITS) -> DataFrame:
    """The rows of :func:`snapshot_diff`, of which only those in differing ranges are shuffled."""
    left, right, _ = narrowed(expected, actual.select(*expected.columns), key, enough=enough, bits=bits)
    return snapshot_diff(left, right)


def deleted(source: DataFrame, state: DataFrame, contract: Contract, enough: int = ENOUGH, bits: int = LEVEL_BITS) -> DataFrame:
    """The rows of ``state`` whose key the source no longer has. Digests cover the keys alone."""
    here, there, _ = narrowed(state, source.select(contract.key), contract.key, [contract.key], enough, bits)
    return here.join(there, contract.key, "left_anti").select(*state.columns)


def tombstones(gone: DataFrame, contract: Contract) -> DataFrame:
    """A delete for each row: its key and instant, nothing else.

    It stands at the position of the version it ends, where a delete is the last, so the high-water
    mark does not move; the commit that carries it tells when the delete was found.
    """
    kept = (contract.key, UPDATED_AT)
    return gone.select(*(F.lit("delete").alias(OP) if f.name == OP else F.col(f.name) if f.name in kept else F.lit(None).cast(f.dataType).alias(f.name) for f in contract.schema.fields))
