"""Digests: schema fingerprints, row hashes and order-free digests of row sets."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import Contract
from tidemark.errors import ContractError
from tidemark.functions.canonical import canonical_text

FINGERPRINT_LENGTH = 16
RUN_ID_LENGTH = 32

LANES = 4
_LANE_HEX = 15  # 60 bits of the row hash per lane
_PART_BITS = 20  # each lane is summed in three parts, exact up to 2**43 rows


def _checked_length(length: int) -> int:
    if length not in range(8, 65):
        raise ContractError(f"digest length must lie between 8 and 64, got {length}")
    return length


def sha256_prefix(text: Column, length: int = 64) -> Column:
    return F.substring(F.sha2(text, 256), 1, _checked_length(length))


def sha256_text(text: str, length: int = 64) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()[: _checked_length(length)]


def schema_fingerprint(contract: Contract, length: int = FINGERPRINT_LENGTH) -> str:
    """Changes with the table name and with any column's name, position or source type."""
    shape = [{"name": column, "type": source_type} for column, source_type in contract.columns]
    return sha256_text(canonical_text({"table": contract.name, "columns": shape}), length)


def with_lanes(rows: DataFrame, row_hash: Column) -> DataFrame:
    """``rows`` with the four lane numbers of each row's SHA-256 hex digest.

    Added in two projections, so that the hash is computed once per row and not once per lane.
    """
    lanes = [
        f"CAST(conv(substring(row_hash, {1 + _LANE_HEX * lane}, {_LANE_HEX}), 16, 10) AS bigint) AS lane{lane}"
        for lane in range(LANES)
    ]
    return rows.withColumn("row_hash", row_hash).selectExpr(*[f"`{c}`" for c in rows.columns], *lanes)


def lane_parts() -> list[Column]:
    """Aggregates over the columns of :func:`with_lanes`; read them back with :func:`lane_totals`.

    Sums of 20-bit integers: hash-aggregated on plain longs, combined on the map side, and
    independent of row order.
    """
    mask = (1 << _PART_BITS) - 1
    return [
        F.expr(f"coalesce(sum(shiftright(lane{lane}, {_PART_BITS * part}) & {mask}), 0)").alias(f"lane{lane}_{part}")
        for lane in range(LANES)
        for part in range(3)
    ]


def lane_totals(row: Mapping[str, Any]) -> list[int]:
    """The full lane sums from one aggregated row."""
    return [
        sum(int(row[f"lane{lane}_{part}"]) << (_PART_BITS * part) for part in range(3))
        for lane in range(LANES)
    ]


def lane_columns() -> list[Column]:
    """The full lane sums as decimal text columns ``lane0`` … ``lane3``."""

    def total(lane: int) -> str:
        weighted = [
            f"CAST(lane{lane}_{part} AS decimal(20,0)) * CAST({1 << (_PART_BITS * part)} AS decimal(17,0))"
            for part in range(3)
        ]
        return f"CAST(CAST({' + '.join(weighted)} AS decimal(38,0)) AS string)"

    return [F.expr(total(lane)).alias(f"lane{lane}") for lane in range(LANES)]


def run_id_from_lanes(
    checkpoint_before: Mapping[str, Any],
    digests: Mapping[str, tuple[int, Sequence[int]]],
    length: int = RUN_ID_LENGTH,
) -> str:
    """Run id from per-table row counts and lane sums.

    ``(updated_at, pk)`` totally orders a delta, so the set of identities fixes the sequence
    and an order-free digest loses nothing.
    """
    body = {
        "scheme": "lanes-1",
        "checkpoint_before": checkpoint_before,
        "tables": {t: {"rows": n, "lanes": [str(x) for x in lanes]} for t, (n, lanes) in digests.items()},
    }
    return sha256_text(canonical_text(body), length)


def run_id_from_identities(
    checkpoint_before: Mapping[str, Any],
    identities: Mapping[str, Sequence[str]],
    length: int = RUN_ID_LENGTH,
) -> str:
    """Run id over the ordered identity texts themselves; for deltas of a checked size."""
    tables = ",".join(
        f"{canonical_text(table)}:[{','.join(identities[table])}]" for table in sorted(identities)
    )
    body = f'{{"checkpoint_before":{canonical_text(checkpoint_before)},"tables":{{{tables}}}}}'
    return sha256_text(body, length)
