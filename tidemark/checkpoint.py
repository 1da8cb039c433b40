"""High-water marks: how far each table has been published.

A mark is a position in the total order ``(updated_at, pk)``. It is not Spark's event-time
watermark: it never expires state and never tolerates lateness.

Marks travel on the driver as ISO text, because the empty mark lies in year 1 and cannot be
collected as a Python timestamp.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import CheckpointCorrupt, ContractError
from tidemark.session import metadata_frame

# Fixed value: a position before every real row.
EMPTY_AT = "0001-01-01T00:00:00Z"


def to_iso(moment: datetime) -> str:
    if moment.utcoffset() is None:
        raise ContractError(f"{moment!r} has no time zone")
    utc = moment.astimezone(UTC).replace(tzinfo=None)
    return utc.isoformat() + "Z"


def from_iso(text: str) -> datetime:
    """Parse ISO text; text without an offset is UTC."""
    moment = datetime.fromisoformat(text)
    return moment.replace(tzinfo=UTC) if moment.utcoffset() is None else moment.astimezone(UTC)


@dataclass(frozen=True)
class HighWaterMark:
    at: str = EMPTY_AT
    pk: int = 0

    def __post_init__(self) -> None:
        if isinstance(self.pk, bool) or not isinstance(self.pk, int) or self.pk < 0:
            raise ContractError(f"mark key must be an integer >= 0, got {self.pk!r}")
        at = self.at if isinstance(self.at, datetime) else from_iso(str(self.at))
        object.__setattr__(self, "at", to_iso(at))

    @property
    def at_column(self) -> Column:
        """The instant as a foldable timestamp, so that comparisons reach the scan."""
        return F.lit(self.at).cast("timestamp")

    @property
    def sort_key(self) -> tuple[datetime, int]:
        return from_iso(self.at), self.pk

    def as_dict(self) -> dict[str, Any]:
        return {"last_pk": self.pk, "updated_at": self.at}


@dataclass(frozen=True)
class Checkpoint:
    """The marks of all tables; a table without an entry is at the empty mark."""

    marks: Mapping[str, HighWaterMark]

    @classmethod
    def initial(cls, tables: Iterable[str]) -> Checkpoint:
        return cls({table: HighWaterMark() for table in tables})

    @classmethod
    def parse(cls, state: Any) -> Checkpoint:
        """Read the stored form, either JSON text or the parsed object."""
        try:
            entries = json.loads(state) if isinstance(state, (str, bytes)) else state
            return cls(
                {
                    table: HighWaterMark(entry["updated_at"], int(entry["last_pk"]))
                    for table, entry in entries.items()
                }
            )
        except (AttributeError, KeyError, TypeError, ValueError) as bad:
            raise CheckpointCorrupt(f"unreadable checkpoint: {bad}") from bad

    def mark(self, table: str) -> HighWaterMark:
        return self.marks.get(table, HighWaterMark())

    def advance(self, moved: Mapping[str, HighWaterMark]) -> Checkpoint:
        return Checkpoint({**self.marks, **moved})

    def for_tables(self, tables: Iterable[str]) -> Checkpoint:
        """The same marks with an explicit entry for each of ``tables``."""
        return Checkpoint({**{t: HighWaterMark() for t in tables}, **self.marks})

    def as_dict(self) -> dict[str, dict[str, Any]]:
        return {table: self.marks[table].as_dict() for table in sorted(self.marks)}

    def pretty(self) -> str:
        return json.dumps(self.as_dict(), indent=2, sort_keys=True, ensure_ascii=False) + "\n"

    def as_frame(self, spark: SparkSession) -> DataFrame:
        """``(table, updated_at, last_pk)``, one row per table."""
        rows = [(table, self.marks[table].at, self.marks[table].pk) for table in sorted(self.marks)]
        return metadata_frame(spark, rows, "table string, at string, last_pk bigint").select(
            "table", F.col("at").cast("timestamp").alias("updated_at"), "last_pk"
        )
