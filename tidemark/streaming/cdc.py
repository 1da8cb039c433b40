"""Change streams: at-least-once delivery made effectively once."""

from __future__ import annotations

from pyspark.sql import DataFrame


def deduplicate(
    changes: DataFrame, key: str, lsn: str = "lsn", within: str | None = None, event_time: str = "updated_at"
) -> DataFrame:
    """One row per ``(table, key, lsn)``.

    On a stream every identity is remembered, so no row is ever lost and no repeat passes; the
    state grows with the identities. ``within`` bounds it by Spark's event-time watermark, and then
    drops whatever arrives later than that, repeat or not: only for streams whose lateness is bound
    to stay below it, or whose late rows another job collects.
    """
    identity = ["table", key, lsn]
    if changes.isStreaming and within is not None:
        return changes.withWatermark(event_time, within).dropDuplicatesWithinWatermark(identity)
    return changes.dropDuplicates(identity)
