"""The next page of the change log for many consumers at once.

The log and the cursors are put in one total order ``(updated_at, pk)`` by a range shuffle. A running count of
log rows, within each range and then over the ranges, numbers the log and tells for each cursor how many rows lie at or
before it. A page is then a stretch of numbers: an equality join, and no job per consumer. Consumers at one position
share the look-up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.contract import UPDATED_AT, Contract
from tidemark.session import written

_IN_RANGE_BITS = 33


def counted(log_rows: DataFrame, cursors: DataFrame, contract: Contract) -> DataFrame:
    """Log rows with their ``number`` from 1, and cursors (``cursor`` not null) with the rows at or before them.

    Ranges are cut by position and, within one, by hash, so that a position which very many rows or cursors share is
    spread over tasks. Inside a range the count runs over its place, in blocks, so no window sees more than a block.
    """
    row = F.struct(*(F.col(c) for c in contract.column_names))
    log = log_rows.select(F.col(UPDATED_AT).alias("_at"), F.col(contract.key).cast("long").alias("_pk"), F.lit(0).alias("_kind"), row.alias("row"))
    own = cursors.select(F.col("cursor_at").alias("_at"), F.col("cursor_pk").cast("long").alias("_pk"), F.lit(1).alias("_kind"), F.struct(*cursors.columns).alias("cursor"))
    both = log.withColumn("cursor", F.lit(None).cast(own.schema["cursor"].dataType))
    both = both.unionByName(own.withColumn("row", F.lit(None).cast(log.schema["row"].dataType)))
    # A log row before a cursor at its own position: the page begins past it.
    placed = both.orderBy("_at", "_pk", "_kind", F.xxhash64("row", "cursor")).withColumn("_place", F.monotonically_increasing_id())
    placed = written(placed.drop("_at", "_pk"), "placed")
    block = F.shiftright("_place", 12)
    sizes = placed.groupBy(F.shiftright("_place", _IN_RANGE_BITS).alias("_range"), block.alias("_block")).agg(F.count_if(F.col("_kind") == 0).alias("_rows"))
    ranges = sizes.groupBy("_range").agg(F.sum("_rows").alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    ranges = ranges.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before_range"))
    inner = Window.partitionBy("_range").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_range", F.col("_block").alias("_own"), F.coalesce(F.sum("_rows").over(inner), F.lit(0)).alias("_before_block"))
    offsets = sizes.join(ranges, "_range").select("_own", (F.col("_before_range") + F.col("_before_block")).alias("_before"))
    running = Window.partitionBy("_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = placed.withColumn("_block", block).withColumn("_in", F.count_if(F.col("_kind") == 0).over(running))
    return inside.join(offsets, F.col("_block") == F.col("_own")).select("row", "cursor", (F.col("_before") + F.col("_in")).alias("number"))


def pages(log_rows: DataFrame, cursors: DataFrame, contract: Contract, page: int) -> DataFrame:
    """For every cursor (``cursor_at, cursor_pk`` and other columns) its next ``page`` changes, ``position`` from 1.

    Equals :func:`~tidemark.operators.consumer.changes_since` of each cursor. Rows without an instant or key
    stand before every cursor; a cursor without an instant stands at the beginning. A cursor at the end has no rows.
    """
    numbered = written(counted(log_rows, cursors, contract), "numbered")
    log = numbered.where("row IS NOT NULL").select(F.col("number").alias("_number"), "row")
    own = numbered.where("cursor IS NOT NULL").select("cursor", "number")
    # Each position once; its page is at most ``page`` rows.
    wanted = own.select("number").distinct().select("number", F.explode(F.sequence(F.col("number") + 1, F.col("number") + page)).alias("_wanted"))
    one = F.struct((F.col("_wanted") - F.col("number")).cast("int").alias("position"), F.col("row"))
    found = wanted.join(log, F.col("_wanted") == F.col("_number")).groupBy("number").agg(F.collect_list(one).alias("page"))
    out = own.join(found, "number").select("cursor.*", F.explode("page").alias("one"))
    return out.select(*cursors.columns, "one.position", "one.row.*")
