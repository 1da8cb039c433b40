"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``VIRTUAL`` places on a ring of 64-bit hashes. A row belongs to the arc of the next place clockwise
of its own hash, and to that place's shard; once a shard is full, what it cannot take goes on clockwise to the next
place whose shard has room. Only the ring and the rows per arc are needed to decide this, ``shards * VIRTUAL``
numbers whatever the size of the table, so the driver plans whole stretches of arcs, and the rows look up theirs.
Capacities that add up to exactly the rows make the counts equal (at most one apart: the law is ``rows``); a slack
above leaves more rows at home when shards come or go.

Within an arc rows are ranked by hash buckets first, counted, and by a sort within each bucket, whose number grows
with the arc's own rows; the ranking has no hot key, since rows of one id differ in a number of their own.

Defined cases: a null text has size 8 and the crc32 of an empty one; null ids have a place of their own on the ring;
repeated rows are rows like any other, and equal ones are interchangeable. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import kept
from tidemark.session import metadata_frame

VIRTUAL = 64
#: Rows that are sorted together.
BUCKET_ROWS = 20_000


@dataclass(frozen=True)
class Stretch:
    """Rows ``first <= rank < last`` of an arc go to a shard, whose slots for them start at ``slot``."""

    arc: int
    first: int
    last: int
    shard: int
    slot: int


def ring(shards: int, virtual: int = VIRTUAL) -> list[tuple[int, int]]:
    """Places (signed 64-bit) and their shards, in order."""
    return sorted((int.from_bytes(hashlib.blake2b(f"shard {s} place {v}".encode(), digest_size=8).digest(), "big", signed=True), s) for s in range(shards) for v in range(virtual))


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Of each shard; they differ by one at most, and sum to the rows if there is no slack."""
    if slack > 0:
        return [-int(-rows * (1 + slack) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def plan(counts: dict[int, int], owners: list[int], capacity: list[int]) -> list[Stretch]:
    """Where the rows of each arc go: home as far as there is room, in order of arcs; then clockwise."""
    room, taken, n = list(capacity), [0] * len(capacity), len(owners)
    out: list[Stretch] = []
    carried: list[tuple[int, int, int]] = []  # arc, first and last rank still to be placed

    def place(arc: int, first: int, last: int, shard: int) -> int:
        take = min(last - first, room[shard])
        if take:
            out.append(Stretch(arc, first, first + take, shard, taken[shard]))
            room[shard] -= take
            taken[shard] += take
        return first + take

    for arc in range(n):
        left = place(arc, 0, counts.get(arc, 0), owners[arc])
        if left < counts.get(arc, 0):
            carried.append((arc, left, counts[arc]))
    # Every overflow walks the ring from its own arc; shards that are full are passed.
    for arc, first, last in carried:
        step = 1
        while first < last and step <= n:
            shard = owners[(arc + step) % n]
            if room[shard]:
                first = place(arc, first, last, shard)
            step += 1
    return out


def bucketed(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``rows`` with a rank bucket, of which every arc has as many as its own count asks for."""
    divided = [(arc, -(-n // BUCKET_ROWS)) for arc, n in counts.items() if n > BUCKET_ROWS]
    divided = metadata_frame(rows.sparkSession, divided, "arc int, buckets long")
    rows = rows.join(F.broadcast(divided), "arc", "left")  # at most one row for each arc
    return rows.withColumn("bucket", F.pmod(F.xxhash64("place", "row"), F.coalesce("buckets", F.lit(1))).cast("int")).drop("buckets")


def shard(docs: DataFrame, shards: int = 24, slack: float = 0.0, virtual: int = VIRTUAL) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row."""
    spark = docs.sparkSession
    places = ring(shards, virtual)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(F.col("doc_id"), F.lit(29)).alias("place"), F.monotonically_increasing_id().alias("row"),
    )
    rows = kept(rows.withColumn("arc", _arc(F.col("place"), [p for p, _ in places])), "ring")
    counts = {r[0]: r[1] for r in rows.groupBy("arc").count().collect()}  # at most shards * virtual
    total = sum(counts.values())
    stretches = plan(counts, [s for _, s in places], capacities(total, shards, slack))
    frame = metadata_frame(spark, [(x.arc, x.first, x.last, x.shard, x.slot) for x in stretches], "arc int, first long, last long, shard int, base long")

    rows = bucketed(rows, counts)
    sizes = rows.groupBy("arc", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("arc").orderBy("bucket")) - F.col("n")
    starts = sizes.select("arc", "bucket", before.alias("start"))
    rank = F.row_number().over(Window.partitionBy("arc", "bucket").orderBy("place", "doc_id", "text_crc32", "size", "row")) - 1
    ranked = rows.withColumn("rank", rank).join(starts, ["arc", "bucket"]).withColumn("rank", F.col("rank") + F.col("start"))
    inside = (ranked["arc"] == frame["arc"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    out = ranked.join(F.broadcast(frame), inside)  # a fixed number of stretches
    slot = (F.col("base") + F.col("rank") - F.col("first")).cast("long")
    law = "rows" if slack <= 0 else "bounded"
    return out.select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def _arc(place: Column, bounds: list[int]) -> Column:
    """Index of the first bound that is not below ``place``; past the last one, the first again."""
    known = F.array(*(F.lit(b) for b in bounds))
    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        below = (s["low"] < s["high"]) & (F.get(known, middle) < place)
        return F.struct(F.when(below, middle + 1).otherwise(s["low"]).alias("low"), F.when(below | (s["low"] >= s["high"]), s["high"]).otherwise(middle).alias("high"))

    steps = F.sequence(F.lit(0), F.lit(len(bounds).bit_length()))
    return (F.aggregate(steps, start, halve, lambda s: s["low"]) % len(bounds)).cast("int")
