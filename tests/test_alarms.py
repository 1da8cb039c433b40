"""Alarms of silent consumers against a walk over each consumer's sorted progress."""

from collections import defaultdict
from datetime import UTC, datetime, timedelta
from random import Random

from pyspark.sql import functions as F

from tidemark.streaming.alarms import read_silences, silences, stream_silences

START = datetime(2026, 3, 1, tzinfo=UTC)
HOUR = 3_600
SHAPE = "consumer string, at timestamp"


def stream_of(spark, path, batches):
    """The batches as files read one by one, in order."""
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, SHAPE).coalesce(1).write.parquet(f"{path}/batch={n:03}")
    files = spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
    return files.parquet(path)


def expected(batches, limit, delay):
    own = defaultdict(list)
    for rows in batches:
        for name, at in rows:
            if name is not None and at is not None:
                own[name].append(at)
    clock = max(at for ats in own.values() for at in ats) - timedelta(seconds=delay)
    found = set()
    for name, ats in own.items():
        ats = sorted(ats)
        for at, following in zip(ats, [*ats[1:], None]):
            due = at + timedelta(seconds=limit)
            if due <= clock and (following is None or following > due):
                found.add((name, at, due, following if following and following <= clock else None))
    return found


def told(rows):
    as_utc = lambda at: at and at.replace(tzinfo=UTC)
    return [(r.consumer, as_utc(r.last_progress), as_utc(r.raised_at), as_utc(r.cleared_at)) for r in rows]


def run(spark, root, batches, limit, delay):
    query = stream_silences(stream_of(spark, root + "/in", batches), "consumer", "at", root + "/out", root + "/state", limit, delay)
    query.awaitTermination()
    alarms = spark.read.schema("consumer string, kind string, last_progress timestamp, at timestamp").parquet(root + "/out")
    return query, alarms


def test_alarms_are_those_of_the_sorted_progress(spark, root):
    """Busy, slow and silent consumers, rows out of order by less than the delay, repeated rows, nulls."""
    random, rows = Random(5), []
    for c in range(25):
        at, mean = START + timedelta(hours=random.random() * 20), random.choice([1, 8, 20, 60])
        while at < START + timedelta(days=12):
            rows.append((f"c{c}", at))
            at += timedelta(hours=random.expovariate(1 / mean), microseconds=random.randrange(10**6))
            if c % 5 == 0 and at > START + timedelta(days=4):
                break
    rows.sort(key=lambda r: r[1] + timedelta(hours=random.random() * 5))  # at most 5 hours late
    cut = [0, len(rows) // 4, len(rows) // 2, len(rows) * 3 // 4, len(rows)]
    batches = [rows[a:b] for a, b in zip(cut, cut[1:])]
    batches[1] += batches[1][:5] + [(None, START), ("c1", None)]
    query, alarms = run(spark, root, batches, 24 * HOUR, 6 * HOUR)
    found = told(read_silences(alarms, "consumer").collect())
    assert len(found) == len(set(found)) and set(found) == expected(batches, 24 * HOUR, 6 * HOUR)
    assert any(x[3] is None for x in found) and any(x[3] for x in found)
    # Nothing is told twice, and each consumer keeps one state.
    assert alarms.count() == alarms.distinct().count()
    own = [op for p in query.recentProgress for op in p["stateOperators"]]
    # A value and, in Spark's two timer tables, the next timer of each consumer.
    assert own[-1]["numRowsTotal"] <= 25 * 3


def test_a_busy_consumer_travels_as_stretches(spark):
    """Rows of one consumer fold in the tasks that read them; a pause longer than the limit parts them."""
    from tidemark.streaming.alarms import _folded

    rows = spark.range(100_000).select(F.lit("busy").alias("consumer"), (F.col("id") * 1_000_000 + F.when(F.col("id") >= 50_000, 10**12).otherwise(0)).alias("at"))
    out = rows.coalesce(1).mapInArrow(_folded(60 * 1_000_000), "consumer string, low long, high long")
    assert out.count() <= 2 * (100_000 // 10_000 + 1)
    whole = out.agg(F.min("low"), F.max("high")).first()
    assert tuple(whole) == (0, 99_999 * 1_000_000 + 10**12)
    assert out.where("high - low > 50000 * 1000000L").count() == 0


def test_a_stream_without_rows(spark, root):
    stream = stream_of(spark, root + "/in", [[]])
    assert silences(stream, "consumer", "at").columns == ["consumer", "kind", "last_progress", "at"]
    stream_silences(stream, "consumer", "at", root + "/out", root + "/state").awaitTermination()
