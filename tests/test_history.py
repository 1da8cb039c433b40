"""Exactly-once streams, digest trees, deletes, validity, versions at instants, and pages, against plain Python."""

import random
from dataclasses import replace
from datetime import timedelta

import pytest
from helpers import plan, utc
from pyspark.sql import functions as F

from tidemark import CASES, SyncOptions, TableSource, sync
from tidemark.checkpoint import HighWaterMark, to_iso
from tidemark.errors import ContractError
from tidemark.operators.changes import latest_per_key
from tidemark.operators.consumer import as_of_state, changes_since
from tidemark.operators.history import in_force, validity
from tidemark.operators.pages import pages
from tidemark.operators.quality import snapshot_diff
from tidemark.operators.ranges import deleted, narrowed, tree_diff
from tidemark.plans.commits import CommitLog
from tidemark.plans.deletes import sync_deletes, with_op
from tidemark.sources import seed
from tidemark.sources.published import read_lake
from tidemark.streaming.drain import batch_publisher, unrepeated
from tidemark.streaming.exact import ExactLog, exactly_once
from workload.queries import add_delivery

QUIET = SyncOptions(echo=False)
START = utc(2026, 1, 1)


# streams


def test_rows_repeated_in_a_batch_are_published_once(spark, root):
    source = TableSource.of(seed.cases(spark), CASES)
    publish = batch_publisher(source, root, QUIET, lambda: utc(2026, 4, 1))
    first = seed.cases(spark).where("case_id BETWEEN 101 AND 150")
    publish(first.unionByName(first.where("case_id <= 120")), 0)
    assert read_lake(spark, root, CASES).count() == 50
    late = seed.cases(spark).where("case_id BETWEEN 1 AND 10")
    publish(late.unionByName(late).unionByName(first.limit(5)), 1)
    assert read_lake(spark, root, CASES).count() == 60
    assert read_lake(spark, root, CASES).distinct().count() == 60


def test_one_content_of_a_position_is_chosen_alike(spark):
    rows = seed.cases(spark).limit(20)
    other = rows.withColumn("title", F.lit("another"))
    once = unrepeated(rows.unionByName(other), CASES)
    again = unrepeated(other.repartition(3).unionByName(rows), CASES)
    assert once.count() == 20 and once.exceptAll(again).count() == 0
    odd = rows.withColumn("case_id", F.lit(None).cast("long"))
    assert unrepeated(odd.unionByName(odd), CASES).count() == 40


def test_only_the_dates_touched_are_read(spark, root):
    source = TableSource.of(seed.cases(spark), CASES)
    sync(spark, [source], root, options=QUIET)
    dates = {"2026-03-05", "2026-03-29"}
    found = read_lake(spark, root, CASES, dates=dates)
    assert {str(r[0]) for r in found.select(F.to_date("updated_at")).distinct().collect()} == dates
    assert len(found.inputFiles()) < len(read_lake(spark, root, CASES).inputFiles())


def test_changes_pass_once_with_bounded_state(spark, tmp_path):
    path, root = f"file:{tmp_path}/in", f"file:{tmp_path}/out"
    schema = "k long, v long, big decimal(30,2), raw binary, updated_at timestamp"
    rows = [(i, None if i % 3 else 2**60 + i, None, bytes([i % 256]), START + timedelta(hours=i)) for i in range(400)]
    rows += [(None, 7, None, None, START), (None, 8, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    deliveries = [df.where("v IS NOT NULL OR k < 300"), df.where("k >= 200 OR k IS NULL"), df]
    for part in deliveries:  # the last two bring what the state has long passed, known and new
        part.unionByName(part.limit(30)).coalesce(1).write.mode("append").parquet(path)
    changes = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    query = exactly_once(changes, ["k"], root, f"file:{tmp_path}/state", keep_seconds=86_400, slots=12, buckets=2, words=64)
    query.awaitTermination()
    found = ExactLog(spark, root, changes.schema, ["k"]).rows().select(*df.columns)
    assert found.count() == len(rows) and found.exceptAll(df).count() == 0
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert kept and max(kept) <= 2 * (12 + 2)  # slots of a day and the newest instant of each bucket, not 402 identities


def test_state_has_no_more_tasks_than_its_buckets_need(spark, tmp_path):
    path, root = f"file:{tmp_path}/in", f"file:{tmp_path}/out"
    rows = spark.range(900).select(F.col("id").alias("k"), (F.lit(START) + F.make_dt_interval(hours=F.col("id"))).alias("updated_at"))
    before, progress = spark.conf.get("spark.sql.shuffle.partitions"), []
    for part in (rows.where("k % 3 > 0"), rows.unionByName(rows)):  # a delivery in several files is one batch; the state lasts
        part.repartition(3).write.mode("append").parquet(path)
        changes = spark.readStream.schema(rows.schema).parquet(path)
        query = exactly_once(changes, ["k"], root, f"file:{tmp_path}/state", keep_seconds=86_400, buckets=1)
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        query.awaitTermination()
        progress += [p for p in query.recentProgress if p["numInputRows"]]
    assert [p["numInputRows"] for p in progress] == [600, 1800]
    assert {p["stateOperators"][0]["numShufflePartitions"] for p in progress} == {6}  # of 8 that the session has
    found = ExactLog(spark, root, changes.schema, ["k"])
    assert found.rows().count() == 900 and found.rows().select(*rows.columns).exceptAll(rows).count() == 0
    names = [f for f in found.rows(None).where("_batch = 1").inputFiles() if "_batch=1" in f]
    dates = found.rows().where("_batch = 1").select("_date").distinct().count()
    assert len(names) <= 4 * dates  # late rows are placed by adapting shuffles


def test_a_delivery_has_files_by_its_size(spark, tmp_path):
    path = f"file:{tmp_path}/in"
    rows = spark.range(1_000_000).select(F.col("id").alias("event_id"), F.xxhash64("id").alias("x"))
    add_delivery(spark, rows, path)
    assert len(spark.read.parquet(path).inputFiles()) > 1 and spark.read.parquet(path).count() == 1_000_000
    add_delivery(spark, rows.limit(10), f"{path}-small")
    assert len(spark.read.parquet(f"{path}-small").inputFiles()) == 1


# digest tree


def test_tree_diff_is_the_snapshot_diff(spark):
    schema = "k long, v long, s string"
    rows = spark.range(0, 60_000).select((F.col("id") * 37).alias("k"), (F.col("id") % 11).alias("v"), F.lit(None).cast("string").alias("s"))
    rows = rows.unionByName(spark.createDataFrame([(None, 1, "x"), (None, 1, "x"), (5, 1, "x")], schema))
    actual = rows.where("k IS NULL OR k NOT BETWEEN 740000 AND 741000").withColumn("v", F.when(F.col("k") == 37 * 5000, 99).otherwise(F.col("v")))
    actual = actual.unionByName(spark.createDataFrame([(None, 1, "x"), (3_000_000, None, None)], schema))
    want, got = snapshot_diff(rows, actual), tree_diff(rows, actual, "k", enough=10, bits=5)
    assert want.count() > 20 and want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
    left, right, levels = narrowed(rows, actual, "k", enough=10, bits=5)
    assert [level.rows for level in levels] == sorted((level.rows for level in levels), reverse=True) and len(levels) > 2
    assert left.count() < 100 and right.count() < 100  # of 60,000: only differing ranges are compared
    assert tree_diff(rows, rows, "k").count() == 0 and tree_diff(rows.limit(0), rows.limit(0), "k").count() == 0


def test_deletes_are_found_published_and_dropped(spark, root):
    source = with_op(TableSource.of(seed.cases(spark), CASES))
    sync(spark, [source], root, options=QUIET)
    mark = CommitLog(spark, root).checkpoint(["cases"]).mark("cases")
    less = replace(source, frame=source.frame.where("case_id % 40 <> 0"))
    assert sync_deletes(spark, less, root, QUIET) == 5 and sync_deletes(spark, less, root, QUIET) == 0
    lake = read_lake(spark, root, source.contract)
    assert lake.where("op = 'delete'").count() == 5 and lake.count() == 205
    assert {r.case_id for r in as_of_state(lake, source.contract).collect()} == {i for i in range(1, 201) if i % 40}
    assert CommitLog(spark, root).checkpoint(["cases"]).mark("cases") == mark
    back = source.frame.where("case_id = 40").withColumn("updated_at", F.lit("2026-05-01").cast("timestamp"))
    sync(spark, [replace(source, frame=less.frame.unionByName(back))], root, options=QUIET)
    assert as_of_state(read_lake(spark, root, source.contract), source.contract).where("case_id = 40").count() == 1
    with pytest.raises(ContractError):
        sync_deletes(spark, TableSource.of(seed.cases(spark), CASES), root, QUIET)


def test_deleted_keys_do_not_depend_on_other_columns(spark):
    rows = seed.cases(spark)
    source = rows.where("case_id > 3").withColumn("title", F.lit("new"))
    assert {r.case_id for r in deleted(source, rows, CASES, enough=1, bits=2).collect()} == {1, 2, 3}


# history and pages


def log(spark, n=1200, keys=6):
    """A change log with ties, deletes and a key that holds half of it."""
    rng = random.Random(4)
    rows = []
    for seq in range(n):
        key = 0 if seq % 2 else rng.randrange(keys)
        at = START + timedelta(minutes=rng.randrange(300))
        op = "delete" if rng.random() < 0.15 else "upsert"
        rows.append((key, 1, f"t{seq}", None, "open", at, op, seq))
    schema = "case_id long, customer_id long, title string, description string, status string, updated_at timestamp, op string, seq long"
    return rows, spark.createDataFrame(rows, schema)


def winners(rows):
    """Of each key: instant, op and title of the winner of each instant, in order."""
    best = {}
    for r in rows:
        if (r[0], r[5]) not in best or best[r[0], r[5]][7] < r[7]:
            best[r[0], r[5]] = r
    out = {}
    for (key, at), r in sorted(best.items()):
        out.setdefault(key, []).append((at, r[6], r[2]))
    return out


@pytest.mark.parametrize("bin_rows", [7, 10_000])
def test_validity_with_ties_deletes_and_a_hot_key(spark, bin_rows):
    rows, df = log(spark)
    want = set()
    for key, versions in winners(rows).items():
        for i, (at, op, title) in enumerate(versions):
            if op != "delete":
                want.add((key, title, at, versions[i + 1][0] if i + 1 < len(versions) else None))
    utc_of = lambda t: t.astimezone(START.tzinfo) if t else None
    got = validity(df, CASES, bin_rows=bin_rows).collect()
    assert {(r.case_id, r.title, utc_of(r.valid_from), utc_of(r.valid_to)) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("bin_rows", [7, 10_000])
def test_versions_at_many_instants(spark, bin_rows):
    rows, df = log(spark)
    best = winners(rows)
    probes = [(key, i, START + timedelta(seconds=30 * i)) for key in range(8) for i in range(-5, 620, 3)]
    probes += [(0, -1, START + timedelta(minutes=5)), (0, -1, START + timedelta(minutes=5)), (None, 0, START), (1, 0, None)]
    got = in_force(spark.createDataFrame(probes, "case_id long, i long, at timestamp"), df, CASES, bin_rows=bin_rows).collect()

    def wanted(key, at):
        if at is None:
            return None
        past = [v for v in best.get(key, []) if v[0] <= at]
        return past[-1][2] if past and past[-1][1] != "delete" else None

    assert sorted(map(str, ((r.case_id, r.i, r.version.title if r.version else None) for r in got))) == sorted(str((k, i, wanted(k, at))) for k, i, at in probes)


def test_the_sequence_decides_ties_of_an_instant(spark):
    rows, df = log(spark, 200, 2)
    state = {r.case_id: r.title for r in latest_per_key(df.withColumn("updated_at", F.lit("2026-01-01").cast("timestamp")), CASES).collect()}
    tied = validity(df.withColumn("updated_at", F.lit("2026-01-01").cast("timestamp")), CASES).collect()
    assert {r.case_id: r.title for r in tied} == {k: t for k, t in state.items() if rows[int(t[1:])][6] != "delete"}


def test_pages_are_those_of_each_cursor(spark):
    _, df = log(spark, 700)
    df = df.select(*CASES.column_names).withColumn("case_id", F.xxhash64("title") % 1000 + 1000)
    order = [(r.updated_at, r.case_id) for r in df.orderBy("updated_at", "case_id").collect()]
    rng = random.Random(9)
    cursors = [(i, *rng.choice(order)) for i in range(25)] + [(100 + i, *order[50]) for i in range(300)]
    cursors += [(900, START.replace(tzinfo=None) - timedelta(days=9), 0), (901, order[-1][0], 10**6), (902, None, None)]
    own = spark.createDataFrame(cursors, "consumer long, cursor_at timestamp, cursor_pk long")
    found = {}
    for r in pages(df, own, CASES, 7).collect():
        found.setdefault(r.consumer, []).append((r.position, r.updated_at, r.case_id))
    for consumer, at, pk in cursors:
        want = [x for x in order if at is None or x > (at, pk)][:7]
        assert sorted(found.get(consumer, [])) == [(i, *x) for i, x in enumerate(want, 1)], consumer
    some = cursors[3]
    mark = HighWaterMark(to_iso(some[1].replace(tzinfo=START.tzinfo)), some[2])
    assert [r.case_id for r in changes_since(df, CASES, mark, 7).collect()] == [x[2] for x in sorted(found[some[0]])]
    assert "CartesianProduct" not in plan(pages(df, own, CASES, 7)) and pages(df, own.limit(0), CASES, 7).count() == 0
