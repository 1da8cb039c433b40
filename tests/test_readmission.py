"""Rows set aside are stored once, told of while they last, and published once when mended."""

from collections import Counter

from helpers import plan, sync, utc
from pyspark.sql import functions as F

from tidemark import CASES, CUSTOMERS, SyncOptions, TableSource
from tidemark.plans.maintenance import expire
from tidemark.plans.readmission import mended, readmit
from tidemark.sources import seed
from tidemark.sources.published import read_lake, read_open, read_quarantine, set_aside_log

OPTIONS = SyncOptions(echo=False, quarantine=True)


def source(spark, lost=(), keyless=(), negative=()):
    """The cases, some of which have lost their instant or key."""
    rows = seed.cases(spark)
    at, key = F.col("case_id").isin(*lost) if lost else F.lit(False), F.col("case_id")
    key = F.when(key.isin(*negative), -key - 1).otherwise(key) if negative else key
    key = F.when(~F.col("case_id").isin(*keyless), key) if keyless else key
    rows = rows.withColumn("updated_at", F.when(~at, F.col("updated_at"))).withColumn("case_id", key)
    return TableSource.of(rows.select(*CASES.column_names), CASES)


def run(spark, root, rows, day):
    return sync(spark, [rows], root, options=OPTIONS, clock=lambda: utc(2026, 8, day)).table("cases").delta_row_count


def opened(spark, root):
    return {(r.case_id, r.quarantine_reason, r.copies, r.first_seen.day, r.last_seen.day) for r in read_open(spark, root, CASES).collect()}


def test_three_runs_then_two_mended(spark, root):
    bad = dict(lost=(3, 4, 5), keyless=(6,), negative=(7,))
    assert run(spark, root, source(spark, **bad), 1) == 195
    assert [run(spark, root, source(spark, **bad), day) for day in (2, 3)] == [0, 0]
    assert read_quarantine(spark, root, CASES).count() == set_aside_log(spark, root, CASES).count() == 5
    reasons = Counter((x[1], *x[2:]) for x in opened(spark, root))
    assert reasons == {("updated_at is missing", 1, 1, 3): 3, ("key is missing", 1, 1, 3): 1, ("key is negative", 1, 1, 1): 1}
    # Two are mended, with instants behind the mark: a run does not pick them up, but sees that one which comes back stays away.
    better = source(spark, lost=(4, 5), keyless=(6,))
    assert run(spark, root, better, 4) == 0
    assert {x[1] for x in opened(spark, root)} == {"updated_at is missing", "key is missing", "key is negative"} and len(opened(spark, root)) == 4
    again = lambda day: readmit(spark, better, root, OPTIONS, clock=lambda: utc(2026, 8, day))
    assert (again(5), again(6)) == (2, 0)
    assert Counter(x[1:] for x in opened(spark, root)) == {("updated_at is missing", 1, 1, 6): 2, ("key is missing", 1, 1, 6): 1}
    lake = read_lake(spark, root, CASES)
    assert lake.count() == 197 and lake.select("case_id").distinct().count() == 197
    sound = seed.cases(spark).where("case_id NOT IN (4, 5, 6)").select(*CASES.column_names)
    assert sound.exceptAll(lake.select(*CASES.column_names)).count() == 0
    # All mended.
    assert readmit(spark, source(spark), root, OPTIONS) == 3 and read_lake(spark, root, CASES).count() == 200
    assert opened(spark, root) == set() and read_quarantine(spark, root, CASES).count() == 5
    assert run(spark, root, source(spark), 7) == 0


def test_mended_rows_past_the_mark_are_left_to_the_run(spark, root):
    middle = seed.cases(spark).select(F.percentile_approx("updated_at", 0.5)).first()[0]
    newest = seed.cases(spark).orderBy(F.desc("updated_at")).first().case_id
    early = source(spark, lost=(newest,)).frame.where(F.col("updated_at").isNull() | (F.col("updated_at") < middle))
    run(spark, root, TableSource.of(early, CASES), 1)
    first = read_lake(spark, root, CASES).count()
    assert readmit(spark, source(spark), root, OPTIONS) == 0 and read_lake(spark, root, CASES).count() == first
    assert opened(spark, root) == set()
    assert run(spark, root, source(spark), 2) == 200 - first
    assert readmit(spark, source(spark), root, OPTIONS) == 0


def test_late_rows_are_not_admitted_and_gone_rows_close(spark, root):
    early = source(spark, lost=(9,)).frame.where("case_id IS NOT NULL AND case_id <> 20")
    run(spark, root, TableSource.of(early, CASES), 1)
    whole = source(spark).frame.where("case_id <> 9")  # 20 comes late, 9 is gone
    assert readmit(spark, TableSource.of(whole, CASES), root, OPTIONS) == 0
    assert read_lake(spark, root, CASES).count() == 198 and opened(spark, root) == set()


def test_equal_rows_are_folded(spark, root):
    row = seed.cases(spark).where("case_id = 1").withColumn("updated_at", F.lit(None).cast("timestamp")).select(*CASES.column_names)
    many = TableSource.of(row.crossJoin(spark.range(70_000)).select(*CASES.column_names), CASES)
    run(spark, root, many, 1)
    assert set_aside_log(spark, root, CASES).count() == 1 and read_quarantine(spark, root, CASES).count() == 70_000
    fewer = TableSource.of(many.frame.limit(3), CASES)
    run(spark, root, fewer, 2)
    assert {x[2:] for x in opened(spark, root)} == {(3, 1, 2)}
    expire(spark, root, now=utc(2027, 8, 4))
    assert {x[2:] for x in opened(spark, root)} == {(3, 1, 2)}


def test_nothing_set_aside(spark, root):
    assert read_open(spark, root, CUSTOMERS).count() == 0
    run(spark, root, source(spark), 1)
    assert readmit(spark, source(spark), root, OPTIONS) == 0 and read_open(spark, root, CASES).count() == 0


def test_mended_rows_are_found_by_flat_hashes(spark):
    rows, lost = seed.cases(spark), F.lit(None).cast("timestamp")
    aside = [rows.where("case_id = 3").withColumn("updated_at", lost), rows.where("case_id = 4").withColumn("case_id", F.lit(-9).cast("bigint"))]
    aside.append(rows.where("case_id = 5").withColumn("updated_at", lost).withColumn("case_id", F.lit(None).cast("bigint")))
    aside = aside[0].unionByName(aside[1]).unionByName(aside[2]).select(*CASES.column_names)
    found = mended(rows.unionByName(rows.where("case_id = 3")), aside.unionByName(aside), CASES)
    assert found.columns == rows.columns and Counter(r.case_id for r in found.collect()) == {3: 2, 4: 1, 5: 1}
    assert mended(rows, aside.limit(0), CASES).count() == 0
    joins = [line for line in plan(found, "simple").splitlines() if "LeftSemi" in line]
    assert joins and all("_high" in line and "_payload" not in line for line in joins)  # numbers, sorted by the first
