"""Sketches against exact ranks and counts; streamed windows against the batch."""

import random
from collections import Counter
from datetime import timedelta

from helpers import utc
from pyspark.sql import functions as F

from tidemark import CASES, SyncOptions, TableSource, sync
from tidemark.checkpoint import HighWaterMark
from tidemark.operators.delta import upto
from tidemark.operators.quality import microbatch_windows
from tidemark.operators.sketches import lag_quantile, lag_sketches, noisy_tenants, rank_error, read_lags, tenant_panes, update_lags
from tidemark.sources import seed
from tidemark.streaming.windows import WindowLog

QUIET = SyncOptions(echo=False)
START = utc(2026, 1, 1)


def test_merged_sketches_keep_to_the_rank_bound(spark):
    rows = spark.range(40_000).select(
        (F.col("id") % 40).alias("part"), F.lit(START).alias("updated_at"),
        (F.lit(START) + F.make_dt_interval(secs=F.pmod(F.xxhash64("id"), F.lit(90_000)))).alias("committed_at"),
    )
    sketches = lag_sketches(rows, "part")
    lags = sorted(r[0] for r in rows.select(F.unix_seconds("committed_at") - F.unix_seconds("updated_at")).collect())
    for quantile in (0.05, 0.5, 0.95):
        found = lag_quantile(sketches, quantile=quantile).first()
        below = sum(x < found.lag_seconds for x in lags) / len(lags)
        upto_it = sum(x <= found.lag_seconds for x in lags) / len(lags)
        assert found.row_count == len(lags) and below <= quantile + rank_error() and upto_it >= quantile - rank_error()
    few = lag_quantile(lag_sketches(rows.where("part = 3").limit(100), "part"), "part").first()
    assert few.row_count == 100  # exact below the sketch's size
    assert lag_quantile(lag_sketches(rows.limit(0), "part"), "part").count() == 0


def test_each_run_is_sketched_once(spark, root, tmp_path):
    path, cut = f"file:{tmp_path}/lags", HighWaterMark("2026-03-15T16:48:00Z", 50)
    cases = seed.cases(spark)
    for n, rows in enumerate((cases.where(upto(cut, "case_id")), cases), 1):
        sync(spark, [TableSource.of(rows, CASES)], root, options=QUIET, clock=lambda n=n: utc(2026, 4, n))
        found = update_lags(spark, root, CASES, path)
        assert found.count() == n
    files = sorted(read_lags(spark, path).inputFiles())
    assert update_lags(spark, root, CASES, path).count() == 2 and sorted(read_lags(spark, path).inputFiles()) == files
    day = lag_quantile(read_lags(spark, path).where("committed_at >= '2026-04-02'"), "table", quantile=1.0).first()
    late = cases.where(~upto(cut, "case_id"))
    oldest = late.agg(F.min("updated_at")).first()[0]
    assert day.row_count == late.count() and day.lag_seconds == int((utc(2026, 4, 2) - oldest.replace(tzinfo=START.tzinfo)).total_seconds())


def test_every_noisy_tenant_is_found_within_the_bound(spark):
    rng = random.Random(2)
    rows = [(f"t{int(rng.paretovariate(0.6)) % 5000}", START + timedelta(hours=rng.randrange(24 * 12))) for _ in range(30_000)]
    df = spark.createDataFrame([*rows, (None, START), ("t1", None)], "tenant string, updated_at timestamp")
    panes = tenant_panes(df, "tenant", tracked=500)
    found = noisy_tenants(panes, "tenant", span=3, share=0.02, tracked=500).collect()
    got = {(r.window_end.replace(tzinfo=START.tzinfo), r.tenant): r for r in found}
    for end in range(1, 13):
        last = START + timedelta(days=end)
        own = Counter(t for t, at in rows if last - timedelta(days=3) <= at < last)
        total = sum(own.values())
        for tenant, n in own.items():
            r = got.get((last, tenant))
            assert r is not None or n < 0.02 * total
            if r is not None:
                assert r.rows == total and n <= r.estimate <= n + r.overcount and r.estimate >= 0.02 * total


def windows_of(df):
    return Counter(tuple(r) for r in df.select("window_start", "row_count", "lane0", "lane1", "lane2", "lane3").collect())


def test_streamed_windows_are_those_of_the_batch(spark, root):
    cases = seed.cases(spark)
    log = WindowLog(spark, root, CASES, width=86_400, delay=2 * 86_400)
    order = [cases.where("updated_at < '2026-03-12'"), cases.where("updated_at >= '2026-03-10' AND updated_at < '2026-03-20' AND case_id % 3 = 0")]
    order += [cases.where("updated_at >= '2026-03-12' AND case_id % 3 > 0"), cases.where("updated_at < '2026-03-05'").limit(7)]
    for n, part in enumerate(order):
        log.commit(part, n)
        again = windows_of(log.closed()), log.late().count()
        log.commit(part, n)  # a batch that is run again
        assert (windows_of(log.closed()), log.late().count()) == again
        assert log.open(n).count() <= 30 and max(log.closed().groupBy("window_start").count().select("count").collect(), default=[1])[0] == 1
    everything = order[0]
    for part in order[1:]:
        everything = everything.unionByName(part)
    assert log.late().count() >= 7
    assert windows_of(log.whole(len(order) - 1)) == windows_of(microbatch_windows(everything, CASES, "86400 seconds"))
    # A window once published does not change.
    late = log.late().select(F.window("updated_at", "86400 seconds")["start"].alias("w")).distinct()
    ontime = microbatch_windows(everything.exceptAll(log.late()), CASES, "86400 seconds")
    assert log.closed().join(late, F.col("window_start") == F.col("w"), "left_semi").exceptAll(ontime).count() == 0


def test_a_stream_without_rows(spark, root):
    log = WindowLog(spark, root, CASES)
    log.commit(seed.cases(spark).limit(0), 0)
    assert log.closed().count() == log.open(0).count() == log.late().count() == 0 and log.newest(0) is None
