from helpers import files, local, utc
from pyspark.sql import functions as F

from tidemark import CASES, CUSTOMERS, Checkpoint, HighWaterMark, SyncOptions, TableSource, sync
from tidemark.operators.delta import upto
from tidemark.operators.quality import late_rows, read_late_rows
from tidemark.plans.commits import CommitLog
from tidemark.sources import seed
from tidemark.sources.published import read_lake, read_share
from tidemark.streaming.cdc import deduplicate
from tidemark.streaming.drain import batch_publisher, drain, drain_all, stream_sync, unpublished

QUIET = SyncOptions(echo=False)


def case_stream(spark, path):
    return TableSource.of(spark.readStream.schema(CASES.schema).parquet(path), CASES)


def test_stream_equals_batch(spark, tmp_path):
    path, cut = f"file:{tmp_path}/in", HighWaterMark("2026-03-15T16:48:00Z", 50)
    early = seed.cases(spark).where(upto(cut, "case_id"))
    late = seed.cases(spark).where(~upto(cut, "case_id"))
    streamed, batched, state = (f"file:{tmp_path}/{n}" for n in ("streamed", "batched", "state"))
    ids = []
    for part in (early, late):
        part.coalesce(1).write.mode("append").parquet(path)
        drain(case_stream(spark, path), streamed, state, options=QUIET)
        ids.append(CommitLog(spark, streamed).latest().run_id)
    wanted = [
        sync(spark, [TableSource.of(rows, CASES)], batched).run_id for rows in (early, seed.cases(spark))
    ]
    assert ids == wanted
    a, b = read_lake(spark, streamed, CASES), read_lake(spark, batched, CASES)
    assert a.exceptAll(b).count() == 0 and a.count() == b.count() == 200
    assert read_share(spark, streamed, CASES).count() == 101
    drain(case_stream(spark, path), streamed, state, options=QUIET)
    assert CommitLog(spark, streamed).latest().seq == 2


def test_batch_delivered_again_is_skipped(spark, root):
    source = TableSource.of(seed.cases(spark), CASES)
    publish = batch_publisher(source, root, QUIET, lambda: utc(2026, 4, 1))
    publish(source.frame, 0)
    written = files(root)
    publish(source.frame, 0)
    assert files(root) == written
    publish(source.frame, 1)
    last = CommitLog(spark, root).latest()
    assert last.seq == 2 and last.tables[0]["delta_row_count"] == 0
    assert last.origin == {"streams": {"cases": {"query": None, "batch": 1}}}


def test_batch_interrupted_when_ready_is_not_repeated(spark, root, monkeypatch):
    from tidemark.plans.commits import Claim

    source = TableSource.of(seed.cases(spark), CASES)
    publish = batch_publisher(source, root, QUIET, lambda: utc(2026, 4, 1))

    def die(self):
        raise InterruptedError

    monkeypatch.setattr(Claim, "commit", die)
    try:
        publish(source.frame, 0)
    except InterruptedError:
        pass
    monkeypatch.undo()
    publish(source.frame, 0)
    assert [c.seq for c in CommitLog(spark, root).history()] == [1]
    assert read_lake(spark, root, CASES).count() == 200


def test_late_rows_are_passed_over_and_reported(spark, root):
    rows = seed.cases(spark)
    sync(spark, [TableSource.of(rows.where("case_id <> 7"), CASES)], root)
    manifest = sync(spark, [TableSource.of(rows, CASES)], root)
    assert manifest.table("cases").delta_row_count == 0
    mark = Checkpoint.parse(manifest.checkpoint_after).mark("cases")
    found = late_rows(rows, read_lake(spark, root, CASES), CASES, upto(mark, "case_id"))
    assert [r.case_id for r in found.collect()] == [7]
    assert [r.case_id for r in read_late_rows(TableSource.of(rows, CASES), root).collect()] == [7]


def test_stream_deduplication(spark, tmp_path):
    path = f"file:{tmp_path}/cdc"
    rows = seed.cases(spark).select(F.lit("cases").alias("table"), "case_id", F.col("case_id").alias("lsn"), "updated_at")
    rows.unionByName(rows).coalesce(1).write.parquet(path)
    assert deduplicate(spark.read.parquet(path), "case_id").count() == 200
    stream = spark.readStream.schema(rows.schema).parquet(path)
    out = f"file:{tmp_path}/out"
    query = (
        deduplicate(stream, "case_id", within="60 days")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"file:{tmp_path}/state")
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    assert spark.read.parquet(out).count() == 200
    assert local(out).exists()


def test_continuous_windows(spark, tmp_path):
    path, root = f"file:{tmp_path}/in", f"file:{tmp_path}/out"
    rows = seed.cases(spark)
    rows.where("case_id <= 0").coalesce(1).write.parquet(path)
    query = stream_sync(case_stream(spark, path), root, f"file:{tmp_path}/state", every="1 second", options=QUIET)
    try:
        for day in ("2026-03-05", "2026-03-20"):
            cut = F.lit(day).cast("timestamp")
            seen = rows.where((F.col("updated_at") < cut) & (F.col("updated_at") >= F.date_sub(cut, 4 if day < "2026-03-10" else 15)))
            seen.coalesce(1).write.mode("append").parquet(path)
            query.processAllAvailable()
    finally:
        query.stop()
    assert read_lake(spark, root, CASES).count() == rows.where("updated_at < '2026-03-20'").count()
    assert [c.tables[0]["delta_row_count"] > 0 for c in CommitLog(spark, root).history()].count(True) == 2


def test_several_tables_drain_into_one_log(spark, tmp_path):
    root, state = f"file:{tmp_path}/out", f"file:{tmp_path}/state"
    streams = []
    for contract, rows in ((CUSTOMERS, seed.customers(spark)), (CASES, seed.cases(spark))):
        path = f"file:{tmp_path}/{contract.name}"
        rows.coalesce(1).write.parquet(path)
        streams.append(TableSource.of(spark.readStream.schema(contract.schema).parquet(path), contract))
    drain_all(streams, root, state, options=QUIET)
    last = CommitLog(spark, root).latest()
    assert last.checkpoint_after == {
        "cases": {"last_pk": 200, "updated_at": "2026-03-30T16:48:00Z"},
        "customers": {"last_pk": 30, "updated_at": "2026-03-30T00:00:00Z"},
    }
    assert {name: of["batch"] for name, of in last.origin["streams"].items()} == {"customers": 0, "cases": 0}
    assert read_share(spark, root, CUSTOMERS).count() == 30 and read_lake(spark, root, CASES).count() == 200


def test_drain_takes_files_in_any_order_and_survives_a_lost_state(spark, tmp_path):
    path, root = f"file:{tmp_path}/in", f"file:{tmp_path}/out"
    rows = seed.cases(spark)
    newest = rows.where("updated_at >= '2026-03-15'")
    for part in (newest, rows.exceptAll(newest).where("case_id % 2 = 0"), rows.exceptAll(newest).where("case_id % 2 = 1")):
        part.coalesce(1).write.mode("append").parquet(path)
    stream = TableSource.of(spark.readStream.schema(CASES.schema).option("maxFilesPerTrigger", 1).parquet(path), CASES)
    drain(stream, root, f"file:{tmp_path}/state", options=QUIET)
    assert read_lake(spark, root, CASES).exceptAll(rows).count() == 0
    assert read_lake(spark, root, CASES).count() == rows.count()
    mark = CommitLog(spark, root).latest().after.mark("cases")
    later = rows.limit(3).withColumn("case_id", F.col("case_id") + 1000)
    later.coalesce(1).write.mode("append").parquet(path)
    drain(stream, root, f"file:{tmp_path}/another", options=QUIET)
    assert read_lake(spark, root, CASES).count() == rows.count() + 3
    assert CommitLog(spark, root).latest().after.mark("cases") == mark


def test_stream_deduplication_keeps_late_rows(spark, tmp_path):
    path, out = f"file:{tmp_path}/cdc", f"file:{tmp_path}/out"
    rows = seed.cases(spark).select(F.lit("cases").alias("table"), "case_id", F.col("case_id").alias("lsn"), "updated_at")
    rows.where("updated_at >= '2026-03-15'").coalesce(1).write.parquet(path)
    rows.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    query = deduplicate(stream, "case_id").writeStream.format("parquet").option("checkpointLocation", f"file:{tmp_path}/state")
    query.trigger(availableNow=True).start(out).awaitTermination()
    assert spark.read.parquet(out).count() == 200


def test_a_batch_is_sorted_once_into_a_copy(spark, root, tmp_path):
    sync(spark, [TableSource.of(seed.cases(spark).where("case_id <= 150"), CASES)], root, options=QUIET)
    mark = CommitLog(spark, root).latest().after.mark("cases")
    rows = seed.cases(spark)
    rows.unionByName(rows).write.parquet(f"file:{tmp_path}/batch")
    batch = spark.read.schema(CASES.schema).parquet(f"file:{tmp_path}/batch")
    new = unpublished(batch, root, CASES, mark)
    assert not set(new.inputFiles()) & set(batch.inputFiles())
    assert sorted(r.case_id for r in new.collect()) == list(range(151, 201))
