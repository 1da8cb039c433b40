import json

import pytest
from helpers import FIRST_RUN, NO_OP_RUN, SECOND_RUN, changed, files, lines, local, one_more_customer, seeded, sources, sync, utc
from pyspark.sql import functions as F

from tidemark import CASES, CUSTOMERS, Checkpoint, Contract, HighWaterMark, SyncOptions, TableSource
from tidemark.errors import ContractError, IncompatibleSchema, SourceError
from tidemark.functions.canonical import canonical_text
from tidemark.operators.consumer import next_cursor, read_as_of, read_changes_since
from tidemark.plans.commits import CommitLog, seed_checkpoint
from tidemark.plans.maintenance import expire
from tidemark.plans.publish import output_lines, range_tasks
from tidemark.sources import seed
from tidemark.sources.published import last_date_of_page, read_events, read_lake, read_quarantine, read_share


def test_first_run_then_no_op_then_changes(spark, root):
    first = sync(spark, seeded(spark), root)
    assert first.run_id == FIRST_RUN
    assert [(t.table, t.delta_row_count, len(t.lake_paths)) for t in first.tables] == [("customers", 30, 30), ("cases", 200, 30)]
    assert first.checkpoint_before["cases"] == {"last_pk": 0, "updated_at": "0001-01-01T00:00:00Z"}
    assert first.checkpoint_after == {
        "cases": {"last_pk": 200, "updated_at": "2026-03-30T16:48:00Z"},
        "customers": {"last_pk": 30, "updated_at": "2026-03-30T00:00:00Z"},
    }
    outputs = {k: v for k, v in files(root).items() if "/output=" in k}

    idle = sync(spark, seeded(spark), root)
    assert idle.run_id == NO_OP_RUN
    assert [(t.delta_row_count, t.lake_paths, t.share_path) for t in idle.tables] == [(0, [], None), (0, [], None)]
    assert idle.checkpoint_after == first.checkpoint_after
    assert {k: v for k, v in files(root).items() if "/output=" in k} == outputs
    events = files(root)
    assert sync(spark, seeded(spark), root).run_id == NO_OP_RUN
    assert files(root).items() >= {k: v for k, v in events.items() if k.startswith("events/")}.items()

    second = sync(spark, changed(spark), root)
    assert second.run_id == SECOND_RUN
    assert [t.delta_row_count for t in second.tables] == [2, 15]
    assert second.checkpoint_after == {
        "cases": {"last_pk": 210, "updated_at": "2026-04-15T12:00:00Z"},
        "customers": {"last_pk": 32, "updated_at": "2026-04-15T12:00:00Z"},
    }
    assert lines(second.table("customers").lake_paths[0])[0] == (
        '{"country":"US","customer_id":31,"email":"customer031@example.com","name":"Customer 031",'
        '"updated_at":"2026-04-15T12:00:00Z"}'
    )
    assert files(root).items() >= outputs.items()
    assert json.loads((local(root) / "state/checkpoint.json").read_text()) == second.checkpoint_after
    assert read_lake(spark, root, CASES).count() == 215
    assert [r.case_id for r in read_share(spark, root, CASES).collect()] == [1, 50, 100, 150, 200, *range(201, 211)]
    assert read_events(spark, root).groupBy("run_id").count().count() == 3


def test_share_lines_are_canonical_envelopes(spark, root):
    manifest = sync(spark, changed(spark), root)
    for line in lines(manifest.table("cases").share_path):
        record = json.loads(line)
        assert canonical_text(record) == line
        assert set(record) == {
            "case_id", "checkpoint_after", "op", "record", "run_id", "schema_fingerprint", "table", "updated_at",
        }
        assert record["checkpoint_after"] == manifest.checkpoint_after
        assert record["run_id"] == manifest.run_id and record["op"] == "upsert"
        assert set(record["record"]) == set(CASES.column_names)


def test_dry_run_predicts_and_writes_nothing(spark, root):
    dry = sync(spark, seeded(spark), root, dry_run=True)
    assert files(root) == {}
    real = sync(spark, seeded(spark), root)
    assert (dry.run_id, dry.tables, dry.checkpoint_after) == (real.run_id, real.tables, real.checkpoint_after)
    assert dry.dry_run and not real.dry_run
    assert all(local(p).is_dir() for t in real.tables for p in t.lake_paths)
    written = files(root)
    again = sync(spark, changed(spark), root, dry_run=True)
    assert again.run_id == SECOND_RUN and files(root) == written


def test_share_of_an_unchanged_table_stays(spark, root):
    first = sync(spark, seeded(spark), root)
    share = {k: v for k, v in files(root).items() if k.startswith("cases/output=share")}
    manifest = sync(spark, one_more_customer(spark), root)
    assert manifest.table("customers").delta_row_count == 1
    assert manifest.table("cases").share_path is None and manifest.table("cases").lake_paths == []
    assert {k: v for k, v in files(root).items() if k.startswith("cases/output=share")} == share
    assert read_share(spark, root, CASES).select("run_id").distinct().first().run_id == first.run_id
    event = read_events(spark, root).where(f"run_id = '{manifest.run_id}' AND table = 'cases'").first()
    assert (event.delta_row_count, event.lake_paths, event.share_path) == (0, [], None)


def test_starting_marks(spark, root):
    seed_checkpoint(spark, root, Checkpoint({"cases": HighWaterMark("2026-03-15T16:48:00Z", 50)}), utc(2026, 4, 1))
    manifest = sync(spark, seeded(spark), root)
    assert manifest.table("cases").delta_row_count == 101
    assert [r.case_id for r in read_share(spark, root, CASES).collect()][:5] == [150, 51, 151, 52, 152]


@pytest.mark.parametrize("identity", ["exact", "lanes"])
def test_ids_and_bytes_do_not_depend_on_layout(spark, tmp_path, identity):
    options = SyncOptions(identity=identity, echo=False)
    seen = []
    for i, parts in enumerate((1, 8)):
        shuffled = sources(
            seed.customers(spark).repartition(parts, F.rand(i)), seed.cases(spark).repartition(parts, F.rand(i))
        )
        run = sync(spark, shuffled, f"file:{tmp_path}/{i}", options=SyncOptions(identity=identity, echo=False, small_task_rows=20 + 80 * i))
        text = [line for t in run.tables for p in [*t.lake_paths, t.share_path] for line in lines(p)]
        seen.append((run.run_id, run.checkpoint_after, text))
    assert seen[0] == seen[1]
    assert (seen[0][0] == FIRST_RUN) == (options.identity == "exact")


def test_exact_ids_refuse_large_deltas(spark, root):
    with pytest.raises(ContractError, match="exact_limit"):
        sync(spark, seeded(spark), root, options=SyncOptions(identity="exact", exact_limit=229, echo=False))
    ids = {sync(spark, seeded(spark), root, dry_run=True, options=SyncOptions(exact_limit=n, echo=False)).run_id for n in (1, 229, 230)}
    assert len(ids) == 1 and FIRST_RUN not in ids


def test_invalid_rows_stop_the_run(spark, root):
    broken = seed.customers(spark).withColumn("customer_id", F.col("customer_id") - 5)
    with pytest.raises(ContractError, match="4 rows"):
        sync(spark, sources(broken, seed.cases(spark)), root)
    assert CommitLog(spark, root).latest() is None
    assert sync(spark, seeded(spark), root).run_id == FIRST_RUN


def test_events_are_echoed_in_table_order(spark, root, capsys):
    sync(spark, seeded(spark), root, options=SyncOptions())
    shown = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert [e["table"] for e in shown] == ["customers", "cases"]


def test_compressed_outputs_read_back(spark, root):
    manifest = sync(spark, seeded(spark), root, options=SyncOptions(compression="gzip", echo=False))
    assert all(f.name.endswith(".gz") for f in local(manifest.table("cases").share_path).glob("part-*"))
    assert read_lake(spark, root, CASES).exceptAll(seed.cases(spark)).count() == 0


def test_one_hot_instant_is_split(spark, root):
    """All rows at one instant still spread over tasks, and stay in order."""
    hot = spark.range(0, 40_000, numPartitions=4).select(
        F.col("id").alias("customer_id"), F.lit("n").alias("name"), F.lit("e").alias("email"), F.lit("US").alias("country"),
        F.lit("2026-04-15T12:00:00Z").cast("timestamp").alias("updated_at"),
    )
    options = SyncOptions(identity="lanes", echo=False, small_task_rows=5_000)
    manifest = sync(spark, sources(hot, seed.cases(spark)), root, options=options)
    path = manifest.table("customers").lake_paths[0]
    sizes = [len(p.read_text().splitlines()) for p in sorted(local(path).glob("part-*"))]
    assert len(sizes) >= 4 and max(sizes) < 20_000
    assert [json.loads(line)["customer_id"] for line in lines(path)] == list(range(40_000))


def test_one_shuffle_per_table(spark, root):
    from helpers import plan

    rows = seed.cases(spark)
    shown = plan(output_lines(rows, CASES, "r", Checkpoint({"cases": HighWaterMark()}), 4), "simple")
    assert shown.count("Exchange") == 1 and "rangepartitioning" in shown
    small = plan(output_lines(rows, CASES, "r", Checkpoint({"cases": HighWaterMark()}), 1), "simple")
    assert small.count("Exchange") == 1 and "Coalesce" not in small  # a scan keeps its own tasks
    assert range_tasks(0, 1) == 1 and range_tasks(10 << 30, 1) == 160 and range_tasks(1 << 50, 1) == 1 << 24


def test_paging_through_the_lake(spark, root):
    sync(spark, seeded(spark), root)
    sync(spark, changed(spark), root)
    cursor, seen = HighWaterMark(), []
    while True:
        page = read_changes_since(spark, root, CASES, cursor, page=60)
        ids = [(r.updated_at, r.case_id) for r in page.collect()]
        seen += ids
        moved = next_cursor(page, CASES, cursor)
        if moved == cursor:
            break
        cursor = moved
    assert len(seen) == 215 and seen == sorted(seen)


def test_state_as_of_commits(spark, root):
    sync(spark, seeded(spark), root, clock=lambda: utc(2026, 4, 1))
    sync(spark, changed(spark), root, clock=lambda: utc(2026, 4, 16))
    now = read_as_of(spark, root, CASES)
    assert now.exceptAll(changed(spark)[1].frame).count() == 0 and now.count() == 210
    for then in (read_as_of(spark, root, CASES, seq=1), read_as_of(spark, root, CASES, at=utc(2026, 4, 2))):
        assert then.count() == 200 and then.exceptAll(seed.cases(spark)).count() == 0
    with pytest.raises(ContractError):
        read_as_of(spark, root, CASES, at=utc(2026, 3, 1))


def test_relative_roots_are_rejected(spark):
    with pytest.raises(ContractError):
        sync(spark, seeded(spark), "out")


def test_nothing_published_yet(spark, root):
    assert read_lake(spark, root, CUSTOMERS).collect() == []
    assert read_share(spark, root, CUSTOMERS).collect() == []
    assert read_events(spark, root).collect() == []
    assert CommitLog(spark, root).checkpoint(["customers"]).mark("customers") == HighWaterMark()
    assert files(root) == {}


def diary(spark, shift=0):
    rows = spark.range(1, 400).selectExpr(
        f"id + {shift} AS entry_id",
        "CAST(TIMESTAMP '2026-01-01T00:00:00Z' + make_dt_interval(0, id % 240) AS DATE) AS date",
        "concat('o', id) AS output",
        f"TIMESTAMP '2026-01-01T00:00:00Z' + make_dt_interval({shift}, id % 240) AS updated_at",
    )
    return TableSource.of(rows.repartition(5, "output"), DIARY)


DIARY = Contract(
    "diary", "entry_id", (("entry_id", "bigint"), ("date", "date"), ("output", "text"), ("updated_at", "timestamptz"))
)


def test_columns_named_like_partitions(spark, root):
    source = diary(spark)
    manifest = sync(spark, [source], root, options=SyncOptions(echo=False, small_task_rows=100))
    assert read_lake(spark, root, DIARY).exceptAll(source.frame).count() == 0
    for path in [*manifest.tables[0].lake_paths, manifest.tables[0].share_path]:
        keys = [(r["updated_at"], r["entry_id"]) for r in map(json.loads, lines(path))]
        assert keys == sorted(keys) and keys
    with pytest.raises(ContractError, match="date"):
        sync(spark, [diary(spark, 1000)], root, options=SyncOptions(echo=False, lake_format="parquet"))


def test_lake_of_lines_and_columns(spark, root):
    columnar = SyncOptions(identity="exact", echo=False, lake_format="parquet")
    first = sync(spark, seeded(spark), root, options=columnar)
    assert first.run_id == FIRST_RUN
    assert sync(spark, changed(spark), root).run_id == SECOND_RUN
    rows = read_lake(spark, root, CASES, with_run=True)
    assert rows.where(f"run_id = '{FIRST_RUN}'").drop("run_id").exceptAll(seed.cases(spark)).count() == 0
    assert rows.count() == 215
    assert read_share(spark, root, CUSTOMERS).count() == 2
    from helpers import plan

    narrow = read_lake(spark, root, CASES, last_date="2026-03-30").where("case_id = 7").select("updated_at")
    assert "PushedFilters: [IsNotNull(case_id), EqualTo(case_id,7)]" in plan(narrow)
    assert "ReadSchema: struct<case_id:bigint,updated_at:timestamp>" in plan(narrow)
    with pytest.raises(ContractError):
        SyncOptions(lake_format="avro")

    import pyarrow.parquet as pq

    for path in first.table("cases").lake_paths:
        for part in local(path).glob("part-*"):
            meta = pq.ParquetFile(part).metadata
            column = next(meta.row_group(0).column(i) for i in range(meta.num_columns) if meta.schema.names[i] == "updated_at")
            assert column.physical_type == "INT64" and column.statistics.has_min_max
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == "INT96"


def test_pages_read_only_the_dates_they_need(spark, root):
    sync(spark, seeded(spark), root)
    sync(spark, changed(spark), root)
    leaves = CommitLog(spark, root).live_leaves()
    assert sum(n for part in leaves["cases"].values() for n in part["dates"].values()) == 215
    assert last_date_of_page(leaves, CASES, "2026-03-10", 1) == "2026-03-11"
    assert last_date_of_page(leaves, CASES, "2026-03-10", 20) == "2026-03-13"
    assert last_date_of_page(leaves, CASES, "2026-03-10", 10_000) is None


def test_submitted_job_prints_the_manifest(spark, tmp_path, capsys):
    from tidemark.__main__ import main

    for name, rows in (("customers", seed.customers(spark)), ("cases", seed.cases(spark))):
        rows.write.orc(f"file:{tmp_path}/{name}")
    given = ["--root", f"file:{tmp_path}/out", "--format", "orc", "--identity", "exact"]
    given += ["--customers", f"file:{tmp_path}/customers", "--cases", f"file:{tmp_path}/cases"]
    assert main([*given, "--dry-run"]).run_id == FIRST_RUN
    assert not (tmp_path / "out" / "state" / "commits").exists()
    capsys.readouterr()
    main(given)
    out = capsys.readouterr().out
    shown = json.loads(out[out.index("{\n") :])
    assert shown["run_id"] == FIRST_RUN and not shown["dry_run"]
    assert [t["delta_row_count"] for t in shown["tables"]] == [30, 200]
    assert set(shown["tables"][0]) == {"table", "delta_row_count", "lake_paths", "share_path", "schema_fingerprint"}


def test_a_broken_mirror_does_not_fail_the_run(spark, root, monkeypatch):
    class Broken:
        def write(self, text):
            raise OSError("gone")

    monkeypatch.setattr("tidemark.plans.sync.sys", type("S", (), {"stdout": Broken()}))
    assert sync(spark, seeded(spark), root, options=SyncOptions(identity="exact")).run_id == FIRST_RUN


def test_freshness_of_what_was_published(spark, root):
    from tidemark.operators.quality import freshness, publication_times

    sync(spark, seeded(spark), root, clock=lambda: utc(2026, 4, 1))
    found = freshness(publication_times(spark, root, CUSTOMERS)).first()
    # The 29th of thirty lags in order: that of the second of March.
    assert (found.table, found.row_count, found.lag_seconds) == ("customers", 30, 30 * 86_400)


def test_consumers_opt_into_fingerprints(spark, root):
    sync(spark, seeded(spark), root)
    assert read_share(spark, root, CASES, accept=["2d76125b0e63dbbb"]).count() == 200
    with pytest.raises(IncompatibleSchema, match="2d76125b0e63dbbb"):
        read_share(spark, root, CASES, accept=["7bccf22a775dcf2b"])


def test_unstaged_runs_publish_the_same(spark, tmp_path):
    staged, direct = f"file:{tmp_path}/a", f"file:{tmp_path}/b"
    one = sync(spark, seeded(spark), staged)
    two = sync(spark, seeded(spark), direct, options=SyncOptions(identity="exact", stage=False, echo=False))
    assert one.run_id == two.run_id == FIRST_RUN
    for a, b in zip(one.tables, two.tables):
        assert [lines(p) for p in [*a.lake_paths, a.share_path]] == [lines(p) for p in [*b.lake_paths, b.share_path]]


def test_an_unreadable_source_leaves_no_trace(spark, root):
    broken = seed.customers(spark).withColumn(
        "name", F.when(F.col("customer_id") == 7, F.raise_error(F.lit("disk on fire"))).otherwise(F.col("name"))
    )
    with pytest.raises(SourceError, match="customers"):
        sync(spark, sources(broken, seed.cases(spark)), root)
    assert CommitLog(spark, root).recover() == ["1:discarded"]
    assert files(root) == {}
    with pytest.raises(ContractError):
        sync(spark, [TableSource(CASES, seed.customers(spark))], root)


def damaged_cases(spark):
    lost = F.when(F.col("case_id") % 50 != 7, F.col("updated_at"))
    return seed.cases(spark).withColumn("updated_at", lost).withColumn("case_id", F.when(F.col("case_id") != 3, F.col("case_id")))


def test_quarantined_rows_lie_beside_the_lake(spark, root):
    both, options = sources(seed.customers(spark), damaged_cases(spark)), SyncOptions(echo=False, quarantine=True)
    dry = sync(spark, both, root, dry_run=True, options=options)
    assert files(root) == {}
    run = sync(spark, both, root, options=options)
    assert (run.run_id, run.tables) == (dry.run_id, dry.tables) and run.table("cases").delta_row_count == 195
    good, bad = read_lake(spark, root, CASES), read_quarantine(spark, root, CASES)
    assert good.count() == 195
    reasons = {tuple(r) for r in bad.groupBy("quarantine_reason").count().collect()}
    assert reasons == {("updated_at is missing", 4), ("key is missing", 1)}
    assert good.unionByName(bad.select(*CASES.column_names)).exceptAll(damaged_cases(spark)).count() == 0
    assert read_quarantine(spark, root, CUSTOMERS).count() == 0
    assert set(CommitLog(spark, root).latest().quarantined) == {"cases"}


def test_rows_set_aside_outlive_their_commit(spark, root):
    both, options = sources(seed.customers(spark), damaged_cases(spark)), SyncOptions(echo=False, quarantine=True)
    sync(spark, both, root, options=options, clock=lambda: utc(2026, 4, 1))
    for day in (2, 3):
        sync(spark, seeded(spark), root, options=options, clock=lambda: utc(2026, 8, day))
    expire(spark, root, now=utc(2026, 8, 4))
    assert read_quarantine(spark, root, CASES).count() == 5


def test_a_breaking_contract_is_refused(spark, root):
    wider = Contract("customers", "customer_id", (*CUSTOMERS.columns, ("phone", "text")))
    rows = seed.customers(spark)
    more = TableSource.of(rows.withColumn("phone", F.lit("1")).withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 YEAR")), wider)
    sync(spark, [TableSource.of(rows, CUSTOMERS)], root)
    sync(spark, [more], root)
    before = files(root)
    for dry in (True, False):
        with pytest.raises(IncompatibleSchema, match="customers: phone dropped"):
            sync(spark, [TableSource.of(rows, CUSTOMERS)], root, dry_run=dry)
    CommitLog(spark, root).recover()
    assert files(root) == before
    sync(spark, [TableSource.of(seed.cases(spark), CASES)], root)
    with pytest.raises(IncompatibleSchema):
        sync(spark, [TableSource.of(rows, CUSTOMERS)], root)
    accepted = SyncOptions(echo=False, accept_breaking=("customers",))
    assert sync(spark, [TableSource.of(rows, CUSTOMERS)], root, options=accepted).table("customers").delta_row_count == 0
