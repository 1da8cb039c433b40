import json
import uuid
from dataclasses import replace
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from helpers import FIRST_RUN, SECOND_RUN, changed, files, local, seeded, sync, utc

from tidemark import CASES, CUSTOMERS, HighWaterMark
from tidemark.errors import CheckpointCorrupt, CommitInterrupted, ContractError, RunInProgress
from tidemark.operators.delta import upto
from tidemark.plans.commits import Claim, CommitLog
from tidemark.plans.maintenance import compact, expire
from tidemark.sources.published import read_events, read_lake, read_share


def crash(spark, root, where):
    """A run that ends before its claim is ``ready``, or before its ``commit``."""

    def gone(self, *_):
        raise InterruptedError

    with pytest.MonkeyPatch.context() as patch, pytest.raises(InterruptedError):
        patch.setattr(Claim, where, gone)
        sync(spark, changed(spark), root)


def test_unready_run_is_invisible_and_dropped(spark, root):
    sync(spark, seeded(spark), root)
    before = files(root)
    crash(spark, root, "ready")
    assert read_lake(spark, root, CASES).count() == 200
    assert read_share(spark, root, CASES).count() == 200
    log = CommitLog(spark, root)
    assert log.recover() == ["2:discarded"]
    assert {k for k in files(root) if "output=" in k} == {k for k in before if "output=" in k}
    assert log.recover() == []
    assert sync(spark, changed(spark), root).run_id == SECOND_RUN


def test_ready_run_is_completed(spark, root):
    sync(spark, seeded(spark), root)
    crash(spark, root, "commit")
    assert read_lake(spark, root, CASES).count() == 200
    log = CommitLog(spark, root)
    assert log.recover() == ["2:committed"]
    assert log.latest().run_id == SECOND_RUN
    assert read_lake(spark, root, CASES).count() == 215
    assert read_share(spark, root, CUSTOMERS).count() == 2
    assert log.recover() == []


def test_next_run_recovers_by_itself(spark, root):
    sync(spark, seeded(spark), root)
    crash(spark, root, "commit")
    idle = sync(spark, changed(spark), root)
    assert [t.delta_row_count for t in idle.tables] == [0, 0]
    assert read_lake(spark, root, CASES).count() == 215


def test_crash_between_commit_and_cleanup(spark, root, monkeypatch):
    monkeypatch.setattr(CommitLog, "_cleanup", lambda self, directory: None)
    sync(spark, seeded(spark), root)
    monkeypatch.undo()
    log = CommitLog(spark, root)
    assert log.recover() == ["1:cleaned"]
    assert log.latest().run_id == FIRST_RUN
    assert log.store.names("state/runs") == []


def test_second_run_at_the_same_time_fails(spark, root):
    log = CommitLog(spark, root)
    now = utc(2026, 4, 1)
    claim = log.claim(now)
    with pytest.raises(RunInProgress):
        log.claim(now)
    with pytest.raises(RunInProgress):
        sync(spark, seeded(spark), root)
    claim.release()
    assert sync(spark, seeded(spark), root).run_id == FIRST_RUN


def test_claim_of_another_application(spark, root):
    now = utc(2026, 4, 1)
    log = CommitLog(spark, root)
    body = json.dumps({"token": "t", "application": "elsewhere", "claimed_at": "2026-04-01T00:00:00Z"})
    log.store.create("state/runs/" + "1".zfill(20) + "/claim.json", body)
    with pytest.raises(RunInProgress):
        log.recover(now + timedelta(hours=1))
    assert log.recover(now + timedelta(hours=7)) == ["1:discarded"]
    log.store.create("state/runs/" + "1".zfill(20) + "/claim.json", body)
    assert log.recover(now, force=True) == ["1:discarded"]


def test_a_run_that_lost_its_claim_cannot_commit(spark, root):
    log = CommitLog(spark, root)
    claim = log.claim(utc(2026, 4, 1))
    log.recover(force=True)
    with pytest.raises(CommitInterrupted):
        claim.ready(None)
    with pytest.raises(CommitInterrupted, match="not ready"):
        claim.commit()
    taken = log.claim(utc(2026, 4, 2))
    claim.release()  # must not free what is now another's
    with pytest.raises(RunInProgress):
        log.claim(utc(2026, 4, 2))
    taken.release()


def test_a_gap_in_the_log_is_reported(spark, root):
    for _ in range(3):
        sync(spark, seeded(spark)[:1], root)
    log = CommitLog(spark, root)
    log.store.delete("state/commits/" + "2".zfill(20) + ".json")
    with pytest.raises(CheckpointCorrupt, match="missing"):
        log.history()


def test_unreadable_state_is_reported(spark, root):
    log = CommitLog(spark, root)
    name = "1".zfill(20)
    log.store.replace(f"state/runs/{name}/ready.json", "{")
    with pytest.raises(CommitInterrupted):
        log.recover()
    log.store.delete("state/runs")
    for body in ("not-json{", '"hello"', "[]", "{}"):
        log.store.replace(f"state/commits/{name}.json", body)
        with pytest.raises(CheckpointCorrupt):
            log.checkpoint(["cases"])


def test_state_files_leave_no_drafts(spark, root):
    sync(spark, seeded(spark), root)
    hidden = [p.name for p in (local(root) / "state").rglob(".*") if not p.name.endswith(".crc")]
    assert hidden == []


def test_compaction_keeps_content_and_history(spark, root):
    sync(spark, seeded(spark), root, clock=lambda: utc(2026, 4, 1))
    late = [s for s in changed(spark)]
    sync(spark, late, root, clock=lambda: utc(2026, 4, 16))
    rows = read_lake(spark, root, CASES)
    assert compact(spark, root, CASES, now=utc(2026, 4, 17)) is None  # no date has two runs
    done = compact(spark, root, CASES, min_runs=1, now=utc(2026, 4, 17))
    assert done.kind == "compact"
    after = read_lake(spark, root, CASES, with_run=True)
    assert after.drop("run_id").exceptAll(rows).count() == 0 and after.count() == 215
    assert [r.run_id for r in after.select("run_id").distinct().collect()] == [f"{done.run_id}-json"]
    assert read_lake(spark, root, CASES, as_of=1).count() == 200
    assert read_share(spark, root, CASES).count() == 15
    idle = sync(spark, late, root, clock=lambda: utc(2026, 4, 18))
    assert [t.delta_row_count for t in idle.tables] == [0, 0]


def test_expiry_drops_only_what_nothing_refers_to(spark, root):
    sync(spark, seeded(spark), root, clock=lambda: utc(2026, 4, 1))
    sync(spark, changed(spark), root, clock=lambda: utc(2026, 4, 16))
    compact(spark, root, CASES, min_runs=1, now=utc(2026, 4, 17))
    later = utc(2026, 7, 1)
    assert expire(spark, root, now=utc(2026, 4, 20)) == []
    sync(spark, changed(spark), root, clock=lambda: later)
    gone = expire(spark, root, now=later)
    assert f"cases/output=share/date=all/run_id={FIRST_RUN}" in gone
    assert f"events/run_id={FIRST_RUN}" in gone
    assert any(g.startswith("cases/output=lake") for g in gone)
    assert not any(g.startswith("customers/output=lake") for g in gone)
    assert all(not (local(root) / g).exists() for g in gone)
    log = CommitLog(spark, root)
    assert [c.kind for c in log.history()] == ["baseline", "ingest"]
    assert read_lake(spark, root, CASES).count() == 215
    assert read_lake(spark, root, CUSTOMERS).count() == 32
    assert read_share(spark, root, CASES).count() == 15
    assert read_events(spark, root).count() == 2
    with pytest.raises(ContractError, match="expired"):
        read_lake(spark, root, CASES, as_of=1)
    assert expire(spark, root, now=later) == []
    sync(spark, changed(spark), root, clock=lambda: later)
    assert read_lake(spark, root, CASES).count() == 215


def test_many_commits_are_read_by_spark(spark, root):
    for _ in range(18):
        claim_seq = CommitLog(spark, root).sequence_numbers()
        sync(spark, [s for s in seeded(spark)][:1], root)
        assert len(CommitLog(spark, root).sequence_numbers()) == len(claim_seq) + 1
    assert [c.seq for c in CommitLog(spark, root).history()] == list(range(1, 19))
    assert read_lake(spark, root, CUSTOMERS).count() == 30


def test_compaction_of_both_formats(spark, root):
    from tidemark import SyncOptions

    sync(spark, seeded(spark), root, options=SyncOptions(echo=False, lake_format="parquet"))
    sync(spark, changed(spark), root)
    rows = read_lake(spark, root, CASES)
    compact(spark, root, CASES, min_runs=1)
    after = read_lake(spark, root, CASES)
    assert after.exceptAll(rows).count() == 0 and after.count() == 215
    live = CommitLog(spark, root).live_leaves()["cases"]
    assert sorted(part["format"] for part in live.values()) == ["json", "parquet"]
    assert sum(n for part in live.values() for n in part["dates"].values()) == 215


def test_snapshots_shorten_the_log(spark, root, monkeypatch):
    from tidemark.plans import commits

    monkeypatch.setattr(commits, "SNAPSHOT_EVERY", 3)
    step = timedelta(days=1)
    sync(spark, seeded(spark), root, clock=lambda: utc(2026, 4, 1))
    sync(spark, changed(spark), root, clock=lambda: utc(2026, 4, 1) + step)
    compact(spark, root, CASES, min_runs=1, now=utc(2026, 4, 1) + 2 * step)
    sync(spark, changed(spark), root, clock=lambda: utc(2026, 4, 1) + 3 * step)
    log = CommitLog(spark, root)
    assert log.store.names("state/snapshots") == ["3".zfill(20) + ".json"]
    with_snapshot = {seq: log.live_leaves(seq) for seq in (1, 2, 3, 4)}
    log.store.delete("state/snapshots")
    assert with_snapshot == {seq: log.live_leaves(seq) for seq in (1, 2, 3, 4)}
    assert with_snapshot[2] != with_snapshot[3] == with_snapshot[4]
    for _ in range(2):
        sync(spark, changed(spark), root, clock=lambda: utc(2026, 7, 1))
    assert log.store.names("state/snapshots") == ["6".zfill(20) + ".json"]
    expire(spark, root, now=utc(2026, 7, 2))
    assert read_lake(spark, root, CASES).count() == 215
    assert CommitLog(spark, root).live_leaves() == with_snapshot[4]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 29), st.integers(0, 200)), min_size=1, max_size=3))
def test_any_sequence_of_runs_publishes_every_row_once(spark, tmp_path, cuts):
    root = f"file:{tmp_path}/{uuid.uuid4().hex}"
    source = seeded(spark)[1]
    for day, pk in sorted(cuts):
        mark = HighWaterMark(f"2026-03-{day + 1:02d}T04:48:00Z", pk)
        sync(spark, [replace(source, frame=source.frame.where(upto(mark, "case_id")))], root)
    sync(spark, [source], root)
    rows = read_lake(spark, root, CASES)
    assert rows.count() == 200 and rows.exceptAll(source.frame).count() == 0


def test_racing_runs_commit_one_after_the_other(spark, root):
    from concurrent.futures import ThreadPoolExecutor

    def run(_):
        try:
            return sync(spark, changed(spark), root).run_id
        except RunInProgress:
            return None

    with ThreadPoolExecutor(4) as pool:
        ended = list(pool.map(run, range(4)))
    won = [e for e in ended if e]
    log = CommitLog(spark, root)
    assert won and len(log.history()) == len(won)
    assert [c.tables[1]["delta_row_count"] for c in log.history()][0] == 210
    assert read_lake(spark, root, CASES).count() == 210
    assert log.store.names("state/runs") == []


def test_a_live_run_completed_by_another_application(spark, root, monkeypatch):
    from tidemark.plans import commits

    commit, other = commits.Claim.commit, []

    def overtaken(self):
        held = set(commits._HELD)
        commits._HELD.clear()  # the other application does not know this token
        other.append(CommitLog(spark, root).recover())
        commits._HELD.update(held)
        return commit(self)

    monkeypatch.setattr(commits.Claim, "commit", overtaken)
    assert sync(spark, seeded(spark), root).run_id == FIRST_RUN
    assert other == [["1:committed"]]
    assert read_lake(spark, root, CASES).count() == 200


def test_small_files_are_exclusive_and_whole(spark, root):
    store = CommitLog(spark, root).store
    assert store.create_whole("a/b.json", "one") and not store.create_whole("a/b.json", "two")
    assert store.create("a/c.json", "ü") and not store.create("a/c.json", "v")
    assert (store.read("a/b.json"), store.read("a/c.json")) == ("one", "ü")
    store.replace("a/b.json", "three")
    store.replace("a/b.json", "four")
    assert store.read("a/b.json") == "four"
    assert store.names("a") == ["b.json", "c.json"] and store.names("none") == []
    assert [p.name for p in (local(root) / "a").iterdir() if p.name.startswith(".")] == []
    with pytest.raises(FileNotFoundError):
        store.read("a/none.json")
