"""Keeping the lake small in files and the log short."""

from __future__ import annotations

from dataclasses import replace
from datetime import UTC, datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checkpoint import from_iso, to_iso
from tidemark.contract import UPDATED_AT, Contract
from tidemark.functions.canonical import utc_date
from tidemark.plans.commits import SHARE_DATE, Commit, CommitLog, LeafNames, Leaves, leaf
from tidemark.plans.publish import LAKE, SHARE, by_tenant, placed, range_tasks, write_leaves
from tidemark.session import require_utc, timestamps_with_statistics
from tidemark.sources.published import BY_TENANT, JSON, LAKE_TENANT, PARQUET, tenant_files


def _crowded(
    runs: dict[str, dict[str, Any]], min_runs: int, dates: list[str] | None
) -> dict[str, dict[str, list[str]]]:
    """Format -> date -> the runs to merge, where at least ``min_runs`` of one format wrote a date."""
    found: dict[str, dict[str, list[str]]] = {}
    for run_id, part in sorted(runs.items()):
        for date in part["dates"]:
            if dates is None or date in dates:
                found.setdefault(part["format"], {}).setdefault(date, []).append(run_id)
    crowded = {f: {d: ids for d, ids in per.items() if len(ids) >= min_runs} for f, per in found.items()}
    return {f: per for f, per in crowded.items() if per}


def _placed(rows: DataFrame, contract: Contract, tasks: int) -> DataFrame:
    dated = placed(rows, contract, tasks).select("*", F.lit(LAKE).alias("output"), utc_date(F.col(UPDATED_AT)).alias("date"))
    return dated.sortWithinPartitions("output", "date", UPDATED_AT, contract.key)


def _lines(spark: SparkSession, contract: Contract, sources: list[str], tasks: int) -> DataFrame:
    """The lines as they are; only their position is parsed."""
    position = F.from_json("value", f"`{UPDATED_AT}` timestamp, `{contract.key}` bigint", {"mode": "FAILFAST"})
    lines = spark.read.text(sources).select("value", position.alias("p")).select("value", "p.*")
    return _placed(lines, contract, tasks).select("value", "output", "date")


def _columns(spark: SparkSession, contract: Contract, sources: list[str], tasks: int) -> DataFrame:
    """All columns the files have, also those the contract no longer names."""
    return _placed(spark.read.option("mergeSchema", True).parquet(*sources), contract, tasks)


def _tenants(spark: SparkSession, contract: Contract, sources: list[str], tasks: int) -> DataFrame:
    """The same for files divided by tenant."""
    rows = tenant_files(spark, sources).option("mergeSchema", True).parquet(*sources).drop("date", "run_id", LAKE_TENANT)
    return by_tenant(rows, contract, tasks)


def compact(
    spark: SparkSession,
    root: str,
    contract: Contract,
    min_runs: int = 2,
    dates: list[str] | None = None,
    now: datetime | None = None,
    compression: str | None = None,
) -> Commit | None:
    """Merge the lake directories of every date written by ``min_runs`` runs or more.

    Rows are copied as they are, into order, into directories of a new run; a commit swaps them
    in. The old directories stay readable for earlier commits until :func:`expire`.
    """
    require_utc(spark)
    now = now or datetime.now(UTC)
    log = CommitLog(spark, root)
    log.recover(now)
    claim = log.claim(now)
    try:
        runs = log.live_leaves().get(contract.name, {})
        chosen = _crowded(runs, min_runs, dates)
        if not chosen:
            return None
        run_ids = {fmt: f"compact-{claim.seq:020d}-{fmt}" for fmt in chosen}
        targets = [leaf(contract.directory, LAKE, d, run_ids[fmt]) for fmt, per in chosen.items() for d in per]
        claim.intend(targets, None)
        removed: LeafNames = {contract.name: {}}
        added: Leaves = {contract.name: {}}
        for fmt, per_date in chosen.items():
            sources = [log.store.path(leaf(contract.directory, LAKE, d, r)) for d, ids in per_date.items() for r in ids]
            tasks = range_tasks(sum(log.store.size(path) for path in sources), least=1)
            merged = {JSON: _lines, BY_TENANT: _tenants}.get(fmt, _columns)
            rows = merged(spark, contract, sources, tasks).withColumn("run_id", F.lit(run_ids[fmt]))
            with timestamps_with_statistics(spark):
                write_leaves(rows, log.store.path(contract.directory), "text" if fmt == JSON else PARQUET, compression)
            counts = {d: sum(runs[r]["dates"][d] for r in ids) for d, ids in per_date.items()}
            added[contract.name][run_ids[fmt]] = {"format": fmt, "dates": counts}
            for date, ids in sorted(per_date.items()):
                for old in ids:
                    removed[contract.name].setdefault(old, []).append(date)

        last = log.latest()
        commit = Commit(
            seq=claim.seq,
            kind="compact",
            run_id=f"compact-{claim.seq:020d}",
            committed_at=to_iso(now),
            checkpoint_before=last.checkpoint_after,
            checkpoint_after=last.checkpoint_after,
            lake_added=added,
            lake_removed=removed,
            shares=last.shares,
            schemas=last.schemas,
            origin=last.origin,
        )
        claim.ready(commit)
        return claim.commit()
    finally:
        claim.release()


def expire(
    spark: SparkSession,
    root: str,
    directories: dict[str, str] | None = None,
    keep: timedelta = timedelta(days=30),
    now: datetime | None = None,
) -> list[str]:
    """Drop commits older than ``keep`` and every directory only they refer to.

    The last expired commit is rewritten as a baseline that lists all lake directories live at
    that point and all rows set aside, so no row is lost; only replaced lake directories, superseded shares
    and old events go. ``directories`` names the directory of a table where it is not the
    table's name. Returns what was deleted.
    """
    now = now or datetime.now(UTC)
    log = CommitLog(spark, root)
    log.recover(now)
    claim = log.claim(now)
    try:
        history = log.history()
        expired = [c for c in history[:-1] if from_iso(c.committed_at) < now - keep]
        if not expired:
            return []
        edge, kept = expired[-1], history[len(expired):]
        live = log.live_leaves(edge.seq)

        def directory(table: str) -> str:
            return (directories or {}).get(table, table)

        doomed: set[str] = set()
        for commit in expired:
            for table, runs in commit.lake_removed.items():
                for run_id, covered in runs.items():
                    doomed.update(leaf(directory(table), LAKE, d, run_id) for d in covered)
        current = {(t, s["run_id"]) for c in [edge, *kept] for t, s in c.shares.items()}
        for commit in expired:
            for table, share in commit.shares.items():
                if (table, share["run_id"]) not in current:
                    doomed.add(leaf(directory(table), SHARE, SHARE_DATE, share["run_id"]))
        told = {c.run_id for c in kept}
        doomed.update(f"events/run_id={c.run_id}" for c in expired if c.kind == "ingest" and c.run_id not in told)
        for target in sorted(doomed):
            log.store.delete(target)
        aside: dict[str, list[dict[str, Any]]] = {}
        for commit in expired:
            for table, parts in commit.quarantined.items():
                aside.setdefault(table, []).extend(parts)
        log.store.replace(
            f"state/commits/{edge.seq:020d}.json",
            replace(edge, kind="baseline", tables=[], lake_added=live, lake_removed={}, quarantined=aside).text(),
        )
        for commit in expired[:-1]:
            log.store.delete(f"state/snapshots/{commit.seq:020d}.json")
            log.store.delete(f"state/commits/{commit.seq:020d}.json")
        return sorted(doomed)
    finally:
        claim.release()
