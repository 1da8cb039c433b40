"""The sync job: one run publishes what changed in all tables, or says what it would publish."""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from datetime import UTC, datetime, timedelta
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.checkpoint import Checkpoint, HighWaterMark, to_iso
from tidemark.contract import UPDATED_AT, Contract, contracts_by_name
from tidemark.errors import ContractError, IncompatibleSchema, SourceError
from tidemark.functions.canonical import canonical_text
from tidemark.functions.digest import (
    RUN_ID_LENGTH,
    lane_totals,
    run_id_from_identities,
    run_id_from_lanes,
    schema_fingerprint,
)
from tidemark.operators.delta import delta
from tidemark.operators.identity import identity_text
from tidemark.operators.summary import digests, partition_counts
from tidemark.operators.validate import comes_back, violation
from tidemark.plans.commits import SHARE_DATE, Claim, Commit, CommitLog, leaf
from tidemark.plans.publish import LAKE, SHARE, range_tasks, write_batch
from tidemark.session import metadata_frame, require_utc, scratch_root, timestamps_with_statistics, written
from tidemark.sources.published import BY_TENANT, COPIES, JSON, PARQUET, QUARANTINE, QUARANTINE_REASON, set_aside_log, share_path
from tidemark.sources.tables import DeferredSource, TableSource

Clock = Callable[[], datetime]

# Parquet bytes of a row nobody has measured.
GUESSED_ROW_BYTES = 128


@dataclass(frozen=True)
class SyncOptions:
    """``identity`` picks how the run id is derived.

    ``lanes`` aggregates hashes on the executors and takes any size. ``exact`` hashes the ordered
    identities themselves and so passes them through the driver; whoever asks for it gets an
    error, not another scheme, for a delta of more than ``exact_limit`` rows.

    ``lake_format`` is ``json`` for canonical lines or ``parquet``, which lets readers of a large
    lake skip columns and row groups at the price of a second shuffle per run; a contract with a
    tenant has a Parquet lake divided by it in any case. ``compression``
    applies to lines.

    Outputs are cut into tasks by their size. A batch too small for that still spreads over the
    cores in pieces of ``small_task_rows``.

    ``quarantine`` publishes the sound rows and puts those without an instant or a valid key beside
    the lake, in the same commit; without it they stop the run. Rows that cannot be placed come
    back with every run until the source is mended; they are stored once, and when they stay
    away, that is.

    A contract that drops or retypes a column the last commit of its table had is refused, unless
    its table is named in ``accept_breaking``.

    ``stage=False`` spares the copy of the delta. Only for sources that cannot change while the
    run reads them, such as a table snapshot or closed files.
    """

    identity: str = "lanes"
    exact_limit: int = 100_000
    run_id_length: int = RUN_ID_LENGTH
    lake_format: str = JSON
    compression: str | None = None
    small_task_rows: int = 100_000
    stage: bool = True
    stale_after: timedelta = timedelta(hours=6)
    echo: bool = True
    quarantine: bool = False
    accept_breaking: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.identity not in ("exact", "lanes"):
            raise ContractError(f"unknown identity scheme {self.identity!r}")
        if self.lake_format not in (JSON, PARQUET):
            raise ContractError(f"unknown lake format {self.lake_format!r}")


@dataclass(frozen=True)
class TableManifest:
    table: str
    delta_row_count: int
    lake_paths: list[str]
    share_path: str | None
    schema_fingerprint: str


@dataclass(frozen=True)
class Manifest:
    run_id: str
    started_at: str
    finished_at: str
    dry_run: bool
    checkpoint_before: dict[str, Any]
    checkpoint_after: dict[str, Any]
    tables: list[TableManifest]

    def table(self, name: str) -> TableManifest:
        return next(entry for entry in self.tables if entry.table == name)

    def text(self) -> str:
        """The manifest as JSON."""
        return json.dumps(asdict(self), indent=2, ensure_ascii=False)

    def as_frame(self, spark: SparkSession) -> DataFrame:
        """One row per table, with the run's header on each."""
        rows = [
            (i, self.run_id, self.dry_run, t.table, t.delta_row_count, t.lake_paths, t.share_path, t.schema_fingerprint)
            for i, t in enumerate(self.tables)
        ]
        return metadata_frame(
            spark,
            rows,
            "table_ordinal int, run_id string, dry_run boolean, table string, delta_row_count bigint, "
            "lake_paths array<string>, share_path string, schema_fingerprint string",
        )


@dataclass
class RunFacts:
    """What a run knows about its delta before it writes anything: metadata of all tables."""

    run_id: str
    before: Checkpoint
    after: Checkpoint
    counts: dict[str, int]
    dates: dict[str, dict[str, int]]  # rows per touched date
    contracts: Sequence[Contract]


def _check_rows(summary: Mapping[str, Any], contracts: Sequence[Contract]) -> None:
    for contract in contracts:
        broken = summary[contract.name]["invalid"]
        if broken:
            raise ContractError(f"{contract.name}: {broken} rows lack updated_at or a valid key")


def gate(last: Commit | None, contracts: Sequence[Contract], accept_breaking: Sequence[str] = ()) -> None:
    """Refuse a contract that lacks a column its table has been published with, or has it retyped."""
    known = last.schemas if last else {}
    for c in contracts:
        now = dict(c.columns)
        broken = [f"{name} {'retyped' if name in now else 'dropped'}" for name, kind in known.get(c.name, []) if now.get(name) != kind]
        if broken and c.name not in accept_breaking:
            raise IncompatibleSchema(f"{c.name}: {', '.join(broken)}")


def sound(rows: Mapping[str, DataFrame], contracts: Sequence[Contract], options: SyncOptions) -> Mapping[str, DataFrame]:
    """The rows a run publishes: all of them, which the checks then judge, or those beside the quarantined."""
    if not options.quarantine:
        return rows
    return {c.name: rows[c.name].where(violation(c).isNull()) for c in contracts}


def quarantined(rows: DataFrame, contract: Contract) -> DataFrame:
    """The rows a run cannot publish, with the reason."""
    return rows.select("*", violation(contract).alias(QUARANTINE_REASON)).where(F.col(QUARANTINE_REASON).isNotNull())


def aside_changes(spark: SparkSession, root: str, rows: DataFrame, contract: Contract, whole: bool) -> DataFrame:
    """What the log of rows set aside lacks to agree with a run's unsound rows: signed copies of each.

    A delta says nothing of rows set aside earlier that have an instant and a key, since they lie
    behind the mark; ``whole`` tells that ``rows`` are the source. Equal rows are folded before they
    are shuffled, so a row that comes very often does not pile up.
    """
    columns = [*contract.column_names, QUARANTINE_REASON]
    now = quarantined(rows, contract).select(*columns, F.lit(1).cast("long").alias(COPIES))
    before = set_aside_log(spark, root, contract)
    before = before if whole else before.where(comes_back(contract))
    signed = now.unionByName(before.select(*columns, (-F.col(COPIES)).alias(COPIES)))
    return signed.groupBy(*columns).agg(F.sum(COPIES).alias(COPIES)).where(f"{COPIES} <> 0")


def _run_id(
    deltas: Mapping[str, DataFrame],
    contracts: Sequence[Contract],
    summary: Mapping[str, Any],
    before: Checkpoint,
    options: SyncOptions,
) -> str:
    total = sum(summary[c.name]["delta_row_count"] for c in contracts)
    if options.identity == "lanes":
        counted = {c.name: (summary[c.name]["delta_row_count"], lane_totals(summary[c.name])) for c in contracts}
        return run_id_from_lanes(before.as_dict(), counted, options.run_id_length)
    if total > options.exact_limit:
        raise ContractError(f"{total} rows exceed exact_limit={options.exact_limit}; use identity='lanes'")
    texts: dict[str, list[str]] = {}
    for contract in contracts:
        texts[contract.name] = []
        if summary[contract.name]["delta_row_count"]:
            ordered = (
                deltas[contract.name]
                .orderBy(UPDATED_AT, contract.key)
                .select(identity_text(contract.name, F.col(contract.key).cast("bigint"), F.col(UPDATED_AT)).alias("id"))
            )
            texts[contract.name] = [row.id for row in ordered.collect()]  # at most exact_limit rows
    return run_id_from_identities(before.as_dict(), texts, options.run_id_length)


def _position(mark: HighWaterMark) -> tuple[str, int]:
    return mark.at, mark.pk


def examine(
    deltas: Mapping[str, DataFrame], contracts: Sequence[Contract], before: Checkpoint, options: SyncOptions
) -> RunFacts:
    """Counts, marks, dates and the run id; reads two columns of each delta.

    The two jobs run side by side. Both return metadata: a row per table, a row per date.
    """
    before = before.for_tables(c.name for c in contracts)
    with ThreadPoolExecutor(2) as pool:
        found, counted = pool.map(DataFrame.collect, (digests(deltas, contracts), partition_counts(deltas, contracts)))
    summary = {row["table"]: row.asDict() for row in found}
    _check_rows(summary, contracts)
    moved = {
        c.name: HighWaterMark(summary[c.name]["last_at"], int(summary[c.name]["last_pk"]))
        for c in contracts
        if summary[c.name]["delta_row_count"]
    }
    # A stream's batch may hold late rows only; a mark never moves back.
    moved = {name: mark for name, mark in moved.items() if _position(mark) > _position(before.mark(name))}
    dates: dict[str, dict[str, int]] = {c.name: {} for c in contracts}
    for row in counted:
        dates[row["table"]][row["date"]] = row["row_count"]
    return RunFacts(
        run_id=_run_id(deltas, contracts, summary, before, options),
        before=before,
        after=before.advance(moved),
        counts={c.name: summary[c.name]["delta_row_count"] for c in contracts},
        dates=dates,
        contracts=contracts,
    )


def table_manifests(log: CommitLog, facts: RunFacts) -> list[TableManifest]:
    """Where the run's rows go. Dry and real runs share this, so they cannot disagree."""
    entries = []
    for c in facts.contracts:
        entries.append(
            TableManifest(
                table=c.name,
                delta_row_count=facts.counts[c.name],
                lake_paths=[log.store.path(leaf(c.directory, LAKE, d, facts.run_id)) for d in sorted(facts.dates[c.name])],
                share_path=share_path(log, c, facts.run_id) if facts.counts[c.name] else None,
                schema_fingerprint=schema_fingerprint(c),
            )
        )
    return entries


def event_lines(facts: RunFacts, entries: Sequence[TableManifest]) -> list[str]:
    """Canonical events, one per table, with or without changes."""
    return [
        canonical_text(
            {
                "table": e.table,
                "run_id": facts.run_id,
                "schema_fingerprint": e.schema_fingerprint,
                "delta_row_count": e.delta_row_count,
                "lake_paths": e.lake_paths,
                "share_path": e.share_path,
                "checkpoint_after": facts.after.as_dict(),
            }
        )
        for e in entries
    ]


def _each_table(job: Callable[[Contract], Any], contracts: Sequence[Contract]) -> list[Any]:
    """Run one job per table at the same time, so that a small table does not wait for a large one.

    All jobs have ended, well or not, when this returns.
    """
    if len(contracts) < 2:
        return [job(c) for c in contracts]
    with ThreadPoolExecutor(len(contracts)) as pool:
        return list(pool.map(job, contracts))


def _stage(
    spark: SparkSession, rows: Mapping[str, DataFrame], contracts: Sequence[Contract], stage: str, positions_only: bool = False
) -> dict[str, DataFrame]:
    """Copy each delta once, so that counts, ids and outputs all see the same rows.

    A map-only write; caching would not do, since a lost block is read again from a source
    that may have moved on. With ``positions_only`` the copy has the key and the instant, all that ``examine`` reads.
    """

    def copy(c: Contract) -> DataFrame:
        path = f"{stage}/{c.name}"
        names = [c.key, UPDATED_AT] if positions_only else list(c.column_names)
        try:
            rows[c.name].select(*names).write.mode("overwrite").parquet(path)
        except (PySparkException, Py4JJavaError) as failed:
            raise SourceError(f"cannot read the delta of {c.name}: {failed}") from failed
        return spark.read.schema(T.StructType([c.schema[name] for name in names])).parquet(path)

    return dict(zip((c.name for c in contracts), _each_table(copy, contracts)))


def _echo(lines: Sequence[str]) -> None:
    """Mirror the events to stdout; the run is committed already, so failures are ignored."""
    try:
        for line in lines:
            print(line, file=sys.stdout, flush=True)
    except Exception:  # noqa: BLE001
        pass


def publish(
    spark: SparkSession,
    root: str,
    claim: Claim,
    rows: Mapping[str, DataFrame],
    contracts: Sequence[Contract],
    before: Checkpoint,
    options: SyncOptions,
    clock: Clock,
    origin: Mapping[str, Any] | None = None,
    whole: bool = False,
) -> tuple[RunFacts, list[TableManifest]]:
    """Stage, write and commit one batch under ``claim``; the marks move last, with the commit.

    With ``whole`` the unsound ones of ``rows`` are all that the source has.
    """
    log = claim.log
    last = log.latest()
    gate(last, contracts, options.accept_breaking)
    stage = scratch_root(spark, "stage") if options.stage else None
    deltas = rows
    if stage:
        claim.intend([], stage)
        with timestamps_with_statistics(spark):
            deltas = _stage(spark, rows, contracts, stage)
    staged, deltas = deltas, sound(deltas, contracts, options)
    facts = examine(deltas, contracts, before, options)
    entries = table_manifests(log, facts)
    changed = [c for c in contracts if facts.counts[c.name]]
    targets = [leaf(c.directory, LAKE, d, facts.run_id) for c in changed for d in facts.dates[c.name]]
    targets += [leaf(c.directory, SHARE, SHARE_DATE, facts.run_id) for c in changed]
    aside: dict[str, list[dict[str, Any]]] = {}
    changes: dict[str, DataFrame] = {}
    if options.quarantine:
        earlier = {table for commit in log.history() for table in commit.quarantined}
        counts = dict(zip((c.name for c in contracts), _each_table(lambda c: quarantined(staged[c.name], c).count(), contracts)))
        for c in contracts:
            if not counts[c.name] and c.name not in earlier:
                continue
            changes[c.name] = written(aside_changes(spark, root, staged[c.name], c, whole), "aside")
            gone, new = changes[c.name].agg(*(F.coalesce(F.sum(F.greatest(n, F.lit(0))), F.lit(0)) for n in (-F.col(COPIES), F.col(COPIES)))).first()
            if counts[c.name] or gone:
                part = {"name": f"{facts.run_id}-{claim.seq}", "rows": new, "closed": gone, "seen": counts[c.name], "whole": whole}
                aside[c.name] = [{**part, "at": to_iso(clock())}]
    leaves = {
        table: leaf(c.directory, QUARANTINE, SHARE_DATE, part["name"])
        for c in contracts for table, (part,) in aside.items() if table == c.name and part["rows"] + part["closed"]
    }
    targets += leaves.values()
    claim.intend(targets, stage)

    def lake_format(c: Contract) -> str:
        return BY_TENANT if c.tenant else options.lake_format

    def set_aside(c: Contract) -> None:
        changes[c.name].write.mode("overwrite").parquet(log.store.path(leaves[c.name]))

    def write(c: Contract) -> None:
        least = min(spark.sparkContext.defaultParallelism, -(-facts.counts[c.name] // options.small_task_rows))
        size = log.store.size(f"{stage}/{c.name}") if stage else facts.counts[c.name] * GUESSED_ROW_BYTES
        tasks = range_tasks(size, least)
        path = log.store.path(c.directory)
        write_batch(
            deltas[c.name], c, facts.run_id, facts.after, path, tasks, lake_format(c), options.compression
        )

    with timestamps_with_statistics(spark):
        _each_table(write, changed)
        _each_table(set_aside, [c for c in contracts if c.name in leaves])
    lines = event_lines(facts, entries)
    log.store.replace(f"events/run_id={facts.run_id}/events.json", "".join(line + "\n" for line in lines))

    shares = dict(last.shares) if last else {}
    for c in changed:
        shares[c.name] = {
            "run_id": facts.run_id, "seq": claim.seq, "schema_fingerprint": schema_fingerprint(c),
        }
    commit = Commit(
        seq=claim.seq,
        kind="ingest",
        run_id=facts.run_id,
        committed_at=to_iso(clock()),
        checkpoint_before=facts.before.as_dict(),
        checkpoint_after=facts.after.as_dict(),
        tables=[
            {"table": e.table, "delta_row_count": e.delta_row_count, "schema_fingerprint": e.schema_fingerprint}
            for e in entries
        ],
        lake_added={
            c.name: {facts.run_id: {"format": lake_format(c), "dates": facts.dates[c.name]}} for c in changed
        },
        shares=shares,
        schemas={**(last.schemas if last else {}), **{c.name: [list(column) for column in c.columns] for c in contracts}},
        quarantined=aside,
        origin=dict(origin or {}),
    )
    claim.ready(commit)
    claim.commit()
    if options.echo:
        _echo(lines)
    return facts, entries


def sync(
    spark: SparkSession,
    sources: Sequence[TableSource | DeferredSource],
    root: str,
    dry_run: bool = False,
    options: SyncOptions | None = None,
    clock: Clock = lambda: datetime.now(UTC),
) -> Manifest:
    """Recover, read what lies beyond the marks, publish it and advance the marks.

    Sources are published in the order given; deferred ones are opened once the run is claimed and its marks are
    known. With ``dry_run`` the same facts are computed, from one read of each source, and
    nothing is published. A second run at the same time fails with RunInProgress.
    """
    require_utc(spark)
    options = options or SyncOptions()
    contracts = tuple(s.contract for s in sources)
    contracts_by_name(contracts)
    for source in sources:
        if isinstance(source, TableSource):
            source.contract.require(source.frame)
    log = CommitLog(spark, root)
    log.recover(clock(), stale_after=options.stale_after)
    claim = log.claim(clock())
    try:
        started = clock()
        before = log.checkpoint(c.name for c in contracts)
        opened = [s.at(before.mark(s.contract.name)) for s in sources]
        rows = {s.contract.name: delta(s, before.mark(s.contract.name), unplaced=True) for s in opened}
        if dry_run:
            gate(log.latest(), contracts, options.accept_breaking)
            stage = scratch_root(spark, "stage") if options.stage else None
            try:
                if stage:
                    with timestamps_with_statistics(spark):
                        rows = _stage(spark, rows, contracts, stage, positions_only=True)
                facts = examine(sound(rows, contracts, options), contracts, before, options)
            finally:
                if stage:
                    log.store.delete_uri(stage)
            entries = table_manifests(log, facts)
        else:
            facts, entries = publish(spark, root, claim, rows, contracts, before, options, clock)
    finally:
        claim.release()
    return Manifest(
        run_id=facts.run_id,
        started_at=to_iso(started),
        finished_at=to_iso(clock()),
        dry_run=dry_run,
        checkpoint_before=facts.before.as_dict(),
        checkpoint_after=facts.after.as_dict(),
        tables=entries,
    )
