"""One function per registered query: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.checkpoint import Checkpoint, HighWaterMark
from tidemark.contract import UPDATED_AT, Contract
from tidemark.errors import IncompatibleSchema
from tidemark.functions.canonical import canonical_json, canonical_row, iso_utc, parse_iso_utc, utc_date
from tidemark.functions.digest import lane_columns, schema_fingerprint, sha256_prefix
from tidemark.operators import quality
from tidemark.operators.changes import OP, apply_changes, merge_with_deletes
from tidemark.operators.consumer import as_of_state, changes_since, read_as_of, read_changes_since
from tidemark.operators.delta import delta, numbered, upto
from tidemark.operators.envelope import share_line
from tidemark.operators.history import in_force, validity
from tidemark.operators.identity import row_identities
from tidemark.operators.layout import Layout
from tidemark.operators.pages import pages
from tidemark.operators.ranges import tree_diff
from tidemark.operators.sketches import lag_quantile, noisy_tenants, rank_error, tenant_panes, update_lags
from tidemark.operators.summary import (
    checkpoint_advance,
    delta_counts,
    digests,
    partition_counts,
    touched_partitions,
)
from tidemark.operators.tenants import tenant_partitions
from tidemark.operators.validate import invalid_rows, quarantine_split
from tidemark.plans.commits import CommitLog, seed_checkpoint
from tidemark.plans.deletes import sync_deletes, with_op
from tidemark.plans.maintenance import compact, expire
from tidemark.plans.readmission import readmit
from tidemark.plans.sync import QUARANTINE_REASON, SyncOptions, examine, publish, sync
from tidemark.session import metadata_frame, scratch_root
from tidemark.sources import seed
from tidemark.sources.published import read_events, read_lake, read_open, read_quarantine, read_share
from tidemark.sources.tables import TableSource, read_files
from tidemark.streaming.alarms import read_silences, stream_silences
from tidemark.streaming.cdc import deduplicate
from tidemark.streaming.drain import drain
from tidemark.streaming.exact import ExactLog, exactly_once
from tidemark.streaming.windows import WindowLog, stream_windows
from workload.tables import (
    EVENTS,
    EVENTS_CUT,
    MID_TIE,
    ORDERS,
    ORDERS_END,
    USERS,
    events,
    orders,
    plain,
    session,
    users_log,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}

LANES = SyncOptions(echo=False)
# Marks before a run: half of the orders are published, no event is.
BEFORE = Checkpoint({"orders": MID_TIE}).for_tables(["orders", "events"])
START = datetime(2024, 3, 1, tzinfo=UTC)


def registered(key: str) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        REGISTERED[key] = query
        return query

    return keep


def both_deltas(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders": delta(orders(spark, sf_dir), BEFORE.mark("orders")),
        "events": delta(events(spark, sf_dir), BEFORE.mark("events")),
    }


BOTH = (ORDERS, EVENTS)


def until(source: TableSource, mark: HighWaterMark) -> TableSource:
    """The source as it was when its newest row was ``mark``."""
    return replace(source, frame=source.frame.where(upto(mark, source.contract.key)))


def two_runs(spark: SparkSession, sf_dir: str, **second) -> str:
    """Publish the events up to the cut, then the rest; returns the root."""
    source, root = events(spark, sf_dir), scratch_root(spark, "root")
    sync(spark, [until(source, EVENTS_CUT)], root, options=LANES, clock=lambda: START)
    sync(spark, [source], root, options=LANES, clock=lambda: START + timedelta(hours=1), **second)
    return root


def file_stream(spark: SparkSession, path: str, files: int = 1_000) -> TableSource:
    """The events below a path as a stream of at most ``files`` files a batch."""
    schema = session(spark).read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    return TableSource.of(stream, EVENTS, {"updated_at": "ts"}, assume_utc=True)


def event_stream(spark: SparkSession, sf_dir: str) -> TableSource:
    """The events as a file stream; the pattern makes a single file acceptable as one."""
    return file_stream(spark, f"{sf_dir}/events.parque[t]")


def add_files(spark: SparkSession, rows: DataFrame, path: str, files: int) -> None:
    """Append ``rows`` in files that each span the whole time, so that later batches lie behind the mark."""
    rows.repartition(files, "event_id").write.mode("append").parquet(path)


def add_delivery(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Append ``rows`` as one delivery, in as many files as their size asks for; each spans the whole time."""
    rows.repartition("event_id").write.mode("append").parquet(path)


# scans --------------------------------------------------------------------


@registered("delta_scan")
def delta_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows past the cut with their place in the total order."""
    return plain(numbered(delta(events(spark, sf_dir), EVENTS_CUT), EVENTS))


@registered("delta_mid_tie")
def delta_mid_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(delta(orders(spark, sf_dir), MID_TIE))


@registered("delta_initial")
def delta_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(delta(orders(spark, sf_dir), HighWaterMark()))


@registered("checkpoint_default")
def checkpoint_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark in force per table and the rows waiting beyond it; events has no stored mark."""
    stored = Checkpoint({"orders": MID_TIE})
    waiting = {s.contract.name: delta(s, stored.mark(s.contract.name)) for s in (orders(spark, sf_dir), events(spark, sf_dir))}
    marks = stored.for_tables(c.name for c in BOTH).as_frame(spark)
    counts = delta_counts(waiting, BOTH).select("table", "delta_row_count")
    return plain(marks.join(counts, "table")).withColumnRenamed("table", "table_name")


@registered("row_identities")
def row_identities_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = row_identities(delta(orders(spark, sf_dir), MID_TIE), ORDERS)
    return rows.withColumnRenamed("table", "table_name")


# encodings ----------------------------------------------------------------


@registered("iso_utc")
def iso_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instants with and without a fraction, and before 1970."""
    rows = events(spark, sf_dir).frame
    earlier = F.timestamp_micros(-F.unix_micros(UPDATED_AT))
    return rows.select(
        "event_id",
        iso_utc(F.col(UPDATED_AT)).alias("moment"),
        iso_utc(F.date_trunc("second", F.col(UPDATED_AT))).alias("whole_second"),
        iso_utc(earlier).alias("before_1970"),
    )


@registered("iso_roundtrip")
def iso_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).frame
    text = iso_utc(F.col(UPDATED_AT))
    offset = F.concat(F.date_format(UPDATED_AT, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00"))
    bare = F.date_format(UPDATED_AT, "yyyy-MM-dd'T'HH:mm:ss")
    return rows.select(
        "event_id",
        F.unix_micros(parse_iso_utc(text)).alias("micros"),
        F.unix_seconds(parse_iso_utc(offset)).alias("offset_seconds"),
        F.unix_seconds(parse_iso_utc(bare)).alias("bare_seconds"),
    )


@registered("canonical_json")
def canonical_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake lines; props holds quotes that must be escaped."""
    return events(spark, sf_dir).frame.select("event_id", canonical_row(EVENTS.schema).alias("line"))


@registered("type_encodings")
def type_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).frame.select(
        "order_id",
        F.to_date(UPDATED_AT).alias("day"),
        "total",
        F.encode("priority", "UTF-8").alias("raw"),
        F.when(F.col("status") != "P", F.col("status")).alias("gap"),
        F.array(F.col("total"), F.lit(None).cast("decimal(15,2)")).alias("amounts"),
        F.struct(F.col("status").alias("z"), F.col(UPDATED_AT).alias("a")).alias("nested"),
    )
    return rows.select("order_id", canonical_row(rows.schema).alias("line"))


@registered("checkpoint_map")
def checkpoint_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map of marks with instants in it, normalised to ordered keys and ISO text."""
    rows = orders(spark, sf_dir).frame
    mark = F.struct(F.col(UPDATED_AT), F.col("order_id").alias("last_pk"))
    nested = rows.select("order_id", F.create_map(F.col("status"), mark, F.lit("customers"), mark).alias("marks"))
    return nested.select(
        "order_id", canonical_json({"marks": F.col("marks")}, {"marks": nested.schema["marks"].dataType}).alias("text")
    )


@registered("row_hash")
def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = canonical_row(ORDERS.schema)
    return orders(spark, sf_dir).frame.select("order_id", sha256_prefix(line, 16).alias("hash"))


@registered("seed_shape")
def seed_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The demonstration tables' expressions over the order keys."""
    i = F.col("order_id") + 1
    keyword = seed.cycle(seed.KEYWORDS, i)
    return orders(spark, sf_dir).frame.select(
        "order_id",
        seed.case_title(i, F.initcap(keyword)).alias("title"),
        seed.cycle(seed.STATUSES, i).alias("status"),
        seed.cycle(seed.COUNTRIES, i).alias("country"),
        iso_utc(seed.after_start(F.pmod(i - 1, F.lit(100)) * 25_920)).alias("moment"),
    )


# aggregates ---------------------------------------------------------------


@registered("delta_counts")
def delta_counts_per_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero is a count too: nothing lies beyond the end of orders."""
    deltas = {
        "orders": delta(orders(spark, sf_dir), ORDERS_END),
        "events": delta(events(spark, sf_dir), EVENTS_CUT),
    }
    return delta_counts(deltas, BOTH).select(F.col("table").alias("table_name"), "delta_row_count")


@registered("checkpoint_advance")
def advanced_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events advance to their last row; orders have nothing new and keep their mark."""
    before = Checkpoint({"orders": ORDERS_END, "events": EVENTS_CUT})
    deltas = {
        "orders": delta(orders(spark, sf_dir), before.mark("orders")),
        "events": delta(events(spark, sf_dir), before.mark("events")),
    }
    return checkpoint_advance(deltas, BOTH, before).withColumnRenamed("table", "table_name")


@registered("touched_partitions")
def touched_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = touched_partitions(both_deltas(spark, sf_dir), BOTH)
    return found.select("table_ordinal", F.col("table").alias("table_name"), "date", F.col("position").cast("bigint"))


@registered("partition_counts")
def rows_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = partition_counts(both_deltas(spark, sf_dir), BOTH)
    return found.select(F.col("table").alias("table_name"), "date", "row_count")


@registered("run_digest")
def run_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, digest lanes and last position of each delta: all a run id is made from."""
    found = digests(both_deltas(spark, sf_dir), BOTH)
    return found.select(F.col("table").alias("table_name"), "delta_row_count", "last_at", "last_pk", *lane_columns())


@registered("schema_fingerprint")
def schema_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows published under each table's fingerprint."""
    deltas = both_deltas(spark, sf_dir)
    stamped = [
        deltas[c.name].select(F.lit(c.name).alias("table_name"), F.lit(schema_fingerprint(c)).alias("schema_fingerprint"))
        for c in BOTH
    ]
    return stamped[0].unionByName(stamped[1]).groupBy("table_name", "schema_fingerprint").agg(F.count("*").alias("row_count"))


# runs ---------------------------------------------------------------------


@registered("share_batch")
def share_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share lines of the orders beyond a mark in the middle of a tie."""
    before = Checkpoint({"orders": MID_TIE})
    rows = delta(orders(spark, sf_dir), MID_TIE)
    facts = examine({"orders": rows}, (ORDERS,), before, LANES)
    return rows.select("order_id", share_line(ORDERS, facts.run_id, facts.after).alias("line"))


@registered("dry_run_manifest")
def dry_run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_root(session(spark), "root")
    seed_checkpoint(spark, root, BEFORE, START)
    manifest = sync(spark, [orders(spark, sf_dir), events(spark, sf_dir)], root, dry_run=True, options=LANES)
    day = F.transform("lake_paths", lambda p: F.regexp_extract(p, r"date=([0-9-]+)", 1))
    return manifest.as_frame(spark).select(
        F.col("table").alias("table_name"),
        "delta_row_count",
        "schema_fingerprint",
        "run_id",
        F.size("lake_paths").cast("bigint").alias("partitions"),
        F.array_min(day).alias("first_date"),
        F.array_max(day).alias("last_date"),
        F.col("share_path").isNotNull().alias("has_share"),
    )


@registered("run_events")
def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over two tables, one of them without any change and one table never changing."""
    root = scratch_root(session(spark), "root")
    seed_checkpoint(spark, root, Checkpoint({"orders": ORDERS_END}), START)
    still, moving = orders(spark, sf_dir), events(spark, sf_dir)
    for source in (until(moving, EVENTS_CUT), moving, moving):
        sync(spark, [still, source], root, options=LANES)
    return read_events(spark, root).select(
        F.col("table").alias("table_name"),
        "delta_row_count",
        "schema_fingerprint",
        F.size("lake_paths").cast("bigint").alias("partitions"),
        F.col("share_path").isNotNull().alias("has_share"),
        F.col("checkpoint_after")["events"][UPDATED_AT].alias("events_at"),
        F.col("checkpoint_after")["events"]["last_pk"].alias("events_pk"),
    )


@registered("lake_after_two_runs")
def lake_after_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = two_runs(spark, sf_dir)
    order = [c.run_id for c in CommitLog(spark, root).history()]
    number = F.array_position(F.array(*[F.lit(r) for r in order]), F.col("run_id"))
    return plain(read_lake(spark, root, EVENTS, with_run=True).withColumn("run_no", number).drop("run_id"))


@registered("lake_range_scan")
def lake_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three dates, the middle one written by both runs."""
    root = two_runs(spark, sf_dir)
    return plain(read_lake(spark, root, EVENTS, first_date="2024-01-15", last_date="2024-01-17"))


@registered("committed_lake")
def committed_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside the first run's files lie those of one that never committed; none of them is visible."""
    source, root = events(spark, sf_dir), scratch_root(spark, "root")
    sync(spark, [until(source, EVENTS_CUT)], root, options=LANES)
    left = source.frame.withColumn("date", utc_date(F.col(UPDATED_AT))).withColumn("run_id", F.lit("unfinished"))
    left.write.partitionBy("date", "run_id").mode("append").json(f"{root}/events/output=lake")
    return plain(read_lake(spark, root, EVENTS))


@registered("recovered_lake")
def recovered_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run ends between ready and commit; recovery commits it without reading the source again."""
    source, root = events(spark, sf_dir), scratch_root(spark, "root")
    sync(spark, [until(source, EVENTS_CUT)], root, options=LANES)
    log, now = CommitLog(spark, root), datetime.now(UTC)
    claim, before = log.claim(now), log.checkpoint(["events"])

    def gone() -> None:
        raise InterruptedError

    claim.commit = gone
    try:
        publish(spark, root, claim, {"events": delta(source, before.mark("events"))}, (EVENTS,), before, LANES, lambda: now)
    except InterruptedError:
        claim.release()
    log.recover()
    return plain(read_lake(spark, root, EVENTS))


@registered("share_replace")
def share_after_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share holds the second batch only."""
    share = read_share(spark, two_runs(spark, sf_dir), EVENTS)
    return share.select(
        F.col("table").alias("table_name"),
        "op",
        "event_id",
        UPDATED_AT,
        "schema_fingerprint",
        F.col("checkpoint_after")["events"]["last_pk"].alias("after_pk"),
        F.col("record.user_id").alias("user_id"),
        F.col("record.props").alias("props"),
    )


@registered("compacted_lake")
def compacted_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date both runs wrote is merged; the log still holds every row once."""
    root = two_runs(spark, sf_dir)
    compact(spark, root, EVENTS, now=START + timedelta(hours=2))
    rows = read_lake(spark, root, EVENTS, with_run=True)
    return plain(rows.withColumn("compacted", F.col("run_id").startswith("compact-")).drop("run_id"))


@registered("retained_lake")
def retained_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old commits and replaced directories are gone, no row is."""
    root = two_runs(spark, sf_dir)
    compact(spark, root, EVENTS, now=START + timedelta(hours=2))
    late = START + timedelta(days=60)
    sync(spark, [events(spark, sf_dir)], root, options=LANES, clock=lambda: late)
    expire(spark, root, now=late)
    return plain(read_lake(spark, root, EVENTS))


@registered("time_travel")
def time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as of the first of two commits of their change log."""
    source, root = TableSource.of(users_log(spark, sf_dir), USERS), scratch_root(spark, "root")
    sync(spark, [until(source, EVENTS_CUT)], root, options=LANES)
    sync(spark, [source], root, options=LANES)
    return plain(read_as_of(spark, root, USERS, seq=1))


@registered("columnar_lake")
def columnar_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first run writes lines, the second Parquet; one log holds both."""
    source, root = events(spark, sf_dir), scratch_root(spark, "root")
    sync(spark, [until(source, EVENTS_CUT)], root, options=LANES)
    sync(spark, [source], root, options=replace(LANES, lake_format="parquet"))
    return plain(read_lake(spark, root, EVENTS))


@registered("stream_drain")
def stream_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream, published by one drain."""
    root = scratch_root(spark, "root")
    drain(event_stream(spark, sf_dir), root, scratch_root(spark, "stream"), options=LANES)
    return plain(read_lake(spark, root, EVENTS))


@registered("stream_drain_many")
def stream_drain_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five files that overlap in time, one a batch: each batch but the first holds rows behind the mark."""
    root, path = scratch_root(session(spark), "root"), scratch_root(spark, "files")
    add_files(spark, spark.read.parquet(f"{sf_dir}/events.parquet"), path, 5)
    drain(file_stream(spark, path, files=1), root, scratch_root(spark, "stream"), options=LANES)
    return plain(read_lake(spark, root, EVENTS))


@registered("stream_resume")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drain, more files, and a drain that has lost its state and so is given everything again."""
    root, path = scratch_root(session(spark), "root"), scratch_root(spark, "files")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    for half in (0, 1):
        add_files(spark, rows.where(F.col("event_id") % 2 == half), path, 2)
        drain(file_stream(spark, path, files=2), root, scratch_root(spark, "stream"), options=LANES)
    return plain(read_lake(spark, root, EVENTS))


@registered("stream_drain_repeats")
def stream_drain_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is delivered twice in its batch; a second batch brings a third of them, again twice, behind the mark."""
    root, path = scratch_root(session(spark), "root"), scratch_root(spark, "files")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    folders = []
    for part in (rows.where("event_id % 3 < 2"), rows.where("event_id % 3 > 0")):
        folders.append(f"{path}/{len(folders)}")
        add_delivery(spark, part.unionByName(part), folders[-1])
        for folder in folders:  # a batch each, of drains without state, so that the first comes twice
            drain(file_stream(spark, folder), root, scratch_root(spark, "stream"), options=LANES)
    return plain(read_lake(spark, root, EVENTS))


# consumers and changes ----------------------------------------------------


@registered("changes_since")
def changes_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(changes_since(orders(spark, sf_dir).frame, ORDERS, MID_TIE, page=500))


@registered("changes_since_lake")
def lake_changes_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page from the committed lake; dates before the cursor are not listed."""
    return plain(read_changes_since(spark, two_runs(spark, sf_dir), EVENTS, EVENTS_CUT, page=200))


@registered("as_of_state")
def state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(as_of_state(users_log(spark, sf_dir), USERS, EVENTS_CUT))


@registered("validity")
def validity_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of a user with the time it was in force; users with many versions are cut into bins."""
    return plain(validity(users_log(spark, sf_dir), USERS, bin_rows=200))


@registered("point_in_time")
def versions_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user's version at the instant of every purchase, and a microsecond before."""
    rows = events(spark, sf_dir).frame.where("event_type = 'purchase'")
    probes = [rows.select("user_id", F.col("event_id").alias("probe"), (F.col(UPDATED_AT) - F.expr(f"INTERVAL {back} MICROSECOND")).alias("at")) for back in (0, 1)]
    found = in_force(reduce(DataFrame.unionByName, probes), users_log(spark, sf_dir), USERS, bin_rows=200)
    version = [F.col(f"version.{c}").alias(f"version_{c}") for c in ("event_id", "event_type")]
    return plain(found.select("user_id", "probe", "at", *version))


@registered("cursor_pages")
def pages_of_all_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next 20 changes of the log for every user, who has read up to their first view."""
    rows = events(spark, sf_dir).frame
    cursors = rows.where("event_type = 'view'").groupBy(F.col("user_id").alias("consumer")).agg(F.min(F.struct(UPDATED_AT, "event_id")).alias("c"))
    cursors = cursors.select("consumer", F.col(f"c.{UPDATED_AT}").alias("cursor_at"), F.col("c.event_id").alias("cursor_pk"))
    return plain(pages(rows, cursors, EVENTS, 20).select("consumer", "position", "event_id", UPDATED_AT))


@registered("lake_deletes")
def lake_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source loses its purchases; their deletes reach the lake, beside all that was published."""
    return plain(read_lake(spark, *after_deletes(spark, sf_dir)))


@registered("deletes_as_of")
def state_without_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as the lake with deletes gives it."""
    root, contract = after_deletes(spark, sf_dir)
    return plain(read_as_of(spark, root, contract))


def after_deletes(spark: SparkSession, sf_dir: str) -> tuple[str, Contract]:
    source, root = with_op(events(spark, sf_dir)), scratch_root(spark, "root")
    sync(spark, [source], root, options=LANES)
    sync_deletes(spark, replace(source, frame=source.frame.where("event_type <> 'purchase'")), root, LANES)
    return root, source.contract


@registered("apply_changes")
def changed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending orders are finished a day later; urgent ones are followed up under new keys."""
    rows = orders(spark, sf_dir).frame
    next_day = (F.col(UPDATED_AT) + F.expr("INTERVAL 1 DAY")).alias(UPDATED_AT)
    finished = rows.where("status = 'P'").withColumn("status", F.lit("F")).withColumn(UPDATED_AT, next_day)
    added = rows.where("priority = '1-URGENT'").withColumn("order_id", F.col("order_id") + 1_000_000_000)
    return plain(apply_changes(rows, finished.unionByName(added), ORDERS))


@registered("merge_with_deletes")
def merged_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).frame
    upserts = rows.where("status = 'P'").withColumn("status", F.lit("F")).withColumn(OP, F.lit("upsert"))
    deletes = rows.where("status = 'O'").withColumn(OP, F.lit("delete"))
    new = (
        rows.where("priority = '1-URGENT'")
        .withColumn("order_id", F.col("order_id") + 1_000_000_000)
        .withColumn(OP, F.lit("upsert"))
    )
    return plain(merge_with_deletes(rows, upserts.unionByName(deletes).unionByName(new), ORDERS))


@registered("cdc_dedupe")
def deduplicated_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change is delivered twice, purchases three times."""
    rows = events(spark, sf_dir).frame.select(
        F.lit("events").alias("table"), "event_id", F.unix_micros(UPDATED_AT).alias("lsn"), "event_type"
    )
    delivered = rows.unionByName(rows).unionByName(rows.where("event_type = 'purchase'"))
    return deduplicate(delivered, "event_id").withColumnRenamed("table", "table_name")


@registered("cdc_dedupe_stream")
def deduplicated_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a stream: every change delivered twice, one kept within the watermark."""
    stream = event_stream(spark, sf_dir).frame.select(
        F.lit("events").alias("table"), "event_id", F.unix_micros(UPDATED_AT).alias("lsn"), "event_type", UPDATED_AT
    )
    out = scratch_root(spark, "changes")
    writer = deduplicate(stream.unionByName(stream), "event_id").writeStream.format("parquet")
    writer.option("checkpointLocation", scratch_root(spark, "stream")).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out).withColumnRenamed("table", "table_name").drop(UPDATED_AT)


@registered("cdc_dedupe_late")
def deduplicated_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change delivered twice, in batches that overlap in time: late ones stay, repeats go."""
    path, out = scratch_root(session(spark), "files"), scratch_root(spark, "changes")
    add_files(spark, spark.read.parquet(f"{sf_dir}/events.parquet"), path, 3)
    add_files(spark, spark.read.parquet(f"{sf_dir}/events.parquet"), path, 2)
    changes = file_stream(spark, path, files=1).frame.select(
        F.lit("events").alias("table"), "event_id", F.unix_micros(UPDATED_AT).alias("lsn"), "event_type"
    )
    writer = deduplicate(changes, "event_id").writeStream.format("parquet")
    writer.option("checkpointLocation", scratch_root(spark, "stream")).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out).withColumnRenamed("table", "table_name")


@registered("cdc_exact")
def exactly_once_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes in order of time, then all again: the state covers two days, what is older is found in the committed rows.

    A third of the changes come with the second delivery only, most of them long after the state has passed them.
    """
    path, root, state = scratch_root(session(spark), "files"), scratch_root(spark, "changes"), scratch_root(spark, "stream")
    rows, identity = spark.read.parquet(f"{sf_dir}/events.parquet"), ["table", "event_id"]
    most = rows.where("event_id % 3 > 0")
    first = F.coalesce(F.col("ts") < F.lit(most.select(F.percentile_approx("ts", 0.5)).first()[0]), F.lit(True))
    for part in (most.where(first), most.where(~first), rows.unionByName(rows.where("event_type = 'purchase'"))):
        add_delivery(spark, part, path)
        changes = file_stream(spark, path).frame.select(F.lit("events").alias("table"), "event_id", "event_type", UPDATED_AT)
        exactly_once(changes, identity, root, state, keep_seconds=2 * 86_400, buckets=8).awaitTermination()
    found = ExactLog(spark, root, changes.schema, identity).rows()
    return found.select(F.col("table").alias("table_name"), "event_id", F.unix_micros(UPDATED_AT).alias("lsn"), "event_type")


@registered("late_rows")
def late_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent orders arrived after the mark had passed them."""
    rows = orders(spark, sf_dir).frame
    published = rows.where("priority <> '1-URGENT'").where(upto(MID_TIE, "order_id"))
    return plain(quality.late_rows(rows, published, ORDERS, upto(MID_TIE, "order_id")).select(*ORDERS.column_names))


# quality ------------------------------------------------------------------


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which the pending have lost their instant and the urgent their key."""
    rows = orders(spark, sf_dir).frame
    return rows.select(
        F.col("order_id").alias("row_id"),
        F.when(F.col("priority") == "1-URGENT", -F.col("order_id") - 1)
        .when(F.col("priority") != "2-HIGH", F.col("order_id"))
        .alias("order_id"),
        "customer_id",
        "status",
        "priority",
        "total",
        F.when(F.col("status") != "P", F.col(UPDATED_AT)).alias(UPDATED_AT),
    )


@registered("invalid_rows")
def invalid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invalid_rows(damaged(spark, sf_dir), ORDERS).select("row_id", "reason")


@registered("quarantine_split")
def quarantined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = quarantine_split(damaged(spark, sf_dir), ORDERS)
    return good.select("row_id", F.lit("good").alias("target")).unionByName(
        bad.select("row_id", F.lit("quarantine").alias("target"))
    )


@registered("sync_quarantine")
def quarantining_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run over events of which some users' lost their instant or key: the sound ones in the lake, the others beside it."""
    contract = Contract("events", "event_id", (("row_id", "bigint"), *EVENTS.columns))
    key = F.when(F.col("user_id") % 5 == 0, -F.col("event_id") - 1).when(F.col("user_id") % 5 != 1, F.col("event_id"))
    rows = events(spark, sf_dir).frame.withColumn("row_id", F.col("event_id")).withColumn("event_id", key)
    rows = rows.withColumn(UPDATED_AT, F.when(F.col("user_id") % 7 != 0, F.col(UPDATED_AT)))
    source, root = TableSource.of(rows.select(*contract.column_names), contract), scratch_root(spark, "root")
    sync(spark, [source], root, options=replace(LANES, quarantine=True))
    good = read_lake(spark, root, contract).select("row_id", F.lit(None).cast("string").alias("reason"))
    bad = read_quarantine(spark, root, contract).select("row_id", F.col(QUARANTINE_REASON).alias("reason"))
    return good.unionByName(bad)


@registered("readmitted_rows")
def readmitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over events of which some users' lost their instant or key, then half of them mended: published once, or still open."""
    contract = Contract("events", "event_id", (("row_id", "bigint"), *EVENTS.columns))
    rows = events(spark, sf_dir).frame.withColumn("row_id", F.col("event_id"))

    def with_damage(where: Column) -> TableSource:
        key = F.when(where & (F.col("user_id") % 5 == 0), -F.col("event_id") - 1).when(~(where & (F.col("user_id") % 5 == 1)), F.col("event_id"))
        moment = F.when(~(where & (F.col("user_id") % 7 == 0)), F.col(UPDATED_AT))
        broken = rows.withColumn(UPDATED_AT, moment).withColumn("event_id", key)
        return TableSource.of(broken.select(*contract.column_names), contract)

    root, options = scratch_root(session(spark), "root"), replace(LANES, quarantine=True)
    all_bad = with_damage(F.lit(True))
    cut = F.col(UPDATED_AT).isNull() | upto(EVENTS_CUT, "row_id")
    for day, source in enumerate((replace(all_bad, frame=all_bad.frame.where(cut)), all_bad, all_bad)):
        sync(spark, [source], root, options=options, clock=lambda day=day: START + timedelta(days=day))
    for day in (3, 4):  # the second time there is nothing left to do
        readmit(spark, with_damage(F.col("row_id") % 2 == 1), root, options, clock=lambda day=day: START + timedelta(days=day))
    good = read_lake(spark, root, contract).select("row_id", F.lit("published").alias("state"), F.lit(None).cast("long").alias("copies"), F.lit(None).cast("timestamp").alias("first_seen"), F.lit(None).cast("timestamp").alias("last_seen"))
    bad = read_open(spark, root, contract).select("row_id", F.col(QUARANTINE_REASON).alias("state"), "copies", "first_seen", "last_seen")
    return plain(good.unionByName(bad))


@registered("schema_gate")
def gated_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs: the contract, one with a column more, and one with a column less, which is refused."""
    root, path = scratch_root(session(spark), "root"), f"{sf_dir}/events.parquet"
    wider = replace(EVENTS, columns=(*EVENTS.columns, ("value", "double precision")))
    less = replace(EVENTS, columns=tuple(c for c in EVENTS.columns if c[0] != "props"))
    seen = []
    for contract, mark in ((EVENTS, EVENTS_CUT), (wider, None), (less, None)):
        source = read_files(spark, contract, path, mapping={"updated_at": "ts"}, assume_utc=True)
        try:
            sync(spark, [until(source, mark) if mark else source], root, options=LANES)
            seen.append((schema_fingerprint(contract), "published"))
        except IncompatibleSchema:
            seen.append((schema_fingerprint(contract), "refused"))
    decisions = metadata_frame(spark, seen, "schema_fingerprint string, decision string")
    written = read_events(spark, root).groupBy("schema_fingerprint").agg(F.sum("delta_row_count").alias("row_count"))
    rows = decisions.join(written, "schema_fingerprint", "left")
    return rows.withColumn("row_count", F.coalesce("row_count", F.lit(0)))


@registered("schema_diff")
def schema_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a next version that drops, retypes and adds columns, with the values at stake."""
    rows = damaged(spark, sf_dir).drop("row_id")
    planned = Contract(
        "orders",
        "order_id",
        (
            ("order_id", "bigint"),
            ("customer_id", "text"),
            ("status", "text"),
            ("total", "numeric(15,2)"),
            ("currency", "text"),
            ("updated_at", "timestamptz"),
        ),
    )
    found = quality.schema_impact(rows, ORDERS.schema, planned.schema)
    return found.select(F.col("column").alias("column_name"), "change", "breaking", "values_present")


@registered("fingerprint_gate")
def fingerprint_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events after the cut carry the fingerprint of a wider contract the consumer did not accept."""
    wider = replace(EVENTS, columns=(*EVENTS.columns, ("value", "double precision")))
    old, new = schema_fingerprint(EVENTS), schema_fingerprint(wider)
    rows = events(spark, sf_dir).frame
    stamped = rows.select(F.when(upto(EVENTS_CUT, "event_id"), old).otherwise(new).alias("schema_fingerprint"))
    return quality.fingerprint_gate(stamped, [old])


@registered("freshness")
def freshness_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag of events committed at the end of two-minute windows, of orders with a nightly batch."""
    batch_end = (F.floor(F.unix_seconds(UPDATED_AT) / 120) + 1) * 120
    one = events(spark, sf_dir).frame.select(
        F.lit("events").alias("table"), UPDATED_AT, F.timestamp_seconds(batch_end).alias("committed_at")
    )
    nightly = F.timestamp_seconds(F.unix_seconds(UPDATED_AT) + 86_400 + F.pmod("customer_id", F.lit(7_000)))
    two = orders(spark, sf_dir).frame.select(F.lit("orders").alias("table"), UPDATED_AT, nightly.alias("committed_at"))
    return quality.freshness(one.unionByName(two)).withColumnRenamed("table", "table_name")


@registered("freshness_lake")
def freshness_of_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag of what two runs published, by the times of their commits."""
    published = quality.publication_times(spark, two_runs(spark, sf_dir), EVENTS)
    return quality.freshness(published).withColumnRenamed("table", "table_name")


@registered("stale_cursors")
def stale_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user has read up to their last view."""
    rows = events(spark, sf_dir).frame
    cursors = rows.where("event_type = 'view'").groupBy("user_id").agg(F.max(UPDATED_AT).alias("cursor_at"))
    return plain(quality.stale_cursors(cursors, rows))


@registered("stale_alarms")
def silent_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's views are their progress: a stream of three batches, up to seven hours out of order, tells of pauses of a day."""
    path, out = scratch_root(session(spark), "files"), scratch_root(spark, "alarms")
    arrival = F.unix_seconds(F.col("ts").cast("timestamp")) + F.col("event_id") % 7 * 3_600
    views = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_type = 'view'")
    first, second = (int(datetime(2024, 1, day, tzinfo=UTC).timestamp()) for day in (11, 21))
    for part in (arrival < first, (arrival >= first) & (arrival < second), arrival >= second):
        views.where(part).coalesce(1).write.mode("append").parquet(path)
    progress = file_stream(spark, path, files=1).frame.select("user_id", UPDATED_AT)
    stream_silences(progress, "user_id", UPDATED_AT, out, scratch_root(spark, "stream"), delay_seconds=12 * 3_600).awaitTermination()
    alarms = spark.read.schema("user_id long, kind string, last_progress timestamp, at timestamp").parquet(out)
    return plain(read_silences(alarms, "user_id"))


@registered("snapshot_diff")
def snapshot_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).frame
    actual = rows.where("status <> 'O'").withColumn(
        "status", F.when(F.col("priority") == "1-URGENT", "X").otherwise(F.col("status"))
    )
    return plain(quality.snapshot_diff(rows, actual))


@registered("snapshot_diff_tree")
def snapshot_differences_by_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first orders of each hundred thousand have changed or gone, found range by range."""
    rows = orders(spark, sf_dir).frame
    early = F.col("order_id") % 100_000 < 300
    actual = rows.where(~(early & (F.col("status") == "O"))).withColumn("status", F.when(early, "X").otherwise(F.col("status")))
    return plain(tree_diff(rows, actual, "order_id", enough=100, bits=6))


@registered("tenant_share")
def tenant_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.tenant_share(events(spark, sf_dir).frame, "user_id")


@registered("tenant_partitions")
def tenant_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tenant_partitions(events(spark, sf_dir).frame, "user_id")


@registered("tenant_lake")
def tenant_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published by tenant (here their type) in two runs that share tenants and a date, read tenant by tenant."""
    divided = replace(EVENTS, tenant="event_type")
    source, root = replace(events(spark, sf_dir), contract=divided), scratch_root(spark, "root")
    for until_then in (until(source, EVENTS_CUT), source):
        sync(spark, [until_then], root, options=LANES)
    tenants = [row.event_type for row in source.frame.select("event_type").distinct().collect()]  # a handful of types
    read = [read_lake(spark, root, divided, tenant=name).withColumn("tenant_id", F.lit(name)) for name in tenants]
    rows = reduce(DataFrame.unionByName, read)
    return plain(rows.withColumn("event_date", utc_date(F.col(UPDATED_AT))))


@registered("clustered_lake")
def clustered_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events clustered by user and instant: three users and, for all users, one week, each from the files that may hold them."""
    found = events(spark, sf_dir).frame
    layout = Layout(scratch_root(spark, "clustered"), "user_id", UPDATED_AT)
    layout.write(found, file_rows=2_000)
    first, until_then = datetime(2024, 1, 10, tzinfo=UTC), datetime(2024, 1, 17, tzinfo=UTC)
    read = [layout.read(spark, found.schema, tenant=user).withColumn("asked", F.lit(f"user {user}")) for user in (1, 7, 42)]
    read.append(layout.read(spark, found.schema, first=first, until=until_then).withColumn("asked", F.lit("week")))
    return plain(reduce(DataFrame.unionByName, read))


@registered("microbatch_windows")
def microbatch_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.microbatch_windows(events(spark, sf_dir).frame, EVENTS)
    return plain(found)


@registered("microbatch_windows_stream")
def streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream of three batches that overlap in time: closed windows, late rows and what is open."""
    path, root = scratch_root(session(spark), "files"), scratch_root(spark, "windows")
    add_files(spark, spark.read.parquet(f"{sf_dir}/events.parquet"), path, 3)
    log = WindowLog(spark, root, EVENTS)
    query = stream_windows(file_stream(spark, path, files=1).frame, log, scratch_root(spark, "stream"))
    query.awaitTermination()
    return plain(log.whole(query.lastProgress["batchId"]))


@registered("freshness_sketch")
def freshness_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lag of two runs from their sketches, made one run at a time, and whether its rank is within the bound."""
    root, path = two_runs(spark, sf_dir), scratch_root(spark, "lags")
    sketches = update_lags(spark, root, EVENTS, path)
    found = lag_quantile(sketches, "table")
    lag = F.unix_seconds("committed_at") - F.unix_seconds(UPDATED_AT)
    exact = quality.publication_times(spark, root, EVENTS).select(lag.alias("lag"))
    ranks = exact.agg((F.count_if(F.col("lag") < found.select("lag_seconds").scalar()) / F.count("*")).alias("low"), (F.count_if(F.col("lag") <= found.select("lag_seconds").scalar()) / F.count("*")).alias("high"))
    inside = (F.col("low") <= 0.95 + rank_error()) & (F.col("high") >= 0.95 - rank_error())
    return found.select(F.col("table").alias("table_name"), "row_count", ranks.select(inside).scalar().alias("within_bound"))


@registered("noisy_tenants")
def noisy_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with a hundredth or more of the events of any seven days, from sketches of single days."""
    panes = tenant_panes(events(spark, sf_dir).frame, "user_id", tracked=20_000)
    return plain(noisy_tenants(panes, "user_id", tracked=20_000).select("window_end", "user_id", "estimate", "rows"))
