"""Reading what runs have published. Only committed directories are ever listed."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import Contract
from tidemark.errors import ContractError, IncompatibleSchema
from tidemark.operators.envelope import CHECKPOINT_TYPE, share_schema
from tidemark.operators.validate import comes_back
from tidemark.plans.commits import CommitLog, Leaves, SHARE_DATE, leaf
from tidemark.session import metadata_frame, require_utc

JSON, PARQUET, BY_TENANT = "json", "parquet", "parquet-by-tenant"
LAKE_TENANT = "lake_tenant"
QUARANTINE, QUARANTINE_REASON, COPIES = "quarantine", "quarantine_reason", "_copies"

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("schema_fingerprint", T.StringType()),
        T.StructField("delta_row_count", T.LongType()),
        T.StructField("lake_paths", T.ArrayType(T.StringType())),
        T.StructField("share_path", T.StringType()),
        T.StructField("checkpoint_after", CHECKPOINT_TYPE),
    ]
)


def run_of_file() -> Column:
    """The run that wrote a row, from the directory of its file."""
    return F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/run_id=", -1), "/", 1)


def _text_schema(schema: T.StructType) -> T.StructType:
    """Binary columns are published as UTF-8 text, which the JSON reader would take for base64."""
    return T.StructType(
        [T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.BinaryType) else f.dataType) for f in schema]
    )


_TENANT_FIELD = T.StructField(LAKE_TENANT, T.StringType())


def tenant_files(spark: SparkSession, paths: list[str]) -> DataFrameReader:
    """A reader of several dates and runs of a lake divided by tenant."""
    return spark.read.option("basePath", paths[0].rsplit("/date=", 1)[0])


def _of_tenant(rows: DataFrame, contract: Contract, tenant: str) -> DataFrame:
    """The rows of one tenant; where the files are divided by it, the others' are not opened."""
    if LAKE_TENANT in rows.columns:
        # An empty name has the directory of a missing one.
        rows = rows.where(F.col(LAKE_TENANT) == tenant if tenant else F.col(LAKE_TENANT).isNull()).drop(LAKE_TENANT)
    return rows.where(F.col(contract.tenant).cast("string") == tenant)


def read_rows(
    spark: SparkSession, contract: Contract, fmt: str, paths: list[str], with_run: bool = False, with_tenant: bool = False
) -> DataFrame:
    """Contract rows from lake directories of one format. Columns a file lacks are null."""
    extra = [run_of_file().alias("run_id")] if with_run else []
    if fmt == BY_TENANT:
        frame = tenant_files(spark, paths).schema(T.StructType([*contract.schema.fields, _TENANT_FIELD])).parquet(*paths)
        extra += [F.col(LAKE_TENANT)] if with_tenant else []
    elif fmt == JSON:
        frame = spark.read.schema(_text_schema(contract.schema)).option("mode", "FAILFAST").json(paths)
    else:
        frame = spark.read.schema(contract.schema).parquet(*paths)
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.schema.fields]
    return frame.select(*typed, *extra)


def lake_paths(
    log: CommitLog,
    contract: Contract,
    leaves: Leaves,
    first_date: str | None = None,
    last_date: str | None = None,
    dates: Collection[str] | None = None,
) -> dict[str, list[str]]:
    """The directories of a table's leaves within a date range, or of given dates, by format."""
    found: dict[str, list[str]] = {}
    for run_id, part in sorted(leaves.get(contract.name, {}).items()):
        for date in sorted(part["dates"]):
            inside = (first_date is None or date >= first_date) and (last_date is None or date <= last_date)
            if inside and (dates is None or date in dates):
                path = log.store.path(leaf(contract.directory, "lake", date, run_id))
                found.setdefault(part["format"], []).append(path)
    return found


def read_lake(
    spark: SparkSession,
    root: str,
    contract: Contract,
    first_date: str | None = None,
    last_date: str | None = None,
    as_of: int | None = None,
    with_run: bool = False,
    tenant: str | None = None,
    dates: Collection[str] | None = None,
) -> DataFrame:
    """The committed change log of a table, or its dates in ``[first_date, last_date]`` or among ``dates``, or one tenant of it.

    The commit log is the index: directories outside the range, of unfinished runs or of later
    commits than ``as_of`` are not even listed.
    """
    require_utc(spark)
    if tenant is not None and not contract.tenant:
        raise ContractError(f"{contract.name} has no tenant column")
    log = CommitLog(spark, root)
    paths = lake_paths(log, contract, log.live_leaves(as_of), first_date, last_date, dates)
    if not paths:
        run = T.StructType([T.StructField("run_id", T.StringType())] if with_run else [])
        return spark.createDataFrame([], T.StructType([*contract.schema.fields, *run.fields]))
    parts = [read_rows(spark, contract, f, paths[f], with_run, tenant is not None) for f in sorted(paths)]
    if tenant is not None:
        parts = [_of_tenant(part, contract, tenant) for part in parts]
    return reduce(DataFrame.unionByName, parts)


def last_date_of_page(leaves: Leaves, contract: Contract, cursor_date: str, page: int) -> str | None:
    """The last date a page after ``cursor_date`` can reach, by the row counts in the log."""
    counts: dict[str, int] = {}
    for part in leaves.get(contract.name, {}).values():
        for date, rows in part["dates"].items():
            counts[date] = counts.get(date, 0) + rows
    reached = 0
    for date in sorted(d for d in counts if d > cursor_date):
        reached += counts[date]
        if reached >= page:
            return date
    return None


def share_path(log: CommitLog, contract: Contract, run_id: str) -> str:
    return log.store.path(leaf(contract.directory, "share", SHARE_DATE, run_id))


def read_share(
    spark: SparkSession, root: str, contract: Contract, accept: Sequence[str] | None = None
) -> DataFrame:
    """The latest batch of a table, enveloped; empty if it never had one.

    With ``accept`` the batch must carry one of these schema fingerprints: a consumer opts into
    a new schema instead of meeting it by surprise.
    """
    require_utc(spark)
    log = CommitLog(spark, root)
    last = log.latest()
    current = last.shares.get(contract.name) if last else None
    schema = share_schema(contract)
    if current is None:
        return spark.createDataFrame([], schema)
    if accept is not None and current["schema_fingerprint"] not in accept:
        raise IncompatibleSchema(f"{contract.name}: fingerprint {current['schema_fingerprint']} is not accepted")
    text = T.StructType([f if f.name != "record" else T.StructField("record", _text_schema(contract.schema)) for f in schema])
    frame = spark.read.schema(text).option("mode", "FAILFAST").json(share_path(log, contract, current["run_id"]))
    record = F.struct(
        *[F.col(f"record.{f.name}").cast(f.dataType).alias(f.name) for f in contract.schema.fields]
    )
    return frame.withColumn("record", record)


def _aside_parts(spark: SparkSession, root: str, contract: Contract) -> list[dict[str, Any]]:
    return [part for c in CommitLog(spark, root).history() for part in c.quarantined.get(contract.name, [])]


def set_aside_log(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    """The changes to the rows set aside: contract columns, the reason, signed copies, and the run's leaf as ``run_id``.

    A row comes with its copies when a run meets it first, and with as many less when it has gone or been mended.
    """
    require_utc(spark)
    log = CommitLog(spark, root)
    names = [part["name"] for part in _aside_parts(spark, root, contract) if part["rows"] + part.get("closed", 0)]
    added = [T.StructField(QUARANTINE_REASON, T.StringType()), T.StructField(COPIES, T.LongType())]
    schema = T.StructType([*contract.schema.fields, *added])
    if not names:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("run_id", T.StringType())]))
    paths = [log.store.path(leaf(contract.directory, QUARANTINE, SHARE_DATE, name)) for name in names]
    rows = spark.read.schema(schema).parquet(*paths).select("*", run_of_file().alias("run_id"))
    return rows.withColumn(COPIES, F.coalesce(COPIES, F.lit(1)))


_CHUNK = 1 << 16


def read_quarantine(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    """Rows that committed runs set aside: contract columns, the reason and the first run's leaf as ``run_id``.

    A row stands here once however many runs meet it, also after it has been mended; ``read_open`` leaves those out.
    """
    rows = set_aside_log(spark, root, contract).where(f"{COPIES} > 0")
    chunks = F.sequence(F.lit(0), F.floor((F.col(COPIES) - 1) / _CHUNK))
    rows = rows.withColumn("_chunk", F.explode(chunks))
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least(F.lit(_CHUNK), F.col(COPIES) - F.col("_chunk") * _CHUNK))))
    return rows.drop(COPIES, "_chunk", "_copy")


def read_open(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    """The rows that still lie aside: contract columns, reason, ``copies``, ``first_seen`` and ``last_seen``.

    Those that cannot be placed are seen by each run, those with a negative key when they come and by ``readmit``.
    """
    columns = [*contract.column_names, QUARANTINE_REASON]
    parts = _aside_parts(spark, root, contract)
    times = [(part["name"], part.get("at")) for part in parts]
    newest = lambda of: F.lit(max((p["at"] for p in of if p.get("at") and p.get("seen")), default=None)).cast("timestamp")
    runs = metadata_frame(spark, times, "run_id string, at string").select("run_id", F.col("at").cast("timestamp").alias("_at"))
    log = set_aside_log(spark, root, contract).join(runs, "run_id", "left")
    came = F.when(F.col(COPIES) > 0, F.col("_at"))
    rows = log.groupBy(*columns).agg(F.sum(COPIES).alias("copies"), F.min(came).alias("first_seen"), F.max(came).alias("_last"))
    again = F.when(comes_back(contract), newest(parts)).otherwise(newest([p for p in parts if p.get("whole")]))
    return rows.where("copies > 0").select(*columns, "copies", "first_seen", F.greatest("_last", again).alias("last_seen"))


def read_events(spark: SparkSession, root: str) -> DataFrame:
    """One row per committed run and table. Runs without changes repeat their id, hence the dedupe."""
    log = CommitLog(spark, root)
    runs = sorted({c.run_id for c in log.history() if c.kind == "ingest"})
    paths = [log.store.path("events", f"run_id={run_id}") for run_id in runs]
    if not paths:
        return spark.createDataFrame([], EVENT_SCHEMA)
    events = spark.read.schema(EVENT_SCHEMA).option("mode", "FAILFAST").json(paths)
    return events.dropDuplicates(["run_id", "table"])
