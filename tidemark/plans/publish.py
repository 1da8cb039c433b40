"""Writing one table's batch: lake and share from a single ordered pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.checkpoint import Checkpoint
from tidemark.contract import UPDATED_AT, Contract
from tidemark.errors import ContractError
from tidemark.functions.canonical import utc_date
from tidemark.operators.envelope import envelope, lake_line
from tidemark.plans.commits import SHARE_DATE
from tidemark.sources.published import JSON, LAKE_TENANT, PARQUET

LAKE, SHARE = "lake", "share"
PARTITION_COLUMNS = {"output", "date", "run_id", LAKE_TENANT}


# Staged Parquet bytes one task turns into lines.
TASK_BYTES = 64 << 20


def range_tasks(staged_bytes: int, least: int) -> int:
    """How many ranges to cut a batch into: by its size, since ranges are not split later."""
    return max(least, -(-staged_bytes // TASK_BYTES))


def placed(rows: DataFrame, contract: Contract, tasks: int) -> DataFrame:
    """``rows`` cut into ranges of ``(updated_at, pk)``; the scan keeps its own tasks."""
    return rows.repartitionByRange(tasks, UPDATED_AT, contract.key)


def by_tenant(rows: DataFrame, contract: Contract, tasks: int) -> DataFrame:
    """The rows of a lake divided by tenant, with their date and tenant.

    Ranges of ``(tenant, updated_at, pk)`` split a dominant tenant over many tasks and keep small
    ones together, so that a task writes few files.
    """
    ranges = rows.repartitionByRange(tasks, contract.tenant, UPDATED_AT, contract.key)
    dated = ranges.select(
        "*", F.lit(LAKE).alias("output"), utc_date(F.col(UPDATED_AT)).alias("date"), F.col(contract.tenant).cast("string").alias(LAKE_TENANT)
    )
    return dated.sortWithinPartitions("output", "date", LAKE_TENANT, UPDATED_AT, contract.key)


def output_lines(
    rows: DataFrame,
    contract: Contract,
    run_id: str,
    after: Checkpoint,
    tasks: int,
    outputs: tuple[str, ...] = (LAKE, SHARE),
) -> DataFrame:
    """``(output, date, run_id, value)``: every row once for each output.

    The only shuffle of a run's rows is this range partitioning by ``(updated_at, pk)``. It
    splits a hot date, even a hot instant, over as many tasks as its size asks for; and since
    ranges follow the total order, reading an output's files in name order gives the rows in
    order. Lines are rendered after the shuffle, so typed columns travel, not text.
    """
    # Names no table column has: a table may well have a column called date.
    ranges = placed(rows, contract, tasks)
    doubled = ranges.select("*", F.explode(F.array(*[F.lit(o) for o in outputs])).alias("_output"))
    dated = doubled.select(
        "*",
        F.when(F.col("_output") == LAKE, utc_date(F.col(UPDATED_AT))).otherwise(SHARE_DATE).alias("_date"),
    )
    in_order = dated.sortWithinPartitions("_output", "_date", UPDATED_AT, contract.key)
    head, tail = (F.when(F.col("_output") == SHARE, part).otherwise("") for part in envelope(contract, run_id, after))
    line = F.concat(head, lake_line(contract), tail)
    return in_order.select(
        line.alias("value"), F.col("_output").alias("output"), F.col("_date").alias("date"), F.lit(run_id).alias("run_id")
    )


def lake_rows(rows: DataFrame, contract: Contract, run_id: str, tasks: int) -> DataFrame:
    """The rows of a columnar lake, placed and ordered like lines."""
    clash = PARTITION_COLUMNS & set(contract.column_names)
    if clash:
        raise ContractError(f"{contract.name}: a Parquet lake cannot hold columns named {sorted(clash)}")
    if contract.tenant:
        return by_tenant(rows, contract, tasks).withColumn("run_id", F.lit(run_id))
    ranges = placed(rows, contract, tasks)
    dated = ranges.select("*", F.lit(LAKE).alias("output"), utc_date(F.col(UPDATED_AT)).alias("date"))
    in_order = dated.sortWithinPartitions("output", "date", UPDATED_AT, contract.key)
    return in_order.withColumn("run_id", F.lit(run_id))


def write_leaves(rows: DataFrame, path: str, fmt: str, compression: str | None) -> None:
    """Replace exactly the directories the rows fall into; a repeated run overwrites itself only."""
    writer = rows.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if compression:
        writer = writer.option("compression", compression)
    tenant = [LAKE_TENANT] if LAKE_TENANT in rows.columns else []
    writer.partitionBy("output", "date", "run_id", *tenant).save(path)


def write_batch(
    rows: DataFrame,
    contract: Contract,
    run_id: str,
    after: Checkpoint,
    path: str,
    tasks: int,
    lake_format: str,
    compression: str | None,
) -> None:
    """Lake and share of one table. Lines of both come from one pass; a Parquet lake is its own."""
    if lake_format == JSON:
        write_leaves(output_lines(rows, contract, run_id, after, tasks), path, "text", compression)
        return
    write_leaves(lake_rows(rows, contract, run_id, tasks), path, PARQUET, None)
    write_leaves(output_lines(rows, contract, run_id, after, tasks, (SHARE,)), path, "text", compression)
