"""Checks and reports on published data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.contract import UPDATED_AT, Contract
from tidemark.errors import IncompatibleSchema
from tidemark.functions.digest import lane_columns, lane_parts, with_lanes
from tidemark.operators.delta import upto
from tidemark.operators.identity import identity_hash
from tidemark.plans.commits import CommitLog
from tidemark.session import metadata_frame
from tidemark.sources.published import read_lake
from tidemark.sources.tables import TableSource

# schema compatibility -----------------------------------------------------


def _described(spark: SparkSession, schema: T.StructType, side: str) -> DataFrame:
    rows = [(f.name, f.metadata.get("source_type", f.dataType.simpleString())) for f in schema.fields]
    return metadata_frame(spark, rows, f"column string, {side}_type string")


def schema_diff(spark: SparkSession, old: T.StructType, new: T.StructType) -> DataFrame:
    """One row per column of either schema: what changed, and whether consumers break."""
    both = _described(spark, old, "old").join(_described(spark, new, "new"), "column", "full_outer")
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "dropped")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
        .otherwise("same")
    )
    return both.withColumn("change", change).withColumn("breaking", F.col("change").isin("dropped", "retyped"))


def require_compatible(spark: SparkSession, old: T.StructType, new: T.StructType) -> None:
    """Fail on a dropped, renamed or retyped column; added columns pass."""
    broken = [f"{r['column']} {r['change']}" for r in schema_diff(spark, old, new).where("breaking").collect()]
    if broken:
        raise IncompatibleSchema(", ".join(sorted(broken)))


def schema_impact(rows: DataFrame, old: T.StructType, new: T.StructType) -> DataFrame:
    """:func:`schema_diff` with the values at stake: the non-null count of each column in ``rows``."""
    spark = rows.sparkSession
    diff = schema_diff(spark, old, new)
    counted = [F.count(c).alias(c) for c in rows.columns]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in rows.columns]))
    filled = rows.agg(*counted).select(pairs.alias("p")).select("p.column", F.col("p.n").alias("values_present"))
    return diff.join(filled, "column", "left").withColumn("values_present", F.coalesce("values_present", F.lit(0)))


def fingerprint_gate(rows: DataFrame, accepted: Sequence[str], column: str = "schema_fingerprint") -> DataFrame:
    """Rows per fingerprint and whether a consumer that opted into ``accepted`` takes them."""
    return (
        rows.groupBy(column)
        .agg(F.count("*").alias("row_count"))
        .withColumn("accepted", F.col(column).isin(*accepted))
    )


# freshness ----------------------------------------------------------------

_BUCKET_BITS = 12


def nearest_rank(rows: DataFrame, group: str, value: str, quantile: float) -> DataFrame:
    """Exact ``quantile`` (nearest rank) of an integer column per group: ``(group, row_count, value)``.

    The rows are first reduced to a histogram, whose values fall into buckets of 4096. The rank is
    located among a group's bucket totals, then inside the one bucket that holds it. The windows
    see totals and the values of that bucket, never the whole histogram. Nulls are left out.
    """
    bucket = F.shiftright(value, _BUCKET_BITS).alias("bucket")
    fine = rows.where(F.col(value).isNotNull()).groupBy(group, bucket, value).agg(F.count("*").alias("n"))
    coarse = fine.groupBy(group, "bucket").agg(F.sum("n").alias("inside"))
    whole = Window.partitionBy(group)
    upward = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = coarse.select(
        F.col(group).alias("_group"),
        F.col("bucket").alias("_bucket"),
        "inside",
        (F.sum("inside").over(upward) - F.col("inside")).alias("below"),
        F.sum("inside").over(whole).alias("row_count"),
    ).withColumn("rank", F.ceil(F.col("row_count") * F.lit(quantile)))
    target = placed.where("below < rank AND rank <= below + inside")
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("bucket") == F.col("_bucket"))
    inner = whole.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = (F.col("below") + F.sum("n").over(inner)).alias("reached")
    found = fine.join(target, same).select(group, "row_count", "rank", value, reached)
    return found.where("reached >= rank").groupBy(group, "row_count").agg(F.min(value).alias(value))


def publication_times(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    """``(table, updated_at, committed_at)`` of the lake rows that still lie where a run wrote them."""
    commits = CommitLog(spark, root).records("kind string, run_id string, committed_at string")
    commits = commits.where("kind = 'ingest'").groupBy("run_id").agg(F.min("committed_at").alias("at"))
    rows = read_lake(spark, root, contract, with_run=True).select("run_id", UPDATED_AT)
    return rows.join(commits, "run_id").select(
        F.lit(contract.name).alias("table"), UPDATED_AT, F.col("at").cast("timestamp").alias("committed_at")
    )


def freshness(published: DataFrame, quantile: float = 0.95) -> DataFrame:
    """Publication lag in seconds per table, from ``(table, updated_at, committed_at)``."""
    lag = F.unix_seconds("committed_at") - F.unix_seconds(UPDATED_AT)
    lagged = published.select("table", lag.alias("lag_seconds"))
    return nearest_rank(lagged, "table", "lag_seconds", quantile)


def stale_cursors(cursors: DataFrame, published: DataFrame, max_lag_hours: int = 24) -> DataFrame:
    """Cursors more than ``max_lag_hours`` behind the newest published row.

    The newest instant is one value, compared as a scalar subquery.
    """
    newest = published.select(F.max(UPDATED_AT)).scalar()
    lag = F.unix_seconds(newest) - F.unix_seconds("cursor_at")
    return cursors.withColumn("lag_seconds", lag).where(F.col("lag_seconds") > max_lag_hours * 3600)


# comparison and shares ----------------------------------------------------


def snapshot_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with the side that has more and by how many.

    Both ``EXCEPT ALL`` directions at once: one signed count over the union, one shuffle, with
    equal rows cancelling before it where they meet.
    """
    names = expected.columns
    signed = expected.withColumn("sign", F.lit(1)).unionByName(actual.select(*names).withColumn("sign", F.lit(-1)))
    balance = signed.groupBy(*names).agg(F.sum("sign").alias("balance")).where("balance <> 0")
    side = F.when(F.col("balance") > 0, "expected").otherwise("actual")
    return balance.select(*names, side.alias("only_in"), F.abs("balance").alias("copies"))


def tenant_share(rows: DataFrame, tenant: str) -> DataFrame:
    """Changes per tenant and their share of all changes; the total is a scalar subquery."""
    total = rows.select(F.count("*")).scalar()
    counted = rows.groupBy(tenant).agg(F.count("*").alias("row_count"))
    return counted.withColumn("share", F.col("row_count") / total)


def microbatch_windows(rows: DataFrame, contract: Contract, width: str = "2 minutes") -> DataFrame:
    """Rows and identity digest of each commit window."""
    keyed = rows.select(
        F.window(UPDATED_AT, width)["start"].alias("window_start"),
        F.col(contract.key).cast("bigint").alias("pk"),
        UPDATED_AT,
    )
    hashed = with_lanes(keyed, identity_hash(contract.name, F.col("pk"), F.col(UPDATED_AT)))
    summed = hashed.groupBy("window_start").agg(F.count("*").alias("row_count"), *lane_parts())
    return summed.select("window_start", "row_count", *lane_columns())


def read_late_rows(source: TableSource, root: str) -> DataFrame:
    """:func:`late_rows` of a source against what has been published of it."""
    spark, contract = source.frame.sparkSession, source.contract
    mark = CommitLog(spark, root).checkpoint([contract.name]).mark(contract.name)
    return late_rows(source.frame, read_lake(spark, root, contract), contract, upto(mark, contract.key))


def late_rows(source_rows: DataFrame, lake_rows: DataFrame, contract: Contract, reached: Column) -> DataFrame:
    """Source rows at or before the mark that were never published; sync will not pick them up."""
    published = lake_rows.select(contract.key, UPDATED_AT)
    return source_rows.where(reached).join(published, [contract.key, UPDATED_AT], "left_anti")
