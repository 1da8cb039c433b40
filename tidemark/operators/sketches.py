"""Mergeable summaries kept beside the lake: publication lag as quantile sketches, tenants as heavy-hitter sketches.

A sketch is made once for what a run or a pane of time brought, has a bounded size, and sketches of any stretch are
merged into one without a look at the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import UPDATED_AT, Contract
from tidemark.plans.commits import CommitLog
from tidemark.sources.published import lake_paths, read_rows

#: Size parameter of the quantile sketches, and tenants that a heavy-hitter sketch tracks.
KLL_K, TRACKED = 200, 1_000
_LAG_SCHEMA = "table string, committed_at timestamp, sketch binary, run_id string"


def rank_error(k: int = KLL_K) -> float:
    """How far the rank of a sketch's quantile may be off, as a share of all rows, with 99 in 100 chance."""
    return 2.296 / k**0.9021  # fixed values of the sketch's authors


def lag_sketches(published: DataFrame, *groups: str, k: int = KLL_K) -> DataFrame:
    """A quantile sketch of the publication lag in seconds for each of ``groups``, from ``updated_at, committed_at``."""
    lag = F.unix_seconds("committed_at") - F.unix_seconds(UPDATED_AT)
    rows = published.where(lag.isNotNull()).withColumn("lag_seconds", lag)
    return rows.groupBy(*groups).agg(F.expr(f"kll_sketch_agg_bigint(lag_seconds, {k})").alias("sketch"))


def lag_quantile(sketches: DataFrame, *groups: str, quantile: float = 0.95) -> DataFrame:
    """``groups, row_count, lag_seconds``: the quantile of all rows behind the merged ``sketches``."""
    merged = sketches.groupBy(*groups).agg(F.expr("kll_merge_agg_bigint(sketch)").alias("sketch"))
    of = f"kll_sketch_get_quantile_bigint(sketch, {quantile}D)"
    return merged.select(*groups, F.expr("kll_sketch_get_n_bigint(sketch)").alias("row_count"), F.expr(of).alias("lag_seconds"))


def read_lags(spark: SparkSession, path: str) -> DataFrame:
    """The lag sketches below ``path``: ``table, committed_at, sketch, run_id``, one for each table and run."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], _LAG_SCHEMA)
    return spark.read.schema(_LAG_SCHEMA).parquet(path)


def update_lags(spark: SparkSession, root: str, contract: Contract, path: str, k: int = KLL_K) -> DataFrame:
    """Sketch the runs below ``root`` that have none yet, and return all sketches of the table.

    Only the new runs' directories are read, and of them the instants. A run sketched again is
    replaced by the same. Rows that compaction has moved since keep the sketch of their run.
    """
    log = CommitLog(spark, root)
    known = {r.run_id for r in read_lags(spark, path).where(F.col("table") == contract.name).select("run_id").distinct().collect()}
    leaves = log.live_leaves()
    own = leaves.get(contract.name, {})
    commits = log.records("kind string, run_id string, committed_at string").where("kind = 'ingest'")
    commits = commits.groupBy("run_id").agg(F.min("committed_at").cast("timestamp").alias("committed_at"))
    for fmt, paths in lake_paths(log, contract, {contract.name: {run: part for run, part in own.items() if run not in known}}).items():
        rows = read_rows(spark, contract, fmt, paths, with_run=True).select("run_id", UPDATED_AT).join(commits, "run_id")
        new = lag_sketches(rows.withColumn("table", F.lit(contract.name)), "table", "committed_at", "run_id", k=k)
        new.select("table", "committed_at", "sketch", "run_id").write.partitionBy("run_id").mode("append").parquet(path)
    return read_lags(spark, path).where(F.col("table") == contract.name)


def tenant_panes(rows: DataFrame, tenant: str, pane: str = "1 day", tracked: int = TRACKED) -> DataFrame:
    """``pane_start, rows, sketch``: the tenants of each pane of time in a summary of ``tracked`` counters.

    Each task summarises what it reads; nothing is grouped by tenant, and a dominant one costs one counter.
    """
    start = F.window(UPDATED_AT, pane)["start"].alias("pane_start")
    named = rows.where(F.col(tenant).isNotNull() & F.col(UPDATED_AT).isNotNull())
    return named.groupBy(start).agg(F.count("*").alias("rows"), F.expr(f"approx_top_k_accumulate({tenant}, {tracked})").alias("sketch"))


def overcount(rows: Column, tracked: int = TRACKED) -> Column:
    """How much too high an estimate may be: nothing up to as many tenants as counters, else this share of the rows."""
    counters = 1 << math.ceil(math.log2(tracked / 0.75))
    return F.ceil(rows * (3.5 / counters))  # fixed value of the summary's authors


def noisy_tenants(panes: DataFrame, tenant: str, span: int = 7, pane_seconds: int = 86_400, share: float = 0.01, tracked: int = TRACKED) -> DataFrame:
    """Tenants with at least ``share`` of the rows in each sliding window of ``span`` panes that ends with one of the panes.

    ``window_end, tenant, estimate, rows, overcount``: an estimate is never too low and at most
    ``overcount`` too high, so no tenant with that share is missed, as long as
    ``overcount`` is below it.
    """
    steps = F.sequence(F.lit(1), F.lit(span))
    last = panes.agg(F.max("pane_start")).collect()[0][0]  # one instant
    ends = panes.select(F.explode(steps).alias("_step"), "*").withColumn("window_end", F.timestamp_seconds(F.unix_seconds("pane_start") + F.col("_step") * pane_seconds))
    ends = ends.where(F.unix_seconds("window_end") <= F.unix_seconds(F.lit(last)) + pane_seconds)
    merged = ends.groupBy("window_end").agg(F.sum("rows").alias("rows"), F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    most = min(tracked, math.ceil(2 / share))
    found = merged.select("window_end", "rows", F.explode(F.expr(f"approx_top_k_estimate(sketch, {most})")).alias("t"))
    out = found.select("window_end", F.col("t.item").alias(tenant), F.col("t.count").alias("estimate"), "rows", overcount(F.col("rows"), tracked).cast("long").alias("overcount"))
    return out.where(F.col("estimate") >= F.col("rows") * share)
