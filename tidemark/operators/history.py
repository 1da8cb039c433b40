"""The change log as history: validity intervals, and the version in force at many instants at once.

A key with very many versions is cut into bins of time of about ``BIN_ROWS`` rows, all others have one bin; windows
run inside a bin, and one over the bins of a key, which are few, carries the last version from bin to bin. So no task
gets a hot key whole.

Versions of one key at one instant are decided first: by ``sequence`` where the log has one, then a delete is the last, then
by the larger hash of the row. Only the winner of an instant is ever in force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.contract import UPDATED_AT, Contract
from tidemark.operators.changes import OP
from tidemark.session import written

#: Versions of a key in one bin, if they are spread evenly over its time.
BIN_ROWS = 10_000
VALID_FROM, VALID_TO = "valid_from", "valid_to"


def decided(log_rows: DataFrame, contract: Contract, sequence: str = "seq") -> DataFrame:
    """One version for each key and instant: the last by ``sequence``, then a delete, then by hash."""
    names = contract.column_names
    order = [F.col(sequence).desc()] if sequence in log_rows.columns and sequence not in names else []
    order += [(F.col(OP) == "delete").desc()] if OP in log_rows.columns else []
    order += [F.xxhash64(*names).desc()]
    rank = F.row_number().over(Window.partitionBy(contract.key, UPDATED_AT).orderBy(*order))
    kept = [*names, *([OP] if OP in log_rows.columns and OP not in names else [])]
    return log_rows.withColumn("_rank", rank).where("_rank = 1").select(*kept)


def _hot(rows: DataFrame, key: str, bin_rows: int) -> DataFrame:
    """``_hot, _from, _width`` (microseconds) of the keys that need more than one bin; at most one in ``bin_rows`` rows."""
    at = F.unix_micros(UPDATED_AT)
    sizes = rows.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_n"), F.min(at).alias("_from"), F.max(at).alias("_last"))
    width = F.greatest(F.lit(1), F.expr(f"(_last - _from) div ((_n + {bin_rows - 1}) div {bin_rows})") + 1)
    return written(sizes.where(F.col("_n") > bin_rows).select("_hot", "_from", width.alias("_width")), "hot-keys")


def _binned(rows: DataFrame, hot: DataFrame, key: str, at: str) -> DataFrame:
    """``rows`` with the ``_bin`` of their instant; 0 for keys with a single one."""
    place = F.expr(f"coalesce((unix_micros({at}) - _from) div _width, 0)")
    place = F.when(F.unix_micros(at) < F.col("_from"), F.lit(-1)).otherwise(place)
    return rows.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_bin", F.coalesce(place, F.lit(0))).drop("_hot", "_from", "_width")


def validity(log_rows: DataFrame, contract: Contract, sequence: str = "seq", bin_rows: int = BIN_ROWS) -> DataFrame:
    """Every version with its interval ``[valid_from, valid_to)``; the last of a key ends never (null).

    A delete ends the version before it and is no version itself.
    """
    key, own = contract.key, decided(log_rows, contract, sequence)
    rows = _binned(own, _hot(own, key, bin_rows), key, UPDATED_AT)
    starts = rows.groupBy(key, "_bin").agg(F.min(UPDATED_AT).alias("_start"))
    following = F.lead("_start").over(Window.partitionBy(key).orderBy("_bin"))
    starts = starts.select(F.col(key).alias("_key"), F.col("_bin").alias("_own"), following.alias("_next"))
    rows = rows.withColumn(VALID_TO, F.lead(UPDATED_AT).over(Window.partitionBy(key, "_bin").orderBy(UPDATED_AT)))
    # Only the last version of a bin asks for the next bin.
    last = rows.where(F.col(VALID_TO).isNull()).drop(VALID_TO).join(starts, (F.col(key) == F.col("_key")) & (F.col("_bin") == F.col("_own")))
    ended = rows.where(F.col(VALID_TO).isNotNull()).unionByName(last.withColumn(VALID_TO, F.col("_next")).drop("_key", "_own", "_next"))
    if OP in own.columns:
        ended = ended.where(F.col(OP) != "delete")
    return ended.select(*contract.column_names, F.col(UPDATED_AT).alias(VALID_FROM), VALID_TO)


def in_force(probes: DataFrame, log_rows: DataFrame, contract: Contract, at: str = "at", sequence: str = "seq", bin_rows: int = BIN_ROWS) -> DataFrame:
    """``probes`` (the contract's key, an instant ``at``, other columns) with the ``version`` in force then.

    ``version`` is a struct of the contract's columns, null where the key has none yet or is deleted. A
    version is in force at its own instant. Probes with a null key or instant have none.
    """
    key, own = contract.key, decided(log_rows, contract, sequence)
    placed = probes.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    hot = _hot(own, key, bin_rows)
    packed = F.struct(*(F.col(c) for c in own.columns))
    versions = _binned(own, hot, key, UPDATED_AT).select(F.col(key).alias("_key"), "_bin", F.unix_micros(UPDATED_AT).alias("_at"), packed.alias("version"))
    asked = _binned(placed, hot, key, at)
    payload = F.struct(*(F.col(c) for c in probes.columns))
    asked = asked.select(F.col(key).alias("_key"), "_bin", F.unix_micros(at).alias("_at"), payload.alias("probe"))

    # What a bin inherits: the last version of the nearest earlier bin that has any.
    lasts = versions.groupBy("_key", "_bin").agg(F.max_by("version", "_at").alias("version"))
    bins = lasts.unionByName(asked.select("_key", "_bin").distinct().withColumn("version", F.lit(None).cast(lasts.schema["version"].dataType)))
    bins = bins.groupBy("_key", "_bin").agg(F.first("version", ignorenulls=True).alias("version"))
    before = Window.partitionBy("_key").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = bins.select("_key", "_bin", F.last("version", ignorenulls=True).over(before).alias("version"))
    carried = carried.where(F.col("version").isNotNull()).select("_key", "_bin", F.lit(-(1 << 63)).alias("_at"), "version")

    none = F.lit(None)
    rows = versions.unionByName(carried).withColumn("probe", none.cast(asked.schema["probe"].dataType))
    rows = rows.unionByName(asked.withColumn("version", none.cast(lasts.schema["version"].dataType)))
    upto = Window.partitionBy("_key", "_bin").orderBy("_at", F.col("probe").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("version", F.last("version", ignorenulls=True).over(upto)).where("probe IS NOT NULL")
    living = F.col("version")
    if OP in own.columns:
        living = F.when(F.col(f"version.{OP}") != "delete", living)
    out = found.select("probe.*", living.alias("version"))
    return out.unionByName(probes.where(F.col(key).isNull() | F.col(at).isNull()).withColumn("version", none.cast(lasts.schema["version"].dataType)))
