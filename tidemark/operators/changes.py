"""Applying changes to a table: upserts, and upserts with deletes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.contract import UPDATED_AT, Contract

OP = "op"


def latest_per_key(log_rows: DataFrame, contract: Contract, sequence: str = "seq") -> DataFrame:
    """The newest change of every key: by ``sequence`` if the rows have one, then by instant; a delete is the last of an instant.

    Rank 1 of a window: Spark keeps one row per key in each task before it shuffles, so a key
    with very many changes does not travel or pile up.
    """
    order = [F.col(sequence).desc()] if sequence in log_rows.columns and sequence not in contract.column_names else []
    order += [F.col(UPDATED_AT).desc()]
    order += [(F.col(OP) == "delete").desc()] if OP in log_rows.columns else []
    rank = F.row_number().over(Window.partitionBy(contract.key).orderBy(*order))
    return log_rows.withColumn("rank", rank).where("rank = 1").drop("rank")


def unchanged(rows: DataFrame, changes: DataFrame, contract: Contract) -> DataFrame:
    """The rows whose key ``changes`` does not name.

    Spark sends the keys to the rows where it knows or finds them to be few, and shuffles otherwise.
    """
    keys = changes.select(contract.key)
    names = contract.column_names
    return rows.select(*names).join(keys, contract.key, "left_anti").select(*names)


def apply_changes(rows: DataFrame, changes: DataFrame, contract: Contract) -> DataFrame:
    """``rows`` after an upsert of ``changes``, which holds each key once."""
    return unchanged(rows, changes, contract).unionByName(changes.select(*contract.column_names))


def merge_with_deletes(state: DataFrame, batch: DataFrame, contract: Contract) -> DataFrame:
    """``state`` after a batch whose ``op`` is ``upsert`` or ``delete``.

    Of several changes of a key the newest counts: by ``seq`` where the batch has one, then by
    instant; at one instant a delete is the last.
    """
    batch = latest_per_key(batch, contract)
    upserts = batch.where(F.col(OP) != "delete").select(*contract.column_names)
    return unchanged(state, batch, contract).unionByName(upserts)
