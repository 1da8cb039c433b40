"""Shared by the operators: intermediate tables, samples of labelled rows, joins on small sides."""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_root

#: A side of a join is broadcast up to this many rows of two longs, counted first; beyond it the join shuffles.
FEW = 2_000_000
#: A key is hot if it holds more than one in so many rows.
HOT_PARTS = 4_096
#: Over how many places the rows of a hot key are dealt.
SALTS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """The frame, written to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_root(spark, purpose)}-{time.time_ns()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def small_side(df: DataFrame, most: int = FEW) -> DataFrame:
    """``df`` with a broadcast hint where counting shows that it is small enough."""
    return F.broadcast(df) if df.count() <= most else df


def hot_keys(counted: DataFrame, key: str, rows: int) -> DataFrame:
    """The keys of ``counted(key, n)`` that hold more than one in ``HOT_PARTS`` of ``rows`` rows: fewer than ``HOT_PARTS``."""
    return counted.filter(F.col("n") * HOT_PARTS > rows).select(key)


def joined(rows: DataFrame, side: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``rows`` left joined with ``side``, which has one row for each key.

    Rows of a hot key are dealt over ``SALTS`` places by a hash of all their columns, and the key's row in ``side`` goes to
    each of them: at most ``HOT_PARTS * SALTS`` rows more. Rows without a key are dealt alike and meet nothing.
    """
    hot = F.broadcast(hot.select(F.col(key).alias("_hot")))
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")
    dealt = rows.join(hot, F.col(key) == F.col("_hot"), "left")
    dealt = dealt.withColumn("_salt", F.when(F.col("_hot").isNotNull() | F.col(key).isNull(), salt).otherwise(0)).drop("_hot")
    every = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copied = side.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(every)).drop("_hot")
    return dealt.join(copied, [key, "_salt"], "left").drop("_salt")


def labelled_sample(rows: DataFrame, label: str, key: str, per_class: int, most_classes: int = 256) -> DataFrame:
    """About ``per_class`` rows of each class (twice that at most over all), chosen by a hash of ``key``.

    One aggregate counts the classes; the rows are then a filter, so nothing is sorted or shuffled.
    """
    counts = {r[0]: r[1] for r in rows.filter(F.col(label).isNotNull()).groupBy(label).count().limit(most_classes).collect()}
    if not counts:
        return rows.limit(0)
    share = F.lit(None).cast("double")
    for value, n in counts.items():
        share = F.when(F.col(label) == F.lit(value), F.lit(per_class / n)).otherwise(share)
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(11)), F.lit(1_000_000)) / 1_000_000
    return rows.filter(draw < share).limit(2 * per_class * len(counts))


def groups(batches: Iterable[pa.RecordBatch], key: int = 0) -> Iterator[pa.Table]:
    """Runs of equal values of a sorted column, across batch borders."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            piece = batch.slice(a, b - a)
            if held and held[-1].column(key)[-1].as_py() != piece.column(key)[0].as_py():
                yield pa.Table.from_batches(held)
                held = []
            held.append(piece)
    if held:
        yield pa.Table.from_batches(held)


def labelled_documents(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int, longest: int) -> DataFrame:
    """``doc_id, label, text`` of a sample of labelled documents, at most ``2 * per_class`` rows for each label.

    The sample is drawn from the labels alone, so the join's small side has a fixed bound. A document with two
    different labels is left out, as are texts of more than ``longest`` characters.
    """
    rows = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn).select("doc_id", F.col(label).cast("int").alias("label"))
    rows = rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_high")).filter("label = _high").drop("_high")
    drawn = labelled_sample(rows, "label", "doc_id", per_class, 2)
    texts = docs.filter(F.length("text") <= longest).select("doc_id", "text")
    return texts.join(F.broadcast(drawn), "doc_id").select("doc_id", "label", "text").limit(4 * per_class)
