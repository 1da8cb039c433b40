"""Joins on keys that hold a large share of the rows, and components around a hub."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import neardup
from tidemark.llm.frames import HOT_PARTS, hot_keys, joined


def test_joined_is_a_left_join(spark):
    rows = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), "id")
    side = spark.range(-1, 4_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = hot_keys(rows.groupBy("k").agg(F.count("*").alias("n")), "k", 9_000)
    assert {r.k for r in hot.filter("k is not null").collect()} == {-1}
    got = joined(rows, side, "k", hot).select("id", "k", "v")
    want = rows.join(side, "k", "left").select("id", "k", "v")
    assert got.count() == 9_000 and got.exceptAll(want).count() == 0
    assert joined(rows.limit(0), side, "k", hot).count() == 0
    assert joined(rows, side.limit(0), "k", hot).filter("v is not null").count() == 0


def test_hot_keys_are_fewer_than_the_parts(spark):
    counted = spark.range(10 * HOT_PARTS).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    assert hot_keys(counted, "k", 10 * HOT_PARTS).count() == 0
    assert hot_keys(counted.limit(HOT_PARTS), "k", HOT_PARTS).count() == 0


def test_components_around_hubs_and_along_chains(spark):
    rng = np.random.default_rng(3)
    pairs = [(0, i) for i in range(1, 3_000)] + [(5_000 + i, 5_001 + i) for i in range(200)] + [(9_000, 9_000)]
    pairs += [(int(a), int(b)) for a, b in rng.integers(10_000, 10_400, (250, 2))] + [(7, 5_100), (10_001, 10_001)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    want = {x: find(x) for x in linked}
    key = lambda c: F.encode(F.format_string("%08d", F.col(c)), "utf-8")
    links = spark.createDataFrame(pairs, "a long, b long").select(key("a").alias("a"), key("b").alias("b"))
    got = {int(r.node): int(r.label) for r in neardup.components(links).collect()}
    assert got == want
