from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from helpers import plan
from pyspark.sql import functions as F

from tidemark import CASES, CUSTOMERS, HighWaterMark, TableSource
from tidemark.operators.delta import delta, numbered, ordered
from tidemark.operators.identity import row_identities
from tidemark.operators.summary import checkpoint_advance, delta_counts, digests, partition_counts, touched_partitions
from tidemark.checkpoint import Checkpoint
from tidemark.sources import seed
from workload.tables import MID_TIE, ORDERS, orders

SF = "/root/testdata/sf0.001"


def test_mark_inside_a_tie(spark):
    source = TableSource.of(seed.cases(spark), CASES)
    rows = ordered(delta(source, HighWaterMark("2026-03-15T16:48:00Z", 50)), CASES)
    ids = [r.case_id for r in rows.collect()]
    assert len(ids) == 101
    assert ids[:5] == [150, 51, 151, 52, 152]
    assert 50 not in ids


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 2500), st.integers(0, 1600))
def test_any_cut_splits_without_gap_or_overlap(spark, day, pk):
    source = orders(spark, SF)
    at = spark.range(1).select(F.date_format(F.date_add(F.lit("1995-01-01"), day), "yyyy-MM-dd").alias("d")).first().d
    cut = HighWaterMark(at, pk)
    before, after = delta(source, HighWaterMark(), cut), delta(source, cut)
    both = before.unionByName(after)
    assert both.count() == 1500
    assert both.select("order_id").distinct().count() == 1500


def test_filter_and_columns_reach_the_scan(spark):
    shown = plan(delta(orders(spark, SF), MID_TIE).select("order_id"))
    assert "PushedFilters: [Or(GreaterThan(o_orderdate" in shown
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in shown
    assert "Exchange" not in shown


def test_date_partitions_are_pruned(spark, tmp_path):
    path = f"file:{tmp_path}/customers"
    seed.customers(spark).withColumn("date", F.date_format("updated_at", "yyyy-MM-dd").cast("date")).write.partitionBy("date").parquet(path)
    source = TableSource.of(spark.read.parquet(path), CUSTOMERS, date_column="date")
    rows = delta(source, HighWaterMark("2026-03-28T00:00:00Z", 28))
    assert rows.columns == CUSTOMERS.column_names
    assert sorted(r.customer_id for r in rows.collect()) == [29, 30]
    assert "PartitionFilters: [isnotnull(date" in plan(rows)


def test_aggregates_read_two_columns(spark):
    deltas = {"orders": delta(orders(spark, SF), MID_TIE)}
    for df in (
        digests(deltas, [ORDERS]),
        partition_counts(deltas, [ORDERS]),
        checkpoint_advance(deltas, [ORDERS], Checkpoint({})),
    ):
        assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan(df) or (
            "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan(df)
        )
    assert "Sort [" not in plan(digests(deltas, [ORDERS]))


def test_summary_of_the_seed(spark):
    deltas = {"customers": seed.customers(spark), "cases": seed.cases(spark).where("false")}
    pair = [CUSTOMERS, CASES]
    assert [tuple(r) for r in delta_counts(deltas, pair).orderBy("table_ordinal").collect()] == [(0, "customers", 30), (1, "cases", 0)]
    before = Checkpoint({"cases": HighWaterMark("2026-01-01", 5)})
    assert {tuple(r) for r in checkpoint_advance(deltas, pair, before).collect()} == {
        ("customers", "2026-03-30T00:00:00Z", 30),
        ("cases", "2026-01-01T00:00:00Z", 5),
    }
    found = touched_partitions(deltas, pair).collect()
    assert [r.position for r in found] == list(range(1, 31))
    dates = [r.date for r in found]
    assert dates == sorted(dates) and len(dates) == 30 and dates[0] == "2026-03-01"


def test_identities_keep_their_order(spark):
    rows = spark.createDataFrame([(2, "2026-03-02"), (1, "2026-03-01")], "case_id bigint, t string").selectExpr(
        "case_id", "CAST(t AS TIMESTAMP) AS updated_at"
    )
    assert [r.pk for r in row_identities(rows, CASES).collect()] == [2, 1]


def test_numbers_follow_the_order_over_all_ranges(spark):
    rows = seed.cases(spark).repartition(7, "case_id")
    found = numbered(rows, CASES).orderBy("row_number").collect()
    assert [r.row_number for r in found] == list(range(1, 201))
    assert [(r.updated_at, r.case_id) for r in found] == sorted((r.updated_at, r.case_id) for r in rows.collect())
    assert numbered(rows.where("false"), CASES).count() == 0
