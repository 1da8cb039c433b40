import math
import random
from dataclasses import replace

import pytest
from helpers import plan
from pyspark.sql import functions as F

from tidemark import CASES, CUSTOMERS, TableSource, sync
from tidemark.contract import Contract
from tidemark.errors import ContractError, IncompatibleSchema
from tidemark.operators.changes import merge_with_deletes
from tidemark.operators.consumer import as_of_state, latest_per_key
from tidemark.operators.quality import nearest_rank, require_compatible, schema_diff, snapshot_diff
from tidemark.plans.maintenance import compact
from tidemark.plans.sync import SyncOptions
from tidemark.sources import seed
from tidemark.sources.published import read_lake
from workload.tables import USERS, users_log


def test_schema_gate(spark):
    wider = Contract("customers", "customer_id", (*CUSTOMERS.columns, ("phone", "text")))
    require_compatible(spark, CUSTOMERS.schema, wider.schema)
    with pytest.raises(IncompatibleSchema, match="phone dropped"):
        require_compatible(spark, wider.schema, CUSTOMERS.schema)
    retyped = Contract("customers", "customer_id", (("customer_id", "integer"), *CUSTOMERS.columns[1:]))
    with pytest.raises(IncompatibleSchema, match="customer_id retyped"):
        require_compatible(spark, CUSTOMERS.schema, retyped.schema)
    assert schema_diff(spark, CASES.schema, CASES.schema).where("breaking").count() == 0


@pytest.mark.parametrize("quantile", [0.0001, 0.5, 0.95, 1.0])
def test_nearest_rank_is_exact(spark, quantile):
    rng = random.Random(5)
    values = {g: [rng.choice([7, rng.randint(-9_000, 40_000)]) for _ in range(n)] for g, n in (("a", 1), ("b", 999), ("c", 400))}
    rows = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g string, v bigint")
    found = {r.g: (r.row_count, r.v) for r in nearest_rank(rows, "g", "v", quantile).collect()}
    known = rows.unionByName(spark.createDataFrame([("a", None)], "g string, v bigint"))
    assert nearest_rank(known, "g", "v", quantile).count() == 3
    assert found == {g: (len(vs), sorted(vs)[math.ceil(len(vs) * quantile) - 1]) for g, vs in values.items()}


def test_snapshot_diff_counts_copies(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k bigint, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "w"), (4, "w")], "k bigint, v string")
    found = {(r.k, r.v, r.only_in, r.copies) for r in snapshot_diff(a, b).collect()}
    assert found == {(1, "x", "expected", 1), (3, "z", "expected", 1), (4, "w", "actual", 2)}
    assert plan(snapshot_diff(a, b), "simple").count("Exchange") == 1


def test_latest_per_key_reduces_before_the_shuffle(spark):
    shown = plan(latest_per_key(users_log(spark, "/root/testdata/sf0.001"), USERS), "simple")
    assert shown.index("WindowGroupLimit") < shown.index("Exchange") < shown.rindex("WindowGroupLimit")


def test_tombstones_and_merge(spark):
    rows = seed.cases(spark, 20)
    later = F.col("updated_at") + F.expr("INTERVAL 1 YEAR")
    changes = (
        rows.where("case_id <= 6")
        .withColumn("op", F.when(F.col("case_id") <= 2, "delete").otherwise("upsert"))
        .withColumn("status", F.lit("merged"))
        .withColumn("updated_at", later)
        .unionByName(rows.where("case_id = 20").withColumn("case_id", F.lit(99).cast("bigint")).withColumn("op", F.lit("delete")))
    )
    merged = merge_with_deletes(rows, changes, CASES)
    log = rows.withColumn("op", F.lit("upsert")).unionByName(changes)
    assert merged.exceptAll(as_of_state(log, CASES)).count() == 0
    assert merged.count() == 18 and merged.where("status = 'merged'").count() == 4


def test_changes_are_joined_by_key_or_sent_along(spark):
    from tidemark.operators import changes as module
    from workload.tables import ORDERS, orders

    rows = orders(spark, "/root/testdata/sf0.001").frame
    some = rows.where("order_id < 10").withColumn("status", F.lit("X"))
    few = module.apply_changes(rows, some, ORDERS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        many = module.apply_changes(rows, some, ORDERS)
        assert plan(many, "simple").count("hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert few.exceptAll(many).count() == 0 and few.count() == 1500 and few.where("status = 'X'").count() == 10


def test_merge_counts_only_the_newest_change_of_a_key(spark):
    rows = seed.cases(spark)
    one = rows.where("case_id = 7")
    twice = one.withColumn("op", F.lit("upsert")).unionByName(one.withColumn("op", F.lit("delete")))
    merged = merge_with_deletes(rows, twice, CASES)
    assert merged.count() == rows.count() - 1 and merged.where("case_id = 7").count() == 0


def test_tenants_of_a_committed_lake(spark, root):
    names = F.when(F.col("case_id") % 3 == 0, "a/b").when(F.col("case_id") % 3 == 1, "").otherwise(F.lit(None))
    contract = replace(CASES, columns=(*CASES.columns, ("country", "text")), tenant="country")
    rows = seed.cases(spark).withColumn("country", names).select(*contract.column_names)
    options = SyncOptions(echo=False)
    for bound in (60, 200):
        early = rows.where(F.col("case_id") <= bound).withColumn("updated_at", F.make_timestamp(F.lit(2026), F.lit(3), F.lit(1), F.lit(0), F.lit(bound // 10), F.lit(0)))
        sync(spark, [TableSource.of(early, contract)], root, options=options)
    assert read_lake(spark, root, contract).count() == 260
    found = read_lake(spark, root, contract, tenant="a/b")
    assert found.count() == 20 + 66 and "PartitionFilters: [isnotnull(lake_tenant" in plan(found, "simple")
    assert read_lake(spark, root, contract, tenant="").where("country = ''").count() == 20 + 67
    compact(spark, root, contract)
    rows = read_lake(spark, root, contract, with_run=True)
    assert rows.count() == 260 and rows.where("run_id NOT LIKE 'compact%'").count() == 0
    assert read_lake(spark, root, contract, tenant="a/b").count() == 86
    with pytest.raises(ContractError, match="tenant"):
        read_lake(spark, root, CASES, tenant="x")


def test_rows_without_an_instant_stop_the_run(spark, root):
    rows = seed.cases(spark).withColumn("updated_at", F.when(F.col("case_id") != 7, F.col("updated_at")))
    with pytest.raises(ContractError, match="lack updated_at"):
        sync(spark, [TableSource.of(rows, CASES)], root, options=SyncOptions(echo=False))
