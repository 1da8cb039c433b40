"""A run reads each source once, opens deferred ones for its own mark, and runs of one session leave its settings alone."""

import pytest
from helpers import files, local, one_more_customer, seeded, sync
from pyspark.sql import functions as F

from tidemark import CASES, CUSTOMERS, SyncOptions, TableSource
from tidemark.errors import ContractError, SourceError
from tidemark.session import timestamps_with_statistics
from tidemark.sources import seed
from tidemark.sources.published import read_lake
from tidemark.sources.tables import DeferredSource

LANES = SyncOptions(echo=False)
KEY = "spark.sql.parquet.outputTimestampType"


def moving(spark, seen):
    """Customers of a source that counts how often each row is read."""
    counted = F.udf(lambda key: seen.add(1) or key, "bigint").asNondeterministic()
    return TableSource.of(seed.customers(spark).withColumn("customer_id", counted("customer_id")), CUSTOMERS)


@pytest.mark.parametrize("dry_run", [True, False])
def test_every_row_is_read_once(spark, root, dry_run):
    seen = spark.sparkContext.accumulator(0)
    manifest = sync(spark, [moving(spark, seen)], root, dry_run=dry_run, options=LANES)
    assert manifest.table("customers").delta_row_count == seen.value == 30


def test_dry_run_leaves_nothing_behind(spark, root):
    shared = local(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in shared.glob("stage-*")}
    sync(spark, seeded(spark), root, dry_run=True, options=LANES)
    with pytest.raises(ContractError):
        bad = TableSource.of(seed.customers(spark).withColumn("customer_id", F.lit(-1).cast("bigint")), CUSTOMERS)
        sync(spark, [bad], root, dry_run=True, options=LANES)
    assert files(root) == {} and {p.name for p in shared.glob("stage-*")} == before


def test_deferred_source_is_opened_at_the_mark_of_the_run(spark, root):
    marks = []

    def opened(tables):
        def reader(mark):
            marks.append(mark)
            return tables[0]

        return [DeferredSource(CUSTOMERS, reader)]

    first = sync(spark, opened(seeded(spark)), root, options=LANES)
    second = sync(spark, opened(one_more_customer(spark)), root, options=LANES)
    assert first.table("customers").delta_row_count == 30
    # The reader gave all 31; the mark it was given cuts off what it had before.
    assert second.table("customers").delta_row_count == 1
    assert marks[0].pk == 0 and marks[1].at == first.checkpoint_after["customers"]["updated_at"]
    assert read_lake(spark, root, CUSTOMERS).count() == 31


def test_deferred_source_with_another_contract_is_refused(spark, root):
    wrong = DeferredSource(CUSTOMERS, lambda mark: TableSource.of(seed.cases(spark), CASES))
    with pytest.raises(SourceError):
        sync(spark, [wrong], root, options=LANES)
    # The claim is free again.
    assert sync(spark, seeded(spark), root, options=LANES).table("cases").delta_row_count == 200


def test_overlapping_runs_leave_the_setting_alone(spark):
    before = spark.conf.get(KEY)
    first, second = timestamps_with_statistics(spark), timestamps_with_statistics(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(KEY) == "TIMESTAMP_MICROS"
    second.__exit__(None, None, None)
    assert spark.conf.get(KEY) == before
