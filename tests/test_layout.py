"""Files of a clustered table: what is opened, hot tenants, missing values."""

from datetime import UTC, datetime, timedelta

import pytest
from helpers import plan
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators.layout import MISSING, Layout, clustered

SCHEMA = "id long, tenant string, at timestamp, note string"
START = datetime(2024, 1, 1, tzinfo=UTC)


@pytest.fixture(scope="module")
def rows(spark):
    """20,000 rows over 100 days; a third of them of one tenant, the others of a thousand; one row is from 1970."""
    n = spark.range(20_000)
    tenant = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 1_000))
    at = F.when(F.col("id") == 5, F.timestamp_seconds(F.lit(0))).otherwise(
        F.timestamp_seconds(F.lit(int(START.timestamp())) + F.pmod(F.xxhash64("id"), F.lit(100 * 86_400)))
    )
    return n.select("id", tenant.alias("tenant"), at.alias("at"), F.lit("x").alias("note"))


@pytest.fixture(scope="module")
def layout(spark, rows, tmp_path_factory):
    found = Layout("file:" + str(tmp_path_factory.mktemp("clustered") / "table"), "tenant", "at")
    found.write(rows, file_rows=200)
    return found


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_files_touched(spark, rows, layout):
    every = layout.files(spark).agg(F.count("*").alias("n"), F.sum("rows").alias("rows"), F.max("rows").alias("most")).first()
    assert every.rows == 20_000
    assert every.n >= 90
    # The hot tenant is cut like any other range.
    assert every.most < 600
    day = START + timedelta(days=50)
    of_tenant = layout.files(spark, "t7").count()
    of_days = layout.files(spark, first=day, until=day + timedelta(days=3)).count()
    of_both = layout.files(spark, "t7", day, day + timedelta(days=3)).count()
    hot_days = layout.files(spark, "hot", day, day + timedelta(days=3)).count()
    # One of a thousand tenants, or three of a hundred days: about the square root of all files, and of both a few.
    # A file's range of the order may reach over two neighbouring rectangles, hence the room in these bounds.
    assert of_tenant <= every.n / 4
    assert of_days <= every.n / 3
    assert of_both <= every.n / 12
    assert hot_days <= every.n / 8


@pytest.mark.parametrize("tenant", [None, "t7", "hot", "nobody"])
@pytest.mark.parametrize("days", [None, (50, 53), (0, 1), (200, 201)])
def test_reads_equal_a_filter(spark, rows, layout, tenant, days):
    first, until = (START + timedelta(days=d) for d in days) if days else (None, None)
    want = rows
    if tenant:
        want = want.where(F.col("tenant") == tenant)
    if days:
        want = want.where((F.col("at") >= F.lit(first)) & (F.col("at") < F.lit(until)))
    assert ids(layout.read(spark, rows.schema, tenant, first, until)) == ids(want)


def test_missing_values_repeats_and_ties(spark, root):
    at = START
    data = [(1, None, at, "a"), (2, "a", None, "b"), (3, None, None, "c"), (4, "", at, ""), (5, "a", at, None), (5, "a", at, None), (6, "b", at, "d")]
    rows = spark.createDataFrame(data, SCHEMA)
    layout = Layout(root, "tenant", "at")
    layout.write(rows, file_rows=2)
    assert ids(layout.read(spark, rows.schema)) == [1, 2, 3, 4, 5, 5, 6]
    assert ids(layout.read(spark, rows.schema, "a")) == [2, 5, 5]
    assert ids(layout.read(spark, rows.schema, "")) == [4]
    assert ids(layout.read(spark, rows.schema, MISSING)) == [1, 3]
    assert ids(layout.read(spark, rows.schema, first=at)) == [1, 4, 5, 5, 6]
    assert ids(layout.read(spark, rows.schema, until=at)) == []


def test_empty_and_clashing(spark, root):
    layout = Layout(root, "tenant", "at")
    empty = spark.createDataFrame([], SCHEMA)
    layout.write(empty)
    assert layout.read(spark, empty.schema).count() == 0
    assert layout.read(spark, empty.schema, "a").count() == 0
    with pytest.raises(ContractError):
        clustered(empty.withColumn("_z_place", F.lit(1)), "tenant", "at")
    # Names of the table of files are free.
    named = spark.createDataFrame([(1, "a", START, "n", 3)], f"{SCHEMA}, rows int").withColumnRenamed("note", "file")
    second = Layout(f"{root}-named", "tenant", "at")
    second.write(named)
    assert second.read(spark, named.schema, "a").select("file", "rows").collect() == [("n", 3)]


def test_one_shuffle_by_range(spark, rows):
    shown = plan(clustered(rows, "tenant", "at", 500), "simple")
    assert shown.count("Exchange rangepartitioning") == 1
    assert shown.count("Exchange") == 1
