import pytest
from helpers import utc
from pyspark.sql import functions as F

from tidemark.checkpoint import EMPTY_AT, Checkpoint, HighWaterMark
from tidemark.contract import CASES, CUSTOMERS, Contract, contracts_by_name, spark_type
from tidemark.errors import CheckpointCorrupt, ContractError, SourceError
from tidemark.operators.validate import checked, invalid_rows, quarantine_split
from tidemark.session import require_utc
from tidemark.sources import seed
from tidemark.sources.tables import TableSource, jdbc_slices, read_files

AT = ("updated_at", "timestamptz")


@pytest.mark.parametrize(
    "key, columns",
    [
        ("id", (("other", "bigint"), AT)),
        ("id", (("id", "bigint"),)),
        ("id", (("id", "bigint"), ("id", "bigint"), AT)),
        ("id", (("id", "bigint"), ("x", "hyperint"), AT)),
        ("id", (("id", "text"), AT)),
        ("id", (("id", "bigint"), ("updated_at", "date"))),
    ],
)
def test_broken_contracts_are_rejected(key, columns):
    with pytest.raises(ContractError):
        Contract("t", key, columns)


@pytest.mark.parametrize(
    "source_type, shown",
    [("numeric(15,2)", "decimal(15,2)"), ("numeric(9)", "decimal(9,0)"), ("varchar(20)", "string"), ("jsonb", "string")],
)
def test_source_types(source_type, shown):
    assert spark_type(source_type).simpleString() == shown
    for bad in ("numeric", "numeric(40,2)", "text(3)", "interval"):
        with pytest.raises(ContractError):
            spark_type(bad)


def test_contract_lookup_and_metadata():
    assert contracts_by_name([CUSTOMERS, CASES])["cases"] is CASES
    with pytest.raises(ContractError):
        contracts_by_name([CASES, CASES])
    assert CASES.schema["updated_at"].metadata == {"source_type": "timestamptz"}


def test_source_must_satisfy_the_contract(spark):
    rows = seed.customers(spark)
    with pytest.raises(ContractError, match="no column"):
        TableSource.of(rows.drop("email"), CUSTOMERS)
    with pytest.raises(ContractError, match="is int"):
        TableSource.of(rows.withColumn("email", F.lit(1)), CUSTOMERS)
    naive = rows.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))
    with pytest.raises(ContractError, match="time zone"):
        TableSource.of(naive, CUSTOMERS)
    assert TableSource.of(naive, CUSTOMERS, assume_utc=True).frame.schema["updated_at"].dataType.simpleString() == "timestamp"
    extra = TableSource.of(rows.withColumn("secret", F.lit("x")), CUSTOMERS)
    assert extra.frame.columns == CUSTOMERS.column_names


def test_session_must_be_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ContractError):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_files_of_several_formats(spark, tmp_path):
    rows = seed.customers(spark)
    for fmt in ("parquet", "orc", "json", "csv"):
        path = f"file:{tmp_path}/{fmt}"
        rows.write.format(fmt).save(path)
        assert read_files(spark, CUSTOMERS, path, fmt).frame.exceptAll(rows).count() == 0
    with pytest.raises(SourceError):
        read_files(spark, CUSTOMERS, f"file:{tmp_path}/none")


def test_marks():
    assert HighWaterMark() == HighWaterMark(EMPTY_AT, 0)
    assert HighWaterMark("2026-03-31T17:00:00+05:00", 1).at == "2026-03-31T12:00:00Z"
    assert HighWaterMark(utc(2026, 3, 31, 12), 1) == HighWaterMark("2026-03-31T12:00:00", 1)
    for at, pk in (("2026-03-31", -1), ("not-a-date", 1), ("2026-03-31", 1.5)):
        with pytest.raises(ValueError):
            HighWaterMark(at, pk)


def test_checkpoint_defaults_and_order():
    one = Checkpoint.parse('{"customers":{"updated_at":"2026-03-31T12:00:00Z","last_pk":30}}')
    assert one.mark("customers").pk == 30
    assert one.mark("cases") == HighWaterMark()
    both = one.for_tables(["cases", "customers"])
    assert list(both.as_dict()) == ["cases", "customers"]
    assert Checkpoint.parse(both.pretty()) == Checkpoint(dict(reversed(list(both.marks.items()))))
    assert both.pretty().startswith('{\n  "cases"') and both.pretty().endswith("}\n")
    moved = both.advance({"cases": HighWaterMark("2026-04-01", 7)})
    assert both.mark("cases").pk == 0 and moved.mark("cases").pk == 7


@pytest.mark.parametrize(
    "body", ["not-json{", '"hello"', "[]", '{"t":{}}', '{"t":{"updated_at":"not-a-date","last_pk":1}}', '{"t":{"updated_at":"2026-01-01","last_pk":-1}}']
)
def test_corrupt_checkpoints_are_reported(body):
    with pytest.raises(CheckpointCorrupt):
        Checkpoint.parse(body)


def test_invalid_rows(spark):
    rows = seed.customers(spark, 4).withColumn(
        "customer_id", F.when(F.col("customer_id") == 1, -1).when(F.col("customer_id") != 2, F.col("customer_id"))
    ).withColumn("updated_at", F.when(F.col("country") != "GB", F.col("updated_at")))
    reasons = {r.name: r.reason for r in invalid_rows(rows, CUSTOMERS).collect()}
    assert reasons == {
        "Customer 001": "key is negative", "Customer 002": "key is missing", "Customer 003": "updated_at is missing",
    }
    good, bad = quarantine_split(rows, CUSTOMERS)
    assert (good.count(), bad.count()) == (1, 3)
    with pytest.raises(Exception, match="customers: "):
        checked(rows, CUSTOMERS).collect()
    assert checked(good, CUSTOMERS).exceptAll(good).count() == 0


@pytest.mark.parametrize("time_slices, key_slices", [(1, 1), (7, 3)])
def test_jdbc_slices_cover_the_window_once(time_slices, key_slices):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(
        "CREATE TABLE cases AS SELECT i AS case_id, TIMESTAMPTZ '2026-03-01 00:00:00+00' + to_seconds((i % 50) * 999) AS updated_at "
        "FROM range(1, 1001) t(i)"
    )
    after, until = HighWaterMark("2026-03-01T02:46:30Z", 510), HighWaterMark("2026-03-01T11:05:24Z", 640)
    slices = jdbc_slices(CASES, after, until, "2026-03-01T02:46:30Z", time_slices, key_slices)
    assert len(slices) == time_slices * key_slices
    taken = [r for s in slices for r in con.execute(f"SELECT case_id FROM cases WHERE {s}").fetchall()]
    rows = con.execute("SELECT epoch_us(updated_at), case_id FROM cases").fetchall()
    low, high = ((round(m.sort_key[0].timestamp() * 1e6), m.pk) for m in (after, until))
    wanted = [(pk,) for at, pk in rows if low < (at, pk) <= high]
    assert sorted(taken) == sorted(wanted) and len(wanted) > 100
