import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.checkpoint import from_iso, to_iso
from tidemark.contract import CASES, CUSTOMERS, Contract
from tidemark.errors import ContractError
from tidemark.functions.canonical import canonical_json, canonical_row, canonical_text, iso_utc, parse_iso_utc
from tidemark.functions.digest import (
    lane_parts,
    lane_totals,
    run_id_from_identities,
    run_id_from_lanes,
    schema_fingerprint,
    sha256_prefix,
    with_lanes,
)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-03-31T12:00:00Z", "2026-03-31T12:00:00Z"),
        ("2026-03-31T12:00:00.123456Z", "2026-03-31T12:00:00.123456Z"),
        ("2026-03-31T12:00:00.120Z", "2026-03-31T12:00:00.120000Z"),
        ("2026-03-31T17:00:00+05:00", "2026-03-31T12:00:00Z"),
        ("2026-03-31T12:00:00", "2026-03-31T12:00:00Z"),
        ("1969-12-31T23:59:59.5Z", "1969-12-31T23:59:59.500000Z"),
        ("0001-01-01T00:00:00Z", "0001-01-01T00:00:00Z"),
    ],
)
def test_iso_text_in_spark_and_on_the_driver(spark, text, expected):
    shown = spark.range(1).select(iso_utc(parse_iso_utc(F.lit(text))).alias("t")).first().t
    assert shown == expected
    assert to_iso(from_iso(text)) == expected


def test_naive_datetime_is_rejected():
    with pytest.raises(ContractError):
        to_iso(datetime(2026, 1, 1))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=30), min_size=1, max_size=60))
def test_text_bytes_equal_the_reference_form(spark, texts):
    tricky = ["\x1f\x0b", "\\u001F", "\\\x1f", "\x1e\x1e", 'a"b', "tab\t", "é", " ", "\x7f", "\U0001f600"]
    rows = list(enumerate(texts + tricky))
    df = spark.createDataFrame(rows, "b bigint, a string")
    for row in df.select("b", "a", canonical_row(df.schema).alias("line")).collect():
        assert row.line == canonical_text({"a": row.a, "b": row.b})


def test_types_and_nesting(spark):
    schema = T.StructType(
        [
            T.StructField("z", T.DateType()),
            T.StructField("money", T.DecimalType(15, 2)),
            T.StructField("raw", T.BinaryType()),
            T.StructField("none", T.StringType()),
            T.StructField("marks", T.MapType(T.StringType(), T.StructType([T.StructField("y", T.LongType()), T.StructField("b", T.StringType())]))),
            T.StructField("list", T.ArrayType(T.DecimalType(5, 1))),
            T.StructField("missing", T.StructType([T.StructField("q", T.LongType())])),
        ]
    )
    value = (date(2026, 4, 15), Decimal("10.50"), "ü".encode(), None, {"b": (1, "x"), "a": (2, None)}, [Decimal("1.5"), None], None)
    line = spark.createDataFrame([value], schema).select(canonical_row(schema).alias("line")).first().line
    assert line == (
        '{"list":["1.5",null],"marks":{"a":{"b":null,"y":2},"b":{"b":"x","y":1}},"missing":null,'
        '"money":"10.50","none":null,"raw":"ü","z":"2026-04-15"}'
    )


@pytest.mark.parametrize("bad", ["NaN", "Infinity", "-Infinity"])
def test_numbers_without_a_json_form_fail(spark, bad):
    df = spark.range(1).select(F.lit(bad).cast("double").alias("x"))
    with pytest.raises(Exception, match="no canonical form"):
        df.select(canonical_json({"x": F.col("x")}, {"x": T.DoubleType()})).collect()


def test_timestamps_without_zone_have_no_form(spark):
    with pytest.raises(ContractError):
        canonical_json({"t": F.col("t")}, {"t": T.TimestampNTZType()})


def test_golden_fingerprints():
    assert schema_fingerprint(CUSTOMERS) == "7bccf22a775dcf2b"
    assert schema_fingerprint(CASES) == "2d76125b0e63dbbb"


def test_fingerprint_follows_every_part_of_the_contract():
    base = CUSTOMERS
    variants = [
        base,
        Contract("clients", base.key, base.columns),
        Contract(base.name, base.key, (*base.columns, ("phone", "text"))),
        Contract(base.name, base.key, base.columns[:-2] + (base.columns[-1],)),
        Contract(base.name, base.key, (base.columns[0], base.columns[2], base.columns[1], *base.columns[3:])),
        Contract(base.name, base.key, (base.columns[0], ("name", "bytea"), *base.columns[2:])),
    ]
    assert len({schema_fingerprint(v) for v in variants}) == len(variants)


@pytest.mark.parametrize("length", [0, 4, 65])
def test_digest_length_is_bounded(length):
    with pytest.raises(ContractError):
        schema_fingerprint(CUSTOMERS, length)
    with pytest.raises(ContractError):
        sha256_prefix(F.lit("x"), length)
    with pytest.raises(ContractError):
        run_id_from_lanes({}, {}, length)


def test_exact_ids_depend_on_row_order_and_mark_but_not_on_table_order():
    mark = {"a": {"last_pk": 1, "updated_at": "2026-03-31T12:00:00Z"}}
    base = run_id_from_identities(mark, {"a": ["1", "2"], "b": ["3"]})
    assert base == run_id_from_identities(mark, {"b": ["3"], "a": ["1", "2"]})
    assert base != run_id_from_identities(mark, {"a": ["2", "1"], "b": ["3"]})
    assert base != run_id_from_identities({}, {"a": ["1", "2"], "b": ["3"]})
    assert len(base) == 32


def test_lane_sums_are_exact(spark):
    import hashlib

    df = spark.range(500).select(F.col("id").cast("string").alias("t"))
    found = with_lanes(df, F.sha2("t", 256)).repartition(7).agg(*lane_parts()).first().asDict()
    hashes = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(500)]
    assert lane_totals(found) == [sum(int(h[15 * k : 15 * k + 15], 16) for h in hashes) for k in range(4)]


def test_canonical_text_rejects_nan():
    with pytest.raises(ValueError):
        canonical_text({"x": float("nan")})
    assert json.loads(canonical_text({"b": 1, "a": [None]})) == {"a": [None], "b": 1}
