"""The given tables as sources: orders is rich in ties, events has unique microseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.checkpoint import HighWaterMark
from tidemark.contract import Contract
from tidemark.functions.canonical import iso_utc
from tidemark.sources.tables import TableSource, read_files

ORDERS = Contract(
    "orders",
    "order_id",
    (
        ("order_id", "bigint"),
        ("customer_id", "bigint"),
        ("status", "text"),
        ("priority", "text"),
        ("total", "numeric(15,2)"),
        ("updated_at", "timestamptz"),
    ),
)
EVENTS = Contract(
    "events",
    "event_id",
    (
        ("event_id", "bigint"),
        ("user_id", "bigint"),
        ("event_type", "text"),
        ("props", "text"),
        ("updated_at", "timestamptz"),
    ),
)
# The events read as a change log of users: each event is a new version of its user.
USERS = Contract(
    "users",
    "user_id",
    (("user_id", "bigint"), ("event_id", "bigint"), ("event_type", "text"), ("updated_at", "timestamptz")),
)

ORDERS_COLUMNS = {
    "order_id": "o_orderkey",
    "customer_id": "o_custkey",
    "status": "o_orderstatus",
    "priority": "o_orderpriority",
    "total": "o_totalprice",
    "updated_at": "o_orderdate",
}

# In the middle of nine orders of one instant (at scale 0.01).
MID_TIE = HighWaterMark("1998-06-15T00:00:00Z", 9699)
# In the middle of a day, so that two runs share a lake date.
EVENTS_CUT = HighWaterMark("2024-01-16T12:00:00Z", 0)
# Beyond every order.
ORDERS_END = HighWaterMark("2002-01-01T00:00:00Z", 0)


def session(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def orders(spark: SparkSession, sf_dir: str) -> TableSource:
    path = f"{sf_dir}/orders.parquet"
    return read_files(session(spark), ORDERS, path, mapping=ORDERS_COLUMNS, assume_utc=True)


def events(spark: SparkSession, sf_dir: str) -> TableSource:
    path = f"{sf_dir}/events.parquet"
    return read_files(session(spark), EVENTS, path, mapping={"updated_at": "ts"}, assume_utc=True)


def users_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).frame.select(*USERS.column_names)


def plain(rows: DataFrame) -> DataFrame:
    """Types both engines print alike: instants as canonical text, decimals as text."""

    def column(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.TimestampType):
            return iso_utc(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)

    return rows.select(*[column(f) for f in rows.schema.fields])
