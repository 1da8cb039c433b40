"""The two demonstration tables and their change batch, generated on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import CASES
from tidemark.session import metadata_frame

# Fixed values of the demonstration data.
START = "2026-03-01T00:00:00Z"
CHANGED_AT = "2026-04-15T12:00:00Z"
CUSTOMER_NAME = "Customer %s"
CUSTOMER_EMAIL = "customer%s@example.com"
CASE_TITLE = "Case %s - %s review"
CASE_DESCRIPTION = "%s workflow item %d for customer %d: follow up on %s details and supporting documents."
COUNTRIES = ("US", "CA", "GB", "DE", "AU")
KEYWORDS = ("billing", "audit", "compliance", "payments", "reconciliation", "onboarding", "fraud", "AML")
STATUSES = ("open", "in_review", "resolved", "closed", "pending", "escalated")
STATUS_CHANGES = ((1, "escalated"), (50, "closed"), (100, "resolved"), (150, "in_review"), (200, "pending"))
NEW_CUSTOMERS = ((31, "US"), (32, "CA"))
NEW_CASES = (
    (201, 1, "Billing", "Followup billing reconciliation for customer 1.", "open"),
    (202, 31, "Onboarding", "Onboarding workflow for new customer 31.", "open"),
    (203, 5, "AML", "AML compliance check for customer 5.", "in_review"),
    (204, 32, "Onboarding", "Onboarding workflow for new customer 32.", "open"),
    (205, 10, "Fraud", "Fraud check for customer 10.", "pending"),
    (206, 31, "Compliance", "Compliance review for new customer 31.", "open"),
    (207, 15, "Payments", "Payments dispute for customer 15.", "in_review"),
    (208, 32, "Audit", "Audit follow-up for new customer 32.", "open"),
    (209, 20, "Reconciliation", "Reconciliation issue for customer 20.", "pending"),
    (210, 25, "Billing", "Billing dispute for customer 25.", "escalated"),
)


def cycle(values: tuple[str, ...], number: Column) -> Column:
    """The ``number``-th of endlessly repeated ``values``, counting from 1."""
    position = F.pmod(number - 1, F.lit(len(values))) + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), position.cast("int"))


def padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def after_start(seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(F.lit(START).cast("timestamp")) + seconds * 1_000_000)


def customer_columns(i: Column, country: Column, at: Column) -> list[Column]:
    return [
        i.alias("customer_id"),
        F.format_string(CUSTOMER_NAME, padded(i, 3)).alias("name"),
        F.format_string(CUSTOMER_EMAIL, padded(i, 3)).alias("email"),
        country.alias("country"),
        at.alias("updated_at"),
    ]


def customers(spark: SparkSession, count: int = 30) -> DataFrame:
    """One customer a day."""
    i = F.col("id")
    return spark.range(1, count + 1).select(*customer_columns(i, cycle(COUNTRIES, i), after_start((i - 1) * 86_400)))


def case_title(number: Column, keyword: Column) -> Column:
    return F.format_string(CASE_TITLE, padded(number, 4), keyword)


def cases(spark: SparkSession, count: int = 200, slots: int = 100) -> DataFrame:
    """Cases over thirty days in ``slots`` instants, so that case ``i`` ties with ``i + slots``."""
    i = F.col("id")
    keyword, customer = cycle(KEYWORDS, i), F.pmod(i - 1, F.lit(30)) + 1
    headline = F.initcap(keyword)
    return spark.range(1, count + 1).select(
        i.alias("case_id"),
        customer.alias("customer_id"),
        case_title(i, headline).alias("title"),
        F.format_string(CASE_DESCRIPTION, headline, i, customer, keyword).alias("description"),
        cycle(STATUSES, i).alias("status"),
        after_start(F.pmod(i - 1, F.lit(slots)) * (30 * 86_400 // slots)).alias("updated_at"),
    )


def customer_changes(spark: SparkSession) -> DataFrame:
    rows = metadata_frame(spark, NEW_CUSTOMERS, "id bigint, country string")
    return rows.select(*customer_columns(F.col("id"), F.col("country"), F.lit(CHANGED_AT).cast("timestamp")))


def case_changes(spark: SparkSession, current: DataFrame) -> DataFrame:
    """Five updated and ten new cases, all at one instant."""
    at = F.lit(CHANGED_AT).cast("timestamp").alias("updated_at")
    update = metadata_frame(spark, STATUS_CHANGES, "case_id bigint, new_status string")
    updated = current.join(update, "case_id").select(
        "case_id", "customer_id", "title", "description", F.col("new_status").alias("status"), at
    )
    added = metadata_frame(
        spark, NEW_CASES, "case_id bigint, customer_id bigint, keyword string, description string, status string"
    ).select(
        "case_id", "customer_id", case_title(F.col("case_id"), F.col("keyword")).alias("title"), "description", "status", at
    )
    return updated.select(*CASES.column_names).unionByName(added.select(*CASES.column_names))


