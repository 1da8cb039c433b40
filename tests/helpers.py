from __future__ import annotations

import hashlib
import io
from contextlib import redirect_stdout
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame

import tidemark
from tidemark import CASES, CUSTOMERS, SyncOptions, TableSource
from tidemark.operators.changes import apply_changes
from tidemark.sources import seed

# The golden ids are those of the exact scheme.
FIRST_RUN = "dec1e0bc6b160622b3cc58de428fb8a1"
NO_OP_RUN = "aa5a57719b6d2ee57cb87d460310fe6f"
SECOND_RUN = "0c2783ba7f52971a48441c716ce793cf"


def sync(spark, tables, root, options: SyncOptions | None = None, **kwargs):
    """A run with exact ids unless the options say otherwise."""
    return tidemark.sync(spark, tables, root, options=options or SyncOptions(identity="exact"), **kwargs)


def utc(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=UTC)


def sources(customers: DataFrame, cases: DataFrame) -> list[TableSource]:
    return [TableSource.of(customers, CUSTOMERS), TableSource.of(cases, CASES)]


def seeded(spark) -> list[TableSource]:
    return sources(seed.customers(spark), seed.cases(spark))


def changed(spark) -> list[TableSource]:
    customers, cases = seed.customers(spark), seed.cases(spark)
    return sources(
        apply_changes(customers, seed.customer_changes(spark), CUSTOMERS),
        apply_changes(cases, seed.case_changes(spark, cases), CASES),
    )


def one_more_customer(spark) -> list[TableSource]:
    extra = spark.createDataFrame(
        [(99, "Customer 099", "c099@example.com", "US", "2026-04-20T10:00:00Z")],
        "customer_id bigint, name string, email string, country string, at string",
    ).selectExpr("customer_id", "name", "email", "country", "CAST(at AS TIMESTAMP) AS updated_at")
    return sources(seed.customers(spark).unionByName(extra), seed.cases(spark))


def local(uri: str) -> Path:
    return Path(uri.removeprefix("file:"))


def files(root: str) -> dict[str, str]:
    """Every visible file below a root with its digest."""
    base = local(root)
    return {
        str(f.relative_to(base)): hashlib.sha256(f.read_bytes()).hexdigest()
        for f in sorted(base.rglob("*"))
        if f.is_file() and not f.name.startswith((".", "_"))
    }


def lines(directory: str) -> list[str]:
    """The lines of an output directory, files in name order."""
    found: list[str] = []
    for part in sorted(local(directory).glob("part-*")):
        found += part.read_text(encoding="utf-8").splitlines()
    return found


def plan(df: DataFrame, mode: str = "formatted") -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
