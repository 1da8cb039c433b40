"""Table contracts: which columns a table publishes, their source types and its key."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.errors import ContractError

UPDATED_AT = "updated_at"

# Source type names and the Spark types that carry them.
SPARK_TYPES: dict[str, T.DataType] = {
    "smallint": T.ShortType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "real": T.FloatType(),
    "double precision": T.DoubleType(),
    "text": T.StringType(),
    "varchar": T.StringType(),
    "uuid": T.StringType(),
    "json": T.StringType(),
    "jsonb": T.StringType(),
    "bytea": T.BinaryType(),
    "date": T.DateType(),
    "timestamptz": T.TimestampType(),
}
KEY_TYPES = ("smallint", "integer", "bigint")


def spark_type(source_type: str) -> T.DataType:
    """The Spark type for a source type, ``numeric(p,s)`` and ``varchar(n)`` included."""
    name, _, arguments = source_type.partition("(")
    sizes = [int(n) for n in re.findall(r"\d+", arguments)]
    if name == "numeric" and 1 <= len(sizes) <= 2 and sizes[0] <= 38:
        return T.DecimalType(*sizes, *([0] if len(sizes) == 1 else []))
    if name in SPARK_TYPES and (not arguments or name == "varchar"):
        return SPARK_TYPES[name]
    raise ContractError(f"no Spark type for source type {source_type!r}")


# The members of a share record besides the table's key.
ENVELOPE_NAMES = ("checkpoint_after", "op", "record", "run_id", "schema_fingerprint", "table", "updated_at")


@dataclass(frozen=True)
class Contract:
    """One published table.

    ``columns`` pairs each column with its source type in declared order; the order and the
    type names feed the schema fingerprint, so they are part of the contract. With ``tenant`` the
    lake is Parquet, divided by that column inside each date and run.
    """

    name: str
    key: str
    columns: tuple[tuple[str, str], ...]
    directory: str = field(default="")
    tenant: str = field(default="")

    def __post_init__(self) -> None:
        seen: set[str] = set()
        for column, source_type in self.columns:
            if column in seen:
                raise ContractError(f"{self.name}: column {column!r} is declared twice")
            spark_type(source_type)
            seen.add(column)
        if self.key in ENVELOPE_NAMES:
            raise ContractError(f"{self.name}: key {self.key!r} would hide a member of the share record")
        for needed in (self.key, UPDATED_AT):
            if needed not in seen:
                raise ContractError(f"{self.name}: column {needed!r} is required")
        if dict(self.columns)[UPDATED_AT] != "timestamptz":
            raise ContractError(f"{self.name}: {UPDATED_AT} must be timestamptz")
        if dict(self.columns)[self.key] not in KEY_TYPES:
            raise ContractError(f"{self.name}: key {self.key!r} must be an integer type")
        if self.tenant and self.tenant not in seen:
            raise ContractError(f"{self.name}: tenant column {self.tenant!r} is not declared")
        object.__setattr__(self, "directory", self.directory or self.name)

    @property
    def column_names(self) -> list[str]:
        return [column for column, _ in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(column, spark_type(source_type), True, {"source_type": source_type})
                for column, source_type in self.columns
            ]
        )

    def require(self, df: DataFrame) -> None:
        """Reject a frame that lacks a contract column or carries it with another type."""
        actual = {f.name: f.dataType for f in df.schema.fields}
        for wanted in self.schema.fields:
            if wanted.name not in actual:
                raise ContractError(f"{self.name}: source has no column {wanted.name!r}")
            got = actual[wanted.name]
            if got == wanted.dataType:
                continue
            if isinstance(got, T.TimestampNTZType):
                raise ContractError(
                    f"{self.name}.{wanted.name} has no time zone; pass assume_utc=True to read it as UTC"
                )
            raise ContractError(
                f"{self.name}.{wanted.name} is {got.simpleString()}, "
                f"contract says {wanted.dataType.simpleString()}"
            )


def contracts_by_name(contracts: Iterable[Contract]) -> dict[str, Contract]:
    found: dict[str, Contract] = {}
    for contract in contracts:
        if contract.name in found:
            raise ContractError(f"two contracts are named {contract.name!r}")
        found[contract.name] = contract
    return found


# The published tables. Column order and type names enter the fingerprint.
CUSTOMERS = Contract(
    "customers",
    "customer_id",
    (
        ("customer_id", "bigint"),
        ("name", "text"),
        ("email", "text"),
        ("country", "text"),
        ("updated_at", "timestamptz"),
    ),
)
CASES = Contract(
    "cases",
    "case_id",
    (
        ("case_id", "bigint"),
        ("customer_id", "bigint"),
        ("title", "text"),
        ("description", "text"),
        ("status", "text"),
        ("updated_at", "timestamptz"),
    ),
)
# Order of manifest entries and events.
DEFAULT_CONTRACTS = (CUSTOMERS, CASES)
