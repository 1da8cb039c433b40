"""A space-filling order of (tenant, instant), and a Parquet layout whose files are small in both.

A folder per tenant and date makes a file for each, however few rows it has. Here every row gets the Z-order
position of its bins in the two dimensions, and ranges of that position become files: each holds some tenants
for some stretch of time, so that a read by tenant, by time or by both leaves most files unopened.

Bins have equal numbers of rows, from a mergeable sketch of either column, so outliers in time cost nothing. A
tenant that holds a third of all rows takes a third of the bins; its own bin never changes, so the position
orders its rows by time alone, and the ranges cut it like anything else. Tenants are placed by a hash, which suits reads of single
tenants. A small table beside the files, made from their own rows, holds what each one spans.

Defined cases: rows without a tenant or an instant have a place of their own before all others and come back
from reads without a condition on what they lack (``MISSING`` asks for rows without a tenant). Repeated rows stay. An empty table gives no files and
reads as empty. Names of the layout's own columns start with ``_z_``; a table that has such a column is refused.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import ContractError

BITS = 10
#: Rows of a file, about; ranges are cut by a sample, so sizes vary.
FILE_ROWS = 1_000_000
_PLACE, _MOMENT, _ORDER = "_z_place", "_z_moment", "_z_order"
_OWN = "_z_"


class _Missing:
    """Asks for the rows without a tenant."""


MISSING = _Missing()


def _place(tenant: Column) -> Column:
    """Where a tenant lies: a hash of its text; null for none."""
    return F.when(tenant.isNotNull(), F.xxhash64(tenant.cast("string")))


def _bin(value: Column, cuts: list[int], bits: int) -> Column:
    """How many of ``cuts`` (ascending, ``2 ** bits - 1``) are not above ``value``, in ``bits`` comparisons; 0 for null."""
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(bits))))
    held = F.array(*(F.lit(c).cast("long") for c in cuts))
    return F.when(
        value.isNotNull(),
        F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.element_at(held, at + step) <= value, step).otherwise(0)),
    ).otherwise(0)


def _interleaved(high: Column, low: Column, bits: int) -> Column:
    """The bits of two numbers in turn, those of ``high`` first."""
    total = F.lit(0).cast("long")
    for b in range(bits):
        for value, at in ((high, 2 * b + 1), (low, 2 * b)):
            total = total.bitwiseOR(F.shiftleft(F.shiftright(value, b).bitwiseAND(F.lit(1)).cast("long"), at))
    return total


def _cuts(placed: DataFrame, bits: int) -> tuple[int, list[list[int]]]:
    """Rows, and the quantiles of either column: one aggregate of bounded sketches, combined on the map side."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = placed.agg(
        F.count("*"), *(F.percentile_approx(c, shares, 10 * (1 << bits)) for c in (_PLACE, _MOMENT))
    ).first()
    return found[0], [list(c) if c else [0] * len(shares) for c in found[1:]]


def placed(rows: DataFrame, tenant: str, instant: str) -> DataFrame:
    """``rows`` with the place of the tenant and the microsecond of the instant."""
    clash = [c for c in rows.columns if c.lower().startswith(_OWN)]
    if clash:
        raise ContractError(f"a clustered table cannot hold columns named {clash}")
    return rows.select("*", _place(F.col(tenant)).alias(_PLACE), F.unix_micros(F.col(instant).cast("timestamp")).alias(_MOMENT))


def clustered(rows: DataFrame, tenant: str, instant: str, file_rows: int = FILE_ROWS, bits: int = BITS) -> DataFrame:
    """``rows`` in ranges of the Z-order of tenant and instant, sorted within each, with their place and moment.

    Ties of one bin are cut by the tenant's place, the instant and a hash of the whole row; only rows equal in all columns stay together.
    """
    own = placed(rows, tenant, instant)
    n, (places, moments) = _cuts(own, bits)
    binned = own.select("*", _bin(F.col(_PLACE), places, bits).alias("_z_x"), _bin(F.col(_MOMENT), moments, bits).alias("_z_y"))
    ordered = binned.select("*", _interleaved(F.col("_z_x"), F.col("_z_y"), bits).alias(_ORDER)).drop("_z_x", "_z_y")
    comparable = [F.col(f"`{f.name}`") for f in rows.schema if f.dataType.typeName() not in ("map", "variant")]
    keys = [F.col(_ORDER), F.col(_PLACE), F.col(_MOMENT)]
    ranges = ordered.repartitionByRange(max(1, -(-n // file_rows)), *keys, F.xxhash64(*comparable))
    return ranges.sortWithinPartitions(*keys).drop(_ORDER)


@dataclass(frozen=True)
class Layout:
    """A clustered table at ``path``: its rows below ``rows/``, what each file spans below ``files/``."""

    path: str
    tenant: str
    instant: str

    def write(self, rows: DataFrame, file_rows: int = FILE_ROWS, bits: int = BITS) -> None:
        """Write ``rows`` to a path that does not exist yet; the table of files comes last, so half a table reads as none."""
        spark = rows.sparkSession
        clustered(rows, self.tenant, self.instant, file_rows, bits).write.parquet(f"{self.path}/rows")
        written = spark.read.schema(f"{_PLACE} long, {_MOMENT} long").parquet(f"{self.path}/rows")
        span = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.count("*").alias("rows"),
            *(f(c).alias(f"{name}{c}") for c in (_PLACE, _MOMENT) for name, f in (("least", F.min), ("most", F.max))),
            *(F.count_if(F.col(c).isNull()).alias(f"lacks{c}") for c in (_PLACE, _MOMENT)),
        )
        span.coalesce(1).write.parquet(f"{self.path}/files")

    def files(
        self, spark: SparkSession, tenant: object = None, first: datetime | None = None, until: datetime | None = None
    ) -> DataFrame:
        """What the files span that may hold rows of ``tenant`` in ``[first, until)``."""
        found = spark.read.parquet(f"{self.path}/files")
        if tenant is MISSING:
            found = found.where(F.col(f"lacks{_PLACE}") > 0)
        elif tenant is not None:
            found = found.where(_place(F.lit(tenant)).between(F.col(f"least{_PLACE}"), F.col(f"most{_PLACE}")))
        if first is not None:
            found = found.where(F.col(f"most{_MOMENT}") >= F.unix_micros(F.lit(first)))
        if until is not None:
            found = found.where(F.col(f"least{_MOMENT}") < F.unix_micros(F.lit(until)))
        return found

    def read(
        self, spark: SparkSession, schema, tenant: object = None, first: datetime | None = None, until: datetime | None = None
    ) -> DataFrame:
        """Rows of ``tenant`` with an instant in ``[first, until)``, or all; only the files that may hold some are opened.

        The driver holds the paths of those files, as it does for any scan. ``schema`` is that of the rows as written.
        """
        whole = tenant is None and first is None and until is None
        paths = [f"{self.path}/rows"] if whole else [r.file for r in self.files(spark, tenant, first, until).select("file").collect()]
        if not paths:
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(schema).parquet(*paths)
        if tenant is MISSING:
            rows = rows.where(F.col(self.tenant).isNull())
        elif tenant is not None:
            rows = rows.where(F.col(self.tenant).cast("string") == F.lit(tenant).cast("string"))
        if first is not None:
            rows = rows.where(F.col(self.instant) >= F.lit(first))
        if until is not None:
            rows = rows.where(F.col(self.instant) < F.lit(until))
        return rows
