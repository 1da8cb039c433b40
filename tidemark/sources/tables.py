"""Source tables: any Spark-readable data shaped to a contract."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.checkpoint import HighWaterMark, from_iso, to_iso
from tidemark.contract import UPDATED_AT, Contract
from tidemark.errors import ContractError, SourceError
from tidemark.functions.canonical import iso_utc
from tidemark.session import require_utc


@dataclass(frozen=True)
class TableSource:
    """A contract together with the frame that satisfies it.

    ``date_column`` names a partition column of the frame holding the UTC date of
    ``updated_at``; scans then prune partitions as well as row groups.
    """

    contract: Contract
    frame: DataFrame
    date_column: str | None = None

    @classmethod
    def of(
        cls,
        frame: DataFrame,
        contract: Contract,
        mapping: Mapping[str, str] | None = None,
        assume_utc: bool = False,
        date_column: str | None = None,
    ) -> TableSource:
        """Shape ``frame`` to ``contract``.

        ``mapping`` gives the source column of a contract column where the names differ.
        ``assume_utc`` admits timestamps without a zone and reads them as UTC. Numeric columns
        are cast to the contract's type; everything else must already match.
        """
        require_utc(frame.sparkSession)
        mapping = dict(mapping or {})
        present = {f.name: f.dataType for f in frame.schema.fields}
        shaped = []
        for wanted in contract.schema.fields:
            name = mapping.get(wanted.name, wanted.name)
            if name not in present:
                raise ContractError(f"{contract.name}: source has no column {name!r}")
            column, got = F.col(name), present[name]
            zoneless = isinstance(got, T.TimestampNTZType) and isinstance(wanted.dataType, T.TimestampType)
            numeric = isinstance(got, T.NumericType) and isinstance(wanted.dataType, T.NumericType)
            if got != wanted.dataType and (numeric or (zoneless and assume_utc)):
                column = column.cast(wanted.dataType)
            shaped.append(column.alias(wanted.name))
        kept = [F.col(date_column)] if date_column and date_column not in contract.column_names else []
        shaped_frame = frame.select(*shaped, *kept)
        contract.require(shaped_frame)
        return cls(contract, shaped_frame, date_column)

    def at(self, mark: HighWaterMark) -> TableSource:
        """The source itself: it is open already."""
        return self


@dataclass(frozen=True)
class DeferredSource:
    """A table that is opened for the mark of a claimed run, such as ``read_jdbc_window`` needs.

    ``open`` gets the table's mark and returns its source. Whatever it returns is cut at the mark once more, so a
    reader may give more than was asked, not less. It is called once a run, after the claim: no other run can move the mark meanwhile.
    """

    contract: Contract
    open: Callable[[HighWaterMark], TableSource]

    def at(self, mark: HighWaterMark) -> TableSource:
        source = self.open(mark)
        if source.contract != self.contract:
            raise SourceError(f"{self.contract.name}: opened as {source.contract.name} with another contract")
        self.contract.require(source.frame)
        return source


def read_files(
    spark: SparkSession,
    contract: Contract,
    path: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    **shape,
) -> TableSource:
    """A table kept as files. Text formats take the contract's schema instead of inferring one."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if fmt in ("json", "csv", "xml"):
        reader = reader.schema(contract.schema)
        if "mode" not in dict(options or {}):
            reader = reader.option("mode", "FAILFAST")  # a line that cannot be read must not turn into nulls
    try:
        frame = reader.load(path)
    except Exception as failed:
        raise SourceError(f"cannot read {path}: {failed}") from failed
    return TableSource.of(frame, contract, **shape)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def jdbc_slices(
    contract: Contract,
    after: HighWaterMark,
    until: HighWaterMark,
    first_at: str,
    time_slices: int = 16,
    key_slices: int = 4,
) -> list[str]:
    """Disjoint SQL conditions that together cover ``(after, until]`` exactly once.

    ``[first_at, until]`` is cut at equal steps of time; the outer slices are open, so that the
    marks alone decide what belongs to the window. Each slice is cut again by key, so that an
    instant holding a large share of the rows still spreads over several connections.
    """
    at, pk = _quoted(UPDATED_AT), _quoted(contract.key)

    def instant(iso: str) -> str:
        return f"TIMESTAMPTZ '{iso}'"

    window = (
        f"({at} > {instant(after.at)} OR ({at} = {instant(after.at)} AND {pk} > {after.pk}))"
        f" AND ({at} < {instant(until.at)} OR ({at} = {instant(until.at)} AND {pk} <= {until.pk}))"
    )
    low, high = from_iso(first_at), from_iso(until.at)
    step = (high - low) / time_slices
    cuts = [to_iso(low + step * i) for i in range(1, time_slices)] if step > timedelta(0) else []
    conditions = []
    for start, stop in zip([None, *cuts], [*cuts, None]):
        terms = [window]
        terms += [f"{at} >= {instant(start)}"] if start else []
        terms += [f"{at} < {instant(stop)}"] if stop else []
        for residue in range(key_slices):
            own = f"ABS(MOD({pk}, {key_slices})) = {residue}"
            conditions.append(" AND ".join([*terms, own if residue else f"({own} OR {pk} IS NULL)"]))
    return conditions


def read_jdbc_window(
    spark: SparkSession,
    contract: Contract,
    url: str,
    after: HighWaterMark,
    time_slices: int = 16,
    key_slices: int = 4,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> TableSource:
    """The delta of a database table beyond ``after``, read over many connections.

    The table's present ends are looked up first, so that all connections read the same window:
    a row updated meanwhile moves past the end and belongs to the next run. Each table is thus
    consistent with itself; several tables are not read in one transaction.
    """
    columns = ", ".join(_quoted(c) for c in contract.column_names)
    at, pk, table = _quoted(UPDATED_AT), _quoted(contract.key), _quoted(contract.name)
    ends = (
        f"SELECT (SELECT min({at}) FROM {table} WHERE {at} >= TIMESTAMPTZ '{after.at}') AS first_at, "
        f"{at} AS last_at, {pk} AS last_pk FROM {table} ORDER BY {at} DESC, {pk} DESC LIMIT 1"
    )
    options = {"url": url, **dict(properties or {})}
    try:
        found = (
            spark.read.format("jdbc").options(**options).option("query", ends).load()
            .select(iso_utc(F.col("first_at")).alias("first_at"), iso_utc(F.col("last_at")).alias("at"), "last_pk")
            .first()
        )
        if found is None or found["first_at"] is None:
            conditions = ["1 = 0"]
        else:
            until = HighWaterMark(found["at"], int(found["last_pk"]))
            conditions = jdbc_slices(contract, after, until, found["first_at"], time_slices, key_slices)
        frame = spark.read.jdbc(
            url,
            f"(SELECT {columns} FROM {table}) AS t",
            predicates=conditions,
            properties={"fetchsize": str(fetch_size), **dict(properties or {})},
        )
    except Exception as failed:
        raise SourceError(f"cannot read {contract.name} over JDBC: {failed}") from failed
    return TableSource.of(frame, contract)
