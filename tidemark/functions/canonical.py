"""Canonical text: one byte sequence per value, whoever computes it and wherever."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ContractError

# Control characters whose escape contains a hex letter. Spark's JSON writer
# spells them in upper case, the canonical form in lower case.
_LETTERED_ESCAPES = ("000B", "000E", "000F", "001A", "001B", "001C", "001D", "001E", "001F")


def iso_utc(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS[.ffffff]Z``; the fraction appears only when it is not zero."""
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    fraction = F.when(micros == 0, "").otherwise(
        F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))
    )
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))


def parse_iso_utc(text: Column) -> Column:
    """Timestamp from ISO text with ``Z`` or an offset; without one the session zone (UTC) holds."""
    return text.cast("timestamp")


def utc_date(ts: Column) -> Column:
    """Date key ``YYYY-MM-DD``."""
    return F.date_format(ts, "yyyy-MM-dd")


def encoded(value: Column, dtype: T.DataType) -> Column:
    """Rewrite a value so that ``to_json`` renders it canonically."""
    if isinstance(dtype, T.TimestampType):
        return iso_utc(value)
    if isinstance(dtype, T.TimestampNTZType):
        raise ContractError("timestamps without a time zone have no canonical form")
    if isinstance(dtype, (T.DateType, T.DecimalType)):
        return value.cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.decode(value, "UTF-8")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        finite = value.isNull() | (~F.isnan(value) & (F.abs(value) < float("inf")))
        return F.when(finite, value).otherwise(
            F.raise_error(F.lit("NaN and infinity have no canonical form")).cast(dtype)
        )
    if isinstance(dtype, T.StructType):
        parts = [
            encoded(value[f.name], f.dataType).alias(f.name)
            for f in sorted(dtype.fields, key=lambda f: f.name)
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda item: encoded(item, dtype.elementType))
    if isinstance(dtype, T.MapType):
        entries = F.transform(
            F.array_sort(F.map_entries(value)),
            lambda e: F.struct(
                e["key"].cast("string").alias("key"),
                encoded(e["value"], dtype.valueType).alias("value"),
            ),
        )
        return F.map_from_entries(entries)
    return value


def _lower_escapes(text: Column) -> Column:
    def lower(acc: Column, code: str) -> Column:
        # An even run of backslashes before the escape belongs to the text itself.
        return F.regexp_replace(acc, rf"(?<!\\)((?:\\\\)*)\\u{code}", rf"$1\\u{code.lower()}")

    return F.when(text.contains("\\u00"), reduce(lower, _LETTERED_ESCAPES, text)).otherwise(text)


def canonical_json(fields: Mapping[str, Column], types: Mapping[str, T.DataType]) -> Column:
    """JSON object text: names sorted at every level, no spaces, raw UTF-8, nulls kept."""
    members = [encoded(fields[name], types[name]).alias(name) for name in sorted(fields)]
    return _lower_escapes(F.to_json(F.struct(*members), {"ignoreNullFields": "false"}))


def canonical_row(schema: T.StructType) -> Column:
    """Canonical JSON of the columns of ``schema``, taken from the frame it is used on."""
    return canonical_json(
        {f.name: F.col(f.name) for f in schema.fields}, {f.name: f.dataType for f in schema.fields}
    )


def canonical_text(value: Any) -> str:
    """The same form for driver-side metadata."""
    return json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"), allow_nan=False)
