"""Session requirements and the shared scratch location."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from threading import Lock
from typing import Any
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ContractError


def require_utc(spark: SparkSession) -> None:
    """Dates, ISO text and parsing all assume a UTC session; fail early otherwise."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT"):
        raise ContractError(f"spark.sql.session.timeZone must be UTC, is {zone!r}")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ContractError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = "file:" + tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_DIRS[application]


# Temporary folders of local sessions without a configured one.
_LOCAL_DIRS: dict[str, str] = {}


def scratch_root(spark: SparkSession, purpose: str) -> str:
    """A fresh, not yet existing directory below the shared folder."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str, reader: SparkSession | None = None) -> DataFrame:
    """``df`` as written once to the shared folder: lineage ends here, and a lost executor costs nothing.

    ``reader`` is the session that reads it, if not its own: that of a stateful stream does not adapt its shuffles.
    """
    path = scratch_root(df.sparkSession, purpose)
    df.write.parquet(path)
    return (reader or df.sparkSession).read.schema(df.schema).parquet(path)


def metadata_frame(spark: SparkSession, rows: Sequence[Sequence[Any]], ddl: str) -> DataFrame:
    """A small frame of driver-side metadata, built without starting Python workers."""
    schema = T.StructType.fromDDL(ddl)
    text = json.dumps([dict(zip(schema.names, row)) for row in rows])
    parsed = F.from_json(F.lit(text), T.ArrayType(schema))
    return spark.range(1).select(F.inline(parsed))


@contextmanager
def timestamps_with_statistics(spark: SparkSession) -> Iterator[None]:
    """Write Parquet timestamps as 64-bit microseconds, which carry the statistics filters need.

    Spark's default, INT96, carries none. There is no option per write, hence the session's
    setting; enter before starting concurrent writes. Of several runs in one session the first to enter
    sets it and the last to leave sets it back.
    """
    key = "spark.sql.parquet.outputTimestampType"
    with _ENTERED_LOCK:
        inside, before = _ENTERED.get(spark, (0, None))
        if not inside:
            before = spark.conf.get(key)
            spark.conf.set(key, "TIMESTAMP_MICROS")
        _ENTERED[spark] = (inside + 1, before)
    try:
        yield
    finally:
        with _ENTERED_LOCK:
            inside, before = _ENTERED.pop(spark)
            if inside > 1:
                _ENTERED[spark] = (inside - 1, before)
            else:
                spark.conf.set(key, before)


# Per session, the runs that write timestamps with statistics now, and the setting before them.
_ENTERED: WeakKeyDictionary[SparkSession, tuple[int, str | None]] = WeakKeyDictionary()
_ENTERED_LOCK = Lock()
