"""Order-free comparison of a Spark result with the SQL run by DuckDB."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(r[i]).__name__, r[i]) for i in order) for r in rows)


def compare(actual: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Row count and the differences found."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(actual.columns):
        return 0, [f"columns {sorted(actual.columns)} != {sorted(names)}"]
    expected, got = bag(names, result.fetchall()), bag(actual.columns, actual.collect())
    problems = [f"only in SQL: {row}" for row in list((expected - got).elements())[:3]]
    problems += [f"only in Spark: {row}" for row in list((got - expected).elements())[:3]]
    return sum(got.values()), problems
