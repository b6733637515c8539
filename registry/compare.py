"""Compare registered queries with their SQL in DuckDB: python -m registry.compare [folder] [key ...]"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from registry.oracle import oracle_sql
from registry.queries import queries


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.date() if value.time() == dt.time() else value
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    return value


def _sortable(row: tuple) -> tuple:
    return tuple((value is not None, str(value)) for value in row)


def rows_of(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = [tuple(_plain(row[n]) for n in names) for row in df.collect()]
    return names, sorted(rows, key=_sortable)


def expected(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(row[i]) for i in order) for row in result.fetchall()]
    return [columns[i] for i in order], sorted(rows, key=_sortable)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def difference(spark: SparkSession, connection, sf_dir: str, key: str) -> str | None:
    """None when the results are equal, otherwise the first difference."""
    names, got = rows_of(queries()[key](spark, sf_dir))
    want_names, want = expected(connection, oracle_sql()[key])
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            cells = [f"{n}: {a!r} != {b!r}" for n, a, b in zip(names, mine, theirs) if a != b]
            return f"row {mine}: " + "; ".join(cells)
    return None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    wrong = 0
    for key in keys:
        started = time.monotonic()
        try:
            problem = difference(spark, connection, sf_dir, key)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        wrong += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {key} {time.monotonic() - started:.1f}s {problem or ''}", flush=True)
    print(f"{len(keys) - wrong} of {len(keys)} equal")
    sys.exit(1 if wrong else 0)


if __name__ == "__main__":
    main()
