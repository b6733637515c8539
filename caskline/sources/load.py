"""Load control: run table loads, count their rows on the way, isolate or pass on failures."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from caskline.operators.cleanse import CLEANERS
from caskline.sources.ingest import ingest
from caskline.sources.publish import publish, read_published
from caskline.sources.schemas import ENTITIES

AUDIT_SCHEMA = "table_name string, rows bigint, elapsed_ms bigint, ok boolean, error string"


Writer = Callable[[DataFrame, str], str]


def load_table(
    name: str, build: Callable[[], DataFrame], root: str, write: Writer = publish
) -> tuple:
    """Build and publish one table; the row count is observed by the write itself."""
    started = time.monotonic()
    counted = Observation(f"load_{name}")
    write(build().observe(counted, F.count(F.lit(1)).alias("rows")), root)
    elapsed = int((time.monotonic() - started) * 1000)
    return (name, counted.get["rows"], elapsed, True, None)


def load_all(
    spark: SparkSession,
    builders: Mapping[str, Callable[[], DataFrame]],
    out: str,
    *,
    fail_fast: bool,
    parallel: int = 1,
    writers: Mapping[str, Writer] | None = None,
) -> DataFrame:
    """Publish every table under ``out`` and return one audit row per table.

    ``fail_fast=True`` stops at the first failure and raises it, leaving later tables as they were;
    otherwise a failure becomes an audit row and the other tables still load, ``parallel`` of them
    at a time.
    """

    def load(name: str) -> tuple:
        write = (writers or {}).get(name, publish)
        return load_table(name, builders[name], f"{out}/{name}", write)

    def attempt(name: str) -> tuple:
        started = time.monotonic()
        try:
            return load(name)
        except Exception as problem:
            elapsed = int((time.monotonic() - started) * 1000)
            return (name, None, elapsed, False, str(problem))

    if fail_fast:
        results = [load(name) for name in builders]
    else:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            results = list(pool.map(attempt, builders))
    return spark.createDataFrame(results, AUDIT_SCHEMA)


def load_bronze(
    spark: SparkSession,
    files: Mapping[str, str],
    out: str,
    *,
    parallel: int = 1,
    malformed: str = "fail",
) -> DataFrame:
    """Ingest ``{entity: file path}`` into raw tables; one bad file does not stop the others."""
    builders = {
        name: lambda name=name, path=path: ingest(
            spark, path, ENTITIES[name], malformed=malformed
        )
        for name, path in files.items()
    }
    return load_all(spark, builders, out, fail_fast=False, parallel=parallel)


def load_silver(
    spark: SparkSession, bronze: str, out: str, entities: Sequence[str] = tuple(ENTITIES)
) -> DataFrame:
    """Cleanse the raw tables in order; the first failure stops the load."""
    builders = {
        name: lambda name=name: CLEANERS[name](read_published(spark, f"{bronze}/{name}"))
        for name in entities
    }
    return load_all(spark, builders, out, fail_fast=True)
