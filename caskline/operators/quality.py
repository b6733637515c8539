"""Quality checks: counted conditions in one pass per table, duplicates, domains, orphans, gaps."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A row of ``table`` that meets ``failure`` fails check ``check_id``."""

    check_id: str
    table: str
    failure: Column


def null_checks() -> list[Check]:
    return [
        Check("1a", "sales_reps", F.col("rep_id").isNull()),
        Check("1b", "sales_transactions", F.col("txn_date").isNull()),
        Check(
            "1c",
            "sales_transactions",
            F.col("revenue_usd").isNull() | (F.col("revenue_usd") <= 0),
        ),
        Check("1d", "products", F.col("price_per_case_usd").isNull()),
        Check(
            "1e", "supplier_programs", F.col("goal_value").isNull() | F.col("bonus_usd").isNull()
        ),
    ]


def range_checks(first_day: dt.date, last_day: dt.date, as_of: dt.date) -> list[Check]:
    return [
        Check("3a", "sales_transactions", ~F.col("txn_date").between(first_day, last_day)),
        Check("3b", "supplier_programs", F.col("start_date") > F.col("end_date")),
        Check("3c", "sales_reps", F.col("hire_date") > F.lit(as_of)),
    ]


def validity_checks() -> list[Check]:
    return [Check("5a", "sales_transactions", ~F.col("is_valid"))]


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """(check_id, table_name, failures): every check of a table is counted in the same scan."""
    results = []
    for table in dict.fromkeys(check.table for check in checks):
        own = [check for check in checks if check.table == table]
        counts = tables[table].agg(
            *[F.count_if(check.failure).alias(check.check_id) for check in own]
        )
        pairs = F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(check.check_id).alias("check_id"),
                        F.lit(table).alias("table_name"),
                        F.col(f"`{check.check_id}`").alias("failures"),
                    )
                    for check in own
                ]
            )
        )
        results.append(counts.select(pairs.alias("r")).select("r.*"))
    return _union(results)


def failing_rows(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    """The rows behind a count, for a person to look at."""
    return tables[check.table].filter(check.failure)


def duplicate_keys(
    tables: Mapping[str, DataFrame], keys: Mapping[str, tuple[str, Sequence[str]]]
) -> DataFrame:
    """(check_id, table_name, key, cnt) for every key held by more than one row."""
    results = []
    for check_id, (table, columns) in keys.items():
        repeated = (
            tables[table].groupBy(*columns).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")
        )
        # Different keys never read alike: a part's own \ and | follow a \, and so does a text NULL.
        parts = [
            F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"([\\|]|^(?=NULL$))", r"\\$1"), F.lit("NULL"))
            for c in columns
        ]
        text = F.concat(*[p for part in parts for p in (F.lit("|"), part)][1:])
        results.append(
            repeated.select(
                F.lit(check_id).alias("check_id"),
                F.lit(table).alias("table_name"),
                text.alias("key"),
                "cnt",
            )
        )
    return _union(results)


# The keys and label columns that are checked.
UNIQUE_KEYS: dict[str, tuple[str, tuple[str, ...]]] = {
    "2a": ("sales_reps", ("rep_id",)),
    "2b": ("sales_transactions", ("txn_id",)),
    "2c": ("products", ("sku_id",)),
    "2d": ("rep_quota_actuals", ("rep_id", "month_year")),
}
LABEL_COLUMNS: dict[str, tuple[str, str]] = {
    "4a": ("accounts", "channel"),
    "4b": ("suppliers", "category"),
    "4c": ("rep_quota_actuals", "performance_flag"),
    "4d": ("program_attainments", "status"),
}


def label_counts(
    tables: Mapping[str, DataFrame], columns: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """(check_id, table_name, value, cnt): how often each label occurs."""
    return _union(
        [
            tables[table]
            .groupBy(F.col(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("cnt"))
            .select(
                F.lit(check_id).alias("check_id"), F.lit(table).alias("table_name"), "value", "cnt"
            )
            for check_id, (table, column) in columns.items()
        ]
    )


def attainment_gaps(attainments: DataFrame, tolerance: float = 1) -> DataFrame:
    """Rows whose stored percentage is more than ``tolerance`` points off actual / goal."""
    goal = F.nullif(F.col("goal_value"), F.lit(0).cast("decimal(12,2)"))
    computed = F.round(F.col("actual_value") * 100 / goal, 2)
    return (
        attainments.select(
            "attainment_id",
            "goal_value",
            "actual_value",
            F.col("attainment_pct").alias("stored_pct"),
            computed.alias("calc_pct"),
            F.abs(F.col("attainment_pct") - computed).alias("gap"),
        )
        .filter(F.col("gap") > tolerance)
        .orderBy(F.desc("gap"), "attainment_id")
    )


def orphan_keys(facts: DataFrame, reps: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct ``columns`` of rows whose rep_id is not among ``reps``.

    Distinct first: the anti join then moves one row per value instead of one per sale.
    """
    return facts.select(*columns).distinct().join(reps.select("rep_id"), "rep_id", "left_anti")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), one row per table."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )
