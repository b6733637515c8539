"""Raw text tables to typed, trimmed, conformed, deduplicated tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caskline.functions.labels import (
    CATEGORY_LABELS,
    CATEGORY_PATTERNS,
    CHANNEL_LABELS,
    STATUS_LABELS,
    conform,
    safe_cast,
    strict_cast,
    text_to_flag,
    threshold_label,
)
from caskline.operators.dedup import dedup_latest, split_rejects
from caskline.sources.schemas import ENTITIES, LOADED_AT, SOURCE

# Attainment percentage to performance label.
PERFORMANCE_CUTPOINTS = ((100, "Achieved"), (75, "At Risk"))
PERFORMANCE_FLOOR = "Behind"


def _latest(raw: DataFrame, entity: str) -> DataFrame:
    """Rows with a usable key, one per key; keys are compared as the numbers they are cast to.

    A key that does not read as a number stays as it is, and the cast to come fails on it.
    """
    keys = ENTITIES[entity].key
    types = dict(ENTITIES[entity].clean_columns)

    def same(key: str) -> Column:
        text = F.trim(F.col(key))
        if types.get(key, "string") == "string":
            return text
        return F.coalesce(text.try_cast(types[key]).cast("string"), text)

    keyed = raw.withColumns({k: same(k) for k in keys})
    for key in keys:
        keyed = keyed.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    tiebreak = [c for c in ENTITIES[entity].raw_columns if c not in keys]
    return dedup_latest(keyed, keys, LOADED_AT, tiebreak)


def _typed(rows: DataFrame, entity: str, loaded_at: Column | None, **expressions: Column) -> DataFrame:
    """Select the entity's columns in order; plain text columns are only trimmed."""
    columns = [
        expressions.get(name, F.trim(F.col(name)) if name in rows.columns else F.lit(None))
        .cast(data_type)
        .alias(name)
        for name, data_type in ENTITIES[entity].clean_columns
    ]
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    return rows.select(
        *columns, stamp.alias(LOADED_AT), F.lit(f"bronze.{entity}").alias(SOURCE)
    )


def clean_sales_reps(raw: DataFrame, *, loaded_at: Column | None = None) -> DataFrame:
    return _typed(
        _latest(raw, "sales_reps"),
        "sales_reps",
        loaded_at,
        rep_id=strict_cast("rep_id", "bigint"),
        channel=conform("channel", CHANNEL_LABELS),
        hire_date=safe_cast("hire_date", "date"),
        email=F.lower(F.trim("email")),
    )


def clean_suppliers(raw: DataFrame, *, loaded_at: Column | None = None) -> DataFrame:
    return _typed(
        _latest(raw, "suppliers"),
        "suppliers",
        loaded_at,
        supplier_id=strict_cast("supplier_id", "bigint"),
        category=conform("category", CATEGORY_LABELS, CATEGORY_PATTERNS),
    )


def clean_products(raw: DataFrame, *, loaded_at: Column | None = None) -> DataFrame:
    return _typed(
        _latest(raw, "products"),
        "products",
        loaded_at,
        sku_id=strict_cast("sku_id", "bigint"),
        supplier_id=strict_cast("supplier_id", "bigint"),
        size_ml=safe_cast("size_ml", "int"),
        price_per_case_usd=safe_cast("price_per_case_usd", "decimal(10,2)"),
    )


def clean_accounts(raw: DataFrame, *, loaded_at: Column | None = None) -> DataFrame:
    return _typed(
        _latest(raw, "accounts"),
        "accounts",
        loaded_at,
        account_id=strict_cast("account_id", "bigint"),
        channel=conform("channel", CHANNEL_LABELS),
        state=F.upper(F.trim("state")),
        rep_id=strict_cast("rep_id", "bigint"),
        is_active=text_to_flag("active"),
    )


def split_supplier_programs(
    raw: DataFrame, *, loaded_at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(programs with a valid date range, rejected raw rows with a reason)."""
    start, end = safe_cast("start_date", "date"), safe_cast("end_date", "date")
    accepted, rejected = split_rejects(
        _latest(raw, "supplier_programs"),
        {
            "start_date is not a date": start.isNotNull(),
            "end_date is not a date": end.isNotNull(),
            "start_date is after end_date": start <= end,
        },
    )
    programs = _typed(
        accepted,
        "supplier_programs",
        loaded_at,
        program_id=strict_cast("program_id", "bigint"),
        supplier_id=strict_cast("supplier_id", "bigint"),
        start_date=start,
        end_date=end,
        goal_value=safe_cast("goal_value", "decimal(12,2)"),
        bonus_usd=safe_cast("bonus_usd", "decimal(12,2)"),
    )
    return programs, rejected


def clean_supplier_programs(raw: DataFrame, *, loaded_at: Column | None = None) -> DataFrame:
    return split_supplier_programs(raw, loaded_at=loaded_at)[0]


def valid_sale(revenue: Column, cases: Column, day: Column) -> Column:
    """A sale counts when it has a date, a positive revenue and a positive number of cases."""
    return positive_amounts(revenue, cases) & day.isNotNull()


def positive_amounts(revenue: Column, cases: Column) -> Column:
    return F.coalesce((revenue > 0) & (cases > 0), F.lit(False))


def clean_sales_transactions(raw: DataFrame, *, loaded_at: Column | None = None) -> DataFrame:
    day = safe_cast("txn_date", "date")
    revenue = safe_cast("revenue_usd", "decimal(12,2)")
    cases = strict_cast("cases_sold", "int")
    return _typed(
        _latest(raw, "sales_transactions"),
        "sales_transactions",
        loaded_at,
        txn_id=strict_cast("txn_id", "bigint"),
        txn_date=day,
        account_id=strict_cast("account_id", "bigint"),
        rep_id=strict_cast("rep_id", "bigint"),
        sku_id=strict_cast("sku_id", "bigint"),
        supplier_id=strict_cast("supplier_id", "bigint"),
        cases_sold=cases,
        discount_pct=F.coalesce(
            safe_cast("discount_pct", "decimal(5,2)"), F.lit(0).cast("decimal(5,2)")
        ),
        revenue_usd=revenue,
        channel=conform("channel", CHANNEL_LABELS),
        is_valid=valid_sale(revenue, cases, day),
    )


def clean_rep_quota_actuals(raw: DataFrame, *, loaded_at: Column | None = None) -> DataFrame:
    attainment = safe_cast("attainment_pct", "decimal(6,2)")
    return _typed(
        _latest(raw, "rep_quota_actuals"),
        "rep_quota_actuals",
        loaded_at,
        rep_id=strict_cast("rep_id", "bigint"),
        month_year=F.trim("month"),
        quota_cases=strict_cast("quota_cases", "int"),
        actual_cases=strict_cast("actual_cases", "int"),
        attainment_pct=attainment,
        quota_revenue_usd=safe_cast("quota_revenue_usd", "decimal(14,2)"),
        actual_revenue_usd=safe_cast("actual_revenue_usd", "decimal(14,2)"),
        performance_flag=threshold_label(attainment, PERFORMANCE_CUTPOINTS, PERFORMANCE_FLOOR),
    )


def clean_program_attainments(raw: DataFrame, *, loaded_at: Column | None = None) -> DataFrame:
    return _typed(
        _latest(raw, "program_attainments"),
        "program_attainments",
        loaded_at,
        attainment_id=strict_cast("attainment_id", "bigint"),
        program_id=strict_cast("program_id", "bigint"),
        supplier_id=strict_cast("supplier_id", "bigint"),
        rep_id=strict_cast("rep_id", "bigint"),
        goal_value=safe_cast("goal_value", "decimal(12,2)"),
        actual_value=safe_cast("actual_value", "decimal(12,2)"),
        attainment_pct=safe_cast("attainment_pct", "decimal(6,2)"),
        status=conform("status", STATUS_LABELS),
        bonus_earned_usd=safe_cast("bonus_earned_usd", "decimal(12,2)"),
    )


CLEANERS: dict[str, Callable[..., DataFrame]] = {
    "sales_reps": clean_sales_reps,
    "suppliers": clean_suppliers,
    "products": clean_products,
    "accounts": clean_accounts,
    "supplier_programs": clean_supplier_programs,
    "sales_transactions": clean_sales_transactions,
    "rep_quota_actuals": clean_rep_quota_actuals,
    "program_attainments": clean_program_attainments,
}
