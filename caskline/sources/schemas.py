"""Columns of the eight source entities, in file order, with their cleansed types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LOADED_AT = "dwh_create_date"
SOURCE = "dwh_source"


@dataclass(frozen=True)
class Entity:
    """One source file: raw column names, key columns, cleansed columns as (name, type)."""

    name: str
    raw_columns: tuple[str, ...]
    key: tuple[str, ...]
    clean_columns: tuple[tuple[str, str], ...]

    @property
    def raw_schema(self) -> T.StructType:
        """Every raw column is text; nothing is inferred."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.raw_columns])


def _entity(name: str, key: str, columns: str, renamed: dict[str, str], extra: str = "") -> Entity:
    clean = tuple(tuple(c.strip().split(" ", 1)) for c in columns.split(";"))
    raw_name = {new: old for old, new in renamed.items()}
    raw = tuple(raw_name.get(c, c) for c, _ in clean)
    added = tuple(tuple(c.strip().split(" ", 1)) for c in extra.split(";")) if extra else ()
    return Entity(name, raw, tuple(key.split()), clean + added)


# File columns and their cleansed types. Ids are 64-bit so that keys keep fitting.
ENTITIES: dict[str, Entity] = {
    entity.name: entity
    for entity in (
        _entity(
            "sales_reps",
            "rep_id",
            "rep_id bigint; rep_name string; division string; channel string; hire_date date; "
            "email string",
            {},
        ),
        _entity(
            "suppliers",
            "supplier_id",
            "supplier_id bigint; supplier_name string; category string; country string",
            {},
        ),
        _entity(
            "products",
            "sku_id",
            "sku_id bigint; product_name string; supplier_id bigint; category string; "
            "sub_category string; size_ml int; price_per_case_usd decimal(10,2)",
            {},
        ),
        _entity(
            "accounts",
            "account_id",
            "account_id bigint; account_name string; account_type string; channel string; "
            "town string; state string; division string; rep_id bigint; is_active boolean",
            {"active": "is_active"},
        ),
        _entity(
            "supplier_programs",
            "program_id",
            "program_id bigint; supplier_id bigint; quarter string; start_date date; "
            "end_date date; program_type string; goal_value decimal(12,2); "
            "bonus_usd decimal(12,2); division string",
            {},
        ),
        _entity(
            "sales_transactions",
            "txn_id",
            "txn_id bigint; txn_date date; account_id bigint; rep_id bigint; division string; "
            "sku_id bigint; supplier_id bigint; cases_sold int; discount_pct decimal(5,2); "
            "revenue_usd decimal(12,2); channel string",
            {},
            "is_valid boolean",
        ),
        _entity(
            "rep_quota_actuals",
            "rep_id month",
            "rep_id bigint; rep_name string; division string; month_year string; "
            "quota_cases int; actual_cases int; attainment_pct decimal(6,2); "
            "quota_revenue_usd decimal(14,2); actual_revenue_usd decimal(14,2)",
            {"month": "month_year"},
            "performance_flag string",
        ),
        _entity(
            "program_attainments",
            "attainment_id",
            "attainment_id bigint; program_id bigint; supplier_id bigint; quarter string; "
            "rep_id bigint; rep_name string; division string; program_type string; "
            "goal_value decimal(12,2); actual_value decimal(12,2); attainment_pct decimal(6,2); "
            "status string; bonus_earned_usd decimal(12,2)",
            {},
        ),
    )
}
