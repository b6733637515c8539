"""The six dimensions.

Surrogate keys are dense row numbers over the natural key. Numbering a whole table costs a shuffle and a
staged table, so ``keyed=False`` leaves the key out: the analyses join on the natural key, which
identifies the same rows. Loads that come again take their keys from a map that is kept between them
(``caskline.operators.keys``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caskline.functions.labels import ceiling_label
from caskline.functions.measures import year_boundaries, year_quarter
from caskline.operators.global_window import global_row_number

# Upper price limits of the tiers, calendar bounds, season months.
PRICE_TIERS: tuple[tuple[int, str], ...] = ((100, "Value"), (200, "Mid-Range"), (350, "Premium"))
TOP_PRICE_TIER = "Ultra-Premium"
FIRST_DAY = dt.date(2024, 1, 1)
LAST_DAY = dt.date(2025, 12, 31)
SEASONS = {"Holiday Season": (11, 12), "Summer Peak": (6, 7, 8)}
USUAL_SEASON = "Standard"
HOME_COUNTRY = "USA"

#: The surrogate and the natural key of each dimension that has one.
KEYS = {
    "dim_reps": ("rep_key", "rep_src_id"),
    "dim_accounts": ("account_key", "account_src_id"),
    "dim_products": ("product_key", "sku_src_id"),
    "dim_suppliers": ("supplier_key", "supplier_src_id"),
    "dim_programs": ("program_key", "program_src_id"),
}


def _with_key(dim: DataFrame, key: str, natural: str, keyed: bool) -> DataFrame:
    if not keyed:
        return dim
    columns = dim.columns
    return global_row_number(dim, [(natural, "asc")], key).select(key, *columns)


def dim_reps(reps: DataFrame, *, as_of: dt.date, keyed: bool = True) -> DataFrame:
    """Tenure counts the new years between the hire date and ``as_of``."""
    dim = reps.select(
        F.col("rep_id").alias("rep_src_id"),
        "rep_name",
        "division",
        "channel",
        "hire_date",
        year_boundaries("hire_date", F.lit(as_of)).alias("years_tenure"),
        "email",
    )
    return _with_key(dim, "rep_key", "rep_src_id", keyed)


def dim_accounts(accounts: DataFrame, *, keyed: bool = True) -> DataFrame:
    dim = accounts.select(
        F.col("account_id").alias("account_src_id"),
        "account_name",
        "account_type",
        "channel",
        "town",
        "state",
        "division",
        F.col("rep_id").alias("rep_src_id"),
        "is_active",
        F.when(F.col("is_active"), "Active").otherwise("Inactive").alias("account_status"),
    )
    return _with_key(dim, "account_key", "account_src_id", keyed)


def dim_products(
    products: DataFrame,
    *,
    tiers: Sequence[tuple[object, str]] = PRICE_TIERS,
    top_tier: str = TOP_PRICE_TIER,
    keyed: bool = True,
) -> DataFrame:
    """``tiers`` lists exclusive upper price limits; a missing price falls in the top tier."""
    dim = products.select(
        F.col("sku_id").alias("sku_src_id"),
        F.col("supplier_id").alias("supplier_src_id"),
        "product_name",
        "category",
        "sub_category",
        "size_ml",
        "price_per_case_usd",
        ceiling_label("price_per_case_usd", tiers, top_tier, inclusive=False).alias("price_tier"),
    )
    return _with_key(dim, "product_key", "sku_src_id", keyed)


def dim_suppliers(
    suppliers: DataFrame, *, home_country: str = HOME_COUNTRY, keyed: bool = True
) -> DataFrame:
    dim = suppliers.select(
        F.col("supplier_id").alias("supplier_src_id"),
        "supplier_name",
        "category",
        "country",
        F.when(F.upper("country") == home_country.upper(), "Domestic")
        .otherwise("Import")
        .alias("origin_type"),
    )
    return _with_key(dim, "supplier_key", "supplier_src_id", keyed)


def dim_programs(programs: DataFrame, *, keyed: bool = True) -> DataFrame:
    dim = programs.select(
        F.col("program_id").alias("program_src_id"),
        F.col("supplier_id").alias("supplier_src_id"),
        "quarter",
        "start_date",
        "end_date",
        "program_type",
        "goal_value",
        "bonus_usd",
        "division",
        (F.datediff("end_date", "start_date") + 1).alias("program_duration_days"),
    )
    return _with_key(dim, "program_key", "program_src_id", keyed)


def dim_date(
    spark: SparkSession, start: dt.date = FIRST_DAY, end: dt.date = LAST_DAY
) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    return _calendar(spark.range(1), F.lit(start), F.lit(end))


def dim_date_covering(df: DataFrame, column: str) -> DataFrame:
    """One row per day of every year from the first to the last year found in ``column``."""
    day = F.col(column).cast("date")
    bounds = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    last_day = F.date_sub(F.add_months(F.trunc("last", "year"), 12), 1)
    return _calendar(bounds, F.trunc("first", "year"), last_day)


def date_attributes(day: Column) -> dict[str, Column]:
    """What the calendar says of a day, as functions of the date."""
    weekday = F.dayofweek(day)
    season = F.lit(USUAL_SEASON)
    for label, months in SEASONS.items():
        season = F.when(F.month(day).isin(*months), label).otherwise(season)
    return {
        "date_key": F.date_format(day, "yyyyMMdd").cast("int"),
        "year": F.year(day),
        "month_num": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "month_short": F.left(F.date_format(day, "MMMM"), F.lit(3)),
        "year_month": F.date_format(day, "yyyy-MM"),
        "day_of_month": F.dayofmonth(day),
        "day_of_week_num": weekday,
        "day_of_week_name": F.date_format(day, "EEEE"),
        "quarter_num": F.quarter(day),
        "quarter_label": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "year_quarter": year_quarter(day),
        "is_weekend": F.when(weekday.isin(1, 7), 1).otherwise(0),
        "season": season,
    }


def _calendar(one_row: DataFrame, start: Column, end: Column) -> DataFrame:
    days = one_row.select(
        F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("full_date")
    )
    attributes = date_attributes(F.col("full_date"))
    return days.select("full_date", *[c.alias(name) for name, c in attributes.items()])
