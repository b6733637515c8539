"""The three facts.

``sales_measures`` is the sales fact with natural ids; the analyses start from it. ``fact_sales``
adds the surrogate keys by four more joins, which only a consumer of those keys needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caskline.functions.labels import rank_of_label
from caskline.functions.measures import from_cents, round_quotient, to_cents

# Flat margin on revenue, and the sort position of each attainment status.
MARGIN_RATE = Decimal("0.30")
STATUS_ORDER = ("Achieved", "At Risk", "Behind")
OTHER_STATUS_POSITION = 9

#: How an id of a sale is found in its dimension: the dimension's own column of it, and the key there.
KEY_LOOKUPS = {
    "rep_id": ("rep_src_id", "rep_key"),
    "account_id": ("account_src_id", "account_key"),
    "supplier_id": ("supplier_src_id", "supplier_key"),
}

_CARRIED = ("txn_id", "rep_id", "account_id", "sku_id", "supplier_id", "channel")


def sales_measures(
    transactions: DataFrame,
    products: DataFrame | None = None,
    *,
    margin_rate: Decimal = MARGIN_RATE,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Valid sales with their derived money columns, in whole cents.

    Gross revenue and discount need the list price: they are added when ``products`` is given, or
    when ``transactions`` already carries ``price_per_case_usd``; otherwise the join with the
    products is left out. Id columns ``transactions`` lacks are left out too, so a caller can leave
    away what it does not group by; ``carry`` names further columns to keep. ``discount_points``
    are hundredths of a percent.
    """
    sales = transactions.filter("is_valid")
    if products is not None:
        sales = with_price(sales, products)
    columns = [F.col(c) for c in (*_CARRIED, *carry) if c in sales.columns]
    if "txn_date" in sales.columns:
        columns.append(F.col("txn_date").alias("order_date"))
    columns += [
        F.col("cases_sold"),
        to_cents("discount_pct").alias("discount_points"),
        to_cents("revenue_usd").alias("revenue_cents"),
    ]
    priced = "price_per_case_usd" in sales.columns
    if priced:
        price = F.coalesce(to_cents("price_per_case_usd"), F.lit(0))
        columns.append((F.col("cases_sold") * price).alias("gross_cents"))
    sales = sales.select(*columns)
    revenue = F.col("revenue_cents")
    part, whole = margin_rate.as_integer_ratio()
    derived = {
        "per_case_cents": round_quotient(revenue, F.nullif(F.col("cases_sold"), F.lit(0))),
        "margin_cents": round_quotient(revenue * part, F.lit(whole)),
    }
    if priced:
        given = F.col("gross_cents") * F.col("discount_points")
        derived["discount_cents"] = round_quotient(given, F.lit(10_000))
    return sales.withColumns(derived)


def with_price(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Add the list price of each sale's product; NULL when the product is unknown."""
    return transactions.join(products.select("sku_id", "price_per_case_usd"), "sku_id", "left")


def key_lookup(dim: DataFrame, own_id: str) -> DataFrame:
    """A dimension's surrogate keys by the sales' id."""
    source_id, key = KEY_LOOKUPS[own_id]
    return dim.select(F.col(source_id).alias(own_id), key)


def price_lookup(products_dim: DataFrame) -> DataFrame:
    """The surrogate keys and list prices of products by the sales' id."""
    return products_dim.select(F.col("sku_src_id").alias("sku_id"), "product_key", "price_per_case_usd")


def fact_sales(
    transactions: DataFrame,
    reps_dim: DataFrame,
    accounts_dim: DataFrame,
    products_dim: DataFrame,
    suppliers_dim: DataFrame,
    *,
    margin_rate: Decimal = MARGIN_RATE,
    loaded_at: Column | None = None,
    by_month: bool = False,
) -> DataFrame:
    """Sales with surrogate keys; a key is NULL when the id is unknown to its dimension.

    ``dwh_create_date`` tells the load a row came from: ``loaded_at``, else the time of the query.

    One join with the products brings both the list price and the key. Keys that ``transactions``
    already carries (``KEY_LOOKUPS``; ``product_key`` with the price) are not looked up again. Rows stay narrow until all shuffles are done:
    money columns are derived last. With ``by_month`` rows are dealt by the month of their order
    date before that, which saves ``publish_by_month`` a shuffle of the whole fact.
    """
    sales = transactions.filter("is_valid")
    if "product_key" not in sales.columns:
        sales = sales.join(price_lookup(products_dim), "sku_id", "left")
    dims = {"rep_id": reps_dim, "account_id": accounts_dim, "supplier_id": suppliers_dim}
    for own_id, dim in dims.items():
        if KEY_LOOKUPS[own_id][1] not in sales.columns:
            sales = sales.join(key_lookup(dim, own_id), own_id, "left")
    if by_month:
        month = F.year("txn_date") * 12 + F.month("txn_date")
        sales = sales.withColumn("_month", month).hint("rebalance", F.col("_month"))
    sales = sales_measures(
        sales,
        margin_rate=margin_rate,
        carry=["product_key", *(key for _, key in KEY_LOOKUPS.values())],
    )

    def amount(cents: str, name: str) -> Column:
        return from_cents(cents).cast("decimal(14,2)").alias(name)

    return sales.select(
        "txn_id",
        "rep_key",
        "account_key",
        "product_key",
        "supplier_key",
        "order_date",
        "cases_sold",
        from_cents("discount_points").cast("decimal(5,2)").alias("discount_pct"),
        amount("revenue_cents", "revenue_usd"),
        amount("per_case_cents", "revenue_per_case"),
        amount("gross_cents", "gross_revenue_usd"),
        amount("discount_cents", "discount_usd"),
        amount("margin_cents", "estimated_margin_usd"),
        "channel",
        F.lit(True).alias("is_valid"),
        _stamp(loaded_at),
    )


def sales_from_gold(
    fact: DataFrame,
    reps_dim: DataFrame | None = None,
    accounts_dim: DataFrame | None = None,
    products_dim: DataFrame | None = None,
    suppliers_dim: DataFrame | None = None,
) -> DataFrame:
    """The measures of a (published) sales fact as the analyses take them.

    Of the ids rep_id, account_id, sku_id and supplier_id those come whose keyed dimension is given;
    an analysis that needs none reads the fact alone, and a filter on the fact's month column reaches
    its folders.
    """
    sales = fact.withColumns(
        {
            "discount_points": to_cents("discount_pct"),
            "revenue_cents": to_cents("revenue_usd"),
            "per_case_cents": to_cents("revenue_per_case"),
            "gross_cents": to_cents("gross_revenue_usd"),
            "discount_cents": to_cents("discount_usd"),
            "margin_cents": to_cents("estimated_margin_usd"),
        }
    )
    for dim, source_id, key, own_id in (
        (reps_dim, "rep_src_id", "rep_key", "rep_id"),
        (accounts_dim, "account_src_id", "account_key", "account_id"),
        (products_dim, "sku_src_id", "product_key", "sku_id"),
        (suppliers_dim, "supplier_src_id", "supplier_key", "supplier_id"),
    ):
        if dim is not None:
            sales = sales.join(dim.select(key, F.col(source_id).alias(own_id)), key, "left")
    return sales


def _stamp(loaded_at: Column | None) -> Column:
    return (F.current_timestamp() if loaded_at is None else loaded_at).alias("dwh_create_date")


def fact_quota(
    quotas: DataFrame, reps_dim: DataFrame, *, loaded_at: Column | None = None
) -> DataFrame:
    """Monthly quota against actuals with year-to-date totals.

    A window partition is one representative's year: twelve rows at most.
    """
    year_to_date = (
        Window.partitionBy("rep_id", F.left("month_year", F.lit(4)))
        .orderBy("month_year")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    key = [F.col("rep_key")] if "rep_key" in reps_dim.columns else []
    reps = reps_dim.select(
        F.col("rep_src_id").alias("rep_id"), *key, "rep_name", "division", "channel"
    )
    totals = quotas.drop("rep_name", "division").withColumns(
        {
            "ytd_actual_cases": F.sum("actual_cases").over(year_to_date),
            "ytd_quota_cases": F.sum("quota_cases").over(year_to_date),
        }
    )
    return totals.join(reps, "rep_id", "left").select(
        *(key or [F.col("rep_id")]),
        "month_year",
        "quota_cases",
        "actual_cases",
        "attainment_pct",
        "quota_revenue_usd",
        "actual_revenue_usd",
        (F.col("actual_cases") - F.col("quota_cases")).alias("cases_variance"),
        (F.col("actual_revenue_usd") - F.col("quota_revenue_usd")).alias("revenue_variance_usd"),
        "ytd_actual_cases",
        "ytd_quota_cases",
        "performance_flag",
        "rep_name",
        "division",
        "channel",
        _stamp(loaded_at),
    )


def fact_attainment(
    attainments: DataFrame,
    reps_dim: DataFrame,
    suppliers_dim: DataFrame,
    programs_dim: DataFrame,
    *,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Programme results per representative, with the gap to goal and the bonus missed.

    Programmes are looked up first: they are the most, and rows carry no names yet when shuffled for them.
    """
    lookups = (
        (programs_dim, "program_src_id", "program_id", "program_key", ["bonus_usd"]),
        (suppliers_dim, "supplier_src_id", "supplier_id", "supplier_key", ["supplier_name", "category"]),
        (reps_dim, "rep_src_id", "rep_id", "rep_key", ["rep_name", "channel"]),
    )
    facts = attainments.drop("rep_name")
    keys = []
    for dim, source_id, own_id, key, attributes in lookups:
        has_key = key in dim.columns
        keys.insert(0, key if has_key else own_id)
        kept = ([key] if has_key else []) + attributes
        facts = facts.join(dim.select(F.col(source_id).alias(own_id), *kept), own_id, "left")
    missed = F.when(F.col("attainment_pct") >= 100, F.lit(0).cast("decimal(12,2)")).otherwise(
        F.round(F.col("bonus_usd") - F.col("bonus_earned_usd"), 2)
    )
    position = rank_of_label("status", STATUS_ORDER)
    return facts.select(
        *keys,
        "quarter",
        "goal_value",
        "actual_value",
        "attainment_pct",
        "bonus_earned_usd",
        (F.col("goal_value") - F.col("actual_value")).alias("gap_to_goal"),
        missed.alias("bonus_missed_usd"),
        "status",
        F.when(position > len(STATUS_ORDER), OTHER_STATUS_POSITION)
        .otherwise(position)
        .alias("status_sort_order"),
        "program_type",
        "division",
        "rep_name",
        "channel",
        "supplier_name",
        F.col("category").alias("supplier_category"),
        _stamp(loaded_at),
    )
