"""Comparisons between groups: channels, discount levels, premium mix."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caskline.functions.measures import (
    dollars_of,
    from_cents,
    mean_dollars,
    mean_of,
    merge_squares,
    money_percentage,
    percentage,
    ratio,
    round_quotient,
    sample_stdev_dollars,
    sum_of_squares,
)
from caskline.plans.common import count_of, known_ids, lookup

# Group labels and limits.
WINNER, COMPARISON = "Winner", "Comparison"
NO_DISCOUNT = "A_Control: No Discount"
DISCOUNT_BANDS = ((1, 5, "B_Low Discount (1-5%)"), (6, 15, "C_Mid Discount (6-15%)"))
OTHER_DISCOUNT = "D_High Discount (>15%)"
PREMIUM_TIERS = ("Premium", "Ultra-Premium")
PREMIUM_CUTPOINT = 30
TREATMENT, CONTROL = "Treatment", "Control"


def ab_channel(sales: DataFrame, accounts: DataFrame) -> DataFrame:
    """Channels as test groups: size, mean and spread of sales, margin, discount, and a winner.

    The spread comes from the count, sum and sum of squares of whole cents: exact moments that are merged
    after the distinct counts have been taken per account.
    """
    revenue = F.col("revenue_cents")
    per_account = sales.groupBy("channel", "account_id").agg(
        count_of(sales, "txn_id").alias("_orders"),
        F.count(revenue).alias("_n"),
        F.sum(revenue).alias("_net"),
        sum_of_squares(revenue).alias("_net_squared"),
        F.sum("per_case_cents").alias("_per_case"),
        F.count("per_case_cents").alias("_cases_n"),
        F.sum("margin_cents").alias("_margin"),
        F.sum("discount_cents").alias("_discount"),
        F.sum("gross_cents").alias("_gross"),
    )
    known = known_ids(per_account, accounts, "account_src_id", "account_id")
    net, margin, n = dollars_of(F.sum("_net")), dollars_of(F.sum("_margin")), F.sum("_n")
    groups = known.groupBy(F.col("channel").alias("test_group")).agg(
        F.sum("_orders").alias("n_transactions"),
        F.count_distinct("account_id").alias("n_accounts"),
        from_cents(F.sum("_net")).alias("total_revenue"),
        ratio(net, n).alias("avg_order_value"),
        sample_stdev_dollars(n, F.sum("_net"), merge_squares("_net_squared")).alias("stdev_order_value"),
        ratio(dollars_of(F.sum("_per_case")), F.sum("_cases_n")).alias("avg_rev_per_case"),
        from_cents(F.sum("_margin")).alias("total_margin"),
        percentage(ratio(margin, n), ratio(net, n)).alias("avg_margin_pct"),
        money_percentage(F.sum("_discount"), F.sum("_gross")).alias("discount_rate"),
    )
    # One row per channel label.
    best = F.max("avg_margin_pct").over(Window.partitionBy())
    return groups.select(
        "*",
        ratio("total_revenue", "n_accounts").alias("revenue_per_account"),
        F.when(F.col("avg_margin_pct") == best, WINNER).otherwise(COMPARISON).alias("margin_winner"),
    )


def discount_band(
    points: Column, bands: Sequence[tuple[float, float, str]], otherwise: str
) -> Column:
    """Band of a discount in hundredths of a percent; between two bands it is ``otherwise``."""
    result = F.lit(otherwise)
    for low, high, label in reversed(list(bands)):
        inside = points.between(round(low * 100), round(high * 100))
        result = F.when(inside, label).otherwise(result)
    return F.when(points == 0, NO_DISCOUNT).otherwise(result)


def ab_discount_lift(
    sales: DataFrame,
    *,
    bands: Sequence[tuple[float, float, str]] = DISCOUNT_BANDS,
    other: str = OTHER_DISCOUNT,
) -> DataFrame:
    """Discount bands: means per sale, uplift in cases over undiscounted sales, discount yield."""
    band = discount_band(F.col("discount_points"), bands, other)
    groups = sales.groupBy(band.alias("test_group")).agg(
        F.count(F.lit(1)).alias("n_transactions"),
        mean_dollars("discount_points").alias("avg_discount_applied"),
        mean_of("cases_sold").alias("avg_cases_per_order"),
        mean_dollars("revenue_cents").alias("avg_net_revenue_per_order"),
        mean_dollars("gross_cents").alias("avg_gross_per_order"),
        mean_dollars("discount_cents").alias("avg_discount_given"),
        mean_dollars("per_case_cents").alias("avg_rev_per_case"),
        mean_dollars("margin_cents").alias("avg_margin_per_order"),
        from_cents(F.sum("discount_cents")).alias("total_discounts_given"),
        from_cents(F.sum("revenue_cents")).alias("_net"),
    )
    # The undiscounted sales are the control band itself; the window sees one row per band.
    baseline = F.max(
        F.when(F.col("test_group") == NO_DISCOUNT, F.col("avg_cases_per_order"))
    ).over(Window.partitionBy())
    return groups.select(
        *[c for c in groups.columns if c != "_net"],
        (ratio("avg_cases_per_order", baseline) * 100 - 100).alias("case_uplift_vs_no_discount"),
        ratio("_net", "total_discounts_given").alias("revenue_per_dollar_discounted"),
    ).orderBy("test_group")


def ab_discount_roi(sales: DataFrame) -> DataFrame:
    """One row: revenue with and without discount, and what discounts cost."""
    points, revenue = F.col("discount_points"), F.col("revenue_cents")
    gross, given = F.sum("gross_cents"), F.sum("discount_cents")
    return sales.agg(
        from_cents(F.sum(F.when(points == 0, revenue).otherwise(0))).alias("full_price_revenue"),
        from_cents(F.sum(F.when(points > 0, revenue).otherwise(0))).alias("discounted_revenue"),
        from_cents(given).alias("total_discounts_given"),
        from_cents(gross - F.sum(revenue)).alias("revenue_left_on_table"),
        money_percentage(given, gross).alias("overall_discount_rate"),
        money_percentage(given, gross - given).alias("breakeven_uplift_needed"),
    )


def _scaled_mean(total: str, count: str, factor: int) -> Column:
    """total * factor / count as a whole number; decimals hold the large product."""
    product = F.col(total).cast("decimal(20,0)") * F.lit(Decimal(factor))
    return round_quotient(product, F.nullif(F.col(count), F.lit(0)).cast("decimal(20,0)"))


def ab_premium_mix(
    sales: DataFrame,
    reps: DataFrame,
    products: DataFrame,
    *,
    cutpoint: float = PREMIUM_CUTPOINT,
    premium: Sequence[str] = PREMIUM_TIERS,
) -> DataFrame:
    """Representatives with a high share of premium cases against the others.

    Each representative's means are kept as whole numbers with eight decimals before they are
    averaged, so that the lift does not depend on the order in which rows arrive.
    """
    # Sums per representative and product first: the tier is then joined to those, not to every sale.
    per_product = sales.groupBy("rep_id", "sku_id").agg(
        F.sum("cases_sold").alias("_cases"),
        F.sum("revenue_cents").alias("_net"),
        F.sum("per_case_cents").alias("_per_case"),
        F.count("per_case_cents").alias("_lines"),
        F.sum("margin_cents").alias("_margin"),
    )
    tiered = per_product.join(lookup(products, "sku_src_id", "sku_id", "price_tier"), "sku_id")
    premium_cases = F.sum(F.when(F.col("price_tier").isin(*premium), F.col("_cases")).otherwise(0))
    mixes = (
        tiered.groupBy("rep_id")
        .agg(
            F.sum("_cases").alias("_cases"),
            premium_cases.alias("_premium"),
            F.sum("_net").alias("_net"),
            F.sum("_per_case").alias("_per_case"),
            F.sum("_lines").alias("_lines"),
            F.sum("_margin").alias("_margin"),
        )
        .join(lookup(reps, "rep_src_id", "rep_id"), "rep_id")
        .withColumn("_mix", percentage("_premium", "_cases"))
        .withColumn("_mix_units", _scaled_mean("_premium", "_cases", 10**10))
        .withColumn("_per_case_units", _scaled_mean("_per_case", "_lines", 10**6))
    )

    def mean_of_units(column: str) -> Column:
        return ratio(F.sum(column), F.count(column)) / 1e8

    groups = mixes.groupBy(
        F.when(F.col("_mix") >= cutpoint, TREATMENT).otherwise(CONTROL).alias("ab_group")
    ).agg(
        F.count(F.lit(1)).alias("n_reps"),
        mean_of_units("_mix_units").alias("avg_premium_mix"),
        mean_dollars("_net").alias("avg_rep_revenue"),
        mean_of_units("_per_case_units").alias("avg_rev_per_case"),
        mean_dollars("_margin").alias("avg_rep_margin"),
        F.sum("_cases").alias("_cases"),
    )
    # Two rows at most from here on.
    both = Window.partitionBy()
    treated, control = F.col("ab_group") == TREATMENT, F.col("ab_group") == CONTROL
    lift = F.max(F.when(treated, F.col("avg_rev_per_case"))).over(both) - F.min(
        F.when(control, F.col("avg_rev_per_case"))
    ).over(both)
    control_cases = F.sum(F.when(control, F.col("_cases")).otherwise(0)).over(both)
    return groups.select(
        "ab_group",
        "n_reps",
        "avg_premium_mix",
        "avg_rep_revenue",
        "avg_rev_per_case",
        "avg_rep_margin",
        lift.alias("rev_per_case_lift"),
        (lift * control_cases).alias("potential_incremental_revenue"),
    )
