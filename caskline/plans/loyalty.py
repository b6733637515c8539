"""Lifetime value, retention, revenue concentration, order rhythm and discount leakage."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caskline.functions.labels import ceiling_label, threshold_label
from caskline.functions.measures import (
    dollars_of,
    from_cents,
    money_percentage,
    month_boundaries,
    ratio,
    whole_division,
)
from caskline.operators.global_window import global_running_sum
from caskline.plans.common import count_of, lookup, with_dates
from caskline.session import materialise

# Default thresholds and labels.
LTV_TIERS = ((150_000, "Platinum"), (75_000, "Gold"), (30_000, "Silver"))
LOWEST_LTV_TIER = "Bronze"
RETENTION_YEARS = (2024, 2025)
GROWTH_FACTOR = Decimal("1.10")
DECLINE_FACTOR = Decimal("0.90")
PARETO_SHARE = Decimal("0.80")
RHYTHM_DAYS = ((14, "Weekly Buyer"), (30, "Monthly Buyer"), (60, "Occasional"))
SLOWEST_RHYTHM = "Infrequent"
LEAKAGE_FACTORS = ((1.4, "Investigate Now"), (1.15, "Monitor Closely"))
NO_LEAKAGE = "Within Policy"


def customer_ltv(
    sales: DataFrame,
    accounts: DataFrame,
    reps: DataFrame,
    *,
    tiers: Sequence[tuple[object, str]] = LTV_TIERS,
    lowest_tier: str = LOWEST_LTV_TIER,
) -> DataFrame:
    """Orders, span, volume, revenue and tier of every account under its representative."""
    lifetimes = sales.groupBy("account_id", "rep_id").agg(
        count_of(sales, "txn_id").alias("total_orders"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
        F.sum("cases_sold").alias("lifetime_cases"),
        F.sum("revenue_cents").alias("_revenue"),
        F.sum("margin_cents").alias("_margin"),
        F.count("revenue_cents").alias("_lines"),
    )
    named = lifetimes.join(
        lookup(
            accounts, "account_src_id", "account_id",
            "account_name", "account_type", "channel", "town",
        ),
        "account_id",
    ).join(lookup(reps, "rep_src_id", "rep_id", "rep_name"), "rep_id")
    months = month_boundaries("first_order", "last_order")
    return named.orderBy(F.desc("_revenue"), "account_id", "rep_id").select(
        "account_name",
        "account_type",
        "channel",
        "town",
        "rep_name",
        "total_orders",
        "first_order",
        "last_order",
        F.datediff("last_order", "first_order").alias("relationship_days"),
        "lifetime_cases",
        from_cents("_revenue").alias("lifetime_revenue"),
        from_cents("_margin").alias("lifetime_margin"),
        ratio(dollars_of("_revenue"), "_lines").alias("avg_order_value"),
        ratio(dollars_of("_revenue"), months).alias("monthly_ltv"),
        threshold_label(from_cents("_revenue"), tiers, lowest_tier).alias("ltv_tier"),
    )


def account_retention(
    sales: DataFrame,
    accounts: DataFrame,
    reps: DataFrame,
    dates: DataFrame | None = None,
    *,
    years: tuple[int, int] = RETENTION_YEARS,
    growth: Decimal = GROWTH_FACTOR,
    decline: Decimal = DECLINE_FACTOR,
) -> DataFrame:
    """Revenue and orders of two years side by side, with a retention status.

    Sales outside both years keep their account in the result and count as zero.
    """
    before, after = years
    year = F.when(F.col("year").isin(before, after), F.col("year")).otherwise(0)
    per_year = (
        with_dates(sales, dates, "year")
        .withColumn("_year", year)
        .groupBy("account_id", "rep_id", "_year")
        .agg(
            F.count_distinct(F.when(F.col("_year") != 0, F.col("txn_id"))).alias("_orders"),
            F.sum("revenue_cents").alias("_revenue"),
        )
    )

    def of_year(y: int, column: str):
        return F.sum(F.when(F.col("_year") == y, F.col(column)).otherwise(0))

    old, new = f"revenue_{before}", f"revenue_{after}"
    yearly = per_year.groupBy("account_id", "rep_id").agg(
        of_year(before, "_revenue").alias(old),
        of_year(after, "_revenue").alias(new),
        of_year(before, "_orders").alias(f"orders_{before}"),
        of_year(after, "_orders").alias(f"orders_{after}"),
    )
    churned = (F.col(old) > 0) & (F.col(new) == 0)
    status = (
        F.when(churned, "Churned")
        .when((F.col(old) == 0) & (F.col(new) > 0), "New")
        .when(F.col(new) > F.col(old) * F.lit(growth), "Growing")
        .when(F.col(new) < F.col(old) * F.lit(decline), "Declining")
        .otherwise("Stable")
    )
    change = F.col(new) - F.col(old)
    return (
        yearly.join(
            lookup(accounts, "account_src_id", "account_id", "account_name", "channel", "town"),
            "account_id",
        )
        .join(lookup(reps, "rep_src_id", "rep_id", "rep_name"), "rep_id")
        .orderBy(F.when(churned, 0).otherwise(1), F.desc(old), "account_id", "rep_id")
        .select(
            "account_name",
            "channel",
            "town",
            "rep_name",
            from_cents(old).alias(old),
            from_cents(new).alias(new),
            from_cents(change).alias("yoy_change"),
            money_percentage(change, old).alias("yoy_growth_pct"),
            f"orders_{before}",
            f"orders_{after}",
            status.alias("retention_status"),
            from_cents(F.when(churned, F.col(old)).otherwise(0)).alias("at_risk_revenue"),
        )
    )


def revenue_pareto(
    sales: DataFrame,
    accounts: DataFrame,
    *,
    share: Decimal = PARETO_SHARE,
    slices: int | None = None,
) -> DataFrame:
    """Accounts by falling revenue with rank, share and running share of all revenue."""
    known = sales.groupBy("account_id").agg(F.sum("revenue_cents").alias("_revenue"))
    known = known.join(accounts.select(F.col("account_src_id").alias("account_id")), "account_id")
    ranked = global_running_sum(
        known,
        "_revenue",
        [("_revenue", "desc"), ("account_id", "asc")],
        name="_running",
        total="_total",
        rank=("revenue_rank", ["_revenue"]),
        slices=slices,
    )
    named = ranked.join(
        lookup(
            accounts, "account_src_id", "account_id", "account_name", "account_type", "channel"
        ),
        "account_id",
    )
    within = F.col("_running") <= F.col("_total") * F.lit(share)
    return named.orderBy("revenue_rank", "account_id").select(
        "revenue_rank",
        "account_name",
        "account_type",
        "channel",
        from_cents("_revenue").alias("account_revenue"),
        money_percentage("_revenue", "_total").alias("pct_of_total"),
        money_percentage("_running", "_total").alias("cumulative_pct"),
        F.when(within, "Top Revenue").otherwise("Tail Revenue").alias("pareto_group"),
    )


def order_gaps(
    sales: DataFrame,
    accounts: DataFrame,
    reps: DataFrame,
    *,
    rhythms: Sequence[tuple[object, str]] = RHYTHM_DAYS,
    slowest: str = SLOWEST_RHYTHM,
) -> DataFrame:
    """Days between consecutive sales of an account, by account and representative.

    An account's first sale has no gap and is left out of its counts and revenue. Sales of one day
    are ordered by representative, then transaction. Sales are folded to one row per account, day
    and representative before the window, since further sales of a day only add zero gaps: the
    window sees at most one row per day and representative, however many sales an account has. Ids
    the dimensions do not hold are dropped before it, names are joined to the few rows after it.
    """
    days = sales.groupBy("account_id", "order_date", "rep_id").agg(
        F.count(F.lit(1)).alias("_sales"),
        F.sum("revenue_cents").alias("_revenue"),
        F.min(F.struct("txn_id", "revenue_cents")).alias("_earliest"),
    )
    known = days.join(lookup(accounts, "account_src_id", "account_id"), "account_id").join(
        lookup(reps, "rep_src_id", "rep_id"), "rep_id"
    )
    in_order = Window.partitionBy("account_id").orderBy("order_date", "rep_id")
    gap = F.datediff("order_date", F.lag("order_date").over(in_order))
    first = F.col("_gap").isNull()
    blocks = known.withColumn("_gap", gap).select(
        "account_id",
        "rep_id",
        (F.col("_sales") - F.when(first, 1).otherwise(0)).alias("_counted"),
        (
            F.col("_revenue") - F.when(first, F.col("_earliest.revenue_cents")).otherwise(0)
        ).alias("_revenue"),
        F.coalesce("_gap", F.lit(0)).alias("_gap"),
    )
    rhythm = blocks.groupBy("account_id", "rep_id").agg(
        F.sum("_counted").alias("total_orders"),
        F.sum("_revenue").alias("_revenue"),
        F.sum("_gap").alias("_days"),
        F.max(F.when(F.col("_counted") > 0, F.col("_gap"))).alias("longest_gap_days"),
    )
    mean_gap = whole_division(F.col("_days"), F.col("total_orders")).cast("int")
    names = lookup(accounts, "account_src_id", "account_id", "account_name", "channel")
    return (
        rhythm.filter("total_orders > 0")
        .withColumn("avg_days_between_orders", mean_gap)
        .join(names, "account_id")
        .join(lookup(reps, "rep_src_id", "rep_id", "rep_name"), "rep_id")
        .orderBy(F.desc("avg_days_between_orders"), "account_id", "rep_id")
        .select(
            "account_name",
            "channel",
            "rep_name",
            "total_orders",
            from_cents("_revenue").alias("total_revenue"),
            "avg_days_between_orders",
            "longest_gap_days",
            ceiling_label("avg_days_between_orders", rhythms, slowest).alias("engagement_health"),
        )
    )


def discount_leakage(
    sales: DataFrame,
    reps: DataFrame,
    *,
    factors: Sequence[tuple[float, str]] = LEAKAGE_FACTORS,
    within_policy: str = NO_LEAKAGE,
) -> DataFrame:
    """Representatives' discount rates against the unweighted mean of all representatives."""
    per_rep = sales.groupBy("rep_id").agg(
        F.sum("revenue_cents").alias("_net"),
        F.sum("gross_cents").alias("_gross"),
        F.sum("discount_cents").alias("_discount"),
    )
    # One row per representative, read twice below.
    rated = materialise(
        per_rep.join(lookup(reps, "rep_src_id", "rep_id", "rep_name", "division", "channel"), "rep_id")
        .withColumn("rep_disc_rate", money_percentage("_discount", "_gross"))
    )
    company = rated.agg(F.avg("rep_disc_rate")).scalar()
    above = F.col("rep_disc_rate") - F.col("company_avg")
    action = F.lit(within_policy)
    for factor, label in reversed(list(factors)):
        action = F.when(F.col("rep_disc_rate") > F.col("company_avg") * factor, label).otherwise(
            action
        )
    return (
        rated.withColumn("company_avg", company)
        .select(
            "rep_name",
            "division",
            "channel",
            from_cents("_net").alias("net_revenue"),
            from_cents("_discount").alias("total_discounts"),
            "rep_disc_rate",
            "company_avg",
            above.alias("above_avg_by"),
            F.when(above > 0, dollars_of("_gross") * above / 100)
            .otherwise(0.0)
            .alias("recoverable_revenue"),
            action.alias("action"),
        )
        .orderBy(F.desc("rep_disc_rate"), "rep_id")
    )
