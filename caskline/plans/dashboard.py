"""Key figures, trends, scorecards and mixes for dashboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caskline.functions.labels import rank_of_label, threshold_label
from caskline.functions.measures import (
    dollars_of,
    from_cents,
    mean_of,
    money_percentage,
    percentage,
    ratio,
)
from caskline.operators.dimensions import date_attributes
from caskline.operators.global_window import global_rank, global_running_sum
from caskline.plans.common import count_of, is_unique, join_totals, known_ids, lookup, with_dates

# Default thresholds and labels.
REP_STATUS = ((400_000, "Top Performer"), (250_000, "On Track"))
LOWEST_REP_STATUS = "Needs Support"
URGENCY = ((100, "1_Achieved"), (85, "2_Push_Now"), (60, "3_Focus"))
HIGHEST_URGENCY = "4_At_Risk"
TIER_ORDER = ("Ultra-Premium", "Premium", "Mid-Range")


def kpi_card(sales: DataFrame, accounts: DataFrame, reps: DataFrame) -> DataFrame:
    """One row of company-wide key figures."""
    per_account = sales.groupBy("account_id", "rep_id").agg(
        F.min("order_date").alias("_from"),
        F.max("order_date").alias("_to"),
        count_of(sales, "txn_id").alias("_orders"),
        F.sum("cases_sold").alias("_cases"),
        F.sum("revenue_cents").alias("_net"),
        F.sum("gross_cents").alias("_gross"),
        F.sum("discount_cents").alias("_discount"),
        F.sum("margin_cents").alias("_margin"),
        F.sum("per_case_cents").alias("_per_case"),
        F.count("per_case_cents").alias("_lines"),
    )
    known = known_ids(per_account, accounts, "account_src_id", "account_id")
    known = known_ids(known, reps, "rep_src_id", "rep_id")
    return known.agg(
        F.min("_from").alias("data_from"),
        F.max("_to").alias("data_to"),
        F.sum("_orders").alias("total_transactions"),
        F.count_distinct("account_id").alias("active_accounts"),
        F.count_distinct("rep_id").alias("active_reps"),
        F.sum("_cases").alias("total_cases"),
        from_cents(F.sum("_net")).alias("total_net_revenue"),
        from_cents(F.sum("_gross")).alias("total_gross_revenue"),
        from_cents(F.sum("_discount")).alias("total_discounts"),
        from_cents(F.sum("_margin")).alias("total_est_margin"),
        money_percentage(F.sum("_margin"), F.sum("_net")).alias("overall_margin_pct"),
        money_percentage(F.sum("_discount"), F.sum("_gross")).alias("overall_discount_rate"),
        ratio(dollars_of(F.sum("_per_case")), F.sum("_lines")).alias("avg_rev_per_case"),
    )


def monthly_trend(sales: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Months with the previous month, the change, a 3-month mean and the same month last year.

    Months are compared by the calendar: a month without sales is missing, not skipped. The windows
    run over months (12 rows a year), after the aggregation. Sales are grouped by the day their month
    starts, and the month's attributes follow from that; only a calendar of the caller's own is
    joined to the sales first.
    """
    attributes = ("year_month", "year", "month_num", "month_name", "year_quarter", "season")
    measures = (
        count_of(sales, "txn_id").alias("transactions"),
        F.sum("cases_sold").alias("cases_sold"),
        from_cents(F.sum("revenue_cents")).alias("net_revenue"),
        from_cents(F.sum("margin_cents")).alias("est_margin"),
        from_cents(F.sum("discount_cents")).alias("discounts"),
    )
    if dates is None:
        starts = sales.groupBy(F.trunc("order_date", "month").alias("_start")).agg(*measures)
        usual = date_attributes(F.col("_start"))
        months = starts.select(*[usual[a].alias(a) for a in attributes], *starts.columns[1:])
    else:
        months = with_dates(sales, dates, *attributes).groupBy(*attributes).agg(*measures)
    by_month = Window.orderBy(F.col("year") * 12 + F.col("month_num"))
    last_three = by_month.rangeBetween(-2, 0)
    previous = F.first("net_revenue").over(by_month.rangeBetween(-1, -1))
    return months.select(
        "*",
        previous.alias("prev_month_revenue"),
        (F.col("net_revenue") - previous).alias("mom_change"),
        ratio(
            F.sum("net_revenue").over(last_three), F.count("net_revenue").over(last_three)
        ).alias("rolling_3mo_avg"),
        F.first("net_revenue").over(by_month.rangeBetween(-12, -12)).alias("same_month_prior_year"),
    ).orderBy("year_month")


def rep_scorecard(
    sales: DataFrame,
    accounts: DataFrame,
    reps: DataFrame,
    quotas: DataFrame,
    *,
    levels: Sequence[tuple[object, str]] = REP_STATUS,
    lowest: str = LOWEST_REP_STATUS,
) -> DataFrame:
    """Representatives by revenue with rank, mean quota attainment and status.

    ``quotas`` needs rep_id and attainment_pct; it is averaged per representative before the join,
    so a sale is counted once however many quota months there are.
    """
    per_account = sales.groupBy("rep_id", "account_id").agg(
        count_of(sales, "txn_id").alias("_orders"),
        F.sum("cases_sold").alias("_cases"),
        F.sum("revenue_cents").alias("_net"),
        F.sum("margin_cents").alias("_margin"),
        F.sum("discount_cents").alias("_discount"),
        F.sum("gross_cents").alias("_gross"),
        F.sum("per_case_cents").alias("_per_case"),
        F.count("per_case_cents").alias("_lines"),
    )
    known = known_ids(per_account, accounts, "account_src_id", "account_id")
    per_rep = known.groupBy("rep_id").agg(
        F.sum("_orders").alias("transactions"),
        F.count("account_id").alias("accounts_covered"),
        F.sum("_cases").alias("cases_sold"),
        from_cents(F.sum("_net")).alias("net_revenue"),
        from_cents(F.sum("_margin")).alias("est_margin"),
        from_cents(F.sum("_discount")).alias("discounts_given"),
        from_cents(F.sum("_gross")).alias("_gross"),
        from_cents(F.sum("_per_case")).alias("_per_case"),
        F.sum("_lines").alias("_lines"),
    )
    named = per_rep.join(
        lookup(reps, "rep_src_id", "rep_id", "rep_name", "division", "channel", "years_tenure"),
        "rep_id",
    )
    ranked = global_rank(
        named, [("net_revenue", "desc")], tiebreak=[("rep_id", "asc")], name="revenue_rank"
    )
    attainment = quotas.groupBy("rep_id").agg(
        mean_of("attainment_pct").alias("avg_quota_attainment_pct")
    )
    return ranked.join(attainment, "rep_id", "left").select(
        "rep_name",
        "division",
        "channel",
        "years_tenure",
        "transactions",
        "accounts_covered",
        "cases_sold",
        "net_revenue",
        "est_margin",
        "discounts_given",
        percentage("discounts_given", "_gross").alias("discount_rate_pct"),
        ratio("_per_case", "_lines").alias("avg_rev_per_case"),
        "revenue_rank",
        "avg_quota_attainment_pct",
        threshold_label("net_revenue", levels, lowest).alias("performance_status"),
    ).orderBy(F.desc("net_revenue"), "rep_id")


def supplier_mix(sales: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Suppliers by revenue with their share of all supplier revenue and their rank."""
    per_supplier = sales.groupBy("supplier_id").agg(
        count_of(sales, "txn_id").alias("transactions"),
        F.sum("cases_sold").alias("cases_sold"),
        from_cents(F.sum("revenue_cents")).alias("net_revenue"),
        from_cents(F.sum("margin_cents")).alias("est_margin"),
        from_cents(F.sum("discount_cents")).alias("discounts"),
    )
    named = per_supplier.join(
        lookup(
            suppliers, "supplier_src_id", "supplier_id", "supplier_name", "category", "origin_type"
        ),
        "supplier_id",
    )
    ranked = global_running_sum(
        named,
        "net_revenue",
        [("net_revenue", "desc"), ("supplier_id", "asc")],
        name="_running",
        total="_total",
        rank=("revenue_rank", ["net_revenue"]),
    )
    return ranked.select(
        "supplier_name",
        "category",
        "origin_type",
        "transactions",
        "cases_sold",
        "net_revenue",
        "est_margin",
        "discounts",
        percentage("net_revenue", "_total").alias("revenue_share_pct"),
        "revenue_rank",
    ).orderBy("revenue_rank", "supplier_name", "supplier_id")


def channel_split(
    sales: DataFrame, accounts: DataFrame, reps: DataFrame, dates: DataFrame | None = None
) -> DataFrame:
    """Channels by year: volume, margin, revenue per representative and per account."""
    per_account = (
        with_dates(sales, dates, "year")
        .groupBy("channel", "year", "account_id", "rep_id")
        .agg(
            count_of(sales, "txn_id").alias("_orders"),
            F.sum("cases_sold").alias("_cases"),
            F.sum("revenue_cents").alias("_net"),
            F.sum("margin_cents").alias("_margin"),
        )
    )
    known = known_ids(per_account, accounts, "account_src_id", "account_id")
    known = known_ids(known, reps, "rep_src_id", "rep_id")
    channels = known.groupBy("channel", "year").agg(
        F.sum("_orders").alias("transactions"),
        F.count_distinct("rep_id").alias("reps"),
        F.count_distinct("account_id").alias("accounts"),
        F.sum("_cases").alias("cases_sold"),
        from_cents(F.sum("_net")).alias("net_revenue"),
        from_cents(F.sum("_margin")).alias("est_margin"),
    )
    return channels.select(
        "*",
        percentage("est_margin", "net_revenue").alias("margin_pct"),
        ratio("net_revenue", "reps").alias("revenue_per_rep"),
        ratio("net_revenue", "accounts").alias("revenue_per_account"),
    ).orderBy("year", F.desc("net_revenue"), "channel")


def bonus_tracker(
    attainment: DataFrame,
    *,
    levels: Sequence[tuple[object, str]] = URGENCY,
    highest: str = HIGHEST_URGENCY,
) -> DataFrame:
    """Programme results with an urgency bucket and the supplier's bonus pool of the quarter.

    Pools are kept by supplier id, so namesakes stay apart. The pool is summed from the columns it
    needs and joined back rather than windowed: a window would move all results of a
    supplier's quarter into one task, the sum is combined on the map side first.
    """
    supplier = "supplier_key" if "supplier_key" in attainment.columns else "supplier_id"
    group = [supplier, "quarter"]
    pools = attainment.groupBy(*group).agg(
        F.sum(F.col("bonus_earned_usd") + F.col("bonus_missed_usd")).alias("supplier_total_pool")
    )
    rows = join_totals(attainment, pools, group)
    # Status and bonus have few values; the names and ids behind them spread equal rows over many tasks.
    ids = [c for c in ("attainment_id", "program_key", "program_id", "rep_key", "rep_id", supplier) if c in rows.columns]
    return rows.orderBy(
        "status_sort_order", F.desc("bonus_missed_usd"), "supplier_name", "quarter", "rep_name", *ids
    ).select(
        "supplier_name",
        "rep_name",
        "division",
        "quarter",
        "program_type",
        "attainment_pct",
        "gap_to_goal",
        "bonus_earned_usd",
        "bonus_missed_usd",
        "status",
        "status_sort_order",
        threshold_label("attainment_pct", levels, highest).alias("urgency_bucket"),
        "supplier_total_pool",
    )


def price_tier_mix(
    sales: DataFrame,
    products: DataFrame,
    dates: DataFrame | None = None,
    *,
    tier_order: Sequence[str] = TIER_ORDER,
) -> DataFrame:
    """Volume by price tier and category, with its share of the channel's cases in the year.

    The window runs over category labels of one channel and year, after the aggregation.
    """
    labels = lookup(products, "sku_src_id", "sku_id", "price_tier", "category", "sub_category")
    dated = with_dates(sales, dates, "year")
    group = ["price_tier", "category", "sub_category", "channel", "year"]
    sums = {
        "cases_sold": "cases_sold",
        "_net": "revenue_cents",
        "_margin": "margin_cents",
        "_per_case": "per_case_cents",
    }
    lines = F.count("per_case_cents").alias("_lines")
    if is_unique(sales, "txn_id"):
        # Plain counts add up, so products are folded before their labels are joined.
        folded = dated.groupBy("sku_id", "channel", "year").agg(
            F.count("txn_id").alias("transactions"), lines, *[F.sum(c).alias(name) for name, c in sums.items()]
        )
        mix = folded.join(labels, "sku_id").groupBy(*group).agg(
            *[F.sum(name).alias(name) for name in ("transactions", "_lines", *sums)]
        )
    else:
        mix = dated.join(labels, "sku_id").groupBy(*group).agg(
            F.count_distinct("txn_id").alias("transactions"), lines, *[F.sum(c).alias(name) for name, c in sums.items()]
        )
    mix = mix.select(
        *group,
        "transactions",
        "cases_sold",
        from_cents("_net").alias("net_revenue"),
        from_cents("_margin").alias("est_margin"),
        ratio(dollars_of("_per_case"), "_lines").alias("avg_rev_per_case"),
    )
    channel_year = F.sum("cases_sold").over(Window.partitionBy("channel", "year"))
    return mix.select(
        "*", percentage("cases_sold", channel_year).alias("pct_of_channel_volume")
    ).orderBy(
        "year", "channel", rank_of_label("price_tier", tier_order), "price_tier", "category", "sub_category"
    )


def geo_density(sales: DataFrame, accounts: DataFrame) -> DataFrame:
    """Towns by revenue, with revenue per account against the mean town of the division."""
    per_account = sales.groupBy("account_id").agg(
        count_of(sales, "txn_id").alias("_orders"),
        F.sum("cases_sold").alias("_cases"),
        F.sum("revenue_cents").alias("_net"),
        F.sum("margin_cents").alias("_margin"),
    )
    towns = (
        per_account.join(
            lookup(accounts, "account_src_id", "account_id", "town", "state", "division"),
            "account_id",
        )
        .groupBy("town", "state", "division")
        .agg(
            F.count("account_id").alias("accounts"),
            F.sum("_orders").alias("transactions"),
            F.sum("_cases").alias("cases_sold"),
            from_cents(F.sum("_net")).alias("net_revenue"),
            from_cents(F.sum("_margin")).alias("est_margin"),
        )
        .withColumn("revenue_per_account", ratio("net_revenue", "accounts"))
    )
    division_mean = F.avg("revenue_per_account").over(Window.partitionBy("division"))
    return towns.select(
        "*", percentage("revenue_per_account", division_mean).alias("pct_of_division_avg")
    ).orderBy(F.desc("net_revenue"), "division", "state", "town")
