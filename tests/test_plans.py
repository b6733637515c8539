"""Analyses on small stars written by hand, and the shapes of their plans."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from caskline.functions.display import dollars, grouped, percent
from caskline.functions.measures import month_boundaries, round_quotient, year_boundaries
from caskline.operators import dimensions as dims
from caskline.operators.facts import sales_measures
from caskline.plans import dashboard, experiments, loyalty, segmentation
from caskline.plans.presentation import present

TXN = (
    "txn_id bigint, txn_date date, account_id bigint, rep_id bigint, sku_id bigint, supplier_id bigint, "
    "cases_sold int, discount_pct decimal(5,2), revenue_usd decimal(12,2), channel string, is_valid boolean, "
    "price_per_case_usd decimal(10,2)"
)


def sales_of(spark, *rows):
    """(txn, day, account, rep, cases, discount, revenue)."""
    data = [
        (t, dt.date.fromisoformat(day), a, r, 1, 1, cases, Decimal(str(disc)), Decimal(str(rev)), "On-Premise",
         True, Decimal("100.00"))
        for t, day, a, r, cases, disc, rev in rows
    ]
    return sales_measures(spark.createDataFrame(data, TXN))


@pytest.fixture(scope="module")
def accounts(spark):
    rows = [(i, "Same Name" if i < 3 else f"Account {i}") for i in range(1, 12)]
    df = spark.createDataFrame(rows, "account_id bigint, account_name string")
    return dims.dim_accounts(
        df.selectExpr(
            "*", "'Bar' account_type", "'On-Premise' channel", "'T' town", "'CT' state", "'N' division",
            "1L rep_id", "true is_active",
        ),
        keyed=False,
    )


@pytest.fixture(scope="module")
def reps(spark):
    df = spark.createDataFrame([(1, "R1"), (2, "R2")], "rep_id bigint, rep_name string").selectExpr(
        "*", "'N' division", "'On-Premise' channel", "date'2020-12-31' hire_date", "'e' email"
    )
    return dims.dim_reps(df, as_of=dt.date(2021, 1, 1), keyed=False)


def by(df, key):
    return {row[key]: row for row in df.collect()}


def test_retention_statuses(spark, accounts, reps):
    rows = []
    cases = {3: (100, 0), 4: (0, 100), 5: (100, 111), 6: (100, 89), 7: (100, 110), 8: (100, 90), 9: (0, 0)}
    for account, (old, new) in cases.items():
        rows.append((account * 10, "2023-06-01", account, 1, 1, 0, 5))
        if old:
            rows.append((account * 10 + 1, "2024-06-01", account, 1, 1, 0, old))
        if new:
            rows.append((account * 10 + 2, "2025-06-01", account, 1, 1, 0, new))
    dates = dims.dim_date(spark, dt.date(2023, 1, 1), dt.date(2025, 12, 31))
    got = by(loyalty.account_retention(sales_of(spark, *rows), accounts, reps, dates), "account_name")
    assert {n: r.retention_status for n, r in got.items()} == {
        "Account 3": "Churned", "Account 4": "New", "Account 5": "Growing", "Account 6": "Declining",
        "Account 7": "Stable", "Account 8": "Stable", "Account 9": "Stable",
    }
    assert got["Account 3"].at_risk_revenue == 100
    assert got["Account 4"].yoy_growth_pct is None
    assert (got["Account 9"].orders_2024, got["Account 9"].revenue_2024) == (0, 0)


def test_namesakes_stay_apart_and_monthly_value_counts_boundaries(spark, accounts, reps):
    sales = sales_of(
        spark, (1, "2024-01-31", 1, 1, 1, 0, 100), (2, "2024-02-01", 1, 1, 1, 0, 50), (3, "2024-01-01", 2, 1, 1, 0, 7)
    )
    got = loyalty.customer_ltv(sales, accounts, reps).collect()
    assert [(r.account_name, r.lifetime_revenue) for r in got] == [("Same Name", 150), ("Same Name", 7)]
    assert got[0].monthly_ltv == 150 and got[1].monthly_ltv is None
    assert got[0].relationship_days == 1 and got[0].ltv_tier == "Bronze"


def test_order_gaps_leave_out_the_first_sale_and_truncate_the_mean(spark, accounts, reps):
    sales = sales_of(
        spark,
        # account 1: gaps 14, 15, 15 (mean 14.67), the first sale's revenue is left out
        (1, "2024-01-01", 1, 1, 1, 0, 1000), (2, "2024-01-15", 1, 1, 1, 0, 1), (3, "2024-01-30", 1, 1, 1, 0, 2),
        (4, "2024-02-14", 1, 1, 1, 0, 4),
        # account 2: two sales on one day, a second representative later
        (5, "2024-01-01", 2, 1, 1, 0, 10), (6, "2024-01-01", 2, 1, 1, 0, 20), (7, "2024-03-31", 2, 2, 1, 0, 40),
        # account 3: a single sale has no gap
        (8, "2024-01-01", 3, 1, 1, 0, 10),
    )
    got = loyalty.order_gaps(sales, accounts, reps).collect()
    assert [
        (r.rep_name, r.total_orders, r.total_revenue, r.avg_days_between_orders, r.longest_gap_days, r.engagement_health)
        for r in got
    ] == [
        ("R2", 1, 40, 90, 90, "Infrequent"),
        ("R1", 3, 7, 14, 15, "Weekly Buyer"),
        ("R1", 1, 20, 0, 0, "Weekly Buyer"),
    ]


def test_pareto_ranks_ties_alike_and_ends_at_all_revenue(spark, accounts):
    sales = sales_of(
        spark, *[(i, "2024-01-01", i, 1, 1, 0, rev) for i, rev in ((3, 50), (4, 20), (5, 20), (6, 10))]
    )
    got = loyalty.revenue_pareto(sales, accounts, slices=3).collect()
    assert [r.revenue_rank for r in got] == [1, 2, 2, 4]
    assert [r.cumulative_pct for r in got] == [50.0, 70.0, 90.0, 100.0]
    assert [r.pareto_group[:3] for r in got] == ["Top", "Top", "Tai", "Tai"]


@pytest.mark.parametrize(
    "discount, band",
    [("0", "A"), ("0.5", "D"), ("1", "B"), ("5", "B"), ("5.5", "D"), ("6", "C"), ("15", "C"), ("15.01", "D")],
)
def test_discount_bands(spark, discount, band):
    got = experiments.ab_discount_lift(sales_of(spark, (1, "2024-01-01", 1, 1, 2, discount, 10))).collect()
    assert got[0].test_group[0] == band
    assert got[0].case_uplift_vs_no_discount == (0.0 if band == "A" else None)


def test_unknown_ids_are_not_counted(spark, accounts, reps):
    sales = sales_of(spark, (1, "2024-01-01", 1, 1, 1, 0, 10), (2, "2024-01-01", 99, 98, 1, 0, 5))
    card = dashboard.kpi_card(sales, accounts, reps).collect()[0]
    assert (card.total_transactions, card.active_accounts, card.active_reps) == (2, 1, 1)
    assert card.total_net_revenue == 15


def test_quota_months_do_not_multiply_sales(spark, accounts, reps):
    quotas = spark.createDataFrame([(1, Decimal(80)), (1, Decimal(120))], "rep_id bigint, attainment_pct decimal(6,2)")
    sales = sales_of(spark, (1, "2024-01-01", 1, 1, 2, 0, 10), (2, "2024-01-02", 2, 1, 1, 0, 5))
    row = dashboard.rep_scorecard(sales, accounts, reps, quotas).collect()[0]
    assert (row.net_revenue, row.cases_sold, row.avg_quota_attainment_pct) == (15, 3, 100.0)
    assert (row.years_tenure, row.accounts_covered, row.revenue_rank) == (1, 2, 1)


@pytest.mark.parametrize("best_is_high", [False, True])
def test_rfm_scores_of_few_accounts(spark, accounts, best_is_high):
    rows = [(10 * a + n, f"2025-12-{10 + a}", a, 1, 1, 0, 10 * a) for a in (3, 4, 5) for n in range(a)]
    base = segmentation._base(sales_of(spark, *rows), ["account_id"], segmentation.ANCHOR)
    scored = by(segmentation.score_rfm(base, ["account_id"], best_is_high=best_is_high, slices=2), "account_id")
    codes = [(scored[a].r_score, scored[a].f_score, scored[a].m_score) for a in (5, 4, 3)]
    ranks = [3, 2, 1] if best_is_high else [1, 2, 3]
    assert codes == [(n, n, n) for n in ranks]


def test_segments_follow_the_order_of_the_rules(spark):
    scores = [(4, 3, 3), (3, 3, 4), (1, 4, 4), (2, 1, 4), (4, 2, 1), (3, 3, 2), (1, 1, 1)]
    df = spark.createDataFrame(scores, "r_score int, f_score int, m_score int")
    got = [r.s for r in df.select(segmentation.segment_of().alias("s")).collect()]
    assert got == [
        "Champions", "Loyal Customers", "Loyal Customers", "Cannot Lose Them", "Potential Loyalists",
        "Hibernating", "Hibernating",
    ]


@pytest.mark.parametrize(
    "price, tier",
    [("99.99", "Value"), ("100", "Mid-Range"), ("200", "Premium"), ("350", "Ultra-Premium"), (None, "Ultra-Premium")],
)
def test_price_tiers(spark, price, tier):
    df = spark.createDataFrame([(Decimal(price) if price else None,)], "price_per_case_usd decimal(10,2)")
    products = df.selectExpr("1L sku_id", "1L supplier_id", "'p' product_name", "'c' category", "'s' sub_category", "1 size_ml", "*")
    assert dims.dim_products(products, keyed=False).collect()[0].price_tier == tier


def test_calendar(spark):
    days = by(dims.dim_date(spark), "full_date")
    assert len(days) == 731
    leap, last = days[dt.date(2024, 2, 29)], days[dt.date(2025, 12, 31)]
    assert (leap.date_key, leap.month_short, leap.year_quarter, leap.season) == (20240229, "Feb", "2024-Q1", "Standard")
    assert (last.season, last.is_weekend, last.day_of_week_name) == ("Holiday Season", 0, "Wednesday")
    assert (days[dt.date(2024, 1, 7)].day_of_week_num, days[dt.date(2024, 1, 7)].is_weekend) == (1, 1)


def test_boundaries_and_rounding(spark):
    row = spark.range(1).select(
        month_boundaries(F.lit(dt.date(2024, 1, 31)), F.lit(dt.date(2024, 2, 1))).alias("months"),
        year_boundaries(F.lit(dt.date(2023, 12, 31)), F.lit(dt.date(2024, 1, 1))).alias("years"),
        round_quotient(F.lit(5), F.lit(2)).alias("up"),
        round_quotient(F.lit(-5), F.lit(2)).alias("down"),
        round_quotient(F.lit(5), F.nullif(F.lit(0), F.lit(0))).alias("none"),
        grouped(F.lit(2.5), 0).alias("half"),
        dollars(F.lit(Decimal("-1234567.5")), 0).alias("debt"),
        percent(F.lit(0.25), 1).alias("share"),
        dollars(F.lit(None).cast("double"), 2).alias("missing"),
    ).collect()[0]
    assert tuple(row) == (1, 1, 3, -3, None, "3", "$-1,234,568", "0.3%", None)


def test_report_texts(spark, accounts, reps):
    sales = sales_of(spark, (1, "2024-01-01", 3, 1, 4, 10, "1234567.50"))
    row = present("kpi_card", dashboard.kpi_card(sales, accounts, reps)).collect()[0]
    assert row.total_net_revenue == "$1,234,568" and row.overall_margin_pct == "30.0%"
    row = present("customer_ltv", loyalty.customer_ltv(sales, accounts, reps)).collect()[0]
    assert (row.ltv_tier, row.avg_order_value, row.monthly_ltv) == ("💎 Platinum", "$1,234,567.50", None)


def test_a_hot_product_is_split_over_tasks(spark):
    """Two thirds of the sales are of one product: the price join reads its partition in pieces."""
    from caskline.operators.facts import with_price

    sales = spark.range(60_000).repartition(8).select(
        F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id") % 1000).alias("sku_id"),
        (F.col("id") % 40).alias("cases_sold"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )
    products = spark.range(1000).select(
        F.col("id").alias("sku_id"), F.lit(Decimal("1.00")).alias("price_per_case_usd")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = with_price(sales, products).groupBy("sku_id").agg(
            F.count("price_per_case_usd").alias("n"), F.max("note").alias("last")
        )
        counts = {r.sku_id: r.n for r in joined.collect()}
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert counts[7] == 40_000 + 20
    assert "skew=true" in plan


def test_gaps_of_a_hot_account_need_one_row_per_day(spark, accounts, reps):
    """Many sales a day of one account: results as counted by hand from the days."""
    rows = [(i, f"2024-01-{1 + i % 3 * 10:02d}", 3, 1, 1, 0, 1) for i in range(3000)]
    got = loyalty.order_gaps(sales_of(spark, *rows), accounts, reps).collect()
    assert [(r.total_orders, r.total_revenue, r.longest_gap_days, r.avg_days_between_orders) for r in got] == [
        (2999, 2999, 10, 0)
    ]


def test_no_sale_is_lost_to_a_calendar(spark, accounts, reps):
    sales = sales_of(
        spark, (1, "1987-12-31", 1, 1, 1, 0, 100), (2, "2024-03-01", 1, 1, 1, 0, 100), (3, "2093-01-01", 1, 1, 1, 0, 100)
    )
    whole = dashboard.kpi_card(sales, accounts, reps).first().total_net_revenue
    dates = dims.dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31)).withColumn("season", F.lit("own"))
    for calendar in (None, dates):
        months = dashboard.monthly_trend(sales, calendar).collect()
        assert sum(r.net_revenue for r in months) == whole == 300
        assert [r.season == "own" for r in months] == [False, calendar is not None, False]
    assert sum(r.net_revenue for r in dashboard.channel_split(sales, accounts, reps).collect()) == 300


def test_months_without_sales_are_not_skipped(spark):
    days = ["2024-01-10", "2024-02-10", "2024-03-10", "2024-05-10", "2025-01-10", "2025-02-10"]
    rows = [(k, day, 1, 1, 1, 0, 10 * (k + 1)) for k, day in enumerate(days)]
    got = by(dashboard.monthly_trend(sales_of(spark, *rows)), "year_month")
    assert got["2024-05"].prev_month_revenue is None and got["2024-05"].rolling_3mo_avg == 35
    assert got["2025-02"].same_month_prior_year == 20 and got["2025-01"].same_month_prior_year == 10
    assert got["2024-03"].same_month_prior_year is None and got["2024-03"].mom_change == 10


def test_bonus_pools_of_namesakes_stay_apart(spark):
    schema = (
        "rep_id long, supplier_id long, program_id long, quarter string, attainment_pct double, bonus_earned_usd double, "
        "gap_to_goal double, bonus_missed_usd double, status string, status_sort_order int, program_type string, "
        "division string, rep_name string, supplier_name string"
    )
    rows = [
        (1, s, s, "2024-Q1", 90.0, earned, 1.0, 5.0, "At Risk", 2, "t", "d", "R", "Same") for s, earned in ((1, 10.0), (2, 100.0), (1, 20.0))
    ]
    frame = dashboard.bonus_tracker(spark.createDataFrame(rows, schema))
    assert sorted((r.bonus_earned_usd, r.supplier_total_pool) for r in frame.collect()) == [(10, 40), (20, 40), (100, 105)]
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "Scan ExistingRDD" not in plan.replace("LogicalRDD", "")


def test_settings_of_the_user_stay(spark):
    from caskline.session import configure

    threshold, zone = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.session.timeZone"
    own = spark.newSession()
    own.conf.set(threshold, "-1")
    own.conf.set(zone, "Europe/Berlin")
    configure(own)
    assert (own.conf.get(threshold), own.conf.get(zone)) == ("-1", "Europe/Berlin")
    assert own.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
