"""Report texts for the analyses that are shown as text: '$' and '%' figures and worded labels.

``present(name, df)`` keeps the columns and their order and changes only how values are shown. The
other dashboard results are shown as plain numbers and need no presentation.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caskline.functions.display import dollars, grouped, percent, with_unit

Shown = Callable[[str], Column]


def usd(digits: int = 0) -> Shown:
    return lambda column: dollars(column, digits)


def pct(digits: int) -> Shown:
    return lambda column: percent(column, digits)


def number(digits: int) -> Shown:
    return lambda column: grouped(column, digits)


def unit(digits: int, text: str) -> Shown:
    return lambda column: with_unit(column, digits, text)


def worded(words: Mapping[str, str]) -> Shown:
    def show(column: str) -> Column:
        result = F.col(column)
        for label, text in words.items():
            result = F.when(F.col(column) == label, F.lit(text)).otherwise(result)
        return result

    return show


# Worded labels of the reports.
LTV_WORDS = {
    "Platinum": "💎 Platinum",
    "Gold": "🥇 Gold",
    "Silver": "🥈 Silver",
    "Bronze": "🥉 Bronze",
}
PARETO_WORDS = {"Top Revenue": "⭐ Top 80% Revenue", "Tail Revenue": "   Tail Revenue"}
RHYTHM_WORDS = {
    "Weekly Buyer": "🟢 Weekly Buyer",
    "Monthly Buyer": "🟡 Monthly Buyer",
    "Occasional": "🟠 Occasional",
    "Infrequent": "🔴 Infrequent — Churn Risk",
}
LEAKAGE_WORDS = {
    "Investigate Now": "🚨 Investigate Now",
    "Monitor Closely": "⚠️  Monitor Closely",
    "Within Policy": "✅ Within Policy",
}
PRIORITY_WORDS = {
    "P1": "🔴 P1 — Immediate Action",
    "P2": "🟢 P2 — Nurture & Grow",
    "P3": "🟡 P3 — Develop",
    "P4": "⚪ P4 — Low-cost Re-engage",
}
WINNER_WORDS = {"Winner": "🏆 Higher Margin Winner", "Comparison": "   Comparison"}


def retention_words(later_year: int) -> dict[str, str]:
    return {
        "Churned": "🔴 CHURNED — Needs Win-Back",
        "New": f"🟢 NEW in {later_year}",
        "Growing": "📈 Growing (+10%)",
        "Declining": "📉 Declining (-10%)",
        "Stable": "➡️  Stable",
    }


def premium_words(cutpoint: object) -> dict[str, str]:
    return {
        "Treatment": f"Treatment: High Premium Mix (≥{cutpoint}%)",
        "Control": f"Control: Low Premium Mix (<{cutpoint}%)",
    }


def formats(
    *, retention_years: tuple[int, int] = (2024, 2025), premium_cutpoint: object = 30
) -> dict[str, dict[str, Shown]]:
    """Per analysis, how each reformatted column is shown."""
    before, after = retention_years
    return {
        "customer_ltv": {
            "lifetime_revenue": usd(),
            "lifetime_margin": usd(),
            "avg_order_value": usd(2),
            "monthly_ltv": usd(),
            "ltv_tier": worded(LTV_WORDS),
        },
        "account_retention": {
            f"revenue_{before}": usd(),
            f"revenue_{after}": usd(),
            "yoy_change": usd(),
            "yoy_growth_pct": pct(1),
            "retention_status": worded(retention_words(after)),
            "at_risk_revenue": usd(),
        },
        "revenue_pareto": {
            "account_revenue": usd(),
            "pct_of_total": pct(2),
            "cumulative_pct": pct(1),
            "pareto_group": worded(PARETO_WORDS),
        },
        "order_gaps": {"total_revenue": usd(), "engagement_health": worded(RHYTHM_WORDS)},
        "discount_leakage": {
            "net_revenue": usd(),
            "total_discounts": usd(),
            "rep_disc_rate": pct(2),
            "company_avg": pct(2),
            "above_avg_by": pct(2),
            "recoverable_revenue": usd(),
            "action": worded(LEAKAGE_WORDS),
        },
        "kpi_card": {
            "total_net_revenue": usd(),
            "total_gross_revenue": usd(),
            "total_discounts": usd(),
            "total_est_margin": usd(),
            "overall_margin_pct": pct(1),
            "overall_discount_rate": pct(1),
            "avg_rev_per_case": usd(2),
        },
        "rfm_segments": {
            "lifetime_revenue": usd(),
            "lifetime_margin": usd(),
            "avg_order_value": usd(2),
            "revenue_at_risk_if_churned": usd(),
        },
        "rfm_summary": {
            "total_revenue": usd(),
            "avg_revenue_per_account": usd(),
            "total_margin": usd(),
            "avg_recency": unit(0, " days"),
            "avg_frequency": unit(1, " orders"),
            "priority": worded(PRIORITY_WORDS),
        },
        "ab_channel": {
            "total_revenue": usd(),
            "avg_order_value": usd(2),
            "stdev_order_value": number(2),
            "avg_rev_per_case": usd(2),
            "total_margin": usd(),
            "avg_margin_pct": pct(1),
            "discount_rate": pct(1),
            "revenue_per_account": usd(),
            "margin_winner": worded(WINNER_WORDS),
        },
        "ab_discount_lift": {
            "avg_discount_applied": pct(1),
            "avg_cases_per_order": usd(2),
            "avg_net_revenue_per_order": usd(2),
            "avg_gross_per_order": usd(2),
            "avg_discount_given": usd(2),
            "avg_rev_per_case": usd(2),
            "avg_margin_per_order": usd(2),
            "total_discounts_given": usd(),
            "case_uplift_vs_no_discount": pct(1),
            "revenue_per_dollar_discounted": usd(2),
        },
        "ab_discount_roi": {
            "full_price_revenue": usd(),
            "discounted_revenue": usd(),
            "total_discounts_given": usd(),
            "revenue_left_on_table": usd(),
            "overall_discount_rate": pct(2),
            "breakeven_uplift_needed": pct(2),
        },
        "ab_premium_mix": {
            "ab_group": worded(premium_words(premium_cutpoint)),
            "avg_premium_mix": pct(1),
            "avg_rep_revenue": usd(),
            "avg_rev_per_case": usd(2),
            "avg_rep_margin": usd(),
            "rev_per_case_lift": usd(2),
            "potential_incremental_revenue": usd(),
        },
    }


def present(name: str, df: DataFrame, **options) -> DataFrame:
    """Show the result of analysis ``name`` as report text."""
    shown = formats(**options)[name]
    return df.select(*[shown[c](c).alias(c) if c in shown else F.col(c) for c in df.columns])
