"""Recency, frequency and monetary segmentation of accounts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caskline.functions.labels import rank_of_label
from caskline.functions.measures import dollars_of, from_cents, mean_dollars, ratio
from caskline.operators.global_window import ntile_by_cuts
from caskline.plans.common import count_of, lookup
from caskline.session import stage

# Anchor date, segments, their risk factors, priorities and playbooks.
ANCHOR = dt.date(2025, 12, 31)
CHAMPIONS = "Champions"
LOYAL = "Loyal Customers"
AT_RISK = "At Risk"
CANNOT_LOSE = "Cannot Lose Them"
POTENTIAL = "Potential Loyalists"
HIBERNATING = "Hibernating"
SEGMENT_ORDER = (CANNOT_LOSE, AT_RISK, CHAMPIONS, LOYAL, POTENTIAL)
RISK_FACTORS = {
    CHAMPIONS: Decimal("0.5"),
    LOYAL: Decimal("0.4"),
    AT_RISK: Decimal("0.6"),
    CANNOT_LOSE: Decimal("0.7"),
}
PRIORITIES = {
    CANNOT_LOSE: "P1",
    AT_RISK: "P1",
    CHAMPIONS: "P2",
    LOYAL: "P2",
    POTENTIAL: "P3",
}
LOWEST_PRIORITY = "P4"
PLAYBOOKS = {
    CHAMPIONS: "Reward + upsell premium SKUs. Request referrals. Invite to tasting events.",
    LOYAL: "Offer exclusive supplier programs. Increase visit frequency to weekly.",
    AT_RISK: "URGENT: Call this week. Find out why orders dropped. Offer incentive deal.",
    CANNOT_LOSE: "Personal VP visit required. Major revenue exposure if churned.",
    POTENTIAL: "Introduce to new products. Increase order frequency with targeted promotions.",
    HIBERNATING: "Low-cost re-engagement: email campaign + new product sample.",
}


def _by_label(label: str, values: dict, otherwise: Column) -> Column:
    result = otherwise
    for key, value in reversed(values.items()):
        result = F.when(F.col(label) == key, F.lit(value)).otherwise(result)
    return result


def segment_of(r: str = "r_score", f: str = "f_score", m: str = "m_score") -> Column:
    """Segment of three scores. The order of the rules matters: the 'At Risk' rule is shadowed by
    the 'Loyal Customers' rule before it and never applies."""
    r_score, f_score, m_score = F.col(r), F.col(f), F.col(m)
    strong = (f_score >= 3) & (m_score >= 3)
    return (
        F.when((r_score == 4) & strong, CHAMPIONS)
        .when(strong, LOYAL)
        .when((r_score <= 2) & strong, AT_RISK)
        .when((r_score <= 2) & (m_score == 4), CANNOT_LOSE)
        .when((r_score >= 3) & (f_score <= 2), POTENTIAL)
        .otherwise(HIBERNATING)
    )


def score_rfm(
    base: DataFrame,
    ids: Sequence[str],
    *,
    best_is_high: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Add r_score, f_score, m_score (quartiles 1-4), ties told apart by ``ids``.

    By default quartile 1 holds the most recent, most frequent and highest-spending accounts;
    ``best_is_high=True`` numbers the quartiles the other way round. ``base`` (ids and measures, a row per
    account) is written once, since the cuts are searched in several passes over its order columns.
    """
    up, down = ("desc", "asc") if best_is_high else ("asc", "desc")
    unique = [(c, "asc") for c in ids]
    orders = {
        "r_score": [("recency_days", up), *unique],
        "f_score": [("frequency", down), *unique],
        "m_score": [("monetary", down), *unique],
    }
    return ntile_by_cuts(stage(base, "rfm"), 4, orders, slices=slices)


def _base(sales: DataFrame, ids: Sequence[str], anchor: dt.date) -> DataFrame:
    return (
        sales.groupBy(*ids)
        .agg(
            F.max("order_date").alias("_last"),
            count_of(sales, "txn_id").alias("frequency"),
            F.sum("revenue_cents").alias("monetary"),
            F.sum("margin_cents").alias("total_margin"),
            F.count("revenue_cents").alias("_lines"),
        )
        .withColumn("recency_days", F.datediff(F.lit(anchor), "_last"))
        .drop("_last")
    )


def rfm_segments(
    sales: DataFrame,
    accounts: DataFrame,
    reps: DataFrame,
    *,
    anchor: dt.date = ANCHOR,
    best_is_high: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Accounts (per representative) with scores, segment, playbook and revenue at risk."""
    ids = ["account_id", "rep_id"]
    base = (
        _base(sales, ids, anchor)
        .join(lookup(accounts, "account_src_id", "account_id"), "account_id")
        .join(lookup(reps, "rep_src_id", "rep_id"), "rep_id")
    )
    scored = score_rfm(base, ids, best_is_high=best_is_high, slices=slices)
    named = (
        scored.join(
            lookup(
                accounts, "account_src_id", "account_id",
                "account_name", "account_type", "channel", "town", "division",
            ),
            "account_id",
        )
        .join(lookup(reps, "rep_src_id", "rep_id", "rep_name"), "rep_id")
        .withColumn("segment", segment_of())
        .orderBy(rank_of_label("segment", SEGMENT_ORDER), F.desc("monetary"), *ids)
    )
    code = F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")])
    factor = _by_label("segment", RISK_FACTORS, F.lit(Decimal("0.0")))
    return named.select(
        "account_name",
        "account_type",
        "channel",
        "town",
        "division",
        "rep_name",
        "recency_days",
        "frequency",
        from_cents("monetary").alias("lifetime_revenue"),
        from_cents("total_margin").alias("lifetime_margin"),
        ratio(dollars_of("monetary"), "_lines").alias("avg_order_value"),
        code.alias("rfm_code"),
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_total"),
        "segment",
        "r_score",
        "f_score",
        "m_score",
        _by_label("segment", PLAYBOOKS, F.lit(None).cast("string")).alias("action_playbook"),
        (from_cents("monetary") * factor).alias("revenue_at_risk_if_churned"),
    )


def rfm_summary(
    sales: DataFrame,
    accounts: DataFrame,
    *,
    anchor: dt.date = ANCHOR,
    best_is_high: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Segments with their size, revenue, margin, mean recency and frequency, and priority."""
    base = _base(sales, ["account_id"], anchor).join(
        lookup(accounts, "account_src_id", "account_id"), "account_id"
    )
    scored = score_rfm(base, ["account_id"], best_is_high=best_is_high, slices=slices)
    return (
        scored.groupBy(segment_of().alias("segment"))
        .agg(
            F.count(F.lit(1)).alias("account_count"),
            from_cents(F.sum("monetary")).alias("total_revenue"),
            mean_dollars("monetary").alias("avg_revenue_per_account"),
            from_cents(F.sum("total_margin")).alias("total_margin"),
            ratio(F.sum("recency_days"), F.count("recency_days")).alias("avg_recency"),
            ratio(F.sum("frequency"), F.count("frequency")).alias("avg_frequency"),
        )
        .withColumn("priority", _by_label("segment", PRIORITIES, F.lit(LOWEST_PRIORITY)))
        .orderBy(F.desc("total_revenue"), "segment")
    )
