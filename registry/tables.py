"""The test tables seen as the eight cleansed entities.

Lines of orders are the sales transactions, customers the accounts, nations the representatives.
Quotas, programmes and attainments do not exist in the tables and are derived from the sales.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caskline.functions.labels import threshold_label
from caskline.functions.measures import dollars_of, from_cents, round_quotient, to_cents, year_quarter
from caskline.operators.facts import with_price
from caskline.operators.cleanse import PERFORMANCE_CUTPOINTS, PERFORMANCE_FLOOR, positive_amounts

PROGRAM_BONUS = "5000.00"


# Declared, so that opening a table starts no job to read file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _money(column: str, digits: int = 12) -> Column:
    return F.col(column).cast(f"decimal({digits},2)")


def _channel_of_segment() -> Column:
    on_premise = F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")
    return F.when(on_premise, "On-Premise").otherwise("Off-Premise")


def sales_reps(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.cast("bigint").alias("rep_id"),
            F.concat(F.lit("Rep "), "n_name").alias("rep_name"),
            F.col("r_name").alias("division"),
            F.when(key % 2 == 0, "On-Premise").otherwise("Off-Premise").alias("channel"),
            F.date_add(F.lit("1990-01-01").cast("date"), key * 100).alias("hire_date"),
            F.lower(F.concat("n_name", F.lit("@example.com"))).alias("email"),
        )
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("s_suppkey") % 3
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            F.when(kind == 0, "Wine")
            .when(kind == 1, "Spirits")
            .otherwise("Wine & Spirits")
            .alias("category"),
            F.when(F.col("r_name") == "AMERICA", "USA").otherwise(F.col("n_name")).alias("country"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sku_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_size").cast("bigint").alias("supplier_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        (F.col("p_size") * 50).alias("size_ml"),
        _money("p_retailprice", 10).alias("price_per_case_usd"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("account_id"),
            F.col("c_name").alias("account_name"),
            F.col("c_mktsegment").alias("account_type"),
            _channel_of_segment().alias("channel"),
            F.col("n_name").alias("town"),
            F.left("r_name", F.lit(2)).alias("state"),
            F.col("r_name").alias("division"),
            F.col("c_nationkey").cast("bigint").alias("rep_id"),
            (F.col("c_acctbal") >= 0).alias("is_active"),
        )
    )


HEADER = ("txn_date", "account_id", "rep_id", "channel")


def sales_transactions(
    spark: SparkSession,
    sf_dir: str,
    header: tuple[str, ...] = HEADER,
    priced: bool = False,
    lookups: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per order line, with the wanted columns of its order's ``header``.

    ``lookups`` holds, for ids, tables of that id and further columns, such as surrogate keys. Those of the
    header's ids are joined to the orders, which are fewer than the lines; those of the lines' ids come
    before the header, while lines are narrow. An id they lack gets NULL.

    Headers are completed at order grain first, so lines are shuffled by order once, whatever the
    header needs from the customer; and a header column nobody asked for costs no join. List prices
    come before the header: lines are then left partitioned by order, and counting orders per
    account needs no further shuffle of the lines. An order always has a date in these tables, so a
    line is judged by its amounts.
    """
    percent_off = F.rint(F.col("l_discount") * 100).cast("int")
    revenue = round_quotient(to_cents("l_extendedprice") * (100 - percent_off), F.lit(100))
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("txn_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("int").alias("cases_sold"),
        percent_off.cast("double").alias("discount_pct"),
        dollars_of(revenue).alias("revenue_usd"),
    )
    if priced:
        prices = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("sku_id"), F.col("p_retailprice").alias("price_per_case_usd")
        )
        lines = with_price(lines, prices)
    for own_id, lookup in (lookups or {}).items():
        if own_id in lines.columns:
            lines = lines.join(lookup, own_id, "left")
    if header:
        orders = table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("txn_id"),
            F.col("o_orderdate").cast("date").alias("txn_date"),
            F.col("o_custkey").alias("account_id"),
        )
        if {"rep_id", "channel"} & set(header):
            customers = table(spark, sf_dir, "customer").select(
                F.col("c_custkey").alias("account_id"),
                F.col("c_nationkey").cast("bigint").alias("rep_id"),
                _channel_of_segment().alias("channel"),
            )
            orders = orders.join(customers, "account_id")
        found = []
        for own_id, lookup in (lookups or {}).items():
            if own_id in header:
                orders = orders.join(lookup, own_id, "left")
                found += [c for c in lookup.columns if c != own_id]
        lines = lines.join(orders.select("txn_id", *header, *found), "txn_id")
    valid = positive_amounts(F.col("revenue_usd"), F.col("cases_sold"))
    return lines.withColumn("is_valid", valid)


def rep_quota_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A representative's quota of every month is the mean of its months.

    The window sees one row per month of a representative.
    """
    sales = sales_transactions(spark, sf_dir, ("txn_date", "rep_id")).filter("is_valid")
    monthly = sales.groupBy(
        "rep_id", F.date_format("txn_date", "yyyy-MM").alias("month_year")
    ).agg(
        F.sum("cases_sold").alias("actual_cases"),
        F.sum(to_cents("revenue_usd")).alias("_revenue"),
    )
    rep = Window.partitionBy("rep_id")
    months = F.count(F.lit(1)).over(rep)
    quota = round_quotient(F.sum("actual_cases").over(rep), months)
    quota_revenue = round_quotient(F.sum("_revenue").over(rep), months)
    attainment = round_quotient(F.col("actual_cases") * 10_000, F.col("quota_cases"))
    names = sales_reps(spark, sf_dir).select("rep_id", "rep_name", "division")
    return (
        monthly.withColumn("quota_cases", quota)
        .withColumn("quota_revenue_usd", from_cents(quota_revenue))
        .withColumn("actual_revenue_usd", from_cents("_revenue"))
        .withColumn("attainment_pct", from_cents(attainment))
        .withColumn(
            "performance_flag",
            threshold_label("attainment_pct", PERFORMANCE_CUTPOINTS, PERFORMANCE_FLOOR),
        )
        .drop("_revenue")
        .join(names, "rep_id")
    )


def _program_id() -> Column:
    """Unique number of a supplier's quarter."""
    quarter = F.substring("quarter", 1, 4).cast("bigint") * 4 + F.substring("quarter", 7, 1).cast("bigint")
    return F.col("supplier_id") * 100_000 + quarter


def quarter_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases per supplier, quarter and representative: what programmes and results derive from."""
    sales = sales_transactions(spark, sf_dir, ("txn_date", "rep_id")).filter("is_valid")
    return (
        sales.groupBy("supplier_id", year_quarter("txn_date").alias("quarter"), "rep_id")
        .agg(F.sum("cases_sold").alias("cases"))
        .withColumn("program_id", _program_id())
    )


def supplier_programs(volumes: DataFrame) -> DataFrame:
    """One programme per supplier and quarter; the goal is the mean of its representatives."""
    goal = from_cents(round_quotient(F.sum("cases") * 100, F.count(F.lit(1))))
    quarter_start = F.make_date(
        F.substring("quarter", 1, 4).cast("int"),
        F.substring("quarter", 7, 1).cast("int") * 3 - 2,
        F.lit(1),
    )
    return volumes.groupBy("supplier_id", "quarter", "program_id").agg(goal.alias("goal_value")).select(
        "program_id",
        "supplier_id",
        "quarter",
        quarter_start.alias("start_date"),
        F.date_sub(F.add_months(quarter_start, 3), 1).alias("end_date"),
        F.lit("Volume (cases)").alias("program_type"),
        "goal_value",
        F.lit(PROGRAM_BONUS).cast("decimal(12,2)").alias("bonus_usd"),
        F.lit("All").alias("division"),
    )


def program_attainments(volumes: DataFrame, reps: DataFrame) -> DataFrame:
    """Every representative's cases of a supplier's quarter against the programme's goal."""
    goals = supplier_programs(volumes).select("program_id", "program_type", "goal_value", "bonus_usd")
    actual = F.col("cases").cast("decimal(12,2)")
    attainment = from_cents(round_quotient(F.col("cases") * 1_000_000, to_cents("goal_value")))
    status = threshold_label("attainment_pct", PERFORMANCE_CUTPOINTS, PERFORMANCE_FLOOR)
    earned = (
        F.when(F.col("status") == "Achieved", F.col("bonus_usd"))
        .when(F.col("status") == "At Risk", (F.col("bonus_usd") / 2).cast("decimal(12,2)"))
        .otherwise(F.lit(0).cast("decimal(12,2)"))
    )
    names = reps.select("rep_id", "rep_name", "division")
    return (
        volumes.join(goals, "program_id")
        .withColumn("attainment_pct", attainment)
        .withColumn("status", status)
        .join(names, "rep_id")
        .select(
            (F.col("program_id") * 1000 + F.col("rep_id")).alias("attainment_id"),
            "program_id",
            "supplier_id",
            "quarter",
            "rep_id",
            "rep_name",
            "division",
            "program_type",
            "goal_value",
            actual.alias("actual_value"),
            "attainment_pct",
            "status",
            earned.alias("bonus_earned_usd"),
        )
    )
