"""Raw text feeds derived from the test tables, with what raw feeds bring: repeated keys, mixed
spellings, stray spaces, unreadable values and missing values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caskline.functions.measures import to_cents, whole_division
from caskline.sources.schemas import LOADED_AT
from registry.tables import table


def _text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _money_text(column: str) -> Column:
    cents = to_cents(column)
    return F.concat(
        _text(whole_division(cents, F.lit(100))), F.lit("."), F.lpad(_text(cents % 100), 2, "0")
    )


def _day_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def _pick(selector: Column, *choices: str | None) -> Column:
    """Choice number ``selector`` modulo the number of choices."""
    result = F.lit(choices[-1]).cast("string")
    for position in range(len(choices) - 2, -1, -1):
        result = F.when(selector % len(choices) == position, F.lit(choices[position])).otherwise(
            result
        )
    return result


def sales_reps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change feed: every customer row restates its nation's representative."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit(" "), _text("c_nationkey")).alias("rep_id"),
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("rep_name"),
        F.col("c_mktsegment").alias("division"),
        _pick(key, " on-premise ", "OFF-PREMISE", "Online", None).alias("channel"),
        F.when(key % 5 == 0, "not a date")
        .otherwise(_day_text(F.date_add(F.lit("1990-01-01").cast("date"), (key % 9000).cast("int"))))
        .alias("hire_date"),
        F.concat(F.lit(" "), "c_name", F.lit("@EXAMPLE.COM")).alias("email"),
        F.date_add(F.lit("1995-01-01").cast("date"), (key % 200).cast("int")).alias(LOADED_AT),
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line restates its supplier, half of them with a zero before its id."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(
            F.when(F.col("l_linenumber") % 2 == 0, "0").otherwise(""), _text("l_suppkey")
        ).alias("supplier_id"),
        F.concat(F.lit(" Supplier "), _text("l_suppkey"), F.lit(" ")).alias("supplier_name"),
        F.when(F.col("l_returnflag") == "A", " WINE ")
        .when(F.col("l_returnflag") == "N", "wines and spirits")
        .otherwise("spirits")
        .alias("category"),
        F.when(F.col("l_linenumber") % 3 == 0, " USA ").otherwise(F.col("l_linestatus")).alias("country"),
        F.col("l_shipdate").alias(LOADED_AT),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line restates its product, some with unreadable size or price."""
    quantity = F.col("l_quantity").cast("int")
    return table(spark, sf_dir, "lineitem").select(
        _text("l_partkey").alias("sku_id"),
        F.concat(F.lit(" Part "), _text("l_partkey")).alias("product_name"),
        F.concat(F.lit(" "), _text("l_suppkey")).alias("supplier_id"),
        F.col("l_returnflag").alias("category"),
        F.concat("l_linestatus", F.lit(" ")).alias("sub_category"),
        F.when(quantity % 7 == 0, "n/a").otherwise(_text(quantity)).alias("size_ml"),
        F.when(quantity % 11 == 0, "tbd").otherwise(_money_text("l_extendedprice")).alias(
            "price_per_case_usd"
        ),
        F.col("l_shipdate").alias(LOADED_AT),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order restates its customer's account."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(_text("o_custkey"), F.lit(" ")).alias("account_id"),
        F.concat(F.lit("Account "), _text("o_custkey"), F.lit("  ")).alias("account_name"),
        F.col("o_orderpriority").alias("account_type"),
        _pick(key, "On-Premise", " off-premise", "ON-PREMISE ", "Online").alias("channel"),
        F.concat(F.lit("Town "), "o_orderstatus").alias("town"),
        F.lit(" ct ").alias("state"),
        F.concat(F.lit("Division "), "o_orderstatus").alias("division"),
        _text(F.col("o_custkey") % 28).alias("rep_id"),
        _pick(key, "1", "0", None, "2", "true", "  ").alias("active"),
        F.col("o_orderdate").alias(LOADED_AT),
    )


def _line_id() -> Column:
    """Order and line number: not unique in the tables, so it brings repeated keys."""
    return _text(F.col("l_orderkey") * 10 + F.col("l_linenumber"))


def supplier_programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programmes with some unreadable and some reversed date ranges."""
    line, quantity = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    start = F.col("l_shipdate").cast("date")
    return table(spark, sf_dir, "lineitem").select(
        _line_id().alias("program_id"),
        _text("l_suppkey").alias("supplier_id"),
        F.concat(F.lit(" "), F.date_format(start, "yyyy"), F.lit("-Q"), _text(F.quarter(start))).alias(
            "quarter"
        ),
        F.when(quantity % 13 == 0, "soon").otherwise(_day_text(start)).alias("start_date"),
        F.when(quantity % 17 == 0, "later")
        .when(line == 7, _day_text(F.date_sub(start, 10)))
        .otherwise(_day_text(F.date_add(start, quantity)))
        .alias("end_date"),
        F.concat(F.lit(" Type "), "l_returnflag").alias("program_type"),
        F.when(quantity % 5 == 0, None).otherwise(_text(quantity)).alias("goal_value"),
        _money_text("l_extendedprice").alias("bonus_usd"),
        F.col("l_linestatus").alias("division"),
        F.col("l_shipdate").alias(LOADED_AT),
    )


def sales_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales with zero cases, zero and missing revenue, unreadable dates and missing discounts."""
    quantity = F.col("l_quantity").cast("int")
    return table(spark, sf_dir, "lineitem").select(
        _line_id().alias("txn_id"),
        F.when(quantity == 13, "31/12/99").otherwise(_day_text("l_shipdate")).alias("txn_date"),
        _text(F.col("l_orderkey") % 1000).alias("account_id"),
        _text(F.col("l_partkey") % 30).alias("rep_id"),
        F.concat(F.lit(" Division "), "l_linestatus").alias("division"),
        _text("l_partkey").alias("sku_id"),
        _text("l_suppkey").alias("supplier_id"),
        F.when(quantity == 17, "0").otherwise(_text(quantity)).alias("cases_sold"),
        F.when(quantity % 19 == 0, None)
        .otherwise(F.concat(_text(to_cents("l_discount")), F.lit(".00")))
        .alias("discount_pct"),
        F.when(quantity == 23, "0.00")
        .when(quantity == 29, None)
        .otherwise(_money_text("l_extendedprice"))
        .alias("revenue_usd"),
        _pick(F.col("l_partkey"), " on-premise", "OFF-PREMISE ", "Online").alias("channel"),
        F.col("l_shipdate").alias(LOADED_AT),
    )


def rep_quota_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line restates its supplier's figures of the month."""
    quantity = F.col("l_quantity").cast("int")
    return table(spark, sf_dir, "lineitem").select(
        _text("l_suppkey").alias("rep_id"),
        F.concat(F.lit(" Rep "), _text("l_suppkey")).alias("rep_name"),
        F.concat("l_linestatus", F.lit(" ")).alias("division"),
        F.date_format("l_shipdate", "yyyy-MM").alias("month"),
        F.lit("25").alias("quota_cases"),
        _text(quantity).alias("actual_cases"),
        F.when(quantity % 10 == 9, "n/a").otherwise(_text(quantity * 4)).alias("attainment_pct"),
        _money_text("l_extendedprice").alias("quota_revenue_usd"),
        _money_text("l_extendedprice").alias("actual_revenue_usd"),
        F.col("l_shipdate").alias(LOADED_AT),
    )


def program_attainments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results whose stored percentage is sometimes off."""
    quantity = F.col("l_quantity").cast("int")
    return table(spark, sf_dir, "lineitem").select(
        _line_id().alias("attainment_id"),
        _text("l_orderkey").alias("program_id"),
        _text("l_suppkey").alias("supplier_id"),
        F.concat(F.date_format("l_shipdate", "yyyy"), F.lit("-Q1 ")).alias("quarter"),
        _text(F.col("l_partkey") % 25).alias("rep_id"),
        F.concat(F.lit(" Rep "), _text(F.col("l_partkey") % 25)).alias("rep_name"),
        F.col("l_linestatus").alias("division"),
        F.lit(" Volume (cases)").alias("program_type"),
        _text(F.when(quantity % 6 == 0, 0).otherwise(25)).alias("goal_value"),
        _text(quantity).alias("actual_value"),
        _text(quantity * 4 + F.when(F.col("l_linenumber") == 1, 2).otherwise(0)).alias(
            "attainment_pct"
        ),
        _pick(F.col("l_linenumber"), " achieved", "AT RISK", "Behind ", "Unknown").alias("status"),
        _money_text("l_extendedprice").alias("bonus_earned_usd"),
        F.col("l_shipdate").alias(LOADED_AT),
    )


FEEDS = {
    "sales_reps": sales_reps,
    "suppliers": suppliers,
    "products": products,
    "accounts": accounts,
    "supplier_programs": supplier_programs,
    "sales_transactions": sales_transactions,
    "rep_quota_actuals": rep_quota_actuals,
    "program_attainments": program_attainments,
}
