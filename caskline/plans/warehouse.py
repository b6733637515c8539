"""The gold layer as published tables.

The facts and dimensions can be read as views at any time. When many analyses read them, publishing
them once saves every reader the surrogate keys and lookups. Sales are partitioned by month, so that
date ranges prune whole folders.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caskline.operators import dimensions as dims
from caskline.operators import facts
from caskline.operators.keys import keyed_dimension
from caskline.sources.load import load_all
from caskline.sources.publish import publish, read_published

SALES_PARTITION = "order_month"


def publish_by_month(sales: DataFrame, root: str, *, dealt: bool = False) -> str:
    """Publish sales in monthly folders with files of even size.

    The rebalance lets Spark split a large month over several files and join small ones, so that a
    month that holds most of the sales is not written by one task. ``dealt`` says that the rows come
    so already (``fact_sales`` with ``by_month``).
    """
    monthly = sales.withColumn(SALES_PARTITION, F.date_format("order_date", "yyyy-MM"))
    if not dealt:
        monthly = monthly.hint("rebalance", F.col(SALES_PARTITION))
    return publish(monthly, root, partition_by=[SALES_PARTITION])


def publish_dealt(sales: DataFrame, root: str) -> str:
    """``publish_by_month`` of rows that are dealt by month already."""
    return publish_by_month(sales, root, dealt=True)


def read_sales(
    spark: SparkSession, root: str, first_day: dt.date | None = None, last_day: dt.date | None = None
) -> DataFrame:
    """The published sales of a range of days, both included; only the folders of its months are read."""
    sales = read_published(spark, root)
    for day, inside in ((first_day, ">="), (last_day, "<=")):
        if day is not None:
            sales = sales.where(f"{SALES_PARTITION} {inside} '{day:%Y-%m}' and order_date {inside} date'{day}'")
    return sales


def build_gold(
    spark: SparkSession,
    silver: Mapping[str, DataFrame],
    out: str,
    *,
    as_of: dt.date,
    first_day: dt.date | None = None,
    last_day: dt.date | None = None,
    tiers: Sequence[tuple[object, str]] = dims.PRICE_TIERS,
    margin_rate: Decimal = facts.MARGIN_RATE,
) -> DataFrame:
    """Publish six dimensions and three facts under ``out``; one audit row per table.

    Dimensions come first, and the facts look their keys up in the published ones, so that keys
    agree between all tables of a build. Keys come from maps kept under ``out``/keys, so a later build
    gives every id the key it had. The calendar holds all years with sales, unless both its days are given.
    """

    def gold(name: str) -> DataFrame:
        return read_published(spark, f"{out}/{name}")

    def keyed(name: str, dim: DataFrame) -> DataFrame:
        key, natural = dims.KEYS[name]
        return keyed_dimension(spark, dim, natural, key, f"{out}/keys/{name}")

    audit = load_all(
        spark,
        {
            "dim_reps": lambda: keyed(
                "dim_reps", dims.dim_reps(silver["sales_reps"], as_of=as_of, keyed=False)
            ),
            "dim_accounts": lambda: keyed(
                "dim_accounts", dims.dim_accounts(silver["accounts"], keyed=False)
            ),
            "dim_products": lambda: keyed(
                "dim_products", dims.dim_products(silver["products"], tiers=tiers, keyed=False)
            ),
            "dim_suppliers": lambda: keyed(
                "dim_suppliers", dims.dim_suppliers(silver["suppliers"], keyed=False)
            ),
            "dim_programs": lambda: keyed(
                "dim_programs", dims.dim_programs(silver["supplier_programs"], keyed=False)
            ),
            "dim_date": lambda: (
                dims.dim_date(spark, first_day, last_day)
                if first_day and last_day
                else dims.dim_date_covering(silver["sales_transactions"], "txn_date")
            ),
            "fact_sales": lambda: facts.fact_sales(
                silver["sales_transactions"],
                gold("dim_reps"),
                gold("dim_accounts"),
                gold("dim_products"),
                gold("dim_suppliers"),
                margin_rate=margin_rate,
                by_month=True,
            ),
            "fact_quota": lambda: facts.fact_quota(silver["rep_quota_actuals"], gold("dim_reps")),
            "fact_attainment": lambda: facts.fact_attainment(
                silver["program_attainments"],
                gold("dim_reps"),
                gold("dim_suppliers"),
                gold("dim_programs"),
            ),
        },
        out,
        fail_fast=True,
        writers={"fact_sales": publish_dealt},
    )
    return audit


def register_views(spark: SparkSession, root: str, layer: str, names: Sequence[str]) -> None:
    """Offer published tables to SQL users as ``<layer>_<name>``."""
    for name in names:
        read_published(spark, f"{root}/{name}").createOrReplaceTempView(f"{layer}_{name}")
