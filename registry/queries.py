"""One entry per analysis or operator: (spark, folder of test tables) to a DataFrame."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caskline.functions.measures import from_cents
from caskline.operators import dimensions as dims
from caskline.operators import facts, quality
from caskline.operators.cleanse import CLEANERS, split_supplier_programs
from caskline.operators.global_window import global_running_sum
from caskline.operators.keys import keyed_dimension
from caskline.plans import dashboard, experiments, loyalty, segmentation
from caskline.plans.common import state_unique
from caskline.plans.presentation import formats, present
from caskline.plans.warehouse import build_gold, publish_dealt, read_sales
from caskline.session import configure, ensure_checkpoint_dir, materialise
from caskline.sources.ingest import ingest
from caskline.sources.load import load_bronze, load_silver
from caskline.sources.publish import has_version, publish, read_published
from caskline.sources.schemas import ENTITIES, LOADED_AT, SOURCE
from registry import feeds, tables

# The business values that fit the test tables.
AS_OF = dt.date(2001, 12, 31)
PRICE_TIERS = ((925, "Value"), (950, "Mid-Range"), (975, "Premium"))
LTV_TIERS = ((3_000_000, "Platinum"), (2_000_000, "Gold"), (1_000_000, "Silver"))
REP_STATUS = ((95_000_000, "Top Performer"), (85_000_000, "On Track"))
RETENTION_YEARS = (1999, 2000)
PREMIUM_CUTPOINT = 50
SILVER_TIERS = ((20_000, "Value"), (40_000, "Mid-Range"), (60_000, "Premium"))
TREND_DAYS = (dt.date(1996, 3, 10), dt.date(1996, 5, 20))

#: Folders of the warehouses published so far: one for each application and folder of test tables.
_WAREHOUSES: dict[tuple[str, str], str] = {}

Query = Callable[[SparkSession, str], DataFrame]

#: Independent tables written at a time. Each has its shuffle on disk meanwhile, so no more than it takes to
#: keep cores busy while one's last tasks run.
SIDE_BY_SIDE = 2


def side_by_side(jobs: Sequence[Callable[[], object]]) -> list:
    """The results of independent jobs, in their order; the first failure is raised."""
    with ThreadPoolExecutor(max_workers=SIDE_BY_SIDE) as pool:
        return list(pool.map(lambda job: job(), jobs))


def comparable(df: DataFrame, rounded: Sequence[str] = ()) -> DataFrame:
    """Plain types for comparison: decimals as doubles, whole numbers as 64-bit, flags as 0/1.

    ``rounded`` columns come from sums of doubles or square roots, whose last bits depend on the
    order of the rows.
    """
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.BooleanType)):
            column = column.cast("bigint")
        if field.name in rounded:
            column = F.round(column, 4)
        columns.append(column.alias(field.name))
    return df.select(*columns)


class Star:
    """The star over one folder of test tables; everything is built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    def entity(self, name: str) -> DataFrame:
        if name == "supplier_programs":
            return tables.supplier_programs(self.volumes)
        if name == "program_attainments":
            return tables.program_attainments(self.volumes, self.entity("sales_reps"))
        return getattr(tables, name)(self.spark, self.sf_dir)

    @cached_property
    def volumes(self) -> DataFrame:
        """Written once: programmes and attainments both read it, in several places of a plan."""
        return materialise(tables.quarter_volumes(self.spark, self.sf_dir))

    @cached_property
    def warehouse(self) -> str:
        """The folder that this session publishes the folder's silver and gold tables in, each once."""
        name = (self.spark.sparkContext.applicationId, self.sf_dir)
        if name not in _WAREHOUSES:
            _WAREHOUSES[name] = f"{ensure_checkpoint_dir(self.spark)}/warehouse-{uuid.uuid4().hex}"
        return _WAREHOUSES[name]

    def _published(self, path: str, build: Callable[[], DataFrame], write: Callable = publish) -> DataFrame:
        root = f"{self.warehouse}/{path}"
        if not has_version(self.spark, root):
            write(build(), root)
        return read_published(self.spark, root)

    def silver(self, name: str) -> DataFrame:
        """A cleansed feed as published; its key is unique, and its sales say so."""

        def build() -> DataFrame:
            rows = CLEANERS[name](self.raw(name), loaded_at=F.lit(AS_OF))
            return state_unique(rows, "txn_id", check=False) if name == "sales_transactions" else rows

        return self._published(f"silver/{name}", build)

    def silver_tables(self, *names: str) -> dict[str, DataFrame]:
        """Cleansed feeds, ``SIDE_BY_SIDE`` published at a time: one's last tasks don't leave cores idle."""
        self.warehouse  # one folder for all
        return dict(zip(names, side_by_side([lambda name=name: self.silver(name) for name in names])))

    def silver_sales(self) -> DataFrame:
        return facts.sales_measures(self.silver("sales_transactions"), self.silver("products"))

    def dimension(self, name: str) -> DataFrame:
        """A published dimension, its keys from the map kept beside it."""
        plain = Star(self.spark, self.sf_dir)
        builders = {
            "dim_reps": plain.reps,
            "dim_accounts": plain.accounts,
            "dim_products": plain.products,
            "dim_suppliers": plain.suppliers,
            "dim_programs": plain.programs,
        }
        key, natural = dims.KEYS[name]
        return self._published(
            f"gold/{name}",
            lambda: keyed_dimension(self.spark, builders[name](), natural, key, f"{self.warehouse}/keys/{name}"),
        )

    def gold_sales(self, *days: dt.date) -> DataFrame:
        plain = Star(self.spark, self.sf_dir)
        self._published("gold/fact_sales", lambda: plain.fact_sales(by_month=True), publish_dealt)
        return read_sales(self.spark, f"{self.warehouse}/gold/fact_sales", *days)

    def gold_quota(self) -> DataFrame:
        return self._published("gold/fact_quota", lambda: Star(self.spark, self.sf_dir).fact_quota(keyed=True))

    def gold_attainment(self) -> DataFrame:
        return self._published("gold/fact_attainment", lambda: Star(self.spark, self.sf_dir).fact_attainment(keyed=True))

    def sales(self, *header: str, priced: bool = False) -> DataFrame:
        return facts.sales_measures(
            tables.sales_transactions(self.spark, self.sf_dir, header, priced)
        )

    def reps(self, keyed: bool = False) -> DataFrame:
        return self.dimension("dim_reps") if keyed else dims.dim_reps(self.entity("sales_reps"), as_of=AS_OF, keyed=False)

    def accounts(self, keyed: bool = False) -> DataFrame:
        return self.dimension("dim_accounts") if keyed else dims.dim_accounts(self.entity("accounts"), keyed=False)

    def products(self, keyed: bool = False) -> DataFrame:
        return self.dimension("dim_products") if keyed else dims.dim_products(self.entity("products"), tiers=PRICE_TIERS, keyed=False)

    def suppliers(self, keyed: bool = False) -> DataFrame:
        return self.dimension("dim_suppliers") if keyed else dims.dim_suppliers(self.entity("suppliers"), keyed=False)

    def programs(self, keyed: bool = False) -> DataFrame:
        return self.dimension("dim_programs") if keyed else dims.dim_programs(self.entity("supplier_programs"), keyed=False)

    def fact_sales(self, by_month: bool = False) -> DataFrame:
        """Representatives and accounts belong to the order, so their keys are looked up there."""
        reps, accounts, products = self.reps(keyed=True), self.accounts(keyed=True), self.products(keyed=True)
        lookups = {
            "sku_id": facts.price_lookup(products),
            "rep_id": facts.key_lookup(reps, "rep_id"),
            "account_id": facts.key_lookup(accounts, "account_id"),
        }
        return facts.fact_sales(
            tables.sales_transactions(self.spark, self.sf_dir, lookups=lookups),
            reps,
            accounts,
            products,
            self.suppliers(keyed=True),
            loaded_at=F.lit(AS_OF),
            by_month=by_month,
        )

    def fact_attainment(self, keyed: bool = False) -> DataFrame:
        return facts.fact_attainment(
            self.entity("program_attainments"),
            self.reps(keyed),
            self.suppliers(keyed),
            self.programs(keyed),
            loaded_at=F.lit(AS_OF),
        )

    def fact_quota(self, keyed: bool = False) -> DataFrame:
        return facts.fact_quota(self.entity("rep_quota_actuals"), self.reps(keyed), loaded_at=F.lit(AS_OF))

    def raw(self, name: str) -> DataFrame:
        return feeds.FEEDS[name](self.spark, self.sf_dir)

    def cleansed(self, name: str) -> DataFrame:
        return CLEANERS[name](self.raw(name), loaded_at=F.lit(AS_OF)).drop(LOADED_AT, SOURCE)


class GoldStar(Star):
    """The star as published: sales, quotas and attainments are read from the gold facts.

    ``ids`` names the dimensions whose natural ids an analysis needs beside its header.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, ids: Sequence[str] = ()):
        super().__init__(spark, sf_dir)
        self.ids = ids

    def reps(self, keyed: bool = True) -> DataFrame:
        return self.dimension("dim_reps")

    def accounts(self, keyed: bool = True) -> DataFrame:
        return self.dimension("dim_accounts")

    def products(self, keyed: bool = True) -> DataFrame:
        return self.dimension("dim_products")

    def suppliers(self, keyed: bool = True) -> DataFrame:
        return self.dimension("dim_suppliers")

    def sales(self, *header: str, priced: bool = False) -> DataFrame:
        return facts.sales_from_gold(
            self.gold_sales(),
            self.reps() if "rep_id" in header else None,
            self.accounts() if "account_id" in header else None,
            self.products() if "dim_products" in self.ids else None,
            self.suppliers() if "dim_suppliers" in self.ids else None,
        )

    def entity(self, name: str) -> DataFrame:
        """Quotas under the representative's own id."""
        if name != "rep_quota_actuals":
            return super().entity(name)
        ids = self.reps().select("rep_key", F.col("rep_src_id").alias("rep_id"))
        return self.gold_quota().join(ids, "rep_key", "left")

    def fact_attainment(self, keyed: bool = True) -> DataFrame:
        return self.gold_attainment()


#: Analyses that need more ids than their header says.
_IDS = {
    "supplier_mix": ("dim_suppliers",),
    "price_tier_mix": ("dim_products",),
    "ab_premium_mix": ("dim_products",),
}


def _on_gold(name: str, build: Callable[[Star], DataFrame], rounded: Sequence[str] = ()) -> Query:
    return lambda spark, sf_dir: comparable(build(GoldStar(spark, sf_dir, _IDS.get(name, ()))), rounded)


def _on_star(build: Callable[[Star], DataFrame], rounded: Sequence[str] = ()) -> Query:
    return lambda spark, sf_dir: comparable(build(Star(spark, sf_dir)), rounded)


def _rejected_programs(star: Star) -> DataFrame:
    rejected = split_supplier_programs(star.raw("supplier_programs"))[1]
    return rejected.select("program_id", "start_date", "end_date", "reject_reason")


def _row_counts(star: Star) -> DataFrame:
    """The published dimensions and facts, counted."""
    return quality.row_counts(
        {
            **{name: star.dimension(name) for name in dims.KEYS},
            "dim_date": dims.dim_date_covering(tables.table(star.spark, star.sf_dir, "orders"), "o_orderdate"),
            "fact_sales": star.gold_sales(),
            "fact_quota": star.gold_quota(),
            "fact_attainment": star.gold_attainment(),
        }
    )


def _invalid_sales(star: Star) -> DataFrame:
    check = quality.validity_checks()[0]
    rows = quality.failing_rows(star.silver_tables("sales_transactions"), check)
    return rows.select("txn_id", "txn_date", "cases_sold", "revenue_usd", "is_valid").orderBy("txn_id")


def _orphans(star: Star) -> DataFrame:
    reps = star.silver("sales_reps").select("rep_id")
    sales = quality.orphan_keys(star.silver("sales_transactions"), reps, ["rep_id"])
    accounts = quality.orphan_keys(star.silver("accounts"), reps, ["rep_id", "account_name"])
    return sales.select(
        F.lit("5c").alias("check_id"), "rep_id", F.lit(None).cast("string").alias("account_name")
    ).unionByName(accounts.select(F.lit("5d").alias("check_id"), "rep_id", "account_name"))


def _csv(feed: DataFrame, folder: str, name: str) -> str:
    """Write a raw feed as headed, compressed delimited files and return their path."""
    path = f"{folder}/{name}"
    writer = feed.drop(LOADED_AT).write.option("header", True).option("quote", "").option("compression", "gzip")
    for side in ("Leading", "Trailing"):
        writer = writer.option(f"ignore{side}WhiteSpace", False)
    writer.csv(path)
    return path


def _new_folder(star: Star, label: str) -> str:
    return f"{ensure_checkpoint_dir(star.spark)}/{label}-{uuid.uuid4().hex}"


def _csv_feeds(star: Star, *names: str) -> dict[str, str]:
    """The named raw feeds as delimited files, each written once."""
    paths = {name: f"{star.warehouse}/files/{name}" for name in names}
    for name, path in paths.items():
        root = star.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if not root.getFileSystem(star.spark._jsc.hadoopConfiguration()).exists(root):
            _csv(star.raw(name), f"{star.warehouse}/files", name)
    return paths


def _ingested(star: Star) -> DataFrame:
    return ingest(star.spark, _csv_feeds(star, "accounts")["accounts"], ENTITIES["accounts"]).drop(LOADED_AT)


def _remove(star: Star, path: str) -> None:
    folder = star.spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(star.spark._jsc.hadoopConfiguration()).delete(folder, True)


def _load_raw(star: Star, name: str, root: str) -> DataFrame:
    """Load an entity's delimited files, which are written for this load and removed after it."""
    path = _csv(star.raw(name), f"{root}/files", name)
    try:
        return load_bronze(star.spark, {name: path}, f"{root}/bronze")
    finally:
        _remove(star, path)


def _load_audit(star: Star) -> DataFrame:
    """All eight entities from delimited files to raw and cleansed tables, then the nine gold tables."""
    root = _new_folder(star, "load")
    loads = side_by_side([lambda name=name: _load_raw(star, name, root) for name in ENTITIES])
    bronze = reduce(DataFrame.unionByName, loads)
    silver = load_silver(star.spark, f"{root}/bronze", f"{root}/silver")
    cleansed = {name: read_published(star.spark, f"{root}/silver/{name}") for name in ENTITIES}
    gold = build_gold(star.spark, cleansed, f"{root}/gold", as_of=AS_OF, tiers=PRICE_TIERS)
    layers = (("bronze", bronze), ("silver", silver), ("gold", gold))
    audit = [rows.withColumn("layer", F.lit(layer)) for layer, rows in layers]
    return reduce(DataFrame.unionByName, audit).select("layer", "table_name", "rows", "ok")


def _load_isolated(star: Star) -> DataFrame:
    """A raw load in which one file is missing and one lacks a column: the others are loaded all the same."""
    root = _new_folder(star, "load")
    broken = {
        "products": f"{root}/no-such-file",
        "suppliers": _csv(star.raw("suppliers").drop("country"), root, "suppliers"),
    }
    whole = _csv_feeds(star, *(name for name in ENTITIES if name not in broken))
    files = {name: (broken | whole)[name] for name in ENTITIES}
    audit = load_bronze(star.spark, files, f"{root}/bronze", parallel=4)
    seen = {name: has_version(star.spark, f"{root}/bronze/{name}") for name in ENTITIES}
    counts = quality.row_counts(
        {name: read_published(star.spark, f"{root}/bronze/{name}") for name, there in seen.items() if there}
    )
    stamped = star.spark.createDataFrame(
        [(n, _raw_stamps(read_published(star.spark, f"{root}/bronze/{n}"))) for n, there in seen.items() if there],
        "table_name string, one_stamp boolean",
    )
    return (
        audit.join(counts, "table_name", "left")
        .join(stamped, "table_name", "left")
        .select("table_name", "rows", "ok", F.col("error").isNotNull().alias("failed"), "row_count", "one_stamp")
    )


def _raw_stamps(rows: DataFrame) -> bool:
    """Whether every row has a load stamp and all rows of the load the same."""
    found = rows.agg(F.count_distinct(LOADED_AT).alias("stamps"), F.count_if(F.col(LOADED_AT).isNull()).alias("without"))
    return tuple(found.first()) == (1, 0)


#: Entities of the load that fails, in load order, and the table it fails at.
FAILING, FAILS_AT = ("sales_reps", "suppliers", "products", "accounts"), "products"


def _load_fail_fast(star: Star) -> DataFrame:
    """A load whose third table has an id that is no number: it stops there and raises.

    The tables before it are the new ones (here those of even id), it and those after it the old ones.
    """
    root = _new_folder(star, "load")
    feeds_of = {}
    for name in FAILING:
        raw = feeds_of[f"{root}/old/{name}"] = star.raw(name)
        key = ENTITIES[name].key[0]
        even = raw.where(F.trim(key).cast("bigint") % 2 == 0)
        feeds_of[f"{root}/new/{name}"] = even.withColumn(key, F.lit("none")) if name == FAILS_AT else even
    side_by_side([lambda path=path, rows=rows: publish(rows, path) for path, rows in feeds_of.items()])
    load_silver(star.spark, f"{root}/old", f"{root}/silver", FAILING)
    try:
        load_silver(star.spark, f"{root}/new", f"{root}/silver", FAILING)
        raised = False
    except Exception as problem:  # noqa: BLE001  whatever Spark raises for a cast
        raised = "none" in str(problem)
    counts = quality.row_counts({name: read_published(star.spark, f"{root}/silver/{name}") for name in FAILING})
    return counts.withColumn("raised", F.lit(raised))


def _silver_stamps(star: Star) -> DataFrame:
    """The audit columns of the cleansed tables: where rows come from and when they were loaded."""
    per_table = [
        rows.agg(
            F.lit(name).alias("table_name"),
            F.min(SOURCE).alias("first_source"),
            F.max(SOURCE).alias("last_source"),
            F.min(LOADED_AT).cast("date").alias("first_load"),
            F.max(LOADED_AT).cast("date").alias("last_load"),
            F.count(LOADED_AT).alias("stamped"),
        )
        for name, rows in star.silver_tables(*ENTITIES).items()
    ]
    return reduce(DataFrame.unionByName, per_table)


def _all_checks() -> list[quality.Check]:
    limits = (dt.date(1996, 1, 1), dt.date(2000, 12, 31), dt.date(2010, 1, 1))
    return [*quality.null_checks(), *quality.range_checks(*limits), *quality.validity_checks()]


def _running_revenue(star: Star) -> DataFrame:
    """Order lines folded to products, accumulated from the best-selling product down."""
    revenue = star.sales().groupBy("sku_id").agg(
        from_cents(F.sum("revenue_cents")).alias("revenue_usd")
    )
    return global_running_sum(
        revenue,
        "revenue_usd",
        [("revenue_usd", "desc"), ("sku_id", "asc")],
        name="running_revenue",
        rank=("revenue_rank", ["revenue_usd"]),
    )


def queries() -> dict[str, Query]:
    full = ("txn_date", "account_id", "rep_id", "channel")
    analyses: dict[str, tuple] = {
        # Customer loyalty
        "customer_ltv": (
            lambda s: loyalty.customer_ltv(
                s.sales("txn_date", "account_id", "rep_id"), s.accounts(), s.reps(), tiers=LTV_TIERS
            )
        ,),
        "account_retention": (
            lambda s: loyalty.account_retention(
                s.sales("txn_date", "account_id", "rep_id"),
                s.accounts(),
                s.reps(),
                years=RETENTION_YEARS,
            )
        ,),
        "revenue_pareto": (
            lambda s: loyalty.revenue_pareto(s.sales("account_id"), s.accounts())
        ,),
        "order_gaps": (
            lambda s: loyalty.order_gaps(
                s.sales("txn_date", "account_id", "rep_id"), s.accounts(), s.reps()
            )
        ,),
        "discount_leakage": (
            lambda s: loyalty.discount_leakage(s.sales("rep_id", priced=True), s.reps()),
            ["rep_disc_rate", "company_avg", "above_avg_by", "recoverable_revenue"],
        ),
        # Dashboard
        "kpi_card": (
            lambda s: dashboard.kpi_card(
                s.sales("txn_date", "account_id", "rep_id", priced=True), s.accounts(), s.reps()
            )
        ,),
        "monthly_trend": (
            lambda s: dashboard.monthly_trend(s.sales("txn_date", priced=True))
        ,),
        "rep_scorecard": (
            lambda s: dashboard.rep_scorecard(
                s.sales("txn_date", "account_id", "rep_id", priced=True),
                s.accounts(),
                s.reps(),
                s.entity("rep_quota_actuals"),
                levels=REP_STATUS,
            )
        ,),
        "supplier_mix": (
            lambda s: dashboard.supplier_mix(s.sales(priced=True), s.suppliers())
        ,),
        "channel_split": (
            lambda s: dashboard.channel_split(s.sales(*full), s.accounts(), s.reps())
        ,),
        "bonus_tracker": (lambda s: dashboard.bonus_tracker(s.fact_attainment()),),
        "price_tier_mix": (
            lambda s: dashboard.price_tier_mix(
                s.sales("txn_date", "channel"), s.products()
            )
        ,),
        "geo_density": (
            lambda s: dashboard.geo_density(s.sales("account_id"), s.accounts()),
            ["pct_of_division_avg"],
        ),
        # Segmentation
        "rfm_segments": (
            lambda s: segmentation.rfm_segments(
                s.sales("txn_date", "account_id", "rep_id"), s.accounts(), s.reps(), anchor=AS_OF
            )
        ,),
        "rfm_summary": (
            lambda s: segmentation.rfm_summary(
                s.sales("txn_date", "account_id"), s.accounts(), anchor=AS_OF
            )
        ,),
        # Comparisons
        "ab_channel": (
            lambda s: experiments.ab_channel(
                s.sales("account_id", "channel", priced=True), s.accounts()
            ),
        ),
        "ab_discount_lift": (
            lambda s: experiments.ab_discount_lift(s.sales(priced=True)),
        ),
        "ab_discount_roi": (
            lambda s: experiments.ab_discount_roi(s.sales(priced=True)),
        ),
        "ab_premium_mix": (
            lambda s: experiments.ab_premium_mix(
                s.sales("rep_id"), s.reps(), s.products(), cutpoint=PREMIUM_CUTPOINT
            ),
            [
                "avg_premium_mix",
                "avg_rev_per_case",
                "rev_per_case_lift",
                "potential_incremental_revenue",
            ],
        ),
    }
    registry: dict[str, Query] = {name: _on_star(*analysis) for name, analysis in analyses.items()}
    # The same analyses of the published gold tables
    registry |= {f"gold_{name}": _on_gold(name, *analysis) for name, analysis in analyses.items()}
    registry |= {
        # Dimensions and facts
        "dim_reps": _on_star(lambda s: s.reps(keyed=True)),
        "dim_accounts": _on_star(lambda s: s.accounts(keyed=True)),
        "dim_products": _on_star(lambda s: s.products(keyed=True)),
        "dim_suppliers": _on_star(lambda s: s.suppliers(keyed=True)),
        "dim_programs": _on_star(lambda s: s.programs(keyed=True)),
        "dim_date": _on_star(
            lambda s: dims.dim_date_covering(tables.table(s.spark, s.sf_dir, "orders"), "o_orderdate")
        ),
        "fact_sales": _on_star(lambda s: s.fact_sales()),
        "fact_quota": _on_star(lambda s: s.fact_quota(keyed=True)),
        "fact_attainment": _on_star(lambda s: s.fact_attainment(keyed=True)),
        "row_count_summary": _on_star(_row_counts),
        "quota_by_attainment": _on_star(
            lambda s: s.fact_quota().orderBy(
                F.desc("attainment_pct"), "rep_id", "month_year"
            )
        ),
        "attainment_behind": _on_star(lambda s: s.fact_attainment().filter("status = 'Behind'")),
        # A range of days of the published sales
        "gold_trend_of_days": _on_star(
            lambda s: dashboard.monthly_trend(facts.sales_from_gold(s.gold_sales(*TREND_DAYS)))
        ),
        # Analyses of the published cleansed sales, whose ids are unique: counts without a shuffle by id
        "silver_kpi_card": _on_star(
            lambda s: dashboard.kpi_card(
                s.silver_sales(),
                dims.dim_accounts(s.silver("accounts"), keyed=False),
                dims.dim_reps(s.silver("sales_reps"), as_of=AS_OF, keyed=False),
            )
        ),
        "silver_monthly_trend": _on_star(lambda s: dashboard.monthly_trend(s.silver_sales())),
        "silver_price_tier_mix": _on_star(
            lambda s: dashboard.price_tier_mix(
                s.silver_sales(), dims.dim_products(s.silver("products"), tiers=SILVER_TIERS, keyed=False)
            )
        ),
        # Global window operator
        "global_running_sum": _on_star(_running_revenue),
        # Cleansing
        "silver_reps": _on_star(lambda s: s.cleansed("sales_reps")),
        "silver_suppliers": _on_star(lambda s: s.cleansed("suppliers")),
        "silver_products": _on_star(lambda s: s.cleansed("products")),
        "silver_accounts": _on_star(lambda s: s.cleansed("accounts")),
        "silver_programs": _on_star(lambda s: s.cleansed("supplier_programs")),
        "silver_programs_rejected": _on_star(_rejected_programs),
        "silver_transactions": _on_star(lambda s: s.cleansed("sales_transactions")),
        "silver_quota": _on_star(lambda s: s.cleansed("rep_quota_actuals")),
        "silver_attainments": _on_star(lambda s: s.cleansed("program_attainments")),
        # Quality checks
        "qc_nulls": _on_star(
            lambda s: quality.run_checks(
                s.silver_tables("sales_reps", "sales_transactions", "products", "supplier_programs"),
                quality.null_checks(),
            )
        ),
        "qc_ranges": _on_star(
            lambda s: quality.run_checks(
                s.silver_tables("sales_reps", "sales_transactions", "supplier_programs"),
                quality.range_checks(dt.date(1996, 1, 1), dt.date(2000, 12, 31), dt.date(2010, 1, 1)),
            )
        ),
        "qc_counts": _on_star(lambda s: quality.run_checks(s.silver_tables(*ENTITIES), _all_checks())),
        "qc_domains": _on_star(
            lambda s: quality.label_counts(
                s.silver_tables("accounts", "suppliers", "rep_quota_actuals", "program_attainments"),
                quality.LABEL_COLUMNS,
            )
        ),
        "qc_duplicates": _on_star(
            lambda s: quality.duplicate_keys(
                {
                    "sales_reps": s.raw("sales_reps"),
                    "sales_transactions": s.raw("sales_transactions"),
                    "products": s.raw("products"),
                    "rep_quota_actuals": s.raw("rep_quota_actuals").withColumnRenamed(
                        "month", "month_year"
                    ),
                },
                quality.UNIQUE_KEYS,
            )
        ),
        "qc_invalid_sales": _on_star(_invalid_sales),
        "qc_pct_gap": _on_star(lambda s: quality.attainment_gaps(s.silver("program_attainments"))),
        "qc_orphans": _on_star(_orphans),
        "qc_row_counts": _on_star(lambda s: quality.row_counts(s.silver_tables(*ENTITIES))),
    }
    registry |= {
        # Raw files and load control
        "bronze_accounts": _on_star(_ingested),
        "load_audit": _on_star(_load_audit),
        "load_isolated": _on_star(_load_isolated),
        "load_fail_fast": _on_star(_load_fail_fast),
        "silver_stamps": _on_star(_silver_stamps),
    }
    # Report texts of the analyses that are shown as text
    for name in formats(retention_years=RETENTION_YEARS):
        registry[f"report_{name}"] = _report(name, registry[name])
    return registry


def _report(name: str, query: Query) -> Query:
    return lambda spark, sf_dir: present(
        name,
        query(spark, sf_dir),
        retention_years=RETENTION_YEARS,
        premium_cutpoint=PREMIUM_CUTPOINT,
    )
