"""Surrogate keys between loads, claimed versions, stated uniqueness, exact moments, and the plans they make."""

import random
import statistics
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from caskline.functions.measures import merge_squares, sample_stdev_dollars, sum_of_squares
from caskline.operators import quality
from caskline.operators.keys import extend_keys, with_keys
from caskline.plans.common import count_of, is_unique, state_unique
from caskline.sources.publish import current_path, prune, publish, read_published
from registry.queries import Star, queries
from tests.test_registry import SF_DIR, needs_tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id bigint")


def test_known_ids_keep_their_keys(spark, tmp_path):
    root = str(tmp_path / "keys")
    first = dict(extend_keys(ids(spark, 30, 10, 20, 10, None), "id", "k", root).collect())
    assert first == {10: 1, 20: 2, 30: 3}
    path = current_path(spark, root)
    # Nothing new, and some ids gone: the map stays, and no version is written.
    assert dict(extend_keys(ids(spark, 20), "id", "k", root).collect()) == first
    assert current_path(spark, root) == path
    second = dict(extend_keys(ids(spark, 5, 25, 20), "id", "k", root).collect())
    assert second == first | {5: 4, 25: 5}
    dim = spark.createDataFrame([(25, "a"), (10, "b"), (None, "c")], "id bigint, name string")
    assert sorted(with_keys(dim, read_published(spark, root), "id", "k").collect(), key=str) == [
        (1, 10, "b"), (5, 25, "a"), (None, None, "c"),
    ]


def test_an_empty_first_load(spark, tmp_path):
    root = str(tmp_path / "keys")
    assert extend_keys(ids(spark), "id", "k", root).count() == 0
    assert dict(extend_keys(ids(spark, 7), "id", "k", root).collect()) == {7: 1}


def test_a_second_build_keeps_all_keys(spark, tmp_path):
    import datetime as dt

    from caskline.plans.warehouse import build_gold
    from caskline.sources.load import load_bronze, load_silver
    from tests.test_sources import FILES, write

    def build(folder, files):
        paths = {name: write(tmp_path / f"{folder}-{name}.csv", text) for name, text in files.items()}
        load_bronze(spark, paths, str(tmp_path / folder / "bronze"), parallel=4)
        load_silver(spark, str(tmp_path / folder / "bronze"), str(tmp_path / folder / "silver"))
        silver = {name: read_published(spark, f"{tmp_path}/{folder}/silver/{name}") for name in files}
        build_gold(spark, silver, str(tmp_path / "gold"), as_of=dt.date(2024, 1, 1))
        sales = read_published(spark, str(tmp_path / "gold" / "fact_sales")).collect()
        products = read_published(spark, str(tmp_path / "gold" / "dim_products")).collect()
        return {r.txn_id: r.product_key for r in sales}, {r.sku_src_id: r.product_key for r in products}

    facts, keys = build("one", FILES)
    header, *rows = FILES["products"].splitlines()
    earlier = rows[0].split(",")
    new = ",".join(["1", *earlier[1:]])
    again, more = build("two", {**FILES, "products": "\n".join([header, new, *rows]) + "\n"})
    assert again == facts and more == keys | {1: max(keys.values()) + 1}


def test_each_number_is_claimed_once(spark, tmp_path):
    root = str(tmp_path / "t")
    with ThreadPoolExecutor(6) as pool:
        paths = list(pool.map(lambda n: publish(spark.range(n + 1), root), range(6)))
    pointers = sorted(p.name for p in (tmp_path / "t").glob("_current=*"))
    numbers = [p.removeprefix("_current=").split("-")[0] for p in pointers]
    assert len(set(numbers)) == 6 and len(set(paths)) == 6
    assert current_path(spark, root).endswith(pointers[-1].split("-", 1)[1])
    assert len(prune(spark, root, keep=1)) == 5 and len(list((tmp_path / "t").glob("_claim=*"))) == 1


def test_uniqueness_is_checked_and_kept(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (None, "b")], "txn_id bigint, g string")
    with pytest.raises(ValueError, match="1 rows repeat"):
        state_unique(rows.union(rows.limit(1)), "txn_id")
    stated = state_unique(rows, "txn_id")
    assert is_unique(stated, "txn_id") and not is_unique(rows, "txn_id")
    publish(stated, str(tmp_path / "t"))
    read = read_published(spark, str(tmp_path / "t"))
    kept = read.where("g <> 'x'").select("g", "txn_id").withColumn("more", F.lit(1)).join(spark.range(1, 5).withColumnRenamed("id", "txn_id"), "txn_id", "left")
    assert is_unique(kept, "txn_id")
    counts = lambda df: sorted(df.groupBy("g").agg(count_of(df, "txn_id").alias("n")).collect())
    assert counts(kept) == counts(rows) == [("a", 2), ("b", 0)]


@needs_tables
@pytest.mark.parametrize("key", ["silver_kpi_card", "silver_monthly_trend"])
def test_unique_sales_are_counted_without_a_shuffle_by_id(spark, monkeypatch, key):
    def exchanges():
        return plan_of(queries()[key](spark, SF_DIR)).count("Exchange hashpartitioning")

    stated = exchanges()
    plain = Star.silver_sales
    monkeypatch.setattr(Star, "silver_sales", lambda self: plain(self).withMetadata("txn_id", {}))
    assert exchanges() == stated + 1


@needs_tables
def test_days_read_their_months_only(spark):
    star = Star(spark, SF_DIR)
    from registry.queries import TREND_DAYS

    sales = star.gold_sales(*TREND_DAYS)
    scanned = sales._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in scanned
    files = sales.select(F.input_file_name().alias("f")).distinct().collect()
    months = {r.f.split("order_month=")[1][:7] for r in files}
    assert months == {"1996-03", "1996-04", "1996-05"}
    days = sales.agg(F.min("order_date"), F.max("order_date")).first()
    assert TREND_DAYS[0] <= days[0] and days[1] <= TREND_DAYS[1]
    assert "order_month" in plan_of(queries()["gold_trend_of_days"](spark, SF_DIR)).split("PartitionFilters: [")[1][:60]


@needs_tables
def test_the_warehouse_is_published_once(spark):
    queries()["gold_monthly_trend"](spark, SF_DIR).collect()
    star = Star(spark, SF_DIR)
    before = current_path(spark, f"{star.warehouse}/gold/fact_sales")
    queries()["gold_channel_split"](spark, SF_DIR).collect()
    assert current_path(spark, f"{star.warehouse}/gold/fact_sales") == before


@needs_tables
@pytest.mark.parametrize("key", ["fact_sales", "fact_quota", "fact_attainment"])
def test_facts_number_nothing(spark, key):
    plan = plan_of(queries()[key](spark, SF_DIR))
    assert "row_number" not in plan and "shufflepartitionidpassthrough" not in plan


@needs_tables
@pytest.mark.parametrize(
    "key, tables", [("qc_nulls", 4), ("qc_ranges", 3), ("qc_counts", 4), ("qc_domains", 4), ("qc_row_counts", 8)]
)
def test_checks_scan_each_published_table_once(spark, key, tables):
    plan = plan_of(queries()[key](spark, SF_DIR))
    assert plan.count("FileScan parquet") == tables and "Window" not in plan and "row_number" not in plan
    if key in ("qc_nulls", "qc_ranges", "qc_counts"):
        assert "Exchange hashpartitioning" not in plan


@needs_tables
def test_tiers_meet_sums_not_sales(spark):
    """In both plans the labels are joined above a finished aggregation of the sales by product."""
    for key in ("ab_premium_mix", "silver_price_tier_mix"):
        plan = queries()[key](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
        (join,) = [k for k, line in enumerate(plan.splitlines()) if "Join Inner, (sku_id" in line and "sku_id" in line.split("=")[1]]
        below = plan.splitlines()[join + 1 :]
        first = next(line for line in below if "Aggregate [" in line)
        assert "sku_id" in first.split("], [")[0]


def moments(df):
    parts = df.groupBy("g", F.pmod(F.xxhash64("x", "i"), F.lit(7))).agg(
        F.count("x").alias("n"), F.sum("x").alias("s"), sum_of_squares("x").alias("q")
    )
    rows = parts.groupBy("g").agg(sample_stdev_dollars(F.sum("n"), F.sum("s"), merge_squares("q")).alias("d"))
    return {r.g: r.d for r in rows.collect()}


def test_moments_are_exact_in_any_order(spark):
    rng = random.Random(9)
    values = {
        "far": [90_000_000_000 + rng.choice([0, 1, 2]) for _ in range(500)],
        "wide": [rng.randrange(-10**9, 10**9) for _ in range(400)],
        "one": [5],
        "same": [123_456_789] * 40,
        "none": [None],
    }
    rows = [(g, x, i) for g, xs in values.items() for i, x in enumerate(xs)]
    frames = []
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        frames.append(moments(spark.createDataFrame(rows, "g string, x bigint, i int").repartition(seed + 2)))
    assert frames[0] == frames[1] == frames[2]
    got = frames[0]
    assert got["one"] is None and got["none"] is None and got["same"] == 0
    for name in ("far", "wide"):
        exact = statistics.variance([Decimal(x) for x in values[name]]).sqrt() / 100
        assert abs(Decimal(got[name]) - exact) <= exact * Decimal("1e-4") if name == "far" else abs(Decimal(got[name]) - exact) < Decimal("1e-6")


def test_keys_never_read_alike(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("NULL", "x"), ("\\NULL", "x"), ("NULLS", "x")]
    table = spark.createDataFrame(rows * 2, "p string, q string")
    found = quality.duplicate_keys({"t": table}, {"2x": ("t", ("p", "q"))}).collect()
    assert sorted(r.key for r in found) == sorted(["a\\|b|c", "a|b\\|c", "NULL|x", "\\NULL|x", "\\\\NULL|x", "NULLS|x"])
    assert all(r.cnt == 2 for r in found)
