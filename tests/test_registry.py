"""Every registered query against its SQL, and the shapes of the plans."""

import os

import pytest

from registry.compare import connect, difference
from registry.oracle import oracle_sql
from registry.queries import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
ANALYSES = [k for k in queries() if not k.startswith(("report_", "silver_", "qc_", "dim_", "bronze_", "load_"))]


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(queries()) == set(oracle_sql())


@needs_tables
@pytest.mark.parametrize("key", list(queries()))
def test_equals_sql(spark, connection, key):
    assert difference(spark, connection, SF_DIR, key) is None


@needs_tables
@pytest.mark.parametrize("key", ANALYSES)
def test_plan_has_no_cross_join_and_no_python(spark, key):
    plan = queries()[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"):
        assert forbidden not in plan


@needs_tables
def test_scan_reads_only_what_the_query_needs(spark):
    plan = queries()["revenue_pareto"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "o_totalprice" not in plan.split("== Physical Plan ==")[1]


@needs_tables
def test_lines_are_shuffled_by_order_once(spark):
    """With nothing broadcast, distinct orders are counted on the join's own partitioning."""
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(broadcast)
    from registry.queries import Star
    from pyspark.sql import functions as F

    star = Star(spark, SF_DIR)
    spark.conf.set(broadcast, -1)
    try:
        df = star.sales("txn_date", "account_id").groupBy("account_id").agg(F.count_distinct("txn_id"))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(broadcast, before)
    # lines by order, orders by order, groups by account
    assert plan.count("Exchange hashpartitioning") == 3


@needs_tables
def test_a_range_of_months_reads_only_its_folders(spark, tmp_path):
    from caskline.operators.facts import sales_from_gold
    from caskline.plans.dashboard import monthly_trend
    from caskline.plans.warehouse import SALES_PARTITION, publish_by_month
    from caskline.sources.publish import read_published
    from registry.queries import Star

    publish_by_month(Star(spark, SF_DIR).fact_sales(), str(tmp_path / "fact"))
    fact = read_published(spark, str(tmp_path / "fact")).where(f"{SALES_PARTITION} between '1996-03' and '1996-04'")
    plan = monthly_trend(sales_from_gold(fact))._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({SALES_PARTITION}" in plan and "rep_key" not in plan
    assert {r.year_month for r in monthly_trend(sales_from_gold(fact)).collect()} == {"1996-03", "1996-04"}


@needs_tables
def test_orphans_of_both_kinds_are_found(spark):
    found = {r.check_id for r in queries()["qc_orphans"](spark, SF_DIR).collect()}
    assert found == {"5c", "5d"}


def test_feeds_are_written_compressed_and_only_those_asked_for(spark, tmp_path):
    from types import SimpleNamespace

    from caskline.sources.ingest import ingest
    from caskline.sources.schemas import ENTITIES, LOADED_AT
    from registry.queries import _csv_feeds

    columns = ENTITIES["accounts"].raw_columns
    rows = [(" 7 ", *(f' "{c}" ' for c in columns[1:]), "later"), ("", *(None for _ in columns[1:]), None)]
    feed = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in (*columns, LOADED_AT)))
    star = SimpleNamespace(spark=spark, warehouse=str(tmp_path), raw=lambda name: feed)
    path = _csv_feeds(star, "accounts")["accounts"]
    assert [p.name for p in (tmp_path / "files").iterdir()] == ["accounts"]
    parts = [p.name for p in (tmp_path / "files" / "accounts").glob("part-*")]
    assert parts and all(name.endswith(".csv.gz") for name in parts)
    read = ingest(spark, path, ENTITIES["accounts"]).select(*columns).collect()
    assert ([*rows[0][:-1]]) in [list(r) for r in read]


@needs_tables
def test_sales_stay_narrow_until_they_are_dealt(spark):
    """Keys of the order's header are looked up per order, and no derived column is dealt by month."""
    from registry.queries import Star

    star = Star(spark, SF_DIR)
    dealt = star.fact_sales(by_month=True)
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    before = plan[plan.index("RebalancePartitions"):]
    assert "account_key" in before and "0.3" not in before
    assert not {c for c in ("gross_cents", "margin_cents", "per_case_cents", "discount_cents") if c in before}
    lines = before[: before.index("l_orderkey")]
    assert "c_custkey" not in lines  # the customer stands below the orders, not beside the lines
    own = {tuple(row) for row in star.fact_sales().collect()}
    assert {tuple(row) for row in dealt.collect()} == own and own


def test_keys_the_sales_carry_are_not_looked_up_again(spark):
    import datetime as dt

    from caskline.operators import facts

    sales = spark.createDataFrame(
        [(1, 7, 7, 7, 7, 2, 0.0, 5.0, "x", dt.date(2000, 1, 1), True, 70), (2, 8, 8, 8, 8, 2, 0.0, 5.0, "x", None, True, None)],
        "txn_id bigint, rep_id bigint, account_id bigint, sku_id bigint, supplier_id bigint, cases_sold int, "
        "discount_pct double, revenue_usd double, channel string, txn_date date, is_valid boolean, account_key bigint",
    )
    reps = spark.createDataFrame([(7, 1), (7, 2)], "rep_src_id bigint, rep_key bigint")
    accounts = spark.createDataFrame([], "account_src_id bigint, account_key bigint")
    products = spark.createDataFrame([(7, 3, 4.0)], "sku_src_id bigint, product_key bigint, price_per_case_usd double")
    suppliers = spark.createDataFrame([(8, 4)], "supplier_src_id bigint, supplier_key bigint")
    for by_month in (False, True):
        found = facts.fact_sales(sales, reps, accounts, products, suppliers, by_month=by_month)
        keys = found.select("txn_id", "rep_key", "account_key", "product_key", "supplier_key").collect()
        assert sorted(map(tuple, keys), key=str) == [(1, 1, 70, 3, None), (1, 2, 70, 3, None), (2, None, None, None, 4)]


def test_independent_tables_are_written_side_by_side():
    """Jobs that wait for each other all end: they run at the same time; results keep their order."""
    import threading

    from registry.queries import SIDE_BY_SIDE, side_by_side

    together = threading.Barrier(SIDE_BY_SIDE, timeout=20)
    jobs = [lambda n=n: (together.wait(), n)[1] for n in range(SIDE_BY_SIDE)]
    assert side_by_side(jobs) == list(range(SIDE_BY_SIDE))
    with pytest.raises(ZeroDivisionError):
        side_by_side([lambda: 1, lambda: 1 / 0])


def test_no_more_tables_than_two_shuffle_at_a_time():
    import threading
    import time

    from registry.queries import side_by_side

    lock, running, most = threading.Lock(), [], []

    def job():
        with lock:
            running.append(1)
            most.append(len(running))
        time.sleep(0.05)
        with lock:
            running.pop()

    side_by_side([job] * 8)
    assert max(most) == 2


def test_raw_files_of_a_load_go_once_they_are_loaded(spark, tmp_path):
    from types import SimpleNamespace

    from caskline.sources.publish import read_published
    from caskline.sources.schemas import ENTITIES, LOADED_AT
    from registry.queries import _load_raw

    columns = ENTITIES["accounts"].raw_columns
    feed = spark.createDataFrame([(*columns, None)], ", ".join(f"{c} string" for c in (*columns, LOADED_AT)))
    star = SimpleNamespace(spark=spark, raw=lambda name: feed)
    audit = _load_raw(star, "accounts", str(tmp_path)).collect()
    assert [(r.table_name, r.rows, r.ok) for r in audit] == [("accounts", 1, True)]
    assert read_published(spark, str(tmp_path / "bronze" / "accounts")).first().account_id == "account_id"
    assert not list((tmp_path / "files").glob("*"))
    # A load that fails leaves none either.
    broken = _load_raw(SimpleNamespace(spark=spark, raw=lambda name: feed.drop("town")), "accounts", str(tmp_path)).collect()
    assert broken[0].ok is False and not list((tmp_path / "files").glob("*"))
