"""Reading files, publishing versions, controlling loads."""

import pytest
from pyspark.sql import functions as F

from caskline.sources.ingest import CORRUPT, ingest
from caskline.sources.load import load_all, load_bronze, load_silver
from caskline.sources.publish import current_path, prune, publish, read_published
from caskline.sources.schemas import ENTITIES, LOADED_AT
from caskline.plans.warehouse import build_gold, register_views

SUPPLIERS = ENTITIES["suppliers"]
HEAD = "supplier_id,supplier_name,category,country\n"


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


def test_text_is_kept_as_it_is(spark, tmp_path):
    path = write(tmp_path / "s.csv", HEAD + '1, O"Brien Rosé ,Wine,\n2,b,"x",USA\n', "utf-8-sig")
    df = ingest(spark, path, SUPPLIERS)
    assert dict(df.dtypes)[LOADED_AT] == "timestamp"
    assert {t for c, t in df.dtypes if c != LOADED_AT} == {"string"}
    rows = {r.supplier_id: r for r in df.collect()}
    assert rows["1"].supplier_name == ' O"Brien Rosé '
    assert rows["1"].country is None
    assert rows["2"].category == '"x"'


def test_ragged_line_fails_or_is_kept_aside(spark, tmp_path):
    path = write(tmp_path / "s.csv", HEAD + "1,a,Wine,USA\n2,b\n")
    with pytest.raises(Exception):
        ingest(spark, path, SUPPLIERS).collect()
    kept = ingest(spark, path, SUPPLIERS, malformed="keep").collect()
    assert [r[CORRUPT] for r in kept] == [None, "2,b"]


def test_wrong_header_fails(spark, tmp_path):
    path = write(tmp_path / "s.csv", "id,name,category,country\n1,a,Wine,USA\n")
    with pytest.raises(Exception):
        ingest(spark, path, SUPPLIERS).collect()


def test_reload_replaces_and_a_failed_one_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "table")
    publish(spark.range(3), root)
    first = current_path(spark, root)
    publish(spark.range(5), root)
    assert read_published(spark, root).count() == 5
    assert spark.read.parquet(first).count() == 3
    with pytest.raises(Exception):
        publish(spark.range(4).selectExpr("raise_error('broken') as id"), root)
    assert read_published(spark, root).count() == 5
    publish(spark.range(7), root)
    assert read_published(spark, root).count() == 7


def test_nothing_published(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path / "none"))


def test_failures_are_isolated_or_passed_on(spark, tmp_path):
    builders = {
        "good": lambda: spark.range(3),
        "bad": lambda: spark.range(1).selectExpr("raise_error('broken') as id"),
        "later": lambda: spark.range(2),
    }
    audit = load_all(spark, builders, str(tmp_path / "a"), fail_fast=False, parallel=3)
    rows = {r.table_name: r for r in audit.collect()}
    assert (rows["good"].rows, rows["good"].ok) == (3, True)
    assert rows["bad"].ok is False and "broken" in rows["bad"].error
    assert rows["later"].rows == 2
    with pytest.raises(Exception, match="broken"):
        load_all(spark, builders, str(tmp_path / "b"), fail_fast=True)
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path / "b" / "later"))


FILES = {
    "sales_reps": "rep_id,rep_name,division,channel,hire_date,email\n1,R,North,on-premise,2019-12-31,R@X.COM\n",
    "suppliers": HEAD + "1,S,wine,USA\n2,T,spirits,France\n",
    "products": (
        "sku_id,product_name,supplier_id,category,sub_category,size_ml,price_per_case_usd\n"
        "10,P,1,Wine,Red,750,99.99\n11,Q,2,Spirits,Gin,750,350\n"
    ),
    "accounts": (
        "account_id,account_name,account_type,channel,town,state,division,rep_id,active\n"
        "5,A,Bar,ON-PREMISE,Hartford,ct,North,1,1\n"
    ),
    "supplier_programs": (
        "program_id,supplier_id,quarter,start_date,end_date,program_type,goal_value,bonus_usd,division\n"
        "1,1,2024-Q1,2024-01-01,2024-03-31,Volume,10,100.00,North\n"
    ),
    "sales_transactions": (
        "txn_id,txn_date,account_id,rep_id,division,sku_id,supplier_id,cases_sold,discount_pct,"
        "revenue_usd,channel\n"
        "1,2024-01-31,5,1,North,10,1,3,10,269.97,On-Premise\n"
        "2,2024-02-01,5,1,North,11,2,1,,350,On-Premise\n"
        "3,2024-02-01,5,9,North,11,2,0,,350,On-Premise\n"
        "4,2025-12-31,77,9,North,99,8,2,5.5,10,On-Premise\n"
    ),
    "rep_quota_actuals": (
        "rep_id,rep_name,division,month,quota_cases,actual_cases,attainment_pct,quota_revenue_usd,"
        "actual_revenue_usd\n1,R,North,2024-01,2,3,150,100,269.97\n1,R,North,2024-02,2,1,50,100,350\n"
        "1,R,North,2025-01,2,2,100,100,90\n"
    ),
    "program_attainments": (
        "attainment_id,program_id,supplier_id,quarter,rep_id,rep_name,division,program_type,goal_value,"
        "actual_value,attainment_pct,status,bonus_earned_usd\n"
        "1,1,1,2024-Q1,1,R,North,Volume,10,8,80,at risk,40.00\n"
    ),
}


def test_files_to_star(spark, tmp_path):
    """All three layers from delimited files, once, with the values that come out."""
    import datetime as dt
    from decimal import Decimal

    files = {name: write(tmp_path / f"{name}.csv", text) for name, text in FILES.items()}
    bronze, silver, gold = (str(tmp_path / layer) for layer in ("bronze", "silver", "gold"))
    audit = {r.table_name: r.rows for r in load_bronze(spark, files, bronze, parallel=4).collect()}
    assert audit["sales_transactions"] == 4 and all(audit.values())
    load_silver(spark, bronze, silver)
    tables = {name: read_published(spark, f"{silver}/{name}") for name in FILES}
    built = build_gold(spark, tables, gold, as_of=dt.date(2024, 1, 1))
    counts = {r.table_name: r.rows for r in built.collect()}
    assert counts["dim_date"] == 731 and counts["fact_sales"] == 3

    register_views(spark, gold, "gold", ["fact_sales", "dim_products", "fact_quota"])
    sales = {r.txn_id: r for r in spark.sql("select * from gold_fact_sales").collect()}
    first = sales[1]
    assert first.order_month == "2024-01"
    assert first.revenue_per_case == Decimal("89.99")
    assert first.gross_revenue_usd == Decimal("299.97")
    assert first.discount_usd == Decimal("30.00")
    assert first.estimated_margin_usd == Decimal("80.99")
    assert (first.rep_key, first.account_key, first.product_key) == (1, 1, 1)
    unknown = sales[4]
    assert (unknown.rep_key, unknown.account_key, unknown.product_key, unknown.supplier_key) == (None,) * 4
    assert unknown.gross_revenue_usd == 0
    tiers = {r.sku_src_id: r.price_tier for r in spark.sql("select * from gold_dim_products").collect()}
    assert tiers == {10: "Value", 11: "Ultra-Premium"}
    quota = {r.month_year: r for r in spark.sql("select * from gold_fact_quota").collect()}
    assert [quota[m].ytd_actual_cases for m in ("2024-01", "2024-02", "2025-01")] == [3, 4, 2]
    reps = read_published(spark, f"{gold}/dim_reps").collect()
    assert reps[0].years_tenure == 5
    attained = read_published(spark, f"{gold}/fact_attainment").collect()[0]
    assert (attained.bonus_missed_usd, attained.gap_to_goal, attained.status_sort_order) == (60, 2, 2)


def test_versions_are_unique_and_old_ones_can_be_removed(spark, tmp_path):
    root = str(tmp_path / "t")
    paths = [publish(spark.range(n), root) for n in (1, 2, 3)]
    assert len(set(paths)) == 3 and current_path(spark, root) == paths[-1]
    # A committer that leaves no _SUCCESS marker changes nothing.
    (tmp_path / "t" / paths[-1].rsplit("/", 1)[1] / "_SUCCESS").unlink()
    assert read_published(spark, root).count() == 3
    assert len(prune(spark, root, keep=1)) == 2 and prune(spark, root, keep=1) == []
    assert read_published(spark, root).count() == 3
    with pytest.raises(ValueError):
        prune(spark, root, keep=0)


def test_quoted_values_may_hold_the_delimiter(spark, tmp_path):
    path = tmp_path / "reps.csv"
    path.write_text('rep_id,rep_name,division,channel,hire_date,email\n1,"A, B",x,y,,z\n')
    assert ingest(spark, str(path), ENTITIES["sales_reps"], quote='"').first().rep_name == "A, B"


def test_tasks_read_and_sort_little_at_once(spark, tmp_path):
    """24 MB that do not compress: one split by Spark's own settings."""
    from pyspark.sql import functions as F

    from caskline.session import configure

    path = str(tmp_path / "numbers")
    spark.range(0, 3_000_000, 1, 1).select(F.xxhash64("id").alias("n")).write.parquet(path)
    own = spark.newSession()
    own.conf.set("spark.sql.files.minPartitionNum", 1)
    assert configure(own).read.parquet(path).rdd.getNumPartitions() == 2
    other = spark.newSession()
    other.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "3m")
    assert configure(other).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "3m"
    assert own.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def shuffle_files(spark):
    import os

    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for _, _, files in os.walk(folder) for f in files if f.startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    """Without waiting for the driver to collect garbage; and what was cleaned can be executed again."""
    import time

    own = spark.newSession()
    from caskline.session import configure

    configure(own)
    before = shuffle_files(own)
    sums = own.range(1000).groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("s"))
    publish(sums, str(tmp_path / "t"))
    last = time.monotonic() + 20
    while (left := shuffle_files(own) - before) and time.monotonic() < last:
        time.sleep(0.2)
    assert not left
    assert sorted(sums.collect()) == sorted(sums.collect()) == sorted(read_published(own, str(tmp_path / "t")).collect())


def test_attainments_meet_programmes_before_they_carry_names(spark):
    from caskline.operators.facts import fact_attainment

    entity = dict(ENTITIES["program_attainments"].clean_columns)
    rows = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in entity.items()))
    reps = spark.createDataFrame([], "rep_src_id bigint, rep_key bigint, rep_name string, channel string")
    suppliers = spark.createDataFrame([], "supplier_src_id bigint, supplier_key bigint, supplier_name string, category string")
    programs = spark.createDataFrame([], "program_src_id bigint, program_key bigint, bonus_usd decimal(12,2)")
    facts = fact_attainment(rows, reps, suppliers, programs)
    assert facts.columns[:3] == ["rep_key", "supplier_key", "program_key"]
    joins = [line for line in facts._jdf.queryExecution().analyzed().toString().splitlines() if "Join LeftOuter" in line]
    assert [line.split("(")[1].split("#")[0] for line in joins] == ["rep_id", "supplier_id", "program_id"]
