"""Cleansing rules on hand-written raw rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from caskline.operators.cleanse import CLEANERS, split_supplier_programs
from caskline.operators.dedup import dedup_latest, pack_text, split_rejects, unpack_text
from caskline.sources.schemas import ENTITIES, LOADED_AT, SOURCE

DAY = dt.datetime(2024, 1, 1)


def raw(spark, entity, *rows, loaded=DAY):
    """Rows as dicts of text; columns left out are NULL."""
    columns = ENTITIES[entity].raw_columns
    schema = ", ".join(f"{c} string" for c in columns) + f", {LOADED_AT} timestamp"
    data = [tuple(r.get(c) for c in columns) + (r.get(LOADED_AT, loaded),) for r in rows]
    return spark.createDataFrame(data, schema)


def clean(spark, entity, *rows):
    result = CLEANERS[entity](raw(spark, entity, *rows))
    key = result.columns[0]
    return {row[key]: row for row in result.collect()}


def test_blank_and_missing_ids_are_dropped(spark):
    rows = clean(
        spark,
        "sales_reps",
        {"rep_id": None, "rep_name": "a"},
        {"rep_id": "  ", "rep_name": "b"},
        {"rep_id": " 7 ", "rep_name": " c "},
    )
    assert list(rows) == [7]
    assert rows[7].rep_name == "c"
    assert rows[7][SOURCE] == "bronze.sales_reps"
    assert rows[7][LOADED_AT] is not None


@pytest.mark.parametrize(
    "given, wanted",
    [(" on-premise ", "On-Premise"), ("OFF-PREMISE", "Off-Premise"), (" Online", "Online"), (None, None)],
)
def test_channel_labels(spark, given, wanted):
    assert clean(spark, "accounts", account(channel=given))[1].channel == wanted


def account(**changes):
    base = {"account_id": "1", "account_name": "A", "rep_id": "2", "state": " ct "}
    return base | changes


@pytest.mark.parametrize(
    "given, wanted",
    [("wines and spirits", "Wine & Spirits"), (" wine", "Wine"), ("SPIRITS", "Spirits"), ("Beer ", "Beer")],
)
def test_category_labels(spark, given, wanted):
    assert clean(spark, "suppliers", {"supplier_id": "1", "category": given})[1].category == wanted


@pytest.mark.parametrize(
    "given, wanted",
    [("1", True), ("0", False), (None, False), ("2", True), ("true", True), (" FALSE ", False), ("", False), ("  ", False)],
)
def test_active_flag(spark, given, wanted):
    row = clean(spark, "accounts", account(active=given))[1]
    assert row.is_active is wanted
    assert row.state == "CT"


def test_dates_are_cast_safely_and_emails_lowered(spark):
    row = clean(spark, "sales_reps", {"rep_id": "1", "hire_date": "not a date", "email": " A@B.C "})[1]
    assert row.hire_date is None
    assert row.email == "a@b.c"


def test_bad_ids_stop_the_job(spark):
    with pytest.raises(Exception, match="cannot cast to bigint"):
        clean(spark, "products", {"sku_id": "x1", "supplier_id": "1"})


def test_bad_sizes_and_prices_become_null(spark):
    row = clean(
        spark, "products", {"sku_id": "1", "supplier_id": "1", "size_ml": "n/a", "price_per_case_usd": "tbd"}
    )[1]
    assert row.size_ml is None and row.price_per_case_usd is None


def sale(**changes):
    base = {
        "txn_id": "1", "txn_date": "2024-05-01", "account_id": "1", "rep_id": "1", "sku_id": "1",
        "supplier_id": "1", "cases_sold": "2", "discount_pct": "5", "revenue_usd": "10.00",
    }
    return base | changes


@pytest.mark.parametrize(
    "changes, valid",
    [
        ({}, True),
        ({"revenue_usd": "0"}, False),
        ({"revenue_usd": None}, False),
        ({"revenue_usd": "-1"}, False),
        ({"cases_sold": "0"}, False),
        ({"txn_date": "31/12/2024"}, False),
    ],
)
def test_sale_validity(spark, changes, valid):
    assert clean(spark, "sales_transactions", sale(**changes))[1].is_valid is valid


def test_missing_discount_is_zero(spark):
    assert clean(spark, "sales_transactions", sale(discount_pct=None))[1].discount_pct == Decimal("0.00")


@pytest.mark.parametrize(
    "given, wanted",
    [("100.00", "Achieved"), ("99.99", "At Risk"), ("75.00", "At Risk"), ("74.99", "Behind"), (None, "Behind")],
)
def test_performance_flag(spark, given, wanted):
    row = {"rep_id": "1", "month": "2024-01", "quota_cases": "1", "actual_cases": "1", "attainment_pct": given}
    assert clean(spark, "rep_quota_actuals", row)[1].performance_flag == wanted


def test_status_labels(spark):
    def attainment(i, status):
        return {"attainment_id": i, "program_id": "1", "supplier_id": "1", "rep_id": "1", "status": status}

    rows = clean(
        spark, "program_attainments", attainment("1", " achieved"), attainment("2", "AT RISK"),
        attainment("3", "behind "), attainment("4", "Pending "),
    )
    assert [rows[i].status for i in (1, 2, 3, 4)] == ["Achieved", "At Risk", "Behind", "Pending"]


def test_programs_with_bad_ranges_are_rejected_with_a_reason(spark):
    def program(i, start, end):
        return {"program_id": i, "supplier_id": "1", "start_date": start, "end_date": end}

    good, bad = split_supplier_programs(
        raw(
            spark, "supplier_programs",
            program("1", "2024-01-01", "2024-03-31"), program("2", "2024-04-01", "2024-03-31"),
            program("3", "soon", "2024-03-31"), program("4", "2024-01-01", None),
            program("5", "2024-01-01", "2024-01-01"),
        )
    )
    assert sorted(r.program_id for r in good.collect()) == [1, 5]
    assert {r.program_id: r.reject_reason for r in bad.collect()} == {
        "2": "start_date is after end_date", "3": "start_date is not a date", "4": "end_date is not a date",
    }


def test_every_entity_has_its_declared_columns(spark):
    for name, entity in ENTITIES.items():
        columns = CLEANERS[name](raw(spark, name)).dtypes
        assert columns[:-2] == [(c, t) for c, t in entity.clean_columns]


def test_latest_row_wins_and_ties_are_stable(spark):
    rows = [("k", 1, "old"), ("k", 2, "b"), ("k", 2, "a"), ("k", None, "undated"), ("l", 1, "x")]
    df = spark.createDataFrame(rows, "id string, at int, v string")
    for parts in (1, 5):
        got = dedup_latest(df.repartition(parts), ["id"], "at").collect()
        assert sorted((r.id, r.v) for r in got) == [("k", "a"), ("l", "x")]


def test_dedup_is_idempotent_and_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") % 10).alias("at"), "id")
    once = dedup_latest(df, ["k"], "at")
    assert sorted(dedup_latest(once, ["k"], "at").collect()) == sorted(once.collect())
    plan = once._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:]


def test_packed_texts_order_and_read_as_their_columns(spark):
    values = [None, "", " ", "a", "a b", "\x00", "\x01", "\x02", "a\x00", "a\x01", "\x00\x01", "\x01\x01", "\x01\x02", "é"]
    rows = [(a, b, 1) for a in values for b in values]
    df = spark.createDataFrame(rows, "a string, b string, n int")
    found = df.select("a", "b", pack_text(["a", "b"]).alias("p"))
    found = found.select("a", "b", "p", unpack_text("p", 0).alias("x"), unpack_text("p", 1).alias("y")).collect()
    assert all((r.a, r.b) == (r.x, r.y) for r in found)
    place = lambda r: [(v is not None, (v or "").encode()) for v in (r.a, r.b)]
    assert sorted(found, key=place) == sorted(found, key=lambda r: r.p.encode())


def test_texts_are_shuffled_packed_and_filtered_apart(spark):
    """The shuffle holds one text for all of the tiebreak; a filter above takes no text apart again."""
    base = {"start_date": "2024-01-01", "end_date": "2024-02-01", "supplier_id": "1"}
    rows = raw(
        spark,
        "supplier_programs",
        {"program_id": "1", "quarter": None, "division": "late"} | base,
        {"program_id": "1", "quarter": "", "division": "early"} | base,
        {"program_id": "2", "quarter": "\x01\x00", "division": " \x01 "} | base,
        {"program_id": "2", "quarter": "\x01\x01", "division": "x"} | base,
    )
    good = split_supplier_programs(rows)[0]
    plan = good._jdf.queryExecution().executedPlan().toString()
    shuffled = plan[plan.index("Exchange hashpartitioning(program_id") :]
    assert "_packed" in shuffled and "concat_ws" in shuffled
    assert not [line for line in plan.splitlines() if "Filter" in line and "stringsplitsql" in line]
    assert sorted((r.program_id, r.quarter, r.division) for r in good.collect()) == [(1, None, "late"), (2, "\x01\x00", "\x01")]


def test_a_tiebreak_that_is_not_text_stays_as_it_is(spark):
    df = spark.createDataFrame([(1, 1, 10, "b"), (1, 1, 9, "a"), (1, 1, 9, "A")], "k int, at int, n int, v string")
    assert [tuple(r) for r in dedup_latest(df, ["k"], "at").collect()] == [(1, 1, 9, "A")]
    assert [tuple(r) for r in dedup_latest(df, ["k"], "at", ["v"]).select("k", "v").collect()] == [(1, "A")]


def test_first_failed_rule_names_the_reason(spark):
    df = spark.createDataFrame([(1, 1), (None, -1), (5, None)], "a int, b int")
    good, bad = split_rejects(df, {"a": F.col("a") < 5, "b": F.col("b") > 0})
    assert good.count() == 1
    assert sorted(r.reject_reason for r in bad.collect()) == ["a", "a"]


def test_spellings_of_a_number_are_one_key(spark):
    rows = CLEANERS["suppliers"](
        raw(
            spark,
            "suppliers",
            {"supplier_id": "01", "supplier_name": "old"},
            {"supplier_id": " 1 ", "supplier_name": "new", LOADED_AT: DAY + dt.timedelta(days=1)},
            {"supplier_id": "+2"},
            {"supplier_id": "2"},
        )
    ).collect()
    assert sorted((r.supplier_id, r.supplier_name) for r in rows if r.supplier_id == 1) == [(1, "new")]
    assert [r.supplier_id for r in rows].count(2) == 1


def test_a_key_that_is_no_number_stops_the_load(spark):
    with pytest.raises(Exception, match="cannot cast"):
        CLEANERS["suppliers"](raw(spark, "suppliers", {"supplier_id": "x1"})).collect()


def test_null_parts_show_in_repeated_keys(spark):
    from caskline.operators.quality import duplicate_keys

    rows = [(None, "2024-01"), (None, "2024-01"), (1, None), (1, None)]
    table = spark.createDataFrame(rows, "rep_id long, month_year string")
    got = duplicate_keys({"t": table}, {"2d": ("t", ("rep_id", "month_year"))}).collect()
    assert sorted(r.key for r in got) == ["1|NULL", "NULL|2024-01"]
