"""Global windows equal Spark's own one-task windows, also when ties span slices."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from caskline.operators.global_window import (
    global_ntile,
    global_rank,
    global_row_number,
    global_running_sum,
    ntile_by_cuts,
    slice_columns,
)

def native():
    return Window.orderBy(F.desc("value"), F.asc("id"))


@pytest.fixture(scope="module")
def rows(spark):
    numbers = random.Random(7)
    # A third of the rows share one value; some values are missing.
    values = [
        500 if i % 3 == 0 else (None if i % 50 == 1 else numbers.randrange(1000))
        for i in range(6000)
    ]
    return spark.createDataFrame(
        [(i, v) for i, v in enumerate(values)], "id bigint, value bigint"
    ).repartition(5)


def same(got, want):
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


ORDER = [("value", "desc"), ("id", "asc")]


def sortable(df):
    return df.withColumn("value", F.coalesce("value", F.lit(-1)))


@pytest.mark.parametrize("slices", [1, 3, 16, None])
def test_row_number(rows, slices):
    want = rows.withColumn("n", F.row_number().over(native()))
    same(sortable(global_row_number(rows, ORDER, "n", slices)), sortable(want))


@pytest.mark.parametrize("slices", [3, 16])
@pytest.mark.parametrize("k", [1, 4, 7])
def test_ntile(rows, k, slices):
    want = rows.withColumn("n", F.ntile(k).over(native()))
    same(sortable(global_ntile(rows, k, ORDER, "n", slices)), sortable(want))


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 9])
def test_ntile_of_few_rows(spark, count):
    few = spark.range(count).withColumn("value", F.col("id"))
    want = few.withColumn("n", F.ntile(4).over(Window.orderBy("value")))
    same(global_ntile(few, 4, [("value", "asc")], "n", 3), want)


@pytest.mark.parametrize("slices", [1, 3, 16, 40])
def test_rank_with_a_tie_over_many_slices(rows, slices):
    want = rows.withColumn("n", F.rank().over(Window.orderBy(F.desc("value"))))
    got = global_rank(rows, [("value", "desc")], [("id", "asc")], "n", slices)
    same(sortable(got), sortable(want))


@pytest.mark.parametrize("slices", [1, 3, 16])
def test_running_sum_total_and_rank(rows, slices):
    upto = native().rowsBetween(Window.unboundedPreceding, 0)
    want = rows.select(
        "id",
        "value",
        F.sum("value").over(upto).alias("running"),
        F.sum("value").over(Window.partitionBy()).alias("total"),
        F.rank().over(Window.orderBy(F.desc("value"))).alias("rank"),
    )
    got = global_running_sum(
        rows, "value", ORDER, "running", total="total", rank=("rank", ["value"]), slices=slices
    )
    same(sortable(got), sortable(want))


@pytest.mark.parametrize("slices", [1, 5, None])
@pytest.mark.parametrize("k", [1, 4, 7])
def test_ntile_of_several_orders(rows, k, slices):
    orders = {"up": [("value", "asc"), ("id", "asc")], "down": ORDER, "by_id": [("id", "desc")]}
    want = rows.select(
        "id",
        "value",
        F.ntile(k).over(Window.orderBy(F.asc("value"), F.asc("id"))).alias("up"),
        F.ntile(k).over(native()).alias("down"),
        F.ntile(k).over(Window.orderBy(F.desc("id"))).alias("by_id"),
    )
    got = ntile_by_cuts(rows, k, orders, slices=slices)
    same(sortable(got), sortable(want))
    assert "Exchange" not in plan_of(got.coalesce(1)).replace(plan_of(rows.coalesce(1)), "").split("Exchange RoundRobin")[0]


@pytest.mark.parametrize("kind", ["string", "decimal(12,2)", "double", "date"])
def test_orders_of_other_types(rows, kind):
    cast = {"date": "date_add(date'2020-01-01', cast(value as int))"}.get(kind, f"cast(value as {kind})")
    typed = rows.selectExpr("id", f"{cast} as value")
    want = typed.select("id", F.ntile(5).over(native()).alias("t"), F.row_number().over(native()).alias("n"))
    got = global_row_number(global_ntile(typed, 5, ORDER, "t", 6), ORDER, "n", 6).select("id", "t", "n")
    same(got, want)


def test_slices_are_even_and_the_same_on_every_run(rows):
    (number,) = slice_columns(rows, [ORDER], 8)
    (again,) = slice_columns(rows.repartition(3), [ORDER], 8)
    sizes = [r["count"] for r in rows.groupBy(number.alias("s")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * len(rows.collect()) / 8
    assert rows.where(number != again).isEmpty()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_shuffled_once_and_written_numbered(spark, rows, monkeypatch):
    """The numbered rows come from one exchange, by slice; what is joined is one row per slice."""
    from caskline.operators import global_window as g

    written = []

    def keep(df, label):
        written.append(plan_of(df))
        return stage(df, label)

    stage = g.stage
    monkeypatch.setattr(g, "stage", keep)
    table = spark.createDataFrame(rows.collect(), rows.schema)
    result = global_running_sum(table, "value", ORDER, "running", total="total", rank=("rank", ["value"]))
    (inside,) = written
    assert inside.count("Exchange") == 1 and "Exchange shufflepartitionidpassthrough" in inside and inside.count("Sort [") == 1
    after = plan_of(result)
    # The rows that are read back go straight into the join; only partial counts per slice are moved.
    rows_side = after[after.index("BroadcastHashJoin"):].split("BroadcastExchange")[0]
    assert "Exchange" not in rows_side and "Scan parquet" in rows_side and "ExistingRDD" not in after


def test_empty_input(spark):
    empty = spark.createDataFrame([], "id bigint, value bigint")
    assert global_row_number(empty, ORDER).count() == 0
    assert global_rank(empty, [("value", "desc")]).count() == 0
    assert ntile_by_cuts(empty, 4, {"t": ORDER}).count() == 0
    assert global_running_sum(empty, "value", ORDER, rank=("r", ["value"])).count() == 0
