"""Row numbers, NTILE, RANK and running totals over a whole table, without a one-task window.

A window with no PARTITION BY moves every row into one task. Here the order is cut into slices first: the
rows whose order columns hash lowest are a sample that is the same on every run, and every few of them,
in order, end a slice. A row's slice is then a function of the row alone, so slices can be computed
anywhere, again and again, and always agree.

Numbering sends each row to its slice's partition, numbers it there with an ordinary window (which
needs no second shuffle, since that partition holds the whole slice) and writes the numbered rows as
Parquet. The counts and sums per slice are a table of one row per slice; its prefix sums are all that
is joined to turn slice-local numbers into table-wide ones.

NTILE over several orders needs even less (``ntile_by_cuts``): the first rows of the tiles are found by
counting rows per slice and sorting only the slices that hold one, and each row is then compared with
these few cut rows.

Ties: the order must be made unique by ``tiebreak`` for everything except RANK. A value shared by
very many rows spreads over several slices, because slices are cut on value and tie-break together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from caskline.session import stage

Order = Sequence[tuple[str, str]]

#: Slices at most, and rows of the sample for each.
MOST_SLICES, SAMPLED = 512, 16


def _sort_columns(order: Order) -> list[Column]:
    return [F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in order]


def _key(order: Order) -> Column:
    return F.struct(*[F.col(c) for c, _ in order])


def _not_after(left: Column, right: Column, order: Order) -> Column:
    """Whether key ``left`` stands before ``right`` in the order, or equals it. NULL is the smallest value."""
    result = F.lit(True)
    for column, way in reversed(order):
        a, b = left.getField(column), right.getField(column)
        small, large = (a, b) if way == "asc" else (b, a)
        before = large.isNotNull() & (small.isNull() | F.coalesce(small < large, F.lit(False)))
        result = before | (a.eqNullSafe(b) & result)
    return result


def _literal(df: DataFrame, rows: Sequence[Row], order: Order) -> Column:
    types = {c: df.schema[c].dataType for c, _ in order}
    return F.array(
        *[F.struct(*[F.lit(row[c]).cast(types[c]).alias(c) for c, _ in order]) for row in rows]
    )


def _slice_of(df: DataFrame, bounds: Sequence[Row], order: Order) -> Column:
    """The number of bounds that don't come after the row, by binary search."""
    if not bounds:
        return F.lit(0)
    held, key = _literal(df, bounds, order), _key(order)
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(bounds)) & _not_after(F.get(held, at + step - 1), key, order), at + step
        ).otherwise(at),
    )


def _wanted_slices(df: DataFrame, slices: int | None) -> int:
    return max(1, min(slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_SLICES))


def slice_columns(df: DataFrame, orders: Sequence[Order], slices: int | None = None) -> list[Column]:
    """For each order a column with the number of the row's slice, from one sample of the rows.

    The sample holds SAMPLED rows per slice, MOST_SLICES slices at most, and is all that reaches the driver.
    """
    wanted = _wanted_slices(df, slices)
    columns = list(dict.fromkeys(c for order in orders for c, _ in order))
    lowest = F.xxhash64(*columns)
    sample = df.select(*columns).orderBy(lowest, *columns).limit(wanted * SAMPLED)

    def sorted_keys(order: Order) -> Column:
        def compare(a: Column, b: Column) -> Column:
            return F.when(a.eqNullSafe(b), 0).when(_not_after(a, b, order), -1).otherwise(1)

        return F.array_sort(F.collect_list(_key(order)), compare)

    keys = sample.agg(*[sorted_keys(order).alias(f"k{n}") for n, order in enumerate(orders)]).first()
    result = []
    for rows, order in zip(keys, orders):
        bounds = [rows[len(rows) * n // wanted] for n in range(1, wanted)] if rows else []
        result.append(_slice_of(df, bounds, order))
    return result


def _numbered(
    df: DataFrame, order: Order, slices: int | None, extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """Every row with its slice, its position in it and ``extra`` window values, written once.

    ``extra`` maps names to functions that are evaluated over the slice in order.
    """
    (number,) = slice_columns(df, [order], slices)
    dealt = df.withColumn("_slice", number).repartitionById(_wanted_slices(df, slices), F.col("_slice"))
    in_order = Window.partitionBy("_slice").orderBy(*_sort_columns(order))
    values = {"_position": F.row_number().over(in_order) - 1}
    for name, value in (extra or {}).items():
        values[name] = value(in_order)
    return stage(dealt.withColumns(values), "slices")


def _slice_offsets(
    sliced: DataFrame, summed: str | None = None, ranked: Sequence[str] = ()
) -> DataFrame:
    """One row per slice: rows (and sum) before it and in total. As small as the slice count.

    With ``ranked`` also the slice's first value and how many rows of the table come before it.
    """
    wanted = [F.count(F.lit(1)).alias("_rows")]
    if summed:
        wanted.append(F.sum(summed).alias("_sum"))
    if ranked:
        wanted.append(F.min_by(_value(ranked), "_position").alias("_first"))
        wanted.append(F.max_by(_value(ranked), "_position").alias("_last"))
        wanted.append(F.max("_tie_start").alias("_last_start"))
    stats = sliced.groupBy("_slice").agg(*wanted)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = {
        "_rows_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)),
        "_rows_total": F.sum("_rows").over(everything),
    }
    if summed:
        offsets["_sum_before"] = F.sum("_sum").over(before)
        offsets["_sum_total"] = F.sum("_sum").over(everything)
    table = stats.withColumns(offsets)
    return _with_first_before(table) if ranked else table


def _attach(sliced: DataFrame, offsets: DataFrame) -> DataFrame:
    # Bounded: one row per slice, and there are at most MOST_SLICES.
    return sliced.join(F.broadcast(offsets), "_slice")


def global_row_number(
    df: DataFrame, order: Order, name: str = "row_number", slices: int | None = None
) -> DataFrame:
    """``row_number() over (order by ...)``; ``order`` must be unique."""
    sliced = _numbered(df, order, slices)
    numbered = _attach(sliced, _slice_offsets(sliced))
    number = F.col("_rows_before") + F.col("_position") + 1
    return numbered.select(*df.columns, number.alias(name))


def global_ntile(
    df: DataFrame, k: int, order: Order, name: str = "ntile", slices: int | None = None
) -> DataFrame:
    """``ntile(k) over (order by ...)``; ``order`` must be unique."""
    return ntile_by_cuts(df, k, {name: order}, slices=slices)


def _tile_cuts(
    df: DataFrame, k: int, orders: Mapping[str, Order], slices: int | None
) -> dict[str, list[Row]]:
    """For each order the first rows (their order columns) of tiles 2 to k; fewer if tiles are empty."""
    names = list(orders)
    numbers = slice_columns(df, list(orders.values()), slices)
    each = F.explode(
        F.array(*[F.struct(F.lit(n).alias("which"), number.alias("slice")) for n, number in enumerate(numbers)])
    )
    counts = df.select(each.alias("at")).groupBy("at.which", "at.slice").count()
    rows_of: dict[int, dict[int, int]] = {}
    for row in counts.collect():  # one row per order and slice
        rows_of.setdefault(row["which"], {})[row["slice"]] = row["count"]
    cuts: dict[str, list[Row]] = {}
    for n, name in enumerate(names):
        held = rows_of.get(n, {})
        total, before, wanted = sum(held.values()), 0, {}
        starts = [j * (total // k) + min(j, total % k) for j in range(1, k)]
        for number in sorted(held):
            inside = [s - before for s in starts if before <= s < before + held[number] and s < total]
            if inside:
                wanted[number] = sorted(set(inside))
            before += held[number]
        cuts[name] = _rows_at(df, numbers[n], orders[name], wanted)
    return cuts


def _rows_at(df: DataFrame, number: Column, order: Order, wanted: Mapping[int, Sequence[int]]) -> list[Row]:
    """The rows at the given positions of the given slices; only these slices are sorted."""
    if not wanted:
        return []
    in_order = Window.partitionBy("_slice").orderBy(*_sort_columns(order))
    placed = reduce(
        Column.__or__,
        [(F.col("_slice") == s) & (F.col("_position") - 1).isin(list(at)) for s, at in wanted.items()],
    )
    return (
        df.select(*[c for c, _ in order], number.alias("_slice"))
        .where(F.col("_slice").isin(list(wanted)))
        .withColumn("_position", F.row_number().over(in_order))
        .where(placed)
        .orderBy("_slice", "_position")
        .collect()
    )


def ntile_by_cuts(
    df: DataFrame, k: int, orders: Mapping[str, Order], *, slices: int | None = None
) -> DataFrame:
    """Add ``ntile(k) over (order by ...)`` for every name in ``orders``; each order must be unique.

    Three passes over the order columns find the k - 1 cut rows of all orders: a sample, a count per
    slice (summed in the tasks), and the sort of those slices that hold a cut. What reaches the
    driver are the sample, the counts and the cuts. The result is ``df`` with a comparison per order:
    no sort, no shuffle, no join. ``df`` is read four times, so it should be a table.
    """
    cuts = _tile_cuts(df, k, orders, slices)
    tiles = {}
    for name, order in orders.items():
        found = _slice_of(df, cuts[name], order)
        tiles[name] = (found + 1).cast("int")
    return df.withColumns(tiles)


def global_running_sum(
    df: DataFrame,
    value: str,
    order: Order,
    name: str = "running_sum",
    total: str | None = None,
    rank: tuple[str, Sequence[str]] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """``sum(value) over (order by ... rows unbounded preceding)``; ``order`` must be unique.

    ``total`` also adds the sum over the whole table, ``rank=(name, columns)`` the RANK over the
    leading ``columns`` of the order, from the same sorted slices.
    """
    local = {
        "_upto": lambda w: F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)),
    }
    if rank:
        local["_tie_start"] = _tie_start(order, rank[1])
    sliced = _numbered(df, order, slices, local)
    offsets = _slice_offsets(sliced, value, rank[1] if rank else ())
    extra = []
    if total:
        extra.append(F.col("_sum_total").alias(total))
    if rank:
        rank_name, rank_columns = rank
        extra.append(_rank_column(rank_columns).alias(rank_name))
    running = F.when(F.col("_sum_before").isNull(), F.col("_upto")).otherwise(
        F.col("_sum_before") + F.coalesce(F.col("_upto"), F.lit(0))
    )
    result_type = sliced.schema["_upto"].dataType
    return _attach(sliced, offsets).select(
        *df.columns, running.cast(result_type).alias(name), *extra
    )


def global_rank(
    df: DataFrame,
    order: Order,
    tiebreak: Order = (),
    name: str = "rank",
    slices: int | None = None,
) -> DataFrame:
    """``rank() over (order by ...)``: equal values share a rank, gaps follow.

    ``tiebreak`` only spreads ties over slices; it does not change the result.
    """
    columns = [c for c, _ in order]
    whole = [*order, *tiebreak]
    sliced = _numbered(df, whole, slices, {"_tie_start": _tie_start(whole, columns)})
    offsets = _slice_offsets(sliced, ranked=columns)
    return _attach(sliced, offsets).select(*df.columns, _rank_column(columns).alias(name))


def _value(columns: Sequence[str]) -> Column:
    return F.struct(*columns)


def _tie_start(order: Order, columns: Sequence[str]):
    """The slice position of the first row with the same value: the rank by the leading columns, from 0."""
    leading = _sort_columns([(c, way) for c, way in order if c in columns])
    by_value = Window.partitionBy("_slice").orderBy(*leading)
    return lambda _: F.rank().over(by_value) - 1


def _with_first_before(offsets: DataFrame) -> DataFrame:
    """Add ``_first_before``: rows of the table before the slice's first value.

    That value may already end the slice before, and fill whole slices before that one.
    """
    by_slice = Window.orderBy("_slice")
    last_before = F.min(F.col("_rows_before") + F.col("_last_start")).over(
        Window.partitionBy("_last")
    )
    continues = F.lag("_last").over(by_slice).eqNullSafe(F.col("_first"))
    return offsets.withColumn("_last_before", last_before).withColumn(
        "_first_before",
        F.when(
            continues & F.lag("_last").over(by_slice).isNotNull(),
            F.lag("_last_before").over(by_slice),
        ).otherwise(F.col("_rows_before")),
    )


def _rank_column(columns: Sequence[str]) -> Column:
    local = F.col("_rows_before") + F.col("_tie_start")
    opening = _value(columns).eqNullSafe(F.col("_first"))
    return F.when(opening, F.col("_first_before")).otherwise(local) + 1
