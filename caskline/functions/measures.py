"""Ratios, means and calendar arithmetic."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from caskline.functions.labels import as_column


def to_cents(amount: Column | str) -> Column:
    """Whole cents of an amount with two decimals.

    Sums and products of cents are 64-bit arithmetic in generated code; the same on decimals
    allocates an object per operation and row. The conversion is exact below 90 trillion.
    """
    return F.rint(as_column(amount).cast("double") * 100).cast("bigint")


def from_cents(cents: Column | str) -> Column:
    """Exact decimal amount, for results."""
    return (as_column(cents).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(20,2)")


def dollars_of(cents: Column | str) -> Column:
    """Amount as a double, for ratios."""
    return as_column(cents).cast("double") / 100


def round_quotient(numerator: Column, denominator: Column) -> Column:
    """Whole-number quotient rounded half away from zero; ``denominator`` is positive or NULL."""
    twice = F.abs(numerator) * 2 + denominator
    size = whole_division(twice, denominator * 2)
    return F.when(numerator < 0, -size).otherwise(size)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator as a double, NULL when the denominator is zero."""
    below = as_column(denominator).cast("double")
    return as_column(numerator).cast("double") / F.nullif(below, F.lit(0.0))


def percentage(numerator: Column | str, denominator: Column | str) -> Column:
    return ratio(numerator, denominator) * 100


def mean_of(value: Column | str) -> Column:
    """Aggregate: exact sum divided by the count of non-null values, as a double."""
    measured = as_column(value)
    return ratio(F.sum(measured), F.count(measured))


def mean_dollars(cents: Column | str) -> Column:
    """Aggregate: mean of a cents column, in dollars."""
    return ratio(dollars_of(F.sum(as_column(cents))), F.count(as_column(cents)))


def money_percentage(numerator: Column | str, denominator: Column | str) -> Column:
    """Share of one cents amount in another, in percent."""
    return percentage(dollars_of(numerator), dollars_of(denominator))


def sum_of_squares(cents: Column | str) -> Column:
    """Aggregate: sum of squared whole numbers, exact."""
    whole = as_column(cents).cast("decimal(18,0)")
    return F.sum((whole * whole).cast("decimal(38,0)"))


def merge_squares(squares: Column | str) -> Column:
    """Aggregate: joins the sums of squares of disjoint groups; like counts and sums, they add up."""
    return F.sum(as_column(squares)).cast("decimal(38,0)")


def sample_stdev_dollars(count: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation, in dollars, of cents with these moments; NULL for fewer than two values.

    Moments of whole numbers are whole numbers, so groups are merged by addition in any order with the
    same result, and n * squares - total ** 2, the spread of all pairs, loses nothing where the mean is
    large and the spread small. The variance is cut to four decimals of a squared cent. Products beyond
    38 digits raise.
    """
    n, s = count.cast("decimal(18,0)"), total.cast("decimal(19,0)")
    pairs = (n * (n - 1)).cast("decimal(38,0)")
    spread = ((n * squares).cast("decimal(38,0)") - (s * s).cast("decimal(38,0)")).cast("decimal(38,0)")
    scaled = (spread * F.lit(Decimal(10_000))).cast("decimal(38,0)")
    whole = ((scaled - scaled % pairs).cast("decimal(38,0)") / pairs).cast("double")
    return F.when(count > 1, F.sqrt(whole) / 10_000)


def whole_division(numerator: Column, denominator: Column) -> Column:
    """Integer quotient, rounded towards zero."""
    return F.call_function("div", numerator, denominator)


def month_boundaries(start: Column | str, end: Column | str) -> Column:
    """Number of month starts crossed between two dates (31 Jan to 1 Feb is one)."""
    first, last = as_column(start), as_column(end)
    return (F.year(last) * 12 + F.month(last)) - (F.year(first) * 12 + F.month(first))


def year_boundaries(start: Column | str, end: Column | str) -> Column:
    """Number of new years crossed between two dates."""
    return F.year(as_column(end)) - F.year(as_column(start))


def year_quarter(day: Column | str) -> Column:
    """'2024-Q1'."""
    value = as_column(day)
    return F.concat(
        F.year(value).cast("string"), F.lit("-Q"), F.quarter(value).cast("string")
    )
