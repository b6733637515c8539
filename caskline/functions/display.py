"""Display formats. Rounding is half away from zero, as on an invoice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caskline.functions.labels import as_column


def grouped(value: Column | str, digits: int) -> Column:
    """'1,234.50': thousands separated, a fixed number of decimals.

    format_number rounds half to even, so the value is rounded first, as a decimal.
    """
    exact = as_column(value).cast("decimal(38,10)")
    return F.format_number(F.round(exact, digits), digits)


def dollars(value: Column | str, digits: int = 0) -> Column:
    return F.concat(F.lit("$"), grouped(value, digits))


def percent(value: Column | str, digits: int) -> Column:
    return F.concat(grouped(value, digits), F.lit("%"))


def with_unit(value: Column | str, digits: int, unit: str) -> Column:
    return F.concat(grouped(value, digits), F.lit(unit))
