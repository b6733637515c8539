"""Joins shared by the plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caskline.operators.dimensions import date_attributes


def lookup(dim: DataFrame, source_id: str, own_id: str, *attributes: str) -> DataFrame:
    """The attributes of a dimension under the fact's id column."""
    return dim.select(F.col(source_id).alias(own_id), *attributes)


def with_dates(sales: DataFrame, dates: DataFrame | None, *attributes: str) -> DataFrame:
    """Add calendar attributes of the order date; every sale stays.

    They are functions of the date. A calendar of the caller's own (one row per full_date) takes their
    place on the days it holds.
    """
    usual = date_attributes(F.col("order_date"))
    if dates is None:
        return sales.withColumns({name: usual[name] for name in attributes})
    own = dates.select(
        F.col("full_date").alias("_day"), *[F.col(name).alias(f"_own_{name}") for name in attributes]
    )
    joined = sales.join(own, F.col("order_date") == F.col("_day"), "left")
    held = F.col("_day").isNotNull()
    return joined.withColumns(
        {name: F.when(held, F.col(f"_own_{name}")).otherwise(usual[name]) for name in attributes}
    ).drop("_day", *[f"_own_{name}" for name in attributes])


def known_ids(df: DataFrame, dim: DataFrame, source_id: str, own_id: str) -> DataFrame:
    """Set ids the dimension does not hold to NULL, as a lookup of its surrogate key would."""
    known = dim.select(F.col(source_id).alias(own_id), F.lit(True).alias("_known"))
    rest = [c for c in df.columns if c != own_id]
    return df.join(known, own_id, "left").select(
        F.when(F.col("_known"), F.col(own_id)).alias(own_id), *rest
    )


def join_totals(df: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join per-group totals; a NULL group value matches itself."""
    renamed = totals.withColumnsRenamed({k: f"_{k}" for k in keys})
    match: Column = F.lit(True)
    for key in keys:
        match = match & df[key].eqNullSafe(renamed[f"_{key}"])
    return df.join(renamed, match, "left").drop(*[f"_{k}" for k in keys])


_UNIQUE = "caskline.unique"


def state_unique(df: DataFrame, column: str, *, check: bool = True) -> DataFrame:
    """State that no two rows of ``df`` share a value of ``column``; the column's metadata say so from here on.

    Counts of distinct values of such a column are plain counts, which need no shuffle by value. Cleansing
    makes its keys unique, and published tables keep the statement. ``check`` counts both ways first
    and raises if they differ. Selections, filters and lookups by a unique id keep the property;
    whoever repeats rows afterwards has to drop it (``withMetadata``).
    """
    if check:
        rows, different = df.agg(F.count(column), F.count_distinct(column)).first()
        if rows != different:
            raise ValueError(f"{rows - different} rows repeat a value of {column}")
    return df.withMetadata(column, {**df.schema[column].metadata, _UNIQUE: True})


def is_unique(df: DataFrame, column: str) -> bool:
    return bool(df.schema[column].metadata.get(_UNIQUE))


def count_of(df: DataFrame, column: str) -> Column:
    """Aggregate over ``df`` (or groups of it): the number of different values of ``column``."""
    return F.count(column) if is_unique(df, column) else F.count_distinct(column)
