"""Surrogate keys that stay: a map from natural to surrogate ids, kept between loads.

A map is a published table with one row for each natural id ever seen. A load numbers the ids that
the map doesn't hold, in their own order and after the largest key so far, and publishes the map with them
added. Known ids keep their keys whatever else arrives or goes, so facts of earlier loads stay right.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caskline.operators.global_window import global_row_number
from caskline.sources.publish import has_version, publish, read_published


def extend_keys(ids: DataFrame, natural: str, key: str, root: str) -> DataFrame:
    """The key map under ``root`` (natural, key), after adding the ids in ``ids`` that it doesn't hold.

    NULL ids get no key. If no id is new, nothing is numbered and nothing is written. The first load numbers
    all ids from 1. Loads of one map must not overlap: each starts from the version it reads.
    """
    spark = ids.sparkSession
    wanted = ids.select(natural).where(F.col(natural).isNotNull()).distinct()
    if not has_version(spark, root):
        publish(global_row_number(wanted, [(natural, "asc")], key).select(natural, key), root)
        return read_published(spark, root)
    known = read_published(spark, root)
    fresh = wanted.join(known.select(natural), natural, "left_anti")
    if not fresh.isEmpty():
        last = known.agg(F.max(key)).first()[0] or 0
        numbered = global_row_number(fresh, [(natural, "asc")], key)
        added = numbered.select(natural, (F.col(key) + F.lit(last)).cast(known.schema[key].dataType).alias(key))
        publish(known.unionByName(added), root)
    return read_published(spark, root)


def with_keys(dim: DataFrame, keys: DataFrame, natural: str, key: str) -> DataFrame:
    """The dimension with its surrogate key in front, looked up in the map."""
    columns = dim.columns
    return dim.join(keys, natural, "left").select(key, *columns)


def keyed_dimension(spark: SparkSession, dim: DataFrame, natural: str, key: str, root: str) -> DataFrame:
    """``dim`` with the keys of the map under ``root``, which its new ids are added to."""
    return with_keys(dim, extend_keys(dim, natural, key, root), natural, key)
