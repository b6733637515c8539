"""Delimited files to raw text tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caskline.sources.schemas import LOADED_AT, Entity

CORRUPT = "_corrupt_record"


def ingest(
    spark: SparkSession,
    path: str,
    entity: Entity,
    *,
    loaded_at: Column | None = None,
    delimiter: str = ",",
    malformed: str = "fail",
    quote: str = "",
) -> DataFrame:
    """Read a headed delimited file (or folder of files) as text columns plus the load time.

    ``quote`` encloses values that hold the delimiter; by default no character does. The header must carry the entity's column names. ``malformed``
    is ``"fail"`` (stop the load) or ``"keep"`` (keep the line in ``_corrupt_record``).
    """
    if malformed not in ("fail", "keep"):
        raise ValueError("malformed must be 'fail' or 'keep'")
    schema = entity.raw_schema
    reader = (
        spark.read.option("header", True)
        .option("sep", delimiter)
        .option("quote", quote)
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
    )
    if malformed == "keep":
        schema = schema.add(CORRUPT, "string")
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    else:
        reader = reader.option("mode", "FAILFAST")
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    return reader.schema(schema).csv(path).withColumn(LOADED_AT, stamp)
