"""A corpus from raw documents: quality rules, near duplicates, repeated passages, benchmark leaks, mix."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from caskline.llm.common import lean_workers, row_key, staged, table
from caskline.llm.decontaminate import benchmark_leaks
from caskline.llm.jaccard import keep_one_of_each
from caskline.llm.mixing import balanced_mix
from caskline.llm.quality import keep_quality
from caskline.llm.suffixes import without_repeats


#: A column of the stages' own while they work.
KEY = "_corpus_row_key"


def _lean(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with lean workers; a session's own settings stay."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        lean_workers(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the learned decision list go."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return keep_one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 100-byte strings that start earlier go; ``n_chars`` counts what stays. Documents of which
    no word stays go."""
    return without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give a benchmark item away go."""
    named = docs.withColumn(KEY, row_key("doc_id", "text"))
    leaks = benchmark_leaks(named, table(spark, sf_dir, "benchmark"), id_col=KEY)
    return named.join(leaks.select(KEY).distinct(), KEY, "left_anti").drop(KEY)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often (``copies``) and how many words that is."""
    named = docs.drop("size", "target", "copies", "taken").withColumn(KEY, row_key("doc_id", "text"))
    taken = staged(balanced_mix(named, id_col=KEY).where("copies > 0"), "pipeline-taken")
    # Rows that repeat id and text are drawn one by one; the first of them stands for their sum.
    drawn = taken.groupBy(KEY).agg(
        F.first("size").alias("size"),
        F.first("target").alias("target"),
        F.sum("copies").alias("copies"),
        F.sum("taken").alias("taken"),
        F.count("*").alias("_rows"),
    )
    if not drawn.where("_rows > 1").isEmpty():
        named = named.dropDuplicates([KEY])
    return named.join(drawn.drop("_rows"), KEY).drop(KEY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", _lean(quality)),
    ("near_duplicates", _lean(near_duplicates)),
    ("repeated_passages", _lean(repeated_passages)),
    ("benchmark", _lean(benchmark)),
    ("mix", _lean(mix)),
]

#: Learned rules, similarity classes and a random draw can't be put in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each to what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
