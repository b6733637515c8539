"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on. All are runtime SQL settings, so they can be applied to a session
# that somebody else created.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the aggregate above would have reused the join's partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Before a join runs only compressed file sizes are known, so little is broadcast on trust;
    # once its shuffle has been measured, a side of up to 10 MB is broadcast after all, and sides
    # whose partitions are all small are hashed instead of sorted.
    "spark.sql.autoBroadcastJoinThreshold": "2m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # What a task sorts or hashes is a split of a file or a joined-up shuffle partition. Compressed text
    # and columns take ten to twenty times as much in memory, so with the defaults (128 MB and 64 MB) the
    # sorts of a task outgrow its share of an executor and spill; these sizes don't.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.parquet.compression.codec": "zstd",
    # A write's shuffle files go when the write is done. Otherwise they stay until the driver happens to
    # collect garbage, and the tables of a load fill the disk together. A DataFrame that is executed
    # again makes its shuffles again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings, except those the user or the cluster has set.

    The time zone is left alone: plans use dates, and current timestamps show in the session's zone.
    """
    explicit = {row["key"] for row in spark.sql("SET").collect()}
    for key, value in RUNTIME_SETTINGS.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder: the cluster's own, or a scratch one in local mode only."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise ValueError(
                "set spark.checkpoint.dir to a folder that every executor can reach"
            )
        configured = tempfile.mkdtemp(prefix="caskline-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage and cut its lineage there.

    The rows are on shared storage afterwards, so losing executors costs a re-read and never a
    recomputation that could order rows differently.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to a new folder in the checkpoint folder and read it back.

    Like ``materialise``, but columnar: later passes read only the columns they use. The files stay until
    the folder is cleared.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
