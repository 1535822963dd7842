"""Shared folder for written tables and checkpoints, and checks of a side's size before it is broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a side may have before it is shipped to every executor. Vocabularies, class lists and query blocks
# stay under it; anything larger goes through a shuffle join instead.
BROADCAST_ROW_LIMIT = 200_000

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` if the cluster names one.

    Only a local-mode session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        folder = tempfile.mkdtemp(prefix="quillset-")
        context.setCheckpointDir(folder)
        _local_dirs[context.applicationId] = folder
    return _local_dirs[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: short lineage that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> bool:
    """True if ``df`` has at most ``limit`` rows; counts no further than that."""
    return df.limit(limit + 1).count() <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast hint when counting shows that the side is small; otherwise the join is left to Spark."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows of a table out by key when it is read in fewer tasks than there are cores to use.

    A few files with one row group each would otherwise keep all later map work in a few tasks. A table of many
    files is left as it is read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(cores, key)
