"""Shared storage for intermediate tables, stream checkpoints and lineage cuts.

The folder comes from ``spark.checkpoint.dir``. A machine-local folder is used
only by a local master with the setting left empty (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="cadenza-")
    return _local_roots[context.applicationId]


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so reruns do not
    collide. All paths of one application share a folder that can be expired
    when the application is over."""
    return f"{shared_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def use_checkpoints(spark: SparkSession) -> None:
    """Give iterative MLlib jobs a checkpoint folder if the session has none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(run_dir(spark, "checkpoints"))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a shared Parquet table and continue from the table.

    Cuts lineage so that a lost executor costs a re-read, not a recomputation,
    and fixes row-number or random columns for every later consumer.
    """
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.parquet(path)
