"""Micro-batch upsert by key: append per batch, latest row per key on read.

In the bucketed form rows lie by a hash of their key: ``base`` holds one row a
key, ``deltas`` the batches since. Readers merge both; compaction rewrites only
the buckets that batches touched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators.compaction import read_if_there
from cadenza.sinks.tables import replace_partitions
from cadenza.workspace import materialise

BUCKETS = 64


def upsert_batch(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback. Each batch owns one partition directory, so a
    replayed batch rewrites itself; an empty batch leaves no trace."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current documents: the whole row of the highest batch for each key.

    ``max`` over a struct combines on the map side, so a key rewritten in
    every batch is not gathered first. Two rows of one key in one batch are
    settled by their values, never by arrival order.
    """
    log = spark.read.parquet(path)
    values = [c for c in log.columns if c not in (*keys, "batch_id")]
    newest = log.groupBy(*keys).agg(F.max(F.struct("batch_id", *values)).alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{v}").alias(v) for v in values])


def compact_upserts(spark: SparkSession, path: str, keys: list[str], out: str) -> None:
    """Rewrite the log as one batch in a new folder; readers switch to ``out``."""
    last = spark.read.parquet(path).agg(F.max("batch_id").alias("n")).first().n
    read_latest(spark, path, keys).write.mode("overwrite").parquet(f"{out}/batch_id={last}")


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert_bucketed(path: str, keys: list[str], buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback of the bucketed form. ``buckets`` must stay the same for a table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            (batch.withColumn("bucket", _bucket(keys, buckets)).hint("rebalance", F.col("bucket"))
             .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/deltas/batch_id={batch_id}"))
    return write


def _merged_upto(spark: SparkSession, path: str) -> int:
    done = read_if_there(spark, f"{path}/merged")
    return -1 if done is None else done.agg(F.max("batch_id")).first()[0]


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    values = [c for c in rows.columns if c not in (*keys, "batch_id", "bucket")]
    newest = rows.groupBy("bucket", *keys).agg(F.max(F.struct("batch_id", *values)).alias("_row"))
    return newest.select("bucket", *keys, "_row.*")


def _layers(spark: SparkSession, path: str) -> tuple[DataFrame | None, DataFrame | None]:
    """The base, and the batches that are not part of it yet."""
    deltas = read_if_there(spark, f"{path}/deltas")
    if deltas is not None:
        deltas = deltas.filter(F.col("batch_id") > _merged_upto(spark, path))
    return read_if_there(spark, f"{path}/base"), deltas


def read_merged(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """One row a key: that of the highest batch, from the base and the batches since."""
    base, deltas = _layers(spark, path)
    if deltas is None:
        raise FileNotFoundError(path)
    return _newest(deltas if base is None else base.unionByName(deltas), keys).drop("bucket", "batch_id")


def compact_buckets(spark: SparkSession, path: str, keys: list[str]) -> int:
    """Take all batches but the newest, which may be replayed, into the base; the number of buckets rewritten.

    Only buckets with new rows are read and replaced, the others keep their
    files. Interrupted before its end, it is done again with the same result.
    """
    base, deltas = _layers(spark, path)
    if deltas is None:
        return 0
    last = (deltas.agg(F.max("batch_id")).first()[0] or 0) - 1
    fresh = deltas.filter(F.col("batch_id") <= last)
    touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]
    if not touched:
        return 0
    rows = fresh if base is None else base.filter(F.col("bucket").isin(touched)).unionByName(fresh)
    replace_partitions(materialise(_newest(rows, keys), "merged-buckets"), f"{path}/base", "bucket")
    spark.createDataFrame([(last,)], "batch_id int").write.mode("append").parquet(f"{path}/merged")
    return len(touched)
