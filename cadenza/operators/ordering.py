"""Ranks, positions and dense numbers without sending a whole group or table to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.columns import hash_order
from cadenza.operators.skew import hot_keys
from cadenza.workspace import materialise

# Rows per position block; also the longest sequence handed to one task.
BLOCK = 1000


def ranked_positions(df: DataFrame, key: str, order: list[str], coarse: list[Column],
                     name: str = "pos", **hot: int) -> DataFrame:
    """Zero-based position of each row inside its ``key``, ordered by ``order``.

    Ordinary keys are numbered in one window. A hot key is cut into buckets by
    ``coarse`` (expressions that never decrease along ``order``), numbered per
    bucket, and shifted by the sizes of its earlier buckets.
    """
    heavy = hot_keys(df, [key], **hot).select(key, F.lit(True).alias("_hot"))
    parts = [f"_part{i}" for i in range(len(coarse))]
    tagged = df.join(F.broadcast(heavy), key, "left").withColumns(
        {p: F.when(F.col("_hot"), c) for p, c in zip(parts, coarse)})
    local = F.row_number().over(Window.partitionBy(key, *parts).orderBy(*order)) - 1
    # Sizes of the buckets of hot keys only: no rows at all in the usual case.
    sizes = (tagged.filter("_hot").groupBy(key, *parts)
             .agg(F.count(F.lit(1)).alias("_size")))
    before = F.sum("_size").over(
        Window.partitionBy(key).orderBy(*parts).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.withColumn("_offset", F.coalesce(before, F.lit(0))).drop("_size")
    numbered = tagged.withColumn("_local", local)
    joined = numbered.join(
        offsets.withColumnsRenamed({c: f"_o{c}" for c in [key, *parts]}),
        on=_null_safe([key, *parts], "_o"), how="left")
    out = (F.col("_local") + F.coalesce("_offset", F.lit(0))).cast("bigint")
    return joined.withColumn(name, out).select(*df.columns, name)


def _null_safe(cols: list[str], prefix: str) -> Column:
    condition = F.lit(True)
    for c in cols:
        condition = condition & F.col(c).eqNullSafe(F.col(prefix + c))
    return condition


def first_per_key(df: DataFrame, key: str, order: list[Column | str], n: int,
                  name: str = "rank") -> DataFrame:
    """The first ``n`` rows of each key, numbered from 1.

    Spark keeps at most ``n`` rows per key in every map task before the
    shuffle, so a hot key arrives already cut down.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def dense_index(df: DataFrame, order: list[Column | str], name: str = "idx") -> DataFrame:
    """Number all rows 0..n-1 in the given total order.

    Rows are range-partitioned and sorted, numbered inside each partition and
    written; the shift per partition comes from one row per partition.
    """
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    staged = materialise(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_local": local}), "dense-index")
    sizes = staged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_offset"))
    return (staged.join(F.broadcast(offsets), "_part")
            .withColumn(name, (F.col("_offset") + F.col("_local")).cast("bigint"))
            .drop("_part", "_local", "_offset"))


def hash_rank(df: DataFrame, key: str, seed: int, name: str = "rank") -> DataFrame:
    """Zero-based rank of each row in a seeded pseudo-random order of a unique key.

    The order is by a hash, so 65,536 equal slices of the hash range hold
    equal shares of the keys; slices are ranked in parallel and shifted by the
    sizes of the slices before them (at most 65,536 rows, safe to broadcast).
    """
    hashed = df.withColumn("_h", hash_order(F.col(key), seed)).withColumn(
        "_slice", F.shiftright("_h", 16).cast("int"))
    sizes = hashed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(
        Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_slice", F.coalesce(before, F.lit(0)).alias("_offset"))
    local = F.row_number().over(Window.partitionBy("_slice").orderBy("_h", key)) - 1
    return (hashed.withColumn("_local", local).join(F.broadcast(offsets), "_slice")
            .withColumn(name, (F.col("_local") + F.col("_offset")).cast("bigint"))
            .drop("_h", "_slice", "_local", "_offset"))


def top_n(df: DataFrame, metric: str, n: int, tie: str) -> DataFrame:
    """First ``n`` rows by a metric, ties by id; never a full sort."""
    return df.orderBy(F.desc(metric), tie).limit(n)
