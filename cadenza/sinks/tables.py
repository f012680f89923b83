"""Parquet, catalog, JSON, CSV and model sinks."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_partitioned(df: DataFrame, path: str, cols: list[str]) -> None:
    """Partitioned Parquet. Rows are rebalanced by partition value: few files
    for small values, as many tasks as needed for a dominant one."""
    df.hint("rebalance", *map(F.col, cols)).write.mode("overwrite").partitionBy(*cols).parquet(path)


def replace_partitions(df: DataFrame, path: str, col: str) -> None:
    """Overwrite only the partitions present in ``df``: a rerun changes nothing."""
    (df.hint("rebalance", F.col(col)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(col).parquet(path))


def create_or_replace(df: DataFrame, namespace: str, table: str, cols: list[str], path: str) -> str:
    """Catalog table, created or replaced, namespace created if missing."""
    spark = df.sparkSession
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
    name = f"{namespace}.{table}"
    writer = df.write.mode("overwrite").format("parquet").option("path", path)
    if cols:
        writer = writer.partitionBy(*cols)
    writer.saveAsTable(name)
    return name


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, used for split and evaluation sets."""
    df.write.mode("overwrite").json(path)


def log_trial(df: DataFrame, path: str) -> None:
    """Append trial rows to a CSV log."""
    df.write.mode("append").option("header", True).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
