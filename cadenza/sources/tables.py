"""Parquet, catalog and local-collection sources."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

MAX_LOCAL_ROWS = 10_000


def read_table(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Parquet directory, optionally only files whose name matches ``pattern``.

    Without a pattern the commit log a stream left behind is honoured.
    """
    reader = spark.read
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def table_preview(spark: SparkSession, table: str, n: int = 5) -> DataFrame:
    return spark.sql(f"SELECT * FROM {table} LIMIT {int(n)}")


def dim_from_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Small dimension from driver rows; refuses anything that should be a table."""
    if len(rows) > MAX_LOCAL_ROWS:
        raise ValueError("too many rows for a driver-side dimension; read a table instead")
    return spark.createDataFrame(rows, schema)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
