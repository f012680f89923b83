"""Stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cadenza.schemas import FEATURES_5M


def read_events_kafka(spark: SparkSession, servers: str, topic: str,
                      starting: str = "latest") -> DataFrame:
    """(key, value, timestamp, ...) stream of a topic; needs the connector jar."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting).load())


def read_parquet_stream(spark: SparkSession, path: str, schema: T.StructType,
                        max_files: int | None = None) -> DataFrame:
    """Parquet file stream with a fixed schema, optionally rate-limited."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_features_stream(spark: SparkSession, path: str, max_files: int = 5) -> DataFrame:
    """Windowed features written by the first hop."""
    return read_parquet_stream(spark, path, FEATURES_5M, max_files)


def read_slice_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """New slice files as they arrive."""
    return spark.readStream.schema(schema).option("multiLine", True).json(path)
