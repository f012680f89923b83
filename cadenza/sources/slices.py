"""Readers for nested playlist JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.schemas import CORRUPT, PLAYLIST, SLICE


def read_slices(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Multi-line slice files. With a schema nothing is inferred (one pass less)
    and unreadable files surface as rows with ``_corrupt_record`` set."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])) \
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One JSON object per line; splittable, unlike the multi-line form."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_playlist_list(spark: SparkSession, path: str) -> DataFrame:
    """Files holding a top-level array of playlists: one row per playlist."""
    return spark.read.schema(PLAYLIST).option("multiLine", True).json(path)


def require_column(df: DataFrame, name: str) -> DataFrame:
    """Keep only objects that carry ``name``; fail if no file can have it."""
    if name not in df.columns:
        raise ValueError(f"input has no column {name!r}")
    return df.filter(F.col(name).isNotNull())


def first_files(spark: SparkSession, folder: str, max_files: int, pattern: str = "*.json") -> list[str]:
    """Names of the first ``max_files`` files of a folder, by name.

    Only paths are read (the content column is pruned) and only the requested
    number of names reaches the driver.
    """
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
               .option("recursiveFileLookup", True).load(folder).select("path"))
    return [row.path for row in listing.orderBy("path").limit(max_files).collect()]


def read_first_slices(spark: SparkSession, folder: str, max_files: int,
                      schema: T.StructType = SLICE, pattern: str = "*.json") -> DataFrame:
    """Bounded slice read: the first ``max_files`` files by name."""
    return read_slices(spark, first_files(spark, folder, max_files, pattern), schema)


def read_with_source(spark: SparkSession, path: str, schema: T.StructType = SLICE) -> DataFrame:
    """All slices of a folder in one read, with the file each row came from."""
    return (read_slices(spark, path, schema)
            .withColumn("source_file", F.col("_metadata.file_path")))


def split_rejects(slices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable slices, one reject row per unusable file with its reason)."""
    bad = F.col(CORRUPT).isNotNull() | F.col("playlists").isNull()
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("unreadable")).otherwise(F.lit("no playlists"))
    return (slices.filter(~bad).drop(CORRUPT),
            slices.filter(bad).select("source_file", reason.alias("reason")))
