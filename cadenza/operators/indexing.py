"""Label dictionaries kept as tables, and lookups against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.operators.ordering import dense_index
from cadenza.operators.skew import salted_join


def index_by_frequency(df: DataFrame, col: str, name: str = "idx") -> DataFrame:
    """(label, idx): most frequent label first, ties by label text.

    Same numbering as MLlib's StringIndexer, but the dictionary stays a table
    instead of an array on the driver.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_label", F.col(col).cast("string"))
    return dense_index(counts, [F.desc("_n"), F.asc("_label")], name).select(col, name)


def index_alpha(df: DataFrame, col: str, name: str = "idx") -> DataFrame:
    """(label, idx) in ascending label order."""
    return dense_index(df.select(col).distinct(), [F.asc(col)], name)


def lookup_or(df: DataFrame, dictionary: DataFrame, key: str, default: Column,
              spread_by: list[str], name: str = "idx") -> DataFrame:
    """Index of ``key``, or ``default`` for labels the dictionary lacks."""
    return (salted_join(df, dictionary, key, spread_by, how="left")
            .withColumn(name, F.coalesce(F.col(name), default)))


def known_only(df: DataFrame, users: DataFrame, items: DataFrame,
               user: str = "pid", item: str = "track_uri") -> DataFrame:
    """Rows whose playlist and track both occur in the dictionaries."""
    return (df.join(users.select(user), user, "left_semi")
            .join(items.select(item), item, "left_semi"))


def size_of(df: DataFrame) -> Column:
    """Row count as a scalar usable inside another query."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()
