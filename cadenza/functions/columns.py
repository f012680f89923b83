"""Scalar column functions; all run inside Spark's own expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_to_ts(seconds: Column) -> Column:
    """Epoch seconds to timestamp."""
    return F.timestamp_seconds(seconds)


def normalise_text(df: DataFrame, cols: list[str], lower: bool = False) -> DataFrame:
    """Trim the columns, and lower-case them if asked."""
    def fix(name: str) -> Column:
        value = F.trim(F.col(name))
        return F.lower(value) if lower else value
    return df.withColumns({name: fix(name) for name in cols})


def initial(text: Column) -> Column:
    """First character, used as a coarse partition key."""
    return F.substring(text, 1, 1)


def bucket(value: Column, width: int) -> Column:
    """Lower edge of the ``width``-wide bucket; truncates like an integer cast."""
    return ((value / F.lit(width)).cast("int") * F.lit(width)).cast("int")


def popularity_score(appearances: Column, tracks: Column, w1: float = 0.7, w2: float = 0.3) -> Column:
    """Weighted popularity of an artist."""
    return appearances * F.lit(w1) + tracks * F.lit(w2)


def ratio(part: Column, whole: Column) -> Column:
    """Null instead of an error when the denominator is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def composite_id(df: DataFrame, cols: list[str], name: str = "_id") -> DataFrame:
    """Key as one struct (several columns) or the column itself (one column)."""
    key = F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)
    return df.withColumn(name, key)


def flatten_window(df: DataFrame, name: str = "window") -> DataFrame:
    """Replace a window struct by ``window_start`` and ``window_end``."""
    return df.withColumns({
        "window_start": F.col(f"{name}.start"),
        "window_end": F.col(f"{name}.end"),
    }).drop(name)


def rename(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to ``schema``; absent columns become typed nulls, extra ones go."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def stamp_ingestion(df: DataFrame) -> DataFrame:
    return df.withColumn("ingestion_time", F.current_timestamp())


def hash_order(key: Column, seed: int) -> Column:
    """32-bit number from md5(key:seed); the same in any SQL engine."""
    text = F.concat_ws(":", key.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def all_present(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
