"""Exact distinct counts that can be added up: bitmaps of dense ids per group and day.

A bitmap covers 32,768 ids, so a group's ids are several rows, and keeps only its words of 64 ids
that are not empty: a day with one id of a group costs one word. Days are merged by OR: counts after
a new day need its bitmaps and the old ones, no old row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.indexing import index_alpha
from cadenza.operators.skew import salted_join

WORD, BUCKET_WORDS = 64, 512  # ids of a word, words of a bitmap


def daily_bitmaps(rows: DataFrame, ids: DataFrame, group: list[str], day: str, item: str) -> DataFrame:
    """(group, day, bucket, bitmap) of ``item`` by its number in ``ids`` (item, idx).

    Bits are set on the map side, so a group with most rows shuffles bitmaps only. Ids must
    keep their numbers from day to day; new items get new ones.
    """
    numbered = salted_join(rows.select(*group, day, item), ids, item, [*group, day])
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("idx", F.lit(WORD)).cast("int"))
    words = numbered.groupBy(*group, day, F.floor(F.col("idx") / WORD).alias("word")).agg(F.bit_or(bit).alias("bits"))
    bucket = F.floor(F.col("word") / BUCKET_WORDS) + 1  # buckets begin at 1
    return words.groupBy(*group, day, bucket.alias("bucket")).agg(F.collect_list(F.struct("word", "bits")).alias("bitmap"))


def distinct_counts(bitmaps: DataFrame, group: list[str], name: str = "n_distinct") -> DataFrame:
    """Distinct items of each group over all days given."""
    words = bitmaps.select(*group, F.explode("bitmap").alias("w")).groupBy(*group, "w.word").agg(F.bit_or("w.bits").alias("bits"))
    return words.groupBy(*group).agg(F.sum(F.bit_count("bits").cast("bigint")).alias(name))


def append_ids(ids: DataFrame | None, items: DataFrame, item: str) -> DataFrame:
    """``ids`` with numbers after the last for the items it lacks; known ones keep theirs."""
    if ids is None:
        return index_alpha(items, item)
    start = ids.agg((F.coalesce(F.max("idx"), F.lit(-1)) + 1).alias("n")).scalar()
    new = index_alpha(items.select(item).distinct().join(ids.select(item), item, "left_anti"), item)
    return ids.select(item, "idx").unionByName(new.select(item, (F.col("idx") + start).alias("idx")))
