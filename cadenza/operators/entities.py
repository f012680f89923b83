"""Distinct entity tables and their counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.columns import composite_id

# Columns and key of each entity: fixed values.
ENTITIES = {
    "artists": (["artist_uri", "artist_name"], ["artist_uri"]),
    "albums": (["album_uri", "album_name"], ["album_uri"]),
    "tracks": (["track_uri", "track_name", "artist_uri", "album_uri", "duration_ms"], ["track_uri"]),
    "playlists": (["pid", "playlist_name"], ["pid"]),
    "playlist_tracks": (["pid", "track_uri"], ["pid", "track_uri"]),
}


def entity(flat: DataFrame, name: str) -> DataFrame:
    """Distinct rows of one entity with its document key ``_id``."""
    cols, key = ENTITIES[name]
    return composite_id(flat.select(*cols).distinct(), key)


def entity_counts(flat: DataFrame) -> DataFrame:
    """Rows of the source and of every entity.

    One narrow distinct per entity: cheaper to shuffle than five
    ``count_distinct`` in one aggregate, which repeats each wide row six times.
    """
    def counted(df: DataFrame, label: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).withColumn("entity", F.lit(label))
    parts = [counted(flat, "rows")] + [
        counted(flat.select(*cols).distinct(), name) for name, (cols, _) in ENTITIES.items()]
    return reduce(DataFrame.unionByName, parts).select("entity", "n")
