"""Artist, playlist and corpus features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.columns import bucket, popularity_score, ratio
from cadenza.operators.skew import salted_join


def artist_features(silver: DataFrame) -> DataFrame:
    """Spark first groups by (artist, playlist), then by artist on the map
    side, so a dominant artist reaches its reducer already combined."""
    return silver.groupBy("artist_name").agg(
        F.countDistinct("playlist_id").alias("total_playlist_appearances"),
        F.count("track_uri").alias("total_tracks_count"),
        F.avg("duration_ms").alias("avg_track_duration"),
        F.sum("duration_ms").alias("total_listen_time_ms"),
    ).withColumn("popularity_score", popularity_score(
        F.col("total_playlist_appearances"), F.col("total_tracks_count")))


def playlist_features(silver: DataFrame) -> DataFrame:
    return silver.groupBy("playlist_id", "playlist_name").agg(
        F.count("track_uri").alias("playlist_length"),
        F.countDistinct("artist_name").alias("unique_artists"),
        F.avg("duration_ms").alias("avg_track_duration"),
    ).withColumn("diversity_ratio", ratio(F.col("unique_artists"), F.col("playlist_length")))


def with_length_bucket(features: DataFrame, width: int = 50) -> DataFrame:
    return features.withColumn("length_bucket", bucket(F.col("playlist_length"), width))


def implicit_ratings(links: DataFrame) -> DataFrame:
    """Occurrences per (playlist, track)."""
    return links.groupBy("pid", "track_uri").agg(F.count(F.lit(1)).alias("rating"))


def track_popularity(links: DataFrame) -> DataFrame:
    return links.groupBy("track_uri").agg(F.count(F.lit(1)).alias("popularity"))


def popular_tracks(popularity: DataFrame, n: int = 300) -> DataFrame:
    return popularity.orderBy(F.desc("popularity"), "track_uri").limit(n)


def top_values(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """Most frequent values of a column, ties by value."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n_entries"))
    return counts.orderBy(F.desc("n_entries"), col).limit(n)


def corpus_profile(flat: DataFrame) -> DataFrame:
    return flat.agg(
        F.countDistinct("pid").alias("n_playlists"),
        F.count(F.lit(1)).alias("n_entries"),
        F.countDistinct("track_name").alias("n_tracks"))


def avg_tracks_per_playlist(flat: DataFrame) -> DataFrame:
    per = flat.groupBy("pid").agg(F.count("track_name").alias("n"))
    return per.agg(F.avg("n").alias("avg_tracks"))


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null count of each column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c.replace('.', '_')}_null") for c in cols])


def join_artist_meta(tracks: DataFrame, meta: DataFrame, spread_by: list[str],
                     count_on: DataFrame | None = None) -> DataFrame:
    """Tracks with the country of their artist; a dominant artist is split. ``count_on`` as in ``salted_join``."""
    return salted_join(tracks, meta, "artist_name", spread_by, count_on=count_on)
