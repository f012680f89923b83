"""Nested playlists to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.columns import epoch_to_ts, initial


def explode_playlists(raw: DataFrame) -> DataFrame:
    """One row per playlist; empty and missing arrays vanish."""
    return raw.select(F.explode("playlists").alias("playlist"))


def explode_tracks(playlists: DataFrame) -> DataFrame:
    """One row per playlist-track."""
    return playlists.select(
        F.col("playlist.pid").cast("bigint").alias("pid"),
        F.col("playlist.name").alias("playlist_name"),
        F.explode("playlist.tracks").alias("track"))


def flatten_tracks(tracks: DataFrame) -> DataFrame:
    """The nine curated columns."""
    fields = ["track_name", "track_uri", "artist_name", "album_name", "duration_ms",
              "artist_uri", "album_uri"]
    return tracks.select("pid", "playlist_name", *[F.col(f"track.{f}").alias(f) for f in fields])


def flat_from_slices(raw: DataFrame) -> DataFrame:
    return flatten_tracks(explode_tracks(explode_playlists(raw)))


def playlists_with_tracks(raw: DataFrame) -> DataFrame:
    """Playlist scalars beside their nested track array."""
    return explode_playlists(raw).select(
        F.col("playlist.pid").alias("playlist_id"),
        F.col("playlist.name").alias("playlist_name"),
        F.col("playlist.tracks").alias("tracks"))


def positioned_tracks(playlists: DataFrame) -> DataFrame:
    """(pid, pos, track fields). The position is the track's own field, or its
    place in the array where the field is missing."""
    return (playlists.select("pid", F.posexplode("tracks").alias("_at", "t"))
            .select("pid", F.coalesce("t.pos", "_at").alias("pos"), "t.track_uri", "t.track_name",
                    "t.artist_name", "t.album_uri"))


def first_playlists(playlists: DataFrame, max_playlists: int) -> DataFrame:
    """Bounded read: the first playlists by id, with all their tracks."""
    chosen = playlists.select("pid").distinct().orderBy("pid").limit(max_playlists)
    return playlists.join(chosen, "pid", "left_semi")


def silver_rows(rows: DataFrame) -> DataFrame:
    """Trimmed, typed, deduplicated rows from (pid, name, num_tracks,
    num_followers, modified_at, t: track struct)."""
    return rows.select(
        F.col("pid").alias("playlist_id"), F.trim("name").alias("playlist_name"),
        "num_tracks", "num_followers", epoch_to_ts(F.col("modified_at")).alias("modified_date"),
        *[F.trim(f"t.{c}").alias(c) for c in ("track_uri", "track_name", "artist_uri", "artist_name")],
        F.col("t.duration_ms").alias("duration_ms"),
        initial(F.col("t.artist_name")).alias("artist_partition")).dropDuplicates()


def silver_tracks(raw: DataFrame) -> DataFrame:
    """Silver rows from raw slices."""
    return silver_rows(explode_playlists(raw).select("playlist.*").select(
        "pid", "name", "num_tracks", "num_followers", "modified_at", F.explode("tracks").alias("t")))
