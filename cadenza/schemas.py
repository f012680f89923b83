"""Explicit schemas of the raw slices, events and streamed features."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the input formats: fixed values.
TRACK = T.StructType([
    T.StructField("pos", T.IntegerType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("track_uri", T.StringType()),
    T.StructField("artist_uri", T.StringType()),
    T.StructField("track_name", T.StringType()),
    T.StructField("album_uri", T.StringType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("album_name", T.StringType()),
])

PLAYLIST = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("collaborative", T.StringType()),
    T.StructField("pid", T.LongType()),
    T.StructField("modified_at", T.LongType()),
    T.StructField("num_tracks", T.IntegerType()),
    T.StructField("num_albums", T.IntegerType()),
    T.StructField("num_followers", T.IntegerType()),
    T.StructField("tracks", T.ArrayType(TRACK)),
    T.StructField("description", T.StringType()),
])

INFO = T.StructType([
    T.StructField("tag", T.StringType()),
    T.StructField("generated_on", T.LongType()),
    T.StructField("slice", T.StringType()),
    T.StructField("version", T.StringType()),
])

SLICE = T.StructType([
    T.StructField("info", INFO),
    T.StructField("playlists", T.ArrayType(PLAYLIST)),
])

EVENT = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("pid", T.IntegerType()),
    T.StructField("track_uri", T.StringType()),
    T.StructField("playlist_name", T.StringType()),
    T.StructField("event_ts", T.StringType()),
])

FEATURES_5M = T.StructType([
    T.StructField("window", T.StructType([
        T.StructField("start", T.TimestampType()),
        T.StructField("end", T.TimestampType()),
    ])),
    T.StructField("pid", T.IntegerType()),
    T.StructField("track_uri", T.StringType()),
    T.StructField("event_count", T.LongType()),
])

DAILY = T.StructType([
    T.StructField("event_date", T.DateType()),
    T.StructField("pid", T.LongType()),
    T.StructField("track_uri", T.StringType()),
    T.StructField("daily_event_count", T.LongType()),
    T.StructField("first_seen_ts", T.TimestampType()),
    T.StructField("last_seen_ts", T.TimestampType()),
    T.StructField("playlist_name", T.StringType()),
    T.StructField("track_name", T.StringType()),
])
CORRUPT = "_corrupt_record"
