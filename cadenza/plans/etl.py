"""Nested JSON to curated, silver and gold tables; profiles and entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.columns import rename, stamp_ingestion
from cadenza.operators import entities, features, flatten
from cadenza.operators.clean import decode_events
from cadenza.operators.features import null_profile
from cadenza.operators.ordering import top_n
from cadenza.plans import standins as S
from cadenza.plans import sqltext as Q
from cadenza.schemas import CORRUPT, SLICE
from cadenza.sinks.external import duplicate_keys, write_collection
from cadenza.sinks.tables import create_or_replace, write_partitioned, write_table
from cadenza.sources import slices, tables
from cadenza.workspace import materialise, run_dir


def stamp(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def flatten_playlists(spark: SparkSession, sf: str) -> DataFrame:
    raw = slices.read_slices(spark, S.write_slices(spark, sf), SLICE)
    good = slices.require_column(raw.filter(F.col(CORRUPT).isNull()), "playlists")
    return flatten.flat_from_slices(good)


def flatten_inferred(spark: SparkSession, sf: str) -> DataFrame:
    raw = slices.require_column(slices.read_slices(spark, S.write_slices(spark, sf)), "playlists")
    flat = rename(flatten.flat_from_slices(raw), "pid", "playlist_id")
    return flat.select("playlist_id", "playlist_name", "track_uri", "track_name", "artist_name", "duration_ms")


def playlists_with_tracks(spark: SparkSession, sf: str) -> DataFrame:
    raw = slices.read_json_lines(spark, S.write_slices(spark, sf), SLICE)
    stamped = stamp_ingestion(flatten.playlists_with_tracks(raw))
    sized = stamped.select("playlist_id", "playlist_name", F.coalesce(F.size("tracks"), F.lit(0)).alias("n"),
                           F.col("ingestion_time").isNotNull().alias("stamped"))
    return sized.groupBy("playlist_id", "playlist_name").agg(
        F.sum("n").alias("n_tracks"), F.bool_and("stamped").alias("stamped"))


def first_slices(spark: SparkSession, sf: str) -> DataFrame:
    raw = slices.read_first_slices(spark, S.write_slices(spark, sf), 3, SLICE, "*.txt.gz")
    tracks = flatten.explode_tracks(flatten.explode_playlists(raw))
    return tracks.select("pid", F.col("track.track_uri").alias("track_uri"))


def bounded_playlists(spark: SparkSession, sf: str) -> DataFrame:
    rows = slices.read_playlist_list(spark, S.write_playlist_lists(spark, sf))
    return flatten.positioned_tracks(flatten.first_playlists(rows, 1000)).select("pid", "track_uri", "pos")


def playlist_list_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = slices.read_playlist_list(spark, S.write_playlist_lists(spark, sf))
    return flatten.positioned_tracks(rows)


def silver_tracks(spark: SparkSession, sf: str) -> DataFrame:
    raw = S.raw_playlists(spark, sf).select(F.array(S.full_playlist(F.col("playlist"))).alias("playlists"))
    return flatten.silver_tracks(raw).withColumn("modified_date", stamp("modified_date"))


def _artists(spark: SparkSession, sf: str) -> DataFrame:
    return features.artist_features(S.silver(spark, sf))


def artist_features(spark: SparkSession, sf: str) -> DataFrame:
    return _artists(spark, sf).withColumns({
        "avg_track_duration": F.round("avg_track_duration", 4),
        "popularity_score": F.round("popularity_score", 4)})


def top_artists(spark: SparkSession, sf: str) -> DataFrame:
    best = top_n(_artists(spark, sf), "total_playlist_appearances", 5, "artist_name")
    return best.select("artist_name", "total_playlist_appearances", "total_tracks_count")


def slice_top_artists(spark: SparkSession, sf: str) -> DataFrame:
    """The whole batch path: raw slices, silver, gold, top artists."""
    raw = slices.read_slices(spark, S.write_slices(spark, sf), SLICE)
    best = top_n(features.artist_features(flatten.silver_tracks(raw)),
                 "total_playlist_appearances", 5, "artist_name")
    return best.select("artist_name", "total_playlist_appearances", "total_tracks_count")


def _playlists(spark: SparkSession, sf: str) -> DataFrame:
    return features.playlist_features(S.silver(spark, sf))


def playlist_features(spark: SparkSession, sf: str) -> DataFrame:
    return _playlists(spark, sf).withColumns({
        "avg_track_duration": F.round("avg_track_duration", 4),
        "diversity_ratio": F.round("diversity_ratio", 4)})


def top_playlists(spark: SparkSession, sf: str) -> DataFrame:
    best = top_n(_playlists(spark, sf), "diversity_ratio", 5, "playlist_id")
    return best.select("playlist_id", F.round("diversity_ratio", 4).alias("diversity_ratio"))


def playlist_length_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return features.with_length_bucket(_playlists(spark, sf), 3).select(
        "playlist_id", "playlist_length", "length_bucket")


def partitioned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "playlist-features")
    bucketed = features.with_length_bucket(_playlists(spark, sf), 3)
    write_partitioned(bucketed, path, ["length_bucket"])
    back = tables.read_table(spark, path, "*.parquet")
    return back.groupBy(F.col("length_bucket").cast("int").alias("length_bucket")).agg(
        F.count(F.lit(1)).alias("n_playlists"), F.sum("playlist_length").alias("n_tracks"))


def artists_by_appearances(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "artist-features")
    # One folder per value would be as many folders as there are counts.
    bucketed = _artists(spark, sf).withColumn("bucket", F.floor(F.log2(F.col("total_playlist_appearances") + 1)).cast("int"))
    write_partitioned(bucketed, path, ["bucket"])
    return tables.read_table(spark, path).groupBy("total_playlist_appearances").agg(
        F.count(F.lit(1)).alias("n_artists"), F.sum("total_tracks_count").alias("n_tracks"))


def silver_by_initial(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "silver")
    write_partitioned(S.silver(spark, sf), path, ["artist_partition"])
    return tables.read_table(spark, path).groupBy("artist_partition").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("artist_name").alias("n_artists"))


def catalog_table_preview(spark: SparkSession, sf: str) -> DataFrame:
    name = create_or_replace(stamp_ingestion(S.flat(spark, sf)), "bronze", "flat_tracks", [],
                             run_dir(spark, "bronze"))
    shown = tables.table_preview(spark, name, 5)
    return spark.table(name).agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", shown.agg(F.count(F.lit(1)).alias("n")).scalar().alias("n_shown"))


def corpus_profile(spark: SparkSession, sf: str) -> DataFrame:
    return features.corpus_profile(S.flat(spark, sf))


def avg_tracks_per_playlist(spark: SparkSession, sf: str) -> DataFrame:
    return features.avg_tracks_per_playlist(S.flat(spark, sf)).select(F.round("avg_tracks", 4).alias("avg_tracks"))


def top_artists_by_entries(spark: SparkSession, sf: str) -> DataFrame:
    return features.top_values(S.flat(spark, sf), "artist_name")


def top_albums_by_entries(spark: SparkSession, sf: str) -> DataFrame:
    return features.top_values(S.flat(spark, sf), "album_name")


def column_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return null_profile(decode_events(S.messages(spark, sf)), ["pid", "track_uri", "event_type", "event_ts"])


def _entity(name: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = entities.entity(S.flat(spark, sf), name)
        if name == "playlist_tracks":
            return df.withColumn("_id", F.concat_ws("|", "_id.pid", "_id.track_uri"))
        return df
    return run


def entity_counts(spark: SparkSession, sf: str) -> DataFrame:
    return entities.entity_counts(materialise(S.flat(spark, sf), "flat"))


def duplicate_key_check(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(entities.entity(S.flat(spark, sf), "tracks"), ["_id"])


def collection_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "collection")
    df = entities.entity(S.flat(spark, sf), "albums")
    write_collection(df, "Albums", "parquet", {"path": path})
    return tables.read_table(spark, path)


def curated_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "curated")
    write_table(S.flat(spark, sf), path)
    return tables.read_table(spark, path).groupBy("album_uri").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("duration_ms").alias("duration_ms"))


QUERIES = {
    "flatten_playlists": flatten_playlists,
    "flatten_inferred": flatten_inferred,
    "playlists_with_tracks": playlists_with_tracks,
    "first_slices": first_slices,
    "bounded_playlists": bounded_playlists,
    "playlist_list_rows": playlist_list_rows,
    "silver_tracks": silver_tracks,
    "artist_features": artist_features,
    "top_artists": top_artists,
    "slice_top_artists": slice_top_artists,
    "playlist_features": playlist_features,
    "top_playlists": top_playlists,
    "playlist_length_buckets": playlist_length_buckets,
    "partitioned_roundtrip": partitioned_roundtrip,
    "artists_by_appearances": artists_by_appearances,
    "silver_by_initial": silver_by_initial,
    "catalog_table_preview": catalog_table_preview,
    "corpus_profile": corpus_profile,
    "avg_tracks_per_playlist": avg_tracks_per_playlist,
    "top_artists_by_entries": top_artists_by_entries,
    "top_albums_by_entries": top_albums_by_entries,
    "column_null_profile": column_null_profile,
    **{f"entity_{name}": _entity(name) for name in entities.ENTITIES},
    "entity_counts": entity_counts,
    "duplicate_key_check": duplicate_key_check,
    "collection_roundtrip": collection_roundtrip,
    "curated_roundtrip": curated_roundtrip,
}

_FLAT, _SILVER, _LINKS = f"WITH {Q.FLAT} ", f"WITH {Q.SILVER} ", f"WITH {Q.LINKS} "
_ARTISTS = """SELECT artist_name, count(DISTINCT playlist_id) AS total_playlist_appearances,
  count(track_uri) AS total_tracks_count, round(avg(duration_ms), 4) AS avg_track_duration,
  CAST(sum(duration_ms) AS BIGINT) AS total_listen_time_ms,
  round(count(DISTINCT playlist_id) * CAST(0.7 AS DOUBLE) + count(track_uri) * CAST(0.3 AS DOUBLE), 4)
    AS popularity_score FROM silver GROUP BY 1"""
_TOP_ARTISTS = _SILVER + """SELECT artist_name, count(DISTINCT playlist_id) AS total_playlist_appearances,
  count(track_uri) AS total_tracks_count FROM silver GROUP BY 1
  ORDER BY total_playlist_appearances DESC, artist_name LIMIT 5"""
_LENGTHS = """, lengths AS (SELECT playlist_id, count(track_uri) AS playlist_length,
  CAST(count(track_uri) // 3 * 3 AS INTEGER) AS length_bucket FROM silver GROUP BY playlist_id, playlist_name) """
_TRACK_ROWS = """, rows AS (SELECT l_orderkey AS pid, CAST(row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS INTEGER) AS pos,
  'track:' || l_partkey AS track_uri, p_name AS track_name, s_name AS artist_name, 'album:' || p_brand AS album_uri
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey) """

ORACLES = {
    "flatten_playlists": _FLAT + "SELECT * FROM flat",
    "flatten_inferred": _FLAT + """SELECT pid AS playlist_id, playlist_name, track_uri, track_name, artist_name,
      duration_ms FROM flat""",
    "playlists_with_tracks": """SELECT o_orderkey AS playlist_id, '  ' || o_orderpriority || ' ' AS playlist_name,
      count(l_orderkey) AS n_tracks, true AS stamped
      FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "first_slices": """WITH s AS (SELECT DISTINCT CAST(o_orderkey // 1000 AS VARCHAR) || '-0' AS slice FROM orders
      ORDER BY 1 LIMIT 3) SELECT l_orderkey AS pid, 'track:' || l_partkey AS track_uri FROM lineitem
      WHERE CAST(l_orderkey // 1000 AS VARCHAR) || '-0' IN (SELECT slice FROM s)""",
    "bounded_playlists": _LINKS + """SELECT pid, track_uri, CAST(pos AS INTEGER) AS pos FROM links
      WHERE pid IN (SELECT o_orderkey FROM orders ORDER BY 1 LIMIT 1000)""",
    "playlist_list_rows": _LINKS + _TRACK_ROWS + "SELECT * FROM rows",
    "silver_tracks": _SILVER + "SELECT * REPLACE (" + Q.stamp("modified_date") + " AS modified_date) FROM silver",
    "artist_features": _SILVER + _ARTISTS,
    "top_artists": _TOP_ARTISTS,
    "slice_top_artists": _TOP_ARTISTS,
    "playlist_features": _SILVER + """SELECT playlist_id, playlist_name, count(track_uri) AS playlist_length,
      count(DISTINCT artist_name) AS unique_artists, round(avg(duration_ms), 4) AS avg_track_duration,
      round(count(DISTINCT artist_name) / count(track_uri), 4) AS diversity_ratio FROM silver GROUP BY 1, 2""",
    "top_playlists": _SILVER + """SELECT playlist_id, round(diversity_ratio, 4) AS diversity_ratio FROM (
      SELECT playlist_id, count(DISTINCT artist_name) / count(track_uri) AS diversity_ratio
      FROM silver GROUP BY playlist_id, playlist_name) ORDER BY diversity_ratio DESC, playlist_id LIMIT 5""",
    "playlist_length_buckets": _SILVER + _LENGTHS + "SELECT * FROM lengths",
    "partitioned_roundtrip": _SILVER + _LENGTHS + """SELECT length_bucket, count(*) AS n_playlists,
      CAST(sum(playlist_length) AS BIGINT) AS n_tracks FROM lengths GROUP BY 1""",
    "artists_by_appearances": _SILVER + """SELECT total_playlist_appearances, count(*) AS n_artists,
      CAST(sum(n) AS BIGINT) AS n_tracks FROM (SELECT count(DISTINCT playlist_id) AS total_playlist_appearances,
      count(track_uri) AS n FROM silver GROUP BY artist_name) GROUP BY 1""",
    "silver_by_initial": _SILVER + """SELECT artist_partition, count(*) AS n_rows,
      count(DISTINCT artist_name) AS n_artists FROM silver GROUP BY 1""",
    "catalog_table_preview": _FLAT + "SELECT count(*) AS n_rows, least(5, count(*)) AS n_shown FROM flat",
    "corpus_profile": _FLAT + """SELECT count(DISTINCT pid) AS n_playlists, count(*) AS n_entries,
      count(DISTINCT track_name) AS n_tracks FROM flat""",
    "avg_tracks_per_playlist": _FLAT + """SELECT round(avg(n), 4) AS avg_tracks FROM (
      SELECT count(track_name) AS n FROM flat GROUP BY pid)""",
    "top_artists_by_entries": _FLAT + """SELECT artist_name, count(*) AS n_entries FROM flat GROUP BY 1
      ORDER BY n_entries DESC, artist_name LIMIT 10""",
    "top_albums_by_entries": _FLAT + """SELECT album_name, count(*) AS n_entries FROM flat GROUP BY 1
      ORDER BY n_entries DESC, album_name LIMIT 10""",
    "column_null_profile": """SELECT
      2 * count(*) FILTER (event_type = 'error' OR (event_type = 'view' AND value < 20)) AS pid_null,
      2 * count(*) FILTER (event_type = 'error' OR (event_type = 'view' AND value >= 100)) AS track_uri_null,
      2 * count(*) FILTER (event_type = 'error') AS event_type_null,
      2 * count(*) FILTER (event_type = 'error') AS event_ts_null FROM events""",
    "entity_artists": _FLAT + "SELECT DISTINCT artist_uri, artist_name, artist_uri AS _id FROM flat",
    "entity_albums": _FLAT + "SELECT DISTINCT album_uri, album_name, album_uri AS _id FROM flat",
    "entity_tracks": _FLAT + """SELECT DISTINCT track_uri, track_name, artist_uri, album_uri, duration_ms,
      track_uri AS _id FROM flat""",
    "entity_playlists": _FLAT + "SELECT DISTINCT pid, playlist_name, pid AS _id FROM flat",
    "entity_playlist_tracks": _FLAT + "SELECT DISTINCT pid, track_uri, pid || '|' || track_uri AS _id FROM flat",
    "entity_counts": _FLAT + """SELECT 'rows' AS entity, count(*) AS n FROM flat
      UNION ALL SELECT 'artists', count(*) FROM (SELECT DISTINCT artist_uri, artist_name FROM flat)
      UNION ALL SELECT 'albums', count(*) FROM (SELECT DISTINCT album_uri, album_name FROM flat)
      UNION ALL SELECT 'tracks', count(*) FROM (SELECT DISTINCT track_uri, track_name, artist_uri, album_uri,
        duration_ms FROM flat)
      UNION ALL SELECT 'playlists', count(*) FROM (SELECT DISTINCT pid, playlist_name FROM flat)
      UNION ALL SELECT 'playlist_tracks', count(*) FROM (SELECT DISTINCT pid, track_uri FROM flat)""",
    "duplicate_key_check": _FLAT + """SELECT track_uri AS _id, count(*) AS n_rows FROM (
      SELECT DISTINCT track_uri, track_name, artist_uri, album_uri, duration_ms FROM flat)
      GROUP BY 1 HAVING count(*) > 1""",
    "collection_roundtrip": _FLAT + "SELECT DISTINCT album_uri, album_name, album_uri AS _id FROM flat",
    "curated_roundtrip": _FLAT + """SELECT album_uri, count(*) AS n_rows, CAST(sum(duration_ms) AS BIGINT)
      AS duration_ms FROM flat GROUP BY 1""",
}
