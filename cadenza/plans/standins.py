"""The domain's inputs, derived from the star-schema test tables.

orders = playlists, lineitem = playlist-tracks, part = tracks and albums,
supplier = artists, nation = countries, events = add-track events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators.flatten import silver_rows
from cadenza.operators.ordering import BLOCK, ranked_positions
from cadenza.workspace import materialise, run_dir

SLICE_PLAYLISTS = 1000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def links(spark: SparkSession, sf: str) -> DataFrame:
    """(pid, track_uri, artist_uri, pos): every line of every order, in order. Lines alike in all that is
    kept may change places, so the price, by which they are ordered last, is not shuffled."""
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("pid"), "l_linenumber", "l_partkey", "l_suppkey")
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    return ranked_positions(rows, "pid", order, _coarse()).select(
        "pid", F.concat(F.lit("track:"), F.col("l_partkey")).alias("track_uri"),
        F.concat(F.lit("artist:"), F.col("l_suppkey")).alias("artist_uri"),
        "l_partkey", "l_suppkey", "pos")


def _coarse() -> list[Column]:
    """What never falls along the order of lines."""
    return [F.col("l_linenumber"), F.floor(F.col("l_partkey") / 1000)]


def stored_links(spark: SparkSession, sf: str) -> DataFrame:
    """The links written once, for plans that read them several times; artists are not shuffled, see ``links``."""
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("pid"), "l_linenumber", "l_partkey")
    placed = ranked_positions(rows, "pid", ["l_linenumber", "l_partkey"], _coarse())
    return materialise(placed.select("pid", F.concat(F.lit("track:"), F.col("l_partkey")).alias("track_uri"), "pos"), "links")


def membership(spark: SparkSession, sf: str) -> DataFrame:
    """(pid, track_uri) without positions: a plain column-pruned scan."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("pid"), F.concat(F.lit("track:"), F.col("l_partkey")).alias("track_uri"))


def playlists(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("pid"))


def flat(spark: SparkSession, sf: str) -> DataFrame:
    """The nine curated columns, one row per playlist-track."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    names = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return (lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .join(names, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("l_orderkey").alias("pid"), _playlist_name().alias("playlist_name"),
                    *_track_columns()))


def _playlist_name() -> Column:
    return F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))


_TRACK_FIELDS = ["track_name", "track_uri", "artist_name", "album_name", "duration_ms", "artist_uri", "album_uri"]


def _track_columns(of: Callable[[str], Column] = F.col) -> list[Column]:
    values = [of("p_name"), F.concat(F.lit("track:"), of("l_partkey")), of("s_name"), of("p_brand"),
              F.floor(of("p_retailprice") * 100).cast("bigint"), F.concat(F.lit("artist:"), of("l_suppkey")),
              F.concat(F.lit("album:"), of("p_brand"))]
    return [v.alias(n) for v, n in zip(values, _TRACK_FIELDS)]


def raw_playlists(spark: SparkSession, sf: str) -> DataFrame:
    """Nested playlists (``playlist``) with their slice number. A playlist of more than
    ``BLOCK`` tracks continues in further slices; empty ones keep null tracks.

    Tracks hold keys and names only, so that these are what is shuffled; ``full_playlist`` adds the rest."""
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    names = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    tracks = (links(spark, sf).join(parts, F.col("l_partkey") == F.col("p_partkey"))
              .join(names, F.col("l_suppkey") == F.col("s_suppkey"))
              .select("pid", "pos", "l_partkey", "l_suppkey", "p_name", "p_brand", "p_retailprice", "s_name"))
    fields = ["l_partkey", "l_suppkey", "p_name", "p_brand", "p_retailprice", "s_name"]
    nested = tracks.groupBy("pid", F.floor(F.col("pos") / BLOCK).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("pos").cast("int").alias("pos"), *fields))).alias("tracks"))
    orders = table(spark, sf, "orders")
    number = F.concat_ws("-", F.floor(F.col("pid") / SLICE_PLAYLISTS), F.coalesce("part", F.lit(0)))
    return orders.withColumn("pid", F.col("o_orderkey")).join(nested, "pid", "left").select(
        number.alias("slice"),
        F.struct(
            "pid", *_playlist_scalars(), F.lit("false").alias("collaborative"), F.lit(1).alias("num_albums"),
            F.lit(None).cast("string").alias("description"), "tracks").alias("playlist"))


def full_playlist(playlist: Column) -> Column:
    """A playlist of ``raw_playlists`` with all fields of its tracks, in the order of the source."""
    fields = ["artist_name", "track_uri", "artist_uri", "track_name", "album_uri", "duration_ms", "album_name"]

    def full(track: Column) -> Column:
        columns = dict(zip(_TRACK_FIELDS, _track_columns(track.getField)))
        return F.struct(track["pos"].alias("pos"), *[columns[f].alias(f) for f in fields])
    return playlist.withField("tracks", F.transform(playlist["tracks"], full))


def silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver rows straight from the tables, without the JSON detour."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    names = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    rows = (lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .join(names, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_orderkey").alias("pid"), *_playlist_scalars(), F.struct(*_track_columns()).alias("t")))
    return silver_rows(rows)


def _playlist_scalars() -> list[Column]:
    return [
        _playlist_name().alias("name"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("modified_at"),
        F.floor(F.col("o_totalprice") / 10000).cast("int").alias("num_tracks"),
        F.col("o_custkey").cast("int").alias("num_followers"),
    ]


def write_slices(spark: SparkSession, sf: str) -> str:
    """One JSON object per file, at most ``SLICE_PLAYLISTS`` playlists each."""
    info = F.struct(F.lit("derived").alias("tag"), F.lit(0).cast("bigint").alias("generated_on"),
                    F.col("slice"), F.lit("v1").alias("version"))
    objects = (raw_playlists(spark, sf).groupBy("slice")
               .agg(F.collect_list("playlist").alias("playlists"))
               .withColumn("playlists", F.transform("playlists", full_playlist))
               .select("slice", F.to_json(F.struct(info.alias("info"), "playlists")).alias("value")))
    path = run_dir(spark, "slices")
    objects.write.partitionBy("slice").text(path, compression="gzip")  # a file is one object, read whole in any case
    return path


def write_playlist_lists(spark: SparkSession, sf: str) -> str:
    """One top-level JSON array of playlists per file."""
    arrays = (raw_playlists(spark, sf).groupBy("slice")
              .agg(F.collect_list("playlist").alias("playlists"))
              .select("slice", F.to_json(F.transform("playlists", full_playlist)).alias("value")))
    path = run_dir(spark, "lists")
    arrays.write.partitionBy("slice").text(path, compression="gzip")
    return path


def event_messages(events: DataFrame) -> DataFrame:
    """Transport records (key, value) from the events table, delivered twice.

    Clicks are clean; views may lack the playlist or the track, sign-ups may
    carry an unparsable time, purchases are another event type and errors are
    not JSON at all.
    """
    kind = F.col("event_type")
    small, large = F.col("value") < 20, F.col("value") >= 100
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    body = F.to_json(F.struct(
        F.when(kind == "purchase", "create_playlist").otherwise("add_track").alias("event_type"),
        F.when((kind == "view") & small, None).otherwise(F.col("user_id")).alias("pid"),
        F.when((kind == "view") & large, None).otherwise(F.concat(
            F.lit("track:"), F.get_json_object("props", "$.k"))).alias("track_uri"),
        F.concat(F.lit("  Mix of "), kind, F.lit(" ")).alias("playlist_name"),
        F.when((kind == "signup") & small, "not a time").otherwise(stamp).alias("event_ts")))
    value = F.when(kind == "error", F.concat(F.lit("{broken "), body)).otherwise(body)
    sent = events.select(F.col("user_id").cast("string").alias("key"), value.alias("value"))
    return sent.select("key", "value", F.explode(F.array(F.lit(1), F.lit(2))).alias("_n")).drop("_n")


def messages(spark: SparkSession, sf: str) -> DataFrame:
    return event_messages(table(spark, sf, "events"))


def message_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same messages as a file stream over the events table (the braces
    make the path a pattern, which may name one file or a directory)."""
    schema = table(spark, sf, "events").schema
    return event_messages(spark.readStream.schema(schema).parquet(f"{sf}/{{events}}.parquet"))
