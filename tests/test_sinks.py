import json
import os

import pytest
from pyspark.sql import functions as F

from cadenza.functions import columns
from cadenza.operators import entities, features
from cadenza.operators.cache import cached
from cadenza.operators.report import observed
from cadenza.operators.serving import from_kv, lookup, to_kv
from cadenza.sinks import external, tables
from cadenza.sources.tables import dim_from_rows, read_table, table_preview
from cadenza.workspace import materialise, run_dir, shared_root


@pytest.fixture
def recs(spark):
    return spark.createDataFrame([(7, ["b", "a"]), (8, [])], "pid bigint, recommendations array<string>")


def test_kv_round_trip_and_lookup(spark, recs):
    kv = to_kv(recs)
    assert {(r.key, r.value) for r in kv.collect()} == {("recommendations:7", '["b","a"]'), ("recommendations:8", "[]")}
    assert sorted(map(str, from_kv(kv).collect())) == sorted(map(str, recs.collect()))
    asked = spark.createDataFrame([(7,), (9,)], "pid bigint")
    got = {r.pid: (r.found, r.recommended_tracks) for r in lookup(kv, asked).collect()}
    assert got == {7: (True, ["b", "a"]), 9: (False, None)}


def file_client(path):
    """Client factory; the class is local so that workers need no test module."""
    class FileClient:
        def __init__(self):
            self.flushes = []

        def put_many(self, records):
            self.flushes.append(len(records))
            for key, value in records:
                with open(os.path.join(path, key.replace(":", "_")), "w") as f:
                    f.write(value)

        def close(self):
            with open(os.path.join(path, f"flushes-{os.getpid()}"), "w") as f:
                json.dump(self.flushes, f)
    return FileClient


def test_publish_puts_every_record_in_batches(spark, folder):
    kv = spark.range(25).select(F.concat(F.lit("k:"), "id").alias("key"), F.col("id").cast("string").alias("value"))
    external.publish_kv(kv.coalesce(1), file_client(folder), batch=10)
    names = os.listdir(folder)
    assert sum(n.startswith("k_") for n in names) == 25
    flushed = [json.load(open(os.path.join(folder, n))) for n in names if n.startswith("flushes")]
    assert flushed == [[10, 10, 5]]


class RecordingWriter:
    """Stands in for ``df.write``: no database is started for a test."""

    def __init__(self, calls):
        self.calls = calls

    def option(self, key, value):
        self.calls.append((key, value))
        return self

    def jdbc(self, url, table, mode, properties):
        self.calls.append((url, table, mode, properties))


def test_jdbc_appends_or_empties_first():
    class Frame:
        calls = []
        write = RecordingWriter(calls)
    external.write_jdbc(Frame, "jdbc:x", "artists")
    external.write_jdbc(Frame, "jdbc:x", "artists", {"user": "u"}, replace=True)
    assert Frame.calls == [("jdbc:x", "artists", "append", {}), ("truncate", True),
                           ("jdbc:x", "artists", "overwrite", {"user": "u"})]


FLAT = "pid bigint, playlist_name string, track_name string, track_uri string, artist_name string, " \
       "album_name string, duration_ms bigint, artist_uri string, album_uri string"


@pytest.fixture
def flat(spark):
    return spark.createDataFrame([
        (1, "p", "s1", "t1", "Band", "A", 10, "a1", "b1"), (1, "p", "s1", "t1", "Band", "A", 10, "a1", "b1"),
        (2, "q", "s1", "t1", "band", "A", 10, "a1", "b1"), (2, "q", "s2", "t2", "Band", "A", None, "a1", "b1")], FLAT)


def test_entities_counts_and_duplicate_keys(flat):
    counts = {r.entity: r.n for r in entities.entity_counts(flat).collect()}
    assert counts == {"rows": 4, "artists": 2, "albums": 1, "tracks": 2, "playlists": 2, "playlist_tracks": 3}
    links = entities.entity(flat, "playlist_tracks")
    assert {tuple(r._id) for r in links.collect()} == {(1, "t1"), (2, "t1"), (2, "t2")}
    assert [(r._id, r.n_rows) for r in external.duplicate_keys(entities.entity(flat, "artists"), ["_id"]).collect()] \
        == [("a1", 2)]


def test_null_profile_and_corpus(flat):
    assert features.null_profile(flat, ["pid", "duration_ms"]).first().asDict() == {"pid_null": 0, "duration_ms_null": 1}
    assert tuple(features.corpus_profile(flat).first()) == (2, 4, 2)
    assert features.avg_tracks_per_playlist(flat).first()[0] == 2.0


def test_length_bucket_crosses_fifty(spark):
    df = spark.createDataFrame([(49,), (50,), (149,)], "playlist_length bigint")
    got = features.with_length_bucket(df).collect()
    assert [r.length_bucket for r in got] == [0, 50, 100]


def test_partitioned_catalog_and_append(spark, flat, folder):
    tables.write_partitioned(flat, f"{folder}/p", ["album_uri"])
    assert read_table(spark, f"{folder}/p").count() == 4
    tables.append_table(flat, f"{folder}/a")
    tables.append_table(flat, f"{folder}/a")
    assert read_table(spark, f"{folder}/a", "*.parquet").count() == 8
    for _ in range(2):
        name = tables.create_or_replace(columns.stamp_ingestion(flat), "lake", "bronze", ["pid"], f"{folder}/t")
    assert table_preview(spark, name, 2).count() == 2 and spark.table(name).count() == 4


def test_observed_counts_without_a_second_job(spark, flat, folder):
    df, seen = observed(flat, "etl", last_pid=F.max("pid"))
    tables.write_table(df, f"{folder}/o")
    assert seen.get == {"rows": 4, "last_pid": 2}


def test_cached_releases(flat):
    with cached(flat) as held:
        assert held.is_cached and held.count() == 4
    assert not flat.is_cached


def test_small_dimensions_only(spark):
    assert dim_from_rows(spark, [("x", "CA")], "artist_name string, country string").count() == 1
    with pytest.raises(ValueError):
        dim_from_rows(spark, [(i,) for i in range(10_001)], "i int")


def test_align_schema_adds_typed_nulls(spark):
    from pyspark.sql import types as T
    target = T.StructType([T.StructField("pid", T.LongType()), T.StructField("name", T.StringType())])
    got = columns.align_schema(spark.createDataFrame([(1, 2)], "pid int, extra int"), target)
    assert got.schema.simpleString() == "struct<pid:bigint,name:string>"


def test_artist_join_drops_unknown_names(spark, flat):
    meta = spark.createDataFrame([("Band", "CA"), ("Nobody", "US")], "artist_name string, country string")
    rows = features.join_artist_meta(flat, meta, ["pid"]).collect()
    assert len(rows) == 3 and {r.country for r in rows} == {"CA"}


def test_stored_tables_live_in_the_shared_folder(spark, flat):
    assert run_dir(spark, "x") != run_dir(spark, "x")
    stored = materialise(flat, "flat")
    assert all(shared_root(spark).removeprefix("file:") in f for f in stored.inputFiles())
