import json

import pytest

from cadenza.operators import features, flatten
from cadenza.schemas import CORRUPT, SLICE
from cadenza.sources import slices


def track(pos, n, **other):
    return {"pos": pos, "track_uri": f"track:{n}", "track_name": f" Song {n} ", "artist_uri": f"artist:{n % 3}",
            "artist_name": f"  Band {n % 3}", "album_uri": "album:1", "album_name": "One", "duration_ms": 1000 * n,
            **other}


def playlist(pid, tracks, name="  Hits "):
    return {"pid": pid, "name": name, "collaborative": "false", "modified_at": 86400 * pid, "num_tracks": 3,
            "num_albums": 1, "num_followers": 2, "description": None, "tracks": tracks}


@pytest.fixture
def raw_dir(tmp_path):
    info = {"tag": "t", "generated_on": 1, "slice": "0-1", "version": "v1"}
    a = {"info": info, "playlists": [playlist(1, [track(1, 2), track(0, 1), track(2, 1)]), playlist(2, [])]}
    b = {"info": info, "playlists": [playlist(3, None), playlist(4, [track(0, 5)])]}
    (tmp_path / "a.json").write_text(json.dumps(a, indent=2))
    (tmp_path / "b.json").write_text(json.dumps(b, indent=2))
    (tmp_path / "c.json").write_text(json.dumps({"info": info}, indent=2))
    (tmp_path / "d.json").write_text(json.dumps(a, indent=2)[:200])
    return tmp_path


def test_empty_and_missing_track_lists_vanish(spark, raw_dir):
    good, _ = slices.split_rejects(slices.read_with_source(spark, str(raw_dir)))
    rows = flatten.flat_from_slices(good).collect()
    assert sorted((r.pid, r.track_uri) for r in rows) == [
        (1, "track:1"), (1, "track:1"), (1, "track:2"), (4, "track:5")]
    assert rows[0].playlist_name == "  Hits "


def test_unusable_files_are_reported_with_their_reason(spark, raw_dir):
    _, bad = slices.split_rejects(slices.read_with_source(spark, str(raw_dir)))
    got = {(r.source_file.rsplit("/", 1)[1], r.reason) for r in bad.collect()}
    assert got == {("c.json", "no playlists"), ("d.json", "unreadable")}


def test_schema_read_equals_inferred_read(spark, raw_dir):
    files = [str(raw_dir / f) for f in ("a.json", "b.json")]
    inferred = flatten.flat_from_slices(slices.read_slices(spark, files))
    declared = flatten.flat_from_slices(slices.read_slices(spark, files, SLICE))
    assert sorted(map(tuple, inferred.collect())) == sorted(map(tuple, declared.collect()))


def test_pretty_printed_slices_need_multi_line(spark, raw_dir):
    df = slices.read_json_lines(spark, str(raw_dir / "c.json"))
    assert CORRUPT in df.columns and "playlists" not in df.columns
    with pytest.raises(ValueError):
        slices.require_column(df, "playlists")


def test_first_files_by_name(spark, raw_dir):
    names = [p.rsplit("/", 1)[1] for p in slices.first_files(spark, str(raw_dir), 2)]
    assert names == ["a.json", "b.json"]
    assert slices.read_first_slices(spark, str(raw_dir), 1).count() == 1


def test_top_level_array_and_positions(spark, tmp_path):
    (tmp_path / "list.json").write_text(json.dumps(
        [playlist(7, [track(1, 2), track(0, 1)]), playlist(5, [{"track_uri": "x"}, {"track_uri": "y"}])], indent=2))
    rows = slices.read_playlist_list(spark, str(tmp_path))
    got = {(r.pid, r.track_uri, r.pos) for r in flatten.positioned_tracks(rows).collect()}
    assert got == {(7, "track:2", 1), (7, "track:1", 0), (5, "x", 0), (5, "y", 1)}
    assert [r.pid for r in flatten.first_playlists(rows, 1).collect()] == [5]


def test_silver_trims_types_and_deduplicates(spark, raw_dir):
    raw = slices.read_slices(spark, str(raw_dir / "a.json"), SLICE)
    rows = flatten.silver_tracks(raw).collect()
    assert len(rows) == 2  # the repeated track is one row
    row = next(r for r in rows if r.track_uri == "track:2")
    assert (row.playlist_name, row.track_name, row.artist_name) == ("Hits", "Song 2", "Band 2")
    assert row.artist_partition == " " and str(row.modified_date) == "1970-01-02 00:00:00"
    gold = features.artist_features(flatten.silver_tracks(raw)).collect()
    assert {(r.artist_name, r.total_playlist_appearances, r.total_tracks_count) for r in gold} == {
        ("Band 1", 1, 1), ("Band 2", 1, 1)}
    assert gold[0].popularity_score == pytest.approx(1.0)


def test_etl_job_reports_rows_and_rejects(spark, raw_dir, folder):
    from cadenza.plans.jobs import run_etl, run_loading
    report = run_etl(spark, str(raw_dir / "*.json"), f"{folder}/flat", f"{folder}/rejects")
    assert report == {"rows": 4, "rejected_files": 2}
    assert spark.read.parquet(f"{folder}/rejects").count() == 2
    loaded = {}
    run_loading(spark.read.parquet(f"{folder}/flat"), lambda df, name: loaded.update({name: df.count()}))
    assert loaded == {"artists": 2, "albums": 1, "tracks": 3, "playlists": 2, "playlist_tracks": 3}


def test_ingest_stream_takes_each_file_once(spark, raw_dir, folder):
    import shutil

    from pyspark.sql import types as T

    from cadenza.sources.events import read_slice_stream
    from cadenza.streaming.jobs import ingest_slices
    schema = T.StructType(SLICE.fields + [T.StructField(CORRUPT, T.StringType())])
    inbox = raw_dir / "inbox"
    inbox.mkdir()

    def run():
        ingest_slices(read_slice_stream(spark, str(inbox), schema), f"{folder}/out", f"{folder}/ckpt").awaitTermination()
        return spark.read.parquet(f"{folder}/out").count()

    for name in ("a.json", "d.json"):
        shutil.copy(raw_dir / name, inbox / name)
    assert run() == 3
    for name in ("b.json", "c.json"):
        shutil.copy(raw_dir / name, inbox / name)
    assert run() == 4
    assert run() == 4


def test_slice_files_are_compressed_and_tracks_shuffled_by_key(spark, monkeypatch, folder):
    import os

    from cadenza.plans import standins
    monkeypatch.setattr(standins, "run_dir", lambda spark, label: f"{folder}/{label}")
    tables = {
        "lineitem": ([(1, 1, 5, 7, 1.0), (1, 2, 6, 7, 2.0), (2, 1, 5, 8, 1.0)],
                     "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double"),
        "part": ([(5, "five", "B", 1.5), (6, "six", None, 2.0)], "p_partkey long, p_name string, p_brand string, p_retailprice double"),
        "supplier": ([(7, "seven"), (8, "eight")], "s_suppkey long, s_name string"),
        "orders": ([(n, "1-URGENT", "1995-01-01", 10000.0, 3) for n in (1, 2, 3)],
                   "o_orderkey long, o_orderpriority string, o_orderdate string, o_totalprice double, o_custkey long")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    raw = standins.raw_playlists(spark, folder)
    assert raw.schema["playlist"].dataType["tracks"].dataType.elementType.names == [
        "pos", "l_partkey", "l_suppkey", "p_name", "p_brand", "p_retailprice", "s_name"]
    path = standins.write_slices(spark, folder)
    names = [f for _, _, files in os.walk(path) for f in files if f.startswith("part-")]
    assert names and all(n.endswith(".txt.gz") for n in names)
    lists = {p.pid: p.tracks for r in spark.read.json(path).collect() for p in r.playlists}
    assert [(t.pos, t.track_uri, t.artist_uri, t.album_uri, t.duration_ms) for t in lists[1]] == [
        (0, "track:5", "artist:7", "album:B", 150), (1, "track:6", "artist:7", None, 200)]
    assert len(lists[2]) == 1 and lists[3] is None
