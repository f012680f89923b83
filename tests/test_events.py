import json
import time

import pytest
from pyspark.sql import functions as F

from cadenza.operators import clean, windows
from cadenza.sinks.upsert import compact_upserts, read_latest, upsert_batch
from cadenza.streaming import jobs


def event(ts="2024-01-01 00:01:00", pid=1, track="t1", kind="add_track", name="  My MIX "):
    return json.dumps({"event_type": kind, "pid": pid, "track_uri": track, "playlist_name": name, "event_ts": ts,
                       "timestamp": "unused"})


MESSAGES = [
    event(), event(),  # exact duplicate
    event("2024-01-01 00:01:01"),  # same key a second later
    event("2024-01-01 00:05:00"),  # on a window edge
    event(pid=None), event(track=None), event(kind=None), event(kind="create_playlist"),
    event(ts="soon"), "{not json", event().replace('"pid": 1', '"pid": "x"'),
]


def frame(spark, values):
    return spark.createDataFrame([(None, v.encode()) for v in values], "key binary, value binary")


def test_cleaning_keeps_complete_add_track_events(spark):
    rows = clean.clean_events(frame(spark, MESSAGES)).collect()
    assert sorted(str(r.event_ts)[11:] for r in rows) == ["00:01:00", "00:01:00", "00:01:01", "00:05:00"]
    assert {r.playlist_name for r in rows} == {"my mix"}


def test_decode_parses_each_message_once(spark, capsys):
    clean.clean_events(frame(spark, MESSAGES)).explain()
    assert capsys.readouterr().out.count("from_json") == 1


def test_dedup_and_window_edge(spark):
    events = clean.dedup_events(clean.clean_events(frame(spark, MESSAGES)))
    got = {(str(r.window.start)[11:], r.event_count) for r in windows.features_5m(events).collect()}
    assert got == {("00:00:00", 2), ("00:05:00", 1)}
    hour = windows.features_1h(events).first()
    assert hour.event_count == 3 and str(hour.last_seen_ts)[11:] == "00:05:00"
    day = windows.features_1d(events).first()
    assert str(day.first_seen_ts)[11:] == "00:01:00"


def features(spark, rows):
    return spark.createDataFrame(rows, "start timestamp_ntz, pid int, track_uri string, event_count bigint").select(
        F.struct(F.col("start").cast("timestamp").alias("start"),
                 (F.col("start").cast("timestamp") + F.expr("INTERVAL 5 MINUTES")).alias("end")).alias("window"),
        "pid", "track_uri", "event_count")


def ts(text):
    from datetime import datetime
    return datetime.fromisoformat(text)


def test_daily_rollup_splits_at_midnight_and_reruns_change_nothing(spark, folder):
    f = features(spark, [(ts("2024-01-01 23:55:00"), 1, "a", 2), (ts("2024-01-02 00:00:00"), 1, "a", 3),
                         (ts("2024-01-02 10:00:00"), 1, "a", 4)])
    path = f"{folder}/daily"
    for _ in range(2):
        windows.compact_daily(f, path)
    got = {(str(r.event_date), r.daily_event_count) for r in spark.read.parquet(path).collect()}
    assert got == {("2024-01-01", 2), ("2024-01-02", 7)}
    # A later run over one day leaves the other day alone.
    windows.compact_daily(features(spark, [(ts("2024-01-02 00:00:00"), 1, "a", 9)]), path)
    got = {(str(r.event_date), r.daily_event_count) for r in spark.read.parquet(path).collect()}
    assert got == {("2024-01-01", 2), ("2024-01-02", 9)}


def test_union_aligned_keeps_every_column(spark):
    flat = spark.createDataFrame([(1, "a", "n")], "pid bigint, track_uri string, track_name string")
    daily = windows.daily_rollup(features(spark, [(ts("2024-01-01 00:00:00"), 2, "b", 5)]))
    rows = {r.pid: r for r in windows.union_aligned(flat, daily).collect()}
    assert rows[1].daily_event_count is None and rows[2].daily_event_count == 5 and rows[2].track_name is None


def stream(spark, folder, values, branch=jobs.stream_5m):
    """Each entry of ``values`` is one file and one run of the resumed stream."""
    source, out, ckpt = (f"{folder}/{n}" for n in ("in", "out", "ckpt"))
    with jobs.state_partitions(spark, 2):
        for batch in values:
            frame(spark, batch).coalesce(1).write.mode("append").parquet(source)
            kv = spark.readStream.schema("key binary, value binary").parquet(source)
            jobs.start_feature_sink(branch(kv), out, ckpt, {"availableNow": True}).awaitTermination()
            time.sleep(0.05)
    return spark.read.parquet(out)


def test_stream_equals_batch_up_to_the_watermark(spark, folder):
    later = [event("2024-01-01 01:00:00", track="t9")]
    got = stream(spark, folder, [MESSAGES, later])
    want = windows.features_5m(clean.dedup_events(clean.clean_events(frame(spark, MESSAGES))))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_late_events_and_replays_across_batches_are_dropped(spark, folder):
    batches = [[event("2024-01-01 00:01:00")], [event("2024-01-01 00:01:00")],  # replay
               [event("2024-01-01 01:00:00")],  # moves the watermark to 00:50
               [event("2024-01-01 00:02:00")],  # late
               [event("2024-01-01 02:00:00")]]
    got = {(str(r.window.start)[11:], r.event_count) for r in stream(spark, folder, batches).collect()}
    assert got == {("00:00:00", 1), ("01:00:00", 1)}


@pytest.mark.parametrize("branch", [jobs.stream_1h, jobs.stream_1d])
def test_long_windows_have_their_own_watermark(spark, folder, branch):
    got = stream(spark, folder, [MESSAGES, [event("2024-01-09 01:00:00", track="t9")]], branch).collect()
    assert [r.event_count for r in got] == [3]


def test_upsert_replaces_replays_and_skips_empty(spark, folder):
    path, keys = f"{folder}/target", ["pid", "track_uri", "window"]
    write = upsert_batch(path)
    first = features(spark, [(ts("2024-01-01 00:00:00"), 1, "a", 2), (ts("2024-01-01 00:00:00"), 1, "b", 1)])
    second = features(spark, [(ts("2024-01-01 00:00:00"), 1, "a", 1)])
    for batch, number in ((first, 0), (second, 1), (second, 1), (first.limit(0), 2)):
        write(batch, number)
    want = {("a", 1), ("b", 1)}
    assert {(r.track_uri, r.event_count) for r in read_latest(spark, path, keys).collect()} == want
    compact_upserts(spark, path, keys, f"{folder}/compacted")
    assert {(r.track_uri, r.event_count) for r in
            read_latest(spark, f"{folder}/compacted", keys).collect()} == want


def test_upsert_stream_in_small_batches(spark, folder):
    from cadenza.sources.events import read_features_stream
    for n in range(3):
        features(spark, [(ts("2024-01-01 00:00:00"), 1, "a", n)]).write.mode("append").parquet(f"{folder}/f5")
        jobs.run_upsert_stream(read_features_stream(spark, f"{folder}/f5", 1), f"{folder}/t", f"{folder}/c",
                               {"availableNow": True}).awaitTermination()
    rows = read_latest(spark, f"{folder}/t", ["pid", "track_uri", "window"]).collect()
    assert [r.event_count for r in rows] == [2]
    check = jobs.backfill_check(spark, f"{folder}/f5").first()
    assert check.n_rows == 3 and check.n_files >= 3
