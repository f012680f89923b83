"""Event cleaning, windowed counts, roll-ups and their streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions.columns import flatten_window
from cadenza.operators import clean, compaction, windows
from cadenza.plans import sqltext as Q
from cadenza.plans import standins as S
from cadenza.plans.etl import stamp
from cadenza.schemas import CORRUPT, SLICE
from cadenza.sinks.upsert import compact_buckets, read_latest, read_merged, upsert_bucketed
from cadenza.sources.events import read_features_stream, read_slice_stream
from cadenza.sources.tables import read_table
from cadenza.streaming import jobs
from cadenza.streaming import windows as stream_windows
from cadenza.workspace import run_dir


def _deduped(spark: SparkSession, sf: str) -> DataFrame:
    return clean.dedup_events(clean.clean_events(S.messages(spark, sf)))


def _readable(df: DataFrame) -> DataFrame:
    """Window and time columns as text, for comparison across engines."""
    flat = flatten_window(df) if "window" in df.columns else df
    return flat.withColumns({f.name: stamp(f.name) for f in flat.schema.fields
                             if isinstance(f.dataType, T.TimestampType)})


def clean_events(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_events(S.messages(spark, sf)).select(
        "event_type", "pid", "track_uri", "playlist_name",
        F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_ts"))


def dedup_events(spark: SparkSession, sf: str) -> DataFrame:
    return _deduped(spark, sf).select(
        "event_type", "pid", "track_uri", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_ts"))


def features_5m(spark: SparkSession, sf: str) -> DataFrame:
    return _readable(windows.features_5m(_deduped(spark, sf)))


def features_1h(spark: SparkSession, sf: str) -> DataFrame:
    return _readable(windows.features_1h(_deduped(spark, sf)))


def features_1d(spark: SparkSession, sf: str) -> DataFrame:
    return _readable(windows.features_1d(_deduped(spark, sf)))


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return windows.daily_rollup(windows.features_5m(_deduped(spark, sf)))


def daily_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return _readable(_daily(spark, sf)).withColumn("event_date", F.col("event_date").cast("string"))


def batch_plus_daily(spark: SparkSession, sf: str) -> DataFrame:
    flat = S.flat(spark, sf).select("pid", "playlist_name", "track_name", "track_uri")
    return windows.union_aligned(flat, _daily(spark, sf)).select(
        "pid", "track_uri", "playlist_name", "track_name",
        F.col("daily_event_count").cast("string").alias("daily_event_count"),
        F.col("event_date").cast("string").alias("event_date"))


def rollup_rerun_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "daily")
    features = windows.features_5m(_deduped(spark, sf))
    windows.compact_daily(features, path)
    windows.compact_daily(features, path)
    return read_table(spark, path).select(
        F.col("event_date").cast("string").alias("event_date"), "pid", "track_uri", "daily_event_count")


def rollup_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Rolled up in two runs as files arrive, the second with late rows of days that the first has written,
    and a third that finds nothing new."""
    source, state, daily = (run_dir(spark, n) for n in ("features-5m", "roll-up", "daily"))
    features = windows.features_5m(_deduped(spark, sf))
    early = F.hour("window.start") < 12
    for arrived in (features.filter(early), features.filter(~early), None):
        if arrived is not None:
            arrived.write.mode("append").parquet(source)
        compaction.compact_new(spark, source, state, daily)
    return _readable(read_table(spark, daily)).withColumn("event_date", F.col("event_date").cast("string"))


def _run(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _stream(branch):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = run_dir(spark, "stream-features")
        with jobs.state_partitions(spark):
            _run(jobs.start_feature_sink(branch(S.message_stream(spark, sf)), out, run_dir(spark, "stream-ckpt"),
                                         {"availableNow": True}))
        return _readable(read_table(spark, out))
    return run


def stream_features_all(spark: SparkSession, sf: str) -> DataFrame:
    """All three window lengths from one stream. The later half of the events comes in a second
    delivery, with all earlier ones again, after the stream was stopped; it goes on where it was."""
    source, out, ckpt = (run_dir(spark, n) for n in ("messages", "all-windows", "all-ckpt"))
    events = S.table(spark, sf, "events")
    middle = events.agg(F.percentile_approx(F.col("ts").cast("timestamp"), 0.5).alias("m")).scalar()
    for part in (events.filter(F.col("ts").cast("timestamp") <= middle), events):
        S.event_messages(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema("key string, value string").parquet(source)
        with jobs.state_partitions(spark):
            _run(jobs.start_feature_sink(stream_windows.all_windows(stream), out, ckpt, {"availableNow": True}))
    none = F.lit("")
    return read_table(spark, out).select(
        "kind", "pid", "track_uri", F.coalesce("playlist_name", none).alias("playlist_name"), "event_count",
        stamp("window_start").alias("window_start"), stamp("window_end").alias("window_end"),
        F.when(F.col("kind") != "5m", stamp("last_seen_ts")).otherwise(none).alias("last_seen_ts"),
        F.when(F.col("kind") == "1d", stamp("first_seen_ts")).otherwise(none).alias("first_seen_ts"))


def stream_upsert_features(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of a first pass that saw every delivery are replaced, key by key,
    by the deduplicated ones; the stream is stopped and resumed in between."""
    source, target, ckpt = (run_dir(spark, n) for n in ("features-5m", "upserts", "upsert-ckpt"))
    first = windows.features_5m(clean.clean_events(S.messages(spark, sf)))
    for features in (first, windows.features_5m(_deduped(spark, sf))):
        features.write.mode("append").parquet(source)
        _run(jobs.run_upsert_stream(read_features_stream(spark, source, max_files=1000), target, ckpt,
                                    {"availableNow": True}))
    return _readable(read_latest(spark, target, ["pid", "track_uri", "window"]))


def stream_upsert_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The same two passes into a table of buckets, which is compacted between and after them."""
    source, target, ckpt = (run_dir(spark, n) for n in ("features-5m", "buckets", "bucket-ckpt"))
    keys = ["pid", "track_uri", "window"]
    first = windows.features_5m(clean.clean_events(S.messages(spark, sf)))
    for features in (first, windows.features_5m(_deduped(spark, sf))):
        features.write.mode("append").parquet(source)
        _run(jobs.run_upsert_stream(read_features_stream(spark, source, max_files=1000), target, ckpt,
                                    {"availableNow": True}, upsert_bucketed(target, keys)))
        compact_buckets(spark, target, keys)
    return _readable(read_merged(spark, target, keys))


def stream_ingest_slices(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.StructType(SLICE.fields + [T.StructField(CORRUPT, T.StringType())])
    out = run_dir(spark, "ingested")
    # The slice key is part of the path, not of the object.
    raw = read_slice_stream(spark, S.write_slices(spark, sf) + "/slice=*", schema)
    _run(jobs.ingest_slices(raw, out, run_dir(spark, "ingest-ckpt")))
    return read_table(spark, out)


def backfill_check(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "features-5m")
    windows.features_5m(_deduped(spark, sf)).write.parquet(path)
    return jobs.backfill_check(spark, path).select("n_rows", (F.col("n_files") > 0).alias("has_files"))


QUERIES = {
    "clean_events": clean_events,
    "dedup_events": dedup_events,
    "features_5m": features_5m,
    "features_1h": features_1h,
    "features_1d": features_1d,
    "daily_rollup": daily_rollup,
    "batch_plus_daily": batch_plus_daily,
    "rollup_rerun_idempotent": rollup_rerun_idempotent,
    "rollup_incremental": rollup_incremental,
    "stream_features_5m": _stream(jobs.stream_5m),
    "stream_features_1h": _stream(jobs.stream_1h),
    "stream_features_1d": _stream(jobs.stream_1d),
    "stream_features_all": stream_features_all,
    "stream_upsert_features": stream_upsert_features,
    "stream_upsert_buckets": stream_upsert_buckets,
    "stream_ingest_slices": stream_ingest_slices,
    "backfill_check": backfill_check,
}

_C, _F5 = f"WITH {Q.CLEANED} ", f"WITH {Q.F5M} "
_MICRO = "strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f')"
_5M = f"""SELECT pid, track_uri, event_count, {Q.stamp('ws')} AS window_start,
  {Q.stamp("ws + INTERVAL '5 minutes'")} AS window_end FROM f5m"""


def _window(width: str, first: bool, delay: str | None = None) -> str:
    seen = f", {Q.stamp('min(event_ts)')} AS first_seen_ts" if first else ""
    late = f"HAVING ws + INTERVAL '{width}' <= (SELECT max(event_ts) FROM deduped) - INTERVAL '{delay}'"
    return _C + f"""SELECT CAST(pid AS INTEGER) AS pid, playlist_name, track_uri, event_count, last_seen_ts,
      {Q.stamp('ws')} AS window_start, {Q.stamp(f"ws + INTERVAL '{width}'")} AS window_end
      {', first_seen_ts' if first else ''} FROM (
      SELECT time_bucket(INTERVAL '{width}', event_ts) AS ws, pid, playlist_name, track_uri,
        count(*) AS event_count, {Q.stamp('max(event_ts)')} AS last_seen_ts {seen}
      FROM deduped GROUP BY 1, 2, 3, 4 {late if delay else ''})"""


_DAILY = """daily AS (SELECT CAST(CAST(ws AS DATE) AS VARCHAR) AS event_date, pid, track_uri,
  CAST(sum(event_count) AS BIGINT) AS daily_event_count, min(ws) AS first_seen_ts,
  max(ws + INTERVAL '5 minutes') AS last_seen_ts FROM f5m GROUP BY 1, 2, 3)"""

ORACLES = {
    "clean_events": _C + f"""SELECT 'add_track' AS event_type, CAST(pid AS INTEGER) AS pid, track_uri, playlist_name,
      {_MICRO} AS event_ts FROM cleaned""",
    "dedup_events": _C + f"""SELECT 'add_track' AS event_type, CAST(pid AS INTEGER) AS pid, track_uri,
      {_MICRO} AS event_ts FROM deduped""",
    "features_5m": _F5 + _5M,
    "features_1h": _window("1 hour", False),
    "features_1d": _window("1 day", True),
    "daily_rollup": f"WITH {Q.F5M}, {_DAILY} " + f"""SELECT event_date, CAST(pid AS BIGINT) AS pid, track_uri, daily_event_count,
      {Q.stamp('first_seen_ts')} AS first_seen_ts, {Q.stamp('last_seen_ts')} AS last_seen_ts,
      CAST(NULL AS VARCHAR) AS playlist_name, CAST(NULL AS VARCHAR) AS track_name FROM daily""",
    "batch_plus_daily": f"WITH {Q.F5M}, {_DAILY}, {Q.FLAT} " + """
      SELECT pid, track_uri, playlist_name, track_name, CAST(NULL AS VARCHAR) AS daily_event_count,
             CAST(NULL AS VARCHAR) AS event_date FROM flat
      UNION ALL SELECT pid, track_uri, NULL, NULL, CAST(daily_event_count AS VARCHAR), event_date FROM daily""",
    "rollup_rerun_idempotent": f"WITH {Q.F5M}, {_DAILY} " + """SELECT event_date, CAST(pid AS BIGINT) AS pid,
      track_uri, daily_event_count FROM daily""",
    "stream_features_5m": _F5 + _5M + """ WHERE ws + INTERVAL '5 minutes' <=
      (SELECT max(event_ts) FROM deduped) - INTERVAL '10 minutes'""",
    "stream_features_1h": _window("1 hour", False, "2 hours"),
    "stream_features_1d": _window("1 day", True, "2 days"),
    "stream_upsert_features": _F5 + _5M,
    "stream_upsert_buckets": _F5 + _5M,
    "stream_ingest_slices": f"WITH {Q.FLAT} SELECT * FROM flat",
    "backfill_check": _F5 + "SELECT count(*) AS n_rows, true AS has_files FROM f5m",
}
ORACLES["rollup_incremental"] = ORACLES["daily_rollup"]
ORACLES["stream_features_all"] = f"""
  SELECT '5m' AS kind, pid, track_uri, '' AS playlist_name, event_count, window_start, window_end, '' AS last_seen_ts,
    '' AS first_seen_ts FROM ({ORACLES["stream_features_5m"]})
  UNION ALL SELECT '1h', pid, track_uri, playlist_name, event_count, window_start, window_end, last_seen_ts, ''
    FROM ({ORACLES["stream_features_1h"]})
  UNION ALL SELECT '1d', pid, track_uri, playlist_name, event_count, window_start, window_end, last_seen_ts, first_seen_ts
    FROM ({ORACLES["stream_features_1d"]})"""
