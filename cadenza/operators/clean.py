"""Event cleaning; every function works on batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions.columns import all_present, normalise_text
from cadenza.schemas import EVENT

# Required fields, event type and dedup key: fixed values.
REQUIRED = ["event_ts", "pid", "track_uri", "event_type"]
ADD_TRACK = "add_track"
DEDUP_KEY = ["pid", "track_uri", "event_ts", "event_type"]


def decode_events(kv: DataFrame, schema: T.StructType = EVENT) -> DataFrame:
    """Event columns from a (key, value) frame; malformed values become nulls.

    ``inline`` keeps the filters that follow above the parse. As a plain
    projection, every field and every filter would parse the text again.
    """
    return kv.select(F.inline(F.array(F.from_json(F.col("value").cast("string"), schema))))


def parse_event_ts(events: DataFrame) -> DataFrame:
    """Event time as timestamp; unparsable text becomes null."""
    return events.withColumn("event_ts", F.try_to_timestamp("event_ts"))


def require_fields(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.filter(all_present(cols))


def only_type(df: DataFrame, event_type: str) -> DataFrame:
    return df.filter(F.col("event_type") == event_type)


def clean_events(kv: DataFrame) -> DataFrame:
    """Decode, type, validate, normalise and keep add-track events."""
    events = require_fields(parse_event_ts(decode_events(kv)), REQUIRED)
    return only_type(normalise_text(events, ["playlist_name"], lower=True), ADD_TRACK)


def with_lateness(events: DataFrame, ts: str = "event_ts", delay: str = "10 minutes") -> DataFrame:
    return events.withWatermark(ts, delay)


def dedup_events(events: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per key. The event time is part of the key, so on a stream the
    state of a key expires with the watermark.

    Other columns are the smallest of a key's values in batch; on a stream they
    are those of the first row that arrives.
    """
    keys = keys or DEDUP_KEY
    if events.isStreaming:
        return events.dropDuplicates(keys)
    others = [c for c in events.columns if c not in keys]
    least = [F.min(c).alias(c) for c in others] or [F.count(F.lit(1)).alias("_n")]
    return events.groupBy(*keys).agg(*least).select(*events.columns)
