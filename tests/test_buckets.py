"""Bucketed upserts, served lookups, distinct counts by bitmap."""

import os

import pytest
from pyspark.sql import functions as F

from cadenza.operators import bitmaps, serving
from cadenza.sinks import upsert

KEYS = ["k"]


def batch(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, w string")


def files(path):
    return {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")) for d in os.listdir(path) if "=" in d}


def current(spark, path):
    return {r.k: (r.v, r.w) for r in upsert.read_merged(spark, path, KEYS).collect()}


def test_merge_on_read_and_compaction(spark, folder):
    write, want = upsert.upsert_bucketed(folder, KEYS, 8), {}
    for n in range(4):
        rows = [(f"k{i}", n, None if i % 2 else "x") for i in range(n * 5, n * 5 + 20)]
        write(batch(spark, rows), n)
        want |= {k: (v, w) for k, v, w in rows}
        assert current(spark, folder) == want
    write(batch(spark, rows), 3)  # a replay
    write(batch(spark, []), 4)
    assert upsert.compact_buckets(spark, folder, KEYS) == 8
    assert current(spark, folder) == want
    base = spark.read.parquet(f"{folder}/base")
    assert base.count() == base.select("k").distinct().count() and base.agg(F.max("batch_id")).first()[0] == 2
    write(batch(spark, [("k1", 100, "late")]), 5)
    write(batch(spark, [("k2", 101, "newest")]), 6)
    before = files(f"{folder}/base")
    assert upsert.compact_buckets(spark, folder, KEYS) >= 1
    changed = [d for d, f in files(f"{folder}/base").items() if f != before.get(d)]
    touched = {f"bucket={r[0]}" for r in batch(spark, [*rows, ("k1", 0, "")]).select(upsert._bucket(KEYS, 8)).distinct().collect()}
    assert set(changed) == touched
    assert current(spark, folder) == want | {"k1": (100, "late"), "k2": (101, "newest")}
    assert upsert.compact_buckets(spark, folder, KEYS) == 0


def test_only_touched_buckets_are_rewritten(spark, folder):
    write = upsert.upsert_bucketed(folder, KEYS, 16)
    write(batch(spark, [(f"k{i}", 0, "") for i in range(200)]), 0)
    write(batch(spark, [("k7", 1, "")]), 1)
    assert upsert.compact_buckets(spark, folder, KEYS) == 16
    before = files(f"{folder}/base")
    write(batch(spark, [("k8", 2, "")]), 2)
    assert upsert.compact_buckets(spark, folder, KEYS) == 1
    after = files(f"{folder}/base")
    assert sum(after[d] != before[d] for d in before) == 1
    assert current(spark, folder)["k7"] == (1, "") and current(spark, folder)["k8"] == (2, "")


def test_an_interrupted_compaction_is_done_again(spark, folder, monkeypatch):
    write = upsert.upsert_bucketed(folder, KEYS, 4)
    for n in range(3):
        write(batch(spark, [(f"k{i}", n, "") for i in range(n, 10)]), n)
    want, done = current(spark, folder), upsert.replace_partitions

    def stop(*args):
        done(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(upsert, "replace_partitions", stop)
    with pytest.raises(RuntimeError):
        upsert.compact_buckets(spark, folder, KEYS)
    assert current(spark, folder) == want
    monkeypatch.setattr(upsert, "replace_partitions", done)
    upsert.compact_buckets(spark, folder, KEYS)
    assert current(spark, folder) == want


def test_a_lookup_reads_the_buckets_of_its_keys(spark, folder):
    recs = spark.range(500).select(F.col("id").alias("pid"), F.array(F.concat(F.lit("t"), "id")).alias("recommendations"))
    path = f"{folder}/served"
    serving.write_served(serving.to_kv(recs), path, buckets=32)
    got = {r.pid: (r.found, r.recommended_tracks) for r in serving.lookup_ids(spark, path, [3, 7, 7, 900], buckets=32).collect()}
    assert got == {3: (True, ["t3"]), 7: (True, ["t7"]), 900: (False, None)}
    read = [spark.read.parquet(path).join(serving.served(spark, path, list(ids), 32).select("key"), "key", "left_semi").count()
            for ids in (range(1), range(500))]
    assert read == [1, 500]
    assert len(serving.served(spark, path, [3], 32).inputFiles()) > 0
    plan = serving.served(spark, path, [3], 32)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1][:120]
    with pytest.raises(ValueError):
        serving.served(spark, path, list(range(serving.MAX_IDS + 1)))


def test_distinct_counts_can_be_added_up(spark):
    rows = [("a", d, f"p{(d * 37 + i) % 300}") for d in range(4) for i in range(150)] + [("b", 0, "p1"), ("b", 3, "p1"), ("c", 1, "new")]
    frame = spark.createDataFrame(rows, "g string, day int, item string")
    ids = bitmaps.append_ids(None, frame.filter("day < 2"), "item")
    old = bitmaps.daily_bitmaps(frame.filter("day < 2"), ids, ["g"], "day", "item")
    more = bitmaps.append_ids(ids, frame.filter("day >= 2"), "item")
    assert set(map(tuple, ids.collect())) <= set(map(tuple, more.collect()))
    assert more.select("idx").distinct().count() == more.count() == frame.select("item").distinct().count()
    new = bitmaps.daily_bitmaps(frame.filter("day >= 2"), more, ["g"], "day", "item")
    got = dict(map(tuple, bitmaps.distinct_counts(old.unionByName(new), ["g"]).collect()))
    assert got == {g: len({i for h, _, i in rows if h == g}) for g in "abc"}


def test_ids_beyond_one_bitmap(spark):
    frame = spark.range(70_000).select(F.lit("g").alias("g"), F.lit(1).alias("day"), F.col("id").cast("string").alias("item"))
    bits = bitmaps.daily_bitmaps(frame, bitmaps.append_ids(None, frame, "item"), ["g"], "day", "item")
    assert bits.count() == 3 and bitmaps.distinct_counts(bits, ["g"]).first().n_distinct == 70_000


def test_a_day_of_few_ids_is_a_small_bitmap(spark):
    frame = spark.range(200).select(F.concat(F.lit("g"), F.col("id") % 20).alias("g"), F.col("id").alias("day"), F.col("id").cast("string").alias("item"))
    bits = bitmaps.daily_bitmaps(frame, bitmaps.append_ids(None, frame, "item"), ["g"], "day", "item")
    assert bits.agg(F.max(F.length(F.to_json("bitmap")))).first()[0] < 100
    assert {r.n_distinct for r in bitmaps.distinct_counts(bits, ["g"]).collect()} == {10}
