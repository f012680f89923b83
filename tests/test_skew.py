from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cadenza.operators import ordering, sequences, skew


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows belong to key 0."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).cast("bigint").alias("k"),
        F.col("id").alias("v"), F.pmod(F.xxhash64("id"), F.lit(700)).alias("o"))


def test_hot_keys_are_exact_and_bounded(skewed):
    hot = skew.hot_keys(skewed, ["k"], max_keys=10, min_rows=5).collect()
    assert [(r.k, r.hot_rows) for r in hot] == [(0, 1000)]
    assert skew.hot_keys(skewed, ["k"], max_keys=10, min_rows=2000).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, skewed, how):
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    salted = skew.salted_join(skewed, right, "k", ["v"], how, rows_per_salt=100, max_keys=10, min_rows=5)
    plain = skewed.join(right, "k", how)
    cols = ["k", "v", "o", "w"]
    assert sorted(map(str, salted.select(cols).collect())) == sorted(map(str, plain.select(cols).collect()))


def test_salted_join_spreads_the_hot_key(spark, skewed):
    right = spark.range(40).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_join(skewed, right, "k", ["v"], rows_per_salt=100, max_keys=10, min_rows=5)
        tasks = joined.filter("k = 0").groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks > 1


def test_positions_of_a_hot_key_equal_a_single_window(skewed):
    order = ["o", "v"]
    want = skewed.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy(*order)) - 1)
    got = ordering.ranked_positions(skewed, "k", order, [F.floor(F.col("o") / 100)], max_keys=10, min_rows=5)
    assert sorted(map(tuple, got.select("k", "v", "pos").collect())) == \
        sorted(map(tuple, want.select("k", "v", "pos").collect()))


def test_dense_index_numbers_a_total_order(skewed):
    rows = ordering.dense_index(skewed, [F.desc("o"), F.asc("v")]).collect()
    want = sorted(rows, key=lambda r: (-r.o, r.v))
    assert [r.idx for r in want] == list(range(3000))


def test_hash_rank_is_a_permutation_in_hash_order(skewed):
    from cadenza.functions.columns import hash_order
    rows = ordering.hash_rank(skewed.select("v"), "v", 42).withColumn("h", hash_order(F.col("v"), 42)).collect()
    assert [r.rank for r in sorted(rows, key=lambda r: (r.h, r.v))] == list(range(3000))


def test_first_per_key_cuts_before_the_shuffle(skewed, capsys):
    top = ordering.first_per_key(skewed, "k", ["o", "v"], 5)
    top.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out
    assert max(Counter(r.k for r in top.collect()).values()) == 5


def _links(spark, lengths):
    rows = [(pid, f"t{(pid * 7 + p * p) % 13}", p) for pid, n in lengths.items() for p in range(n)]
    return rows, spark.createDataFrame(rows, "pid bigint, track_uri string, pos bigint")


@pytest.mark.parametrize("block", [4, 10, 1000])
def test_context_pairs_do_not_depend_on_the_block(spark, block):
    rows, links = _links(spark, {1: 3, 2: 25, 3: 10, 4: 1})
    by_pid = defaultdict(list)
    for pid, t, p in rows:
        by_pid[pid].append(t)
    want = Counter()
    for seq in by_pid.values():
        for i, a in enumerate(seq):
            for b in seq[i + 1:i + 4]:
                if a != b:
                    want[a, b] += 1
                    want[b, a] += 1
    got = {(r.track_uri, r.neighbour): r.n for r in sequences.context_pairs(links, 3, block).collect()}
    assert got == dict(want)


def test_sequences_are_bounded_ordered_and_whole(spark):
    rows, links = _links(spark, {1: 3, 2: 25})
    got = sequences.playlist_sequences(links, block=10).orderBy("pid", "chunk").collect()
    assert [(r.pid, r.chunk, len(r.tracks)) for r in got] == [(1, 0, 3), (2, 0, 10), (2, 1, 10), (2, 2, 5)]
    assert sum((r.tracks for r in got if r.pid == 2), []) == [t for p, t, _ in rows if p == 2]


def test_evaluation_sets_go_on_in_further_parts(spark):
    from cadenza.operators import splits

    rows = [(1, f"t{i}", i, "seed" if i < 3 else "truth") for i in range(10)] + [(2, "a", 0, "seed"), (2, "b", 1, "truth")]
    roles = spark.createDataFrame(rows, "pid bigint, track_uri string, pos bigint, role string")
    got = {(r.pid, r.part): (r.seed_tracks, r.gt_tracks) for r in splits.eval_sets(roles, block=4).collect()}
    assert got == {(1, 0): (["t0", "t1", "t2"], ["t3"]), (1, 1): ([], ["t4", "t5", "t6", "t7"]), (1, 2): ([], ["t8", "t9"]),
                   (2, 0): (["a"], ["b"])}
