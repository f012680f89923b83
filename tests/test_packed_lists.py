"""Neighbour lists packed for the shuffle, and steps that need none after it."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadenza.operators import candidates, features, metrics, ranking, sequences, splits
from cadenza.plans import standins


@pytest.fixture
def links(spark):
    rnd = random.Random(5)
    rows = [(p, f"track:{rnd.randrange(30)}", i) for p in range(40) for i in range(rnd.randrange(1, 12))]
    return spark.createDataFrame(rows, "pid bigint, track_uri string, pos bigint").cache()


@pytest.mark.parametrize("texts", [True, False])
@pytest.mark.parametrize("spread", [True, False])
def test_packed_lists_come_back_as_they_were(texts, spread):
    rnd = random.Random(1)
    rows = []
    for _ in range(200):
        size = rnd.choice([0, 1, 2, 40])
        track = (lambda: rnd.choice(["", "é", "\n x", f"track:{rnd.randrange(10 ** 6)}"])) if texts else (lambda: rnd.choice([-5, 0, 2 ** 31 - 1]))
        rows.append({"neighbour": [track() for _ in range(size)], "millionths": [rnd.choice([-3, 0, rnd.randrange(10 ** 9), 2 ** 50]) for _ in range(size)],
                     **({"popularity": [rnd.choice([0, rnd.randrange(50), 2 ** 40]) for _ in range(size)]} if spread else {})})
    kind = pa.string() if texts else pa.int32()
    fields = [("neighbour", pa.list_(kind)), ("millionths", pa.list_(pa.int64())), ("popularity", pa.list_(pa.int64()))][:2 + spread]
    packed = [None, *candidates._pack(pa.array(rows, pa.struct(fields)))]
    n, tracks, *numbers = candidates._unpacked(pa.table({"_list": pa.array(packed, pa.binary())}), kind, spread)
    at, tracks, numbers = 0, tracks.to_pylist(), [c.tolist() for c in numbers]
    for row, size in zip([{f: [] for f, _ in fields}, *rows], n.tolist()):
        got = sorted(zip(tracks[at:at + size], *(c[at:at + size] for c in numbers)))
        assert got == sorted(zip(row["neighbour"], row["millionths"], row.get("popularity", [0] * size)))
        at += size


def test_lists_are_shuffled_packed(spark, links):
    near = sequences.context_similarity(links, 20, popularity=True)
    lists = spark.createDataFrame(candidates.neighbour_lists(near, None, 20, millionths=True).collect(), None)
    packed = candidates._packed(lists).collect()
    entries = {r.track_uri: len(r.near.neighbour) for r in lists.collect()}
    # Three arrays take 8 bytes and more for an entry each.
    assert sum(len(r["_list"]) for r in packed) < 10 * sum(entries.values())
    found = candidates.candidates(candidates.seed_tracks(links).cache(), lists, 9)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "_list" in plan and "_neighbour" not in plan


def test_rows_side_by_side_are_ranked_and_listed_without_a_shuffle(spark, links):
    near = sequences.context_similarity(links, 6, popularity=True)
    lists = spark.createDataFrame(candidates.neighbour_lists(near, None, 6, millionths=True).collect(), None)
    best = candidates.candidates(candidates.seed_tracks(links).cache(), lists, 9)
    scored = best.select("pid", "track_uri", (F.col("cand_rank") % 3).cast("double").alias("final_score"))
    got, want = ranking.rank_topk(scored, 4, side_by_side=True), ranking.rank_topk(scored, 4)
    assert got.orderBy("pid", "rank").collect() == want.select(*got.columns).orderBy("pid", "rank").collect()
    listed = candidates.track_lists(best)
    want = {}
    for r in best.orderBy("pid", "cand_rank").collect():
        want.setdefault(r.pid, []).append(r.track_uri)
    assert {r.pid: r.recommendations for r in listed.collect()} == want
    for df, base in ((got, scored), (listed, best)):
        plans = [x._jdf.queryExecution().optimizedPlan().toString() for x in (df, base)]
        for step in ("Repartition", "Window [", "Aggregate"):
            assert plans[0].count(step) == plans[1].count(step)


@pytest.mark.parametrize("few, bound", [(100, 1000), (2, 1000), (100, 6)])
def test_hits_alone_give_the_metrics_of_all_rows(spark, links, few, bound):
    near = sequences.context_similarity(links, 6, popularity=True)
    lists = spark.createDataFrame(candidates.neighbour_lists(near, None, 6, millionths=True).collect(), None)
    roles = splits.seed_truth_split(links).cache()
    truth = roles.filter("role = 'truth'").select("pid", "track_uri")
    preds = candidates.candidates_any(roles.filter("role = 'seed'").select("pid", "track_uri"), lists, 8)
    want = metrics.ranking_metrics(preds.withColumnRenamed("cand_rank", "rank"), truth, 8)
    judged = candidates.judged_candidates(roles, lists, 8, few, bound)
    got = metrics.hit_metrics(judged.withColumnRenamed("cand_rank", "rank"), truth, 8)
    assert judged.count() == preds.count() and want.filter("n_hits > 0").count() > 3
    assert got.orderBy("pid").collect() == want.select(*got.columns).orderBy("pid").collect()


def test_links_keep_their_order_without_the_price(spark, folder):
    rnd = random.Random(2)
    lines = [(p, rnd.randrange(3), rnd.randrange(2), rnd.randrange(3), float(rnd.randrange(9))) for p in range(30) for _ in range(6)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double"
                          ).write.parquet(f"{folder}/lineitem.parquet")
    want = []
    for p in range(30):
        own = sorted((n, part, supp, price) for o, part, supp, n, price in lines if o == p)
        want += [(p, f"track:{part}", f"artist:{supp}", i) for i, (_, part, supp, _) in enumerate(own)]
    got = standins.links(spark, folder)
    assert sorted(map(tuple, got.select("pid", "track_uri", "artist_uri", "pos").collect())) == sorted(want)
    assert sorted(map(tuple, standins.stored_links(spark, folder).collect())) == sorted((p, t, i) for p, t, _, i in want)
    assert "l_extendedprice" not in got._jdf.queryExecution().executedPlan().toString()


def test_popularity_beside_numbers(spark, links):
    coded, tracks = sequences.code_tracks(links)
    code = {r.code: (r.track_uri, r.popularity) for r in tracks.collect()}
    popularity = {r.track_uri: r.popularity for r in features.track_popularity(links).collect()}
    edges = sequences.context_similarity(coded, 6, popularity=True).collect()
    assert edges and all(popularity[code[r.neighbour][0]] == r.popularity for r in edges)
    with pytest.raises(Exception, match=r"2\^32"):
        sequences.context_similarity(coded.withColumn("popularity", F.lit(1 << 32)), 6).collect()
