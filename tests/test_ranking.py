import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import als, candidates, embeddings, features, indexing, metrics, ranking, sequences, similarity, splits

# truth, preds, k, precision, recall, ndcg, average precision
WORKED = [
    (["a", "b", "c"], ["a", "x", "b"], 3, 2 / 3, 2 / 3, 1.5 / (1 + 1 / math.log2(3)), (1 + 2 / 3) / 3),
    (["a", "b"], ["x", "y"], 2, 0, 0, 0, 0),
    ([], ["a"], 1, 0, 0, 0, 0),
    (["a"], ["x", "a"], 1, 0, 0, 0, 0),
    (["a"], ["x", "a"], 2, 0.5, 1, 1 / math.log2(3), 0.5),
    (["a", "a", "b"], ["a", "b"], 2, 1, 2 / 3, 1, 2 / 3),
]


@pytest.mark.parametrize("case", WORKED)
def test_metrics_by_hand(spark, case):
    truth, preds, k, *want = case
    df = spark.createDataFrame([(truth, preds)], "truth array<string>, preds array<string>")
    t, p = F.col("truth"), F.col("preds")
    got = df.select(metrics.precision_at_k(t, p, k), metrics.recall_at_k(t, p, k), metrics.ndcg_at_k(t, p, k),
                    metrics.average_precision(t, p, k), metrics.hit_rate_at_k(t, p, k)).first()
    assert list(got) == pytest.approx([*want, float(want[0] > 0)])


@pytest.mark.parametrize("case", [c for c in WORKED if c[0]])
def test_row_metrics_agree_with_list_metrics(spark, case):
    truth, preds, k, *want = case
    p = spark.createDataFrame([(1, i, t) for i, t in enumerate(preds)], "pid bigint, rank int, track_uri string")
    t = spark.createDataFrame([(1, x) for x in truth], "pid bigint, track_uri string")
    row = metrics.ranking_metrics(p, t, k).first()
    assert [row.precision, row.recall, row.ndcg, row.average_precision] == pytest.approx(want)


def brute(ids, vectors, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 9)
    out = {}
    for i, own in enumerate(ids):
        others = sorted((-sims[i, j], ids[j]) for j in range(len(ids)) if j != i)
        out[own] = [n for _, n in others[:k]]
    return out


@pytest.mark.parametrize("shape", ["random", "clusters", "copies"])
def test_nearest_neighbours_are_exact(spark, shape):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(240, 6))
    if shape == "clusters":
        v = rng.normal(size=(6, 6))[rng.integers(0, 6, 240)] * 5 + rng.normal(size=(240, 6)) * 0.05
    if shape == "copies":  # a third of all rows are the same vector, some scaled
        v[:80] = v[0] * rng.choice([1.0, 2.0, 0.5], size=(80, 1))
    ids = [f"t{i:03d}" for i in range(240)]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, v)] + [("zero", [0.0] * 6)],
                               "track_uri string, vector array<double>")
    rows = similarity.nearest_neighbours(df, 4, block_rows=32).collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.track_uri, r["rank"])):
        got[r.track_uri].append(r.neighbour)
    assert dict(got) == brute(ids, v, 4)
    assert sorted(r["rank"] for r in rows if r.track_uri == "t000") == [1, 2, 3, 4]


@pytest.mark.parametrize("shape", ["random", "clusters", "one place"])
def test_large_cells_have_cells_of_their_own(spark, monkeypatch, shape):
    monkeypatch.setattr(similarity, "PART_ROWS", 50)
    rng = np.random.default_rng(6)
    v = rng.normal(size=(400, 5))
    if shape == "clusters":
        v = rng.normal(size=(20, 5))[rng.integers(0, 20, 400)] * 5 + rng.normal(size=(400, 5)) * 0.05
    if shape == "one place":
        v[:200] = v[0] + rng.normal(size=(200, 5)) * 1e-3
    ids = [f"t{i:03d}" for i in range(400)]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, v)], "track_uri string, vector array<double>")
    got = defaultdict(list)
    for r in sorted(similarity.nearest_neighbours(df, 4, block_rows=16, max_pivots=5).collect(), key=lambda r: (r.track_uri, r["rank"])):
        got[r.track_uri].append(r.neighbour)
    assert dict(got) == brute(ids, v, 4)


def test_fewer_vectors_than_k(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0])], "track_uri string, vector array<double>")
    rows = similarity.nearest_neighbours(df, 5).collect()
    assert sorted((r.track_uri, r.neighbour, round(r.score, 6)) for r in rows) == [
        ("a", "b", 0.707107), ("b", "a", 0.707107)]


def test_blocks_pack_small_cells_and_split_large_ones():
    first, span = similarity._pack(np.array([3, 4, 0, 25, 5, 6]), 10)
    assert list(first) == [0, 0, 0, 1, 4, 5] and list(span) == [1, 1, 1, 3, 1, 1]


@pytest.fixture(scope="module")
def links(spark):
    rng = np.random.default_rng(5)
    rows = [(pid, f"t{int(min(n, 39)):02d}", pos) for pid in range(60)
            for pos, n in enumerate(rng.geometric(0.08, size=rng.integers(1, 14)))]
    return spark.createDataFrame(rows, "pid bigint, track_uri string, pos bigint").cache()


def test_candidate_features_against_plain_python(spark, links):
    near = sequences.context_similarity(links, 6).cache()
    popularity = features.track_popularity(links)
    got = candidates.candidate_features(links, near, popularity, features.popular_tracks(popularity, 8),
                                        top_seed=3, per_seed=6, max_cands=12).collect()
    rows = links.collect()
    pop = Counter(r.track_uri for r in rows)
    top = sorted(pop, key=lambda t: (-pop[t], t))[:8]
    sims = defaultdict(list)
    for r in near.collect():
        sims[r.track_uri].append((r.neighbour, r.score))
    want = set()
    for pid in {r.pid for r in rows}:
        mine = [r.track_uri for r in sorted((r for r in rows if r.pid == pid), key=lambda r: r.pos)]
        seeds, score = mine[:3], Counter()
        for s in seeds:
            for t, x in sims[s]:
                score[t] = round(score[t] + x, 6)
        cands = sorted(score, key=lambda t: (-score[t], t))[:12]
        cands = (cands + [t for t in top if t not in cands])[:12]
        for rank, t in enumerate(cands):
            want.add((pid, t, rank, pop[t], round(score[t], 6), int(t in seeds), len(mine), int(t in mine[3:] and t not in seeds)))
    assert {(r.pid, r.track_uri, r.cand_rank, r.popularity, round(r.t2v_score, 6), r.seed_overlap, r.playlist_len,
             r.label) for r in got} == want


def test_playlist_without_similar_tracks_gets_the_popular_ones(spark):
    links = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (2, "c", 1)], "pid bigint, track_uri string, pos bigint")
    near = sequences.context_similarity(links, 5)
    popularity = features.track_popularity(links)
    rows = candidates.candidate_features(links, near, popularity, features.popular_tracks(popularity, 2),
                                         max_cands=3).collect()
    assert sorted((r.pid, r.cand_rank, r.track_uri) for r in rows) == [
        (1, 0, "a"), (1, 1, "b"), (2, 0, "b"), (2, 1, "c"), (2, 2, "a")]


def test_split_counts_and_roles(spark):
    playlists = spark.range(20).withColumnRenamed("id", "pid")
    parts = Counter(r.split for r in splits.split_playlists(playlists).collect())
    assert parts == {"train": 14, "val": 3, "test": 3}
    rows = [(n, f"t{p}", p) for n in (10, 5, 4) for p in range(n)]
    roles = splits.seed_truth_split(spark.createDataFrame(rows, "pid bigint, track_uri string, pos bigint"))
    got = Counter((r.pid, r.role) for r in roles.collect())
    assert got == {(10, "seed"): 3, (10, "truth"): 7, (5, "seed"): 1, (5, "truth"): 4}
    assert splits.sample_playlists(playlists, 7).count() == 7


def test_negative_samples(spark, links):
    pos = links.select("pid", "track_uri").distinct()
    drawn = splits.negative_samples(pos, links)
    assert drawn.count() == 3 * pos.count()
    clean = splits.negative_samples(pos, links, exclude=pos)
    assert clean.join(pos.withColumnRenamed("track_uri", "neg_track_uri"), ["pid", "neg_track_uri"]).count() == 0


def test_indexes(spark, links):
    from pyspark.ml.feature import StringIndexer
    ours = {r.track_uri: r.idx for r in indexing.index_by_frequency(links, "track_uri").collect()}
    labels = StringIndexer(inputCol="track_uri", outputCol="i").fit(links).labels
    assert ours == {t: i for i, t in enumerate(labels)}
    alpha = {r.track_uri: r.idx for r in indexing.index_alpha(links, "track_uri").collect()}
    assert alpha == {t: i for i, t in enumerate(sorted(ours))}


def test_als_recommendations_keep_order_and_survive_reload(spark, links, folder):
    rec = als.fit_als(als.ratings_from(links), rank=4, iterations=3)
    rec.save(f"{folder}/als")
    again = als.Recommender.load(spark, f"{folder}/als")
    recs = als.recommend_all(again, 5)
    decoded = {r.pid: r.recommendations for r in als.decode_recs(recs, again.users, again.items).collect()}
    assert len(decoded) == 60 and all(len(set(v)) == 5 for v in decoded.values())
    items = {r.track_numeric: r.track_uri for r in rec.items.collect()}
    users = {r.pid_numeric: r.pid for r in rec.users.collect()}
    for row in als.recommend_all(rec, 5).collect():
        ratings = [x.rating for x in row.recommendations]
        assert ratings == sorted(ratings, reverse=True)
        assert decoded[users[row.pid_numeric]] == [items[x.track_numeric] for x in row.recommendations]
    predicted = als.predict(rec, als.ratings_from(links, "ones"))
    assert 0 < als.rmse(predicted) < 1
    # The dot product equals the model's own prediction; unknown tracks give 0.
    pairs = predicted.select("pid", "track_uri", "prediction")
    near = als.affinity(pairs, rec).select(F.max(F.abs(F.col("affinity") - F.col("prediction")))).first()[0]
    assert near < 1e-5
    unseen = spark.createDataFrame([(1, "nope"), (-5, "t01")], "pid bigint, track_uri string")
    assert {r.affinity for r in als.affinity(unseen, rec).collect()} == {0.0}


def test_random_search_logs_trials_and_returns_the_best(spark, links, folder):
    near = sequences.context_similarity(links, 6)
    popularity = features.track_popularity(links)
    table = candidates.candidate_features(links, near, popularity, features.popular_tracks(popularity, 8),
                                          per_seed=6, max_cands=12)
    grid = {"affinity_rank": [2, 4], "affinity_iterations": [2], "tree_depth": [2], "tree_step": [0.1],
            "tree_rounds": [2], "alpha": [0.1, 0.7]}
    best, log = ranking.random_search(table, table.drop("label"), links.select("pid", "track_uri"), 2, grid,
                                      log=f"{folder}/log")
    scores = [r.score for r in log.collect()]
    assert best["score"] == max(scores) and all(0 <= s <= 1 for s in scores)
    assert spark.read.option("header", True).csv(f"{folder}/log").count() == 2
    assert {len(v) for v in ranking.GRID.values()} == {2, 4}


def test_vectors_for_every_track_by_both_routes(spark, links):
    n = links.select("track_uri").distinct().count()
    skipgram = embeddings.skipgram_vectors(links, dim=8, epochs=1)
    factors = embeddings.context_vectors(links, dim=4, iterations=2)
    for vectors, dim in ((skipgram, 8), (factors, 4)):
        rows = vectors.collect()
        assert len(rows) <= n and {len(r.vector) for r in rows} == {dim}
    assert skipgram.count() == n


@pytest.mark.parametrize("bound", [2, 1000])
def test_labels_of_long_and_short_playlists_without_shuffling_candidates(spark, links, bound):
    near = sequences.context_similarity(links, 6, popularity=True).cache()
    popularity = features.track_popularity(links)
    popular = features.popular_tracks(popularity, 8)
    assert {(r.neighbour, r.popularity) for r in near.collect()} <= {tuple(r) for r in popularity.collect()}
    lists = candidates.neighbour_lists(near, None, 6, millionths=True).cache()
    sizes = {"per_seed": 6, "max_cands": 12}
    want = candidates.candidate_features(links, near.drop("popularity"), popularity, popular, labels=False, **sizes)
    for seeded in (True, False):
        got = candidates.candidate_features(links, lists, popularity, popular, seeds_in_truth=seeded, bound=bound, **sizes)
        seeds = candidates.seed_tracks(links).select("pid", "track_uri")
        truth = links if seeded else links.join(seeds, ["pid", "track_uri"], "left_anti")
        key = ["pid", "track_uri", "cand_rank"]
        assert got.orderBy(*key).collect() == candidates.flag_member(want, truth, "label").select(*got.columns).orderBy(*key).collect()
    got = candidates.candidate_features(links, lists, popularity, popular, **sizes)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and "_in" not in plan  # no join of candidates with the truth, by pair


def test_candidates_of_many_and_few_seeds_agree(spark, links):
    near = sequences.context_similarity(links, 6, popularity=True)
    lists = candidates.neighbour_lists(near, None, 6).cache()
    seeds = links.select("pid", "track_uri")
    want = candidates.candidates(seeds, lists, 9, few_seeds=False).orderBy("pid", "cand_rank").collect()
    for few in (1, 3, 1000):
        got = candidates.candidates_any(seeds, lists, 9, few).select("pid", "track_uri", "t2v_score", "popularity", "cand_rank")
        assert got.orderBy("pid", "cand_rank").collect() == want


def test_groups_of_blocks_send_only_what_reaches_the_kth_score(spark, monkeypatch):
    rng = np.random.default_rng(8)
    v = rng.normal(size=(12, 6))[np.arange(480) % 12] * 5 + rng.normal(size=(480, 6)) * 0.05
    ids, sent = [f"t{i:03d}" for i in range(480)], {}
    df = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, v)], "id string, v array<double>")
    unit = df.withColumn("v", F.transform("v", lambda x: x / F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, y: a + y * y))))
    keep = similarity.first_per_key
    monkeypatch.setattr(similarity, "first_per_key", lambda rows, *a, **o: (sent.update(rows=rows), keep(rows, *a, **o))[1])
    found = similarity._nearest_distinct(unit, 4, 16, 40).collect()
    got = defaultdict(set)
    for r in found:
        got[r.id].add(r.neighbour)
    assert dict(got) == {i: set(n) for i, n in brute(ids, v, 4).items()}
    # Every query held k rows for each of the 30 blocks it met; now its own group's and better ones.
    assert 480 * 4 <= sent["rows"].count() < 2 * 480 * 4


def test_lists_of_whole_scores_need_one_shuffle_by_playlist(spark):
    rows = [(1, "a", 0), (1, "b", 1), (1, "a", 2), (2, "b", 0), (2, "é", 1), (3, None, 0), (3, "c", 1), (None, "a", 0), (None, "d", 1), (4, "z", 0)]
    links = spark.createDataFrame(rows, "pid bigint, track_uri string, pos bigint")
    near = sequences.context_similarity(links, 6, popularity=True)
    popularity = features.track_popularity(links)
    popular = features.popular_tracks(popularity, 5)
    by_row = candidates.neighbour_lists(near, None, 6).cache()
    whole = candidates.neighbour_lists(near, None, 6, millionths=True)
    whole = spark.createDataFrame(whole.collect(), whole.schema)  # no plan of its own
    seeds, playlists = candidates.seed_tracks(links).cache(), links.select("pid").distinct()
    key = ["pid", "cand_rank"]
    for k, cap in ((1, 2), (9, 9)):
        want = candidates.candidates(seeds, by_row, k)
        got = candidates.candidates(seeds, whole, k)
        assert got.orderBy(*key).collect() == want.select(*got.columns).orderBy(*key).collect()
        want = candidates.merge_candidates(want, playlists, popular, cap)
        got = candidates.merged_candidates(seeds, whole, playlists, popular, k, cap)
        assert got.orderBy(*key).collect() == want.select(*got.columns).orderBy(*key).collect()
        tables = [candidates.candidate_features(links, lists, popularity, popular, max_cands=cap, seeds_in_truth=True)
                  for lists in (by_row, whole)]
        assert tables[0].orderBy(*key).collect() == tables[1].orderBy(*key).collect()
    plan = tables[1]._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Window" not in plan


def test_numbered_tracks_have_the_same_neighbours(spark, links):
    coded, tracks = sequences.code_tracks(links)
    assert [r.code for r in tracks.orderBy("track_uri").collect()] == list(range(tracks.count()))
    edges = sequences.context_similarity(coded, 6, popularity=True).cache()
    want = sequences.context_similarity(links, 6, popularity=True)
    got = sequences.named(edges, tracks).select(*want.columns)
    assert dict(edges.dtypes)["neighbour"] == "int"
    assert got.orderBy("track_uri", "rank").collect() == want.orderBy("track_uri", "rank").collect()
