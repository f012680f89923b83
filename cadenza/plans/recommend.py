"""Indexes, splits, candidates, ranking, metrics and serving."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.operators import (als, bitmaps, candidates, embeddings, features, foldin, indexing, metrics, ranking, sequences,
                               serving, similarity, splits, towers, windows)
from cadenza.operators.clean import clean_events, dedup_events
from cadenza.operators.skew import salted_join
from cadenza.plans import sqltext as Q
from cadenza.plans import standins as S
from cadenza.plans.jobs import Locations, run_chain
from cadenza.sinks import publish
from cadenza.sinks.tables import write_json, write_table
from cadenza.sources.slices import read_json_lines
from cadenza.sources.tables import dim_from_rows
from cadenza.workspace import materialise, run_dir

# Sizes of the registered queries: neighbours per track, candidates per
# playlist, popular backfill. The operators default to 200, 500 and 300.
NEAR, CANDS, POPULAR = 20, 50, 30
# The operators' own sizes, for the queries that return one row per playlist.
FULL_NEAR, FULL_CANDS, FULL_POPULAR, FULL_K = 200, 500, 300, 500
# Playlists ``sample_playlists`` takes and ``rank_playlists`` fits its trees on, as in the original jobs.
TRAIN_PLAYLISTS = 1200
# Trials and grid of the registered search; ``ranking.GRID`` is the full one.
SMALL_GRID = {"affinity_rank": [8, 16], "affinity_iterations": [3, 5], "tree_depth": [4, 5],
              "tree_step": [0.1, 0.2], "tree_rounds": [5, 10], "alpha": [0.1, 0.3, 0.5, 0.7]}
K = 10
# Rounds of boosting in the registered queries; the operator defaults to 200.
ROUNDS = 10


# -- joins and popularity ---------------------------------------------------

def artist_country_join(spark: SparkSession, sf: str) -> DataFrame:
    meta = (S.table(spark, sf, "supplier").join(S.table(spark, sf, "nation"),
                                                F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_name").alias("artist_name"), F.col("n_name").alias("country")))
    tracks = S.flat(spark, sf).select("pid", "track_uri", "track_name", "artist_name")
    counted = (S.table(spark, sf, "lineitem").select("l_suppkey")
               .join(S.table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
               .select(F.col("s_name").alias("artist_name")))
    return features.join_artist_meta(tracks, meta, ["pid", "track_uri"], counted)


def artist_meta_join(spark: SparkSession, sf: str) -> DataFrame:
    rows = [(f"Supplier#{n:09d}", country) for n, country in enumerate(["CA", "US", "UK", "BB"])]
    meta = dim_from_rows(spark, rows, "artist_name string, country string")
    tracks = S.flat(spark, sf).select("pid", "track_uri", "track_name", "artist_name")
    return tracks.join(F.broadcast(meta), "artist_name")


def implicit_ratings(spark: SparkSession, sf: str) -> DataFrame:
    return features.implicit_ratings(S.membership(spark, sf))


def track_popularity(spark: SparkSession, sf: str) -> DataFrame:
    return features.track_popularity(S.membership(spark, sf))


def popular_tracks_top300(spark: SparkSession, sf: str) -> DataFrame:
    return features.popular_tracks(track_popularity(spark, sf))


# -- indexes and splits -----------------------------------------------------

def index_labels(spark: SparkSession, sf: str) -> DataFrame:
    return indexing.index_by_frequency(S.membership(spark, sf), "track_uri")


def index_alpha(spark: SparkSession, sf: str) -> DataFrame:
    return indexing.index_alpha(S.membership(spark, sf), "track_uri")


def _known(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct links with their part of an 80/20 row split; train users, items."""
    rows = splits.hash_split_rows(S.membership(spark, sf).distinct(), ["pid", "track_uri"], 80)
    train = rows.filter(F.col("part") == "train")
    return rows, train.select("pid").distinct(), train.select("track_uri").distinct()


def row_split(spark: SparkSession, sf: str) -> DataFrame:
    return _known(spark, sf)[0]


def known_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows, users, items = _known(spark, sf)
    return indexing.known_only(rows.filter(F.col("part") == "validation"), users, items)


def lookup_unseen_default(spark: SparkSession, sf: str) -> DataFrame:
    rows, _, tracks = _known(spark, sf)
    seen = materialise(indexing.index_alpha(tracks, "track_uri"), "seen")
    first = indexing.lookup_or(rows.select("pid", "track_uri"), seen, "track_uri", F.lit(-1).cast("bigint"), ["pid"])
    return first.withColumn("idx_or_last", F.when(F.col("idx") < 0, indexing.size_of(seen)).otherwise(F.col("idx")))


def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    return splits.sample_rows(S.membership(spark, sf), 0.1)


def random_row_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = materialise(S.membership(spark, sf), "rows")
    train, valid = splits.split_rows(rows, [0.8, 0.2])
    return train.withColumn("part", F.lit("train")).unionByName(valid.withColumn("part", F.lit("validation")))


def split_playlists(spark: SparkSession, sf: str) -> DataFrame:
    return splits.split_playlists(S.playlists(spark, sf))


def splits_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "splits")
    write_json(split_playlists(spark, sf), path)
    return read_json_lines(spark, path, "pid bigint, split string").groupBy("split").agg(
        F.count(F.lit(1)).alias("n_playlists"))


def eval_sets_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Seeds and truth of every playlist that is long enough, written as JSON and read back."""
    path = run_dir(spark, "eval-sets")
    write_json(splits.eval_sets(splits.seed_truth_split(S.stored_links(spark, sf))), path)
    back = read_json_lines(spark, path, "pid bigint, part bigint, seed_tracks array<string>, gt_tracks array<string>")
    return back.select("pid", "part", *[F.concat_ws(",", c).alias(c) for c in ("seed_tracks", "gt_tracks")])


def sample_playlists(spark: SparkSession, sf: str) -> DataFrame:
    return splits.sample_playlists(S.playlists(spark, sf), TRAIN_PLAYLISTS)


def min_tracks(spark: SparkSession, sf: str) -> DataFrame:
    return splits.min_tracks(S.membership(spark, sf), 5)


def seed_truth_split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.seed_truth_split(S.stored_links(spark, sf))


def negative_samples(spark: SparkSession, sf: str) -> DataFrame:
    rows = S.membership(spark, sf)
    return splits.negative_samples(rows.distinct(), rows)


def positive_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return splits.positives(_features(spark, sf)).select("pid", "track_uri", "cand_rank")


# -- sequences, vectors, candidates ----------------------------------------

def playlist_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return sequences.playlist_sequences(S.links(spark, sf)).select(
        "pid", "chunk", F.concat_ws(",", "tracks").alias("tracks"))


def vector_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    vectors = S.table(spark, sf, "embeddings")
    return similarity.nearest_neighbours(vectors, 5, "vec_id", "embedding").withColumn(
        "score", F.round("score", 4))


def track2vec_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    vectors = materialise(embeddings.context_vectors(S.stored_links(spark, sf)), "track-vectors")
    return _list_checks(similarity.nearest_neighbours(vectors, FULL_NEAR))


def skipgram_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    vectors = materialise(embeddings.skipgram_vectors(S.stored_links(spark, sf)), "track-vectors")
    return _list_checks(similarity.nearest_neighbours(vectors, FULL_NEAR))


def factor_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    vectors = embeddings.context_vectors(S.stored_links(spark, sf), window=10)
    return _list_checks(similarity.nearest_neighbours(materialise(vectors, "track-vectors"), FULL_NEAR))


def _list_checks(near: DataFrame) -> DataFrame:
    """Per track what any engine can state of learned neighbours: how many, none
    of them itself, all different, scores that never rise."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda r: r["score"])
    return near.groupBy("track_uri").agg(
        F.count(F.lit(1)).alias("n_neighbours"), F.countDistinct("neighbour").alias("n_distinct"),
        F.bool_and(F.col("track_uri") != F.col("neighbour")).alias("no_self"), ordered.alias("_s")).select(
        "track_uri", "n_neighbours", "n_distinct", "no_self",
        F.forall(F.zip_with(F.slice("_s", 1, F.size("_s") - 1), F.slice("_s", 2, F.size("_s")), lambda a, b: a >= b - 1e-9),
                 lambda x: x).alias("falls"))


def context_similarity(spark: SparkSession, sf: str) -> DataFrame:
    return sequences.context_similarity(S.stored_links(spark, sf), NEAR)


def seed_tracks(spark: SparkSession, sf: str) -> DataFrame:
    return candidates.seed_tracks(S.links(spark, sf))


def _corpus(spark: SparkSession, sf: str, near: int = NEAR, popular: int = POPULAR) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Links, neighbour lists, popularity and the popular list, each stored once."""
    links = S.stored_links(spark, sf)
    coded, tracks = sequences.code_tracks(links)
    popularity = tracks.select("track_uri", "popularity")
    return links, _named_lists(coded, tracks, near), popularity, features.popular_tracks(popularity, popular)


def _coded_corpus(links: DataFrame, near: int, popular: int = POPULAR) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """As ``_corpus``, with numbers for tracks, for results that name none or few; and the dictionary."""
    coded, tracks = sequences.code_tracks(links)
    coded = materialise(coded, "coded-links")
    popularity = tracks.select(F.col("code").alias("track_uri"), "popularity")
    lists = _lists(sequences.context_similarity(coded, near, popularity=True), near)
    return coded.drop("popularity"), lists, popularity, features.popular_tracks(popularity, popular), tracks


def _named_lists(coded: DataFrame, tracks: DataFrame, near: int) -> DataFrame:
    """The lists of neighbours, stored, with tracks for numbers: those of neighbours by edge, the others once a list."""
    edges = sequences.context_similarity(coded, near, popularity=True)
    edges = materialise(edges.select("track_uri", "neighbour", "rank", candidates.whole_scores().alias("millionths"), "popularity"), "edges")
    lists = candidates.neighbour_lists(sequences.named(edges, tracks, both=False), None, near, millionths=True)
    names = tracks.select(F.col("code").alias("_code"), F.col("track_uri").alias("_name"))
    named = lists.join(names, F.col("track_uri") == F.col("_code")).select(F.col("_name").alias("track_uri"), "near")
    return materialise(named, "neighbours")


def _lists(edges: DataFrame, near: int) -> DataFrame:
    """The lists of neighbours, stored."""
    return materialise(candidates.neighbour_lists(edges, None, near, millionths=True), "neighbours")


def _seeds(links: DataFrame) -> DataFrame:
    return materialise(candidates.seed_tracks(links), "seeds")


def candidate_scores(spark: SparkSession, sf: str) -> DataFrame:
    links, lists, _, _ = _corpus(spark, sf)
    return candidates.candidates(_seeds(links), lists, CANDS).drop("popularity")


def candidate_union(spark: SparkSession, sf: str) -> DataFrame:
    links, lists, _, popular = _corpus(spark, sf)
    return candidates.merged_candidates(_seeds(links), lists, links.select("pid").distinct(), popular, CANDS, CANDS).select(
        "pid", "track_uri", "cand_rank")


def _features(spark: SparkSession, sf: str, labels: bool = True, seeds_in_truth: bool = True) -> DataFrame:
    links, near, popularity, popular = _corpus(spark, sf)
    return candidates.candidate_features(links, near, popularity, popular, labels=labels,
                                         per_seed=NEAR, max_cands=CANDS, seeds_in_truth=seeds_in_truth)


def candidate_features(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf)


def candidate_features_unseeded(spark: SparkSession, sf: str) -> DataFrame:
    """Labels without the seeds, as the learned scorer is trained on."""
    return _features(spark, sf, seeds_in_truth=False).select("pid", "track_uri", "seed_overlap", "label")


def candidate_features_full(spark: SparkSession, sf: str) -> DataFrame:
    """All features at the operators' own sizes, summed up per playlist."""
    links, near, popularity, popular, tracks = _coded_corpus(S.stored_links(spark, sf), FULL_NEAR, FULL_POPULAR)
    rows = candidates.candidate_features(links, near, popularity, popular, per_seed=FULL_NEAR, max_cands=FULL_CANDS)
    digest = rows.groupBy("pid").agg(
        F.count(F.lit(1)).alias("n_candidates"), F.sum("popularity").alias("popularity"),
        F.count_if(F.col("t2v_score") > 0).alias("n_similar"), F.sum("seed_overlap").cast("bigint").alias("n_seeds"),
        F.sum("label").cast("bigint").alias("n_relevant"), F.max("playlist_len").alias("playlist_len"),
        F.min_by("track_uri", "cand_rank").alias("first_track"), F.max_by("track_uri", "cand_rank").alias("last_track"))
    digest = materialise(digest, "digest")
    for col in ("first_track", "last_track"):
        names = tracks.select(F.col("code").alias(col), F.col("track_uri").alias("_name"))
        digest = salted_join(digest, names, col, ["pid"], how="left").withColumn(col, F.col("_name")).drop("_name")
    return digest.select("pid", "n_candidates", "popularity", "n_similar", "n_seeds", "n_relevant", "playlist_len",
                         "first_track", "last_track")


def candidate_features_unlabelled(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf, labels=False)


# -- ranking ----------------------------------------------------------------

def _blended(spark: SparkSession, sf: str) -> DataFrame:
    """A blend both engines can compute: similarity with inverse candidate rank."""
    inverse = F.lit(1.0) / (F.col("cand_rank") + 1)
    return _features(spark, sf, labels=False).withColumn(
        "final_score", F.round(ranking.blend(F.col("t2v_score"), inverse, 0.25), 10))


def rank_blend(spark: SparkSession, sf: str) -> DataFrame:
    return _blended(spark, sf).select("pid", "track_uri", "final_score")


def rank_topk(spark: SparkSession, sf: str) -> DataFrame:
    scored = _blended(spark, sf).select("pid", "track_uri", "final_score")
    return ranking.rank_topk(scored, K, side_by_side=True).select("pid", "rank", "track_uri", "final_score")


def _table(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Links and the candidate table of all playlists, at full sizes, with numbers for tracks."""
    links, near, popularity, popular, _ = _coded_corpus(S.stored_links(spark, sf), FULL_NEAR, FULL_POPULAR)
    return links, materialise(candidates.candidate_features(
        links, near, popularity, popular, per_seed=FULL_NEAR, max_cands=FULL_CANDS), "features")


def _part(links: DataFrame, part: str) -> DataFrame:
    """Playlists of one part of the train, val and test split."""
    split = splits.split_playlists(links.select("pid").distinct())
    return materialise(split.filter(F.col("split") == part).select("pid"), "part")


def affinity_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Candidate pairs whose two sides both have factors, per playlist: all of them."""
    links, table = _table(spark, sf)
    scored = als.affinity(table.select("pid", "track_uri"), als.fit_als(als.ratings_from(links)), count_on=table)
    return scored.groupBy("pid").agg(F.count(F.lit(1)).alias("n_candidates"),
                                     F.count_if(F.col("affinity") != 0).alias("n_scored")).select(
        "pid", (F.col("n_scored") > 0).alias("has_affinity"), "n_candidates")


def _ranking_digest(ranked: DataFrame) -> DataFrame:
    """Per playlist how many tracks were ranked, how many different ones, and whether scores never rise."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("rank", "final_score"))), lambda r: r["final_score"])
    return ranked.groupBy("pid").agg(F.count(F.lit(1)).alias("n_ranked"), F.countDistinct("track_uri").alias("n_distinct"),
                                     ordered.alias("_s")).select(
        "pid", "n_ranked", "n_distinct",
        F.forall(F.zip_with(F.slice("_s", 1, F.size("_s") - 1), F.slice("_s", 2, F.size("_s")), lambda a, b: a >= b),
                 lambda x: x).alias("best_first"))


def rank_playlists(spark: SparkSession, sf: str) -> DataFrame:
    """All playlists ranked at the operators' own sizes, summed up: trees fitted on a sample of the train
    part, factors on all links."""
    links, table = _table(spark, sf)
    sample = splits.sample_playlists(_part(links, "train"), TRAIN_PLAYLISTS)
    train = materialise(table.join(sample, "pid", "left_semi"), "train-features")
    ranked = ranking.rank_playlists(table.drop("label"), ranking.fit_ranker(train), als.fit_als(als.ratings_from(links)),
                                    alpha=0.1, k=FULL_K)
    return _ranking_digest(ranked)


def rank_unseen_playlists(spark: SparkSession, sf: str) -> DataFrame:
    """The test part ranked by models that saw the train part only, and all of it, at full sizes, summed up per playlist.

    What is known of an unseen playlist are its first tracks; its factor is solved from them."""
    links = S.stored_links(spark, sf)
    split = materialise(splits.split_playlists(S.playlists(spark, sf)), "split")
    seen = materialise(links.join(split.filter("split = 'train'"), "pid", "left_semi"), "seen-links")
    unseen = materialise(split.filter("split = 'test'").select("pid"), "unseen")
    coded, tracks = sequences.code_tracks(seen)
    near = _named_lists(coded, tracks, FULL_NEAR)
    popularity = tracks.select("track_uri", "popularity")
    popular = features.popular_tracks(popularity, FULL_POPULAR)
    sizes = {"per_seed": FULL_NEAR, "max_cands": FULL_CANDS}
    train = materialise(candidates.candidate_features(seen, near, popularity, popular, **sizes), "train-features")
    table = materialise(candidates.candidate_features(links, near, popularity, popular, only=unseen, labels=False, **sizes), "features")
    seeds = candidates.seed_tracks(links.join(unseen, "pid", "left_semi"))
    ratings = materialise(als.ratings_from(seeds, "ones"), "seed-ratings")
    ranked = ranking.rank_unseen(table, ratings, ranking.fit_ranker(train, rounds=ROUNDS),
                                 als.fit_als(als.ratings_from(seen, "ones")), k=FULL_K)
    known = ratings.join(popularity, "track_uri", "left_semi").groupBy("pid").agg(F.count(F.lit(1)).alias("n_known"))
    ranked = materialise(ranked, "ranked")
    affine = ranked.groupBy("pid").agg((F.count_if(F.col("affinity") != 0) > 0).alias("has_affinity"))
    return _ranking_digest(ranked).join(affine, "pid").join(known, "pid", "left").withColumn(
        "n_known", F.coalesce("n_known", F.lit(0)))


def fold_in_trained(spark: SparkSession, sf: str) -> DataFrame:
    """Factors of all playlists solved again from the item factors: whether they are the trained ones."""
    ratings = materialise(als.ratings_from(S.membership(spark, sf)), "ratings")
    rec = als.fit_als(ratings)
    folded = foldin.fold_in(ratings, foldin.item_vectors(rec))
    trained = foldin.user_vectors(rec).withColumnRenamed("vector", "trained")
    off = F.array_max(F.zip_with("vector", "trained", lambda a, b: F.abs(a - b)))
    size = F.array_max(F.transform("trained", lambda x: F.abs(x)))
    return trained.join(folded, "pid", "left").select("pid", "n_known", (off <= 0.001 * (1 + size)).alias("agrees"))


def tower_affinity(spark: SparkSession, sf: str) -> DataFrame:
    """Towers fitted on all links and three sampled negatives each: per playlist the pairs they score,
    whether their loss ends below that of a constant, and links above negatives on the whole."""
    pos = materialise(S.membership(spark, sf).distinct(), "positives")
    neg = materialise(splits.negative_samples(pos, pos).select("pid", F.col("neg_track_uri").alias("track_uri")), "negatives")
    fitted = towers.fit_towers(pos, neg, dim=32, epochs=6)
    pairs = materialise(pos.withColumn("label", F.lit(1)).unionByName(neg.withColumn("label", F.lit(0))), "pairs")
    scored = materialise(fitted.affinity(pairs, count_on=pairs), "scored")
    mean = {r.label: r.m for r in scored.groupBy("label").agg(F.avg("affinity").alias("m")).collect()}
    constant = -(0.25 * math.log(0.25) + 0.75 * math.log(0.75))  # one link to three negatives
    return scored.groupBy("pid").agg(
        F.count_if(F.col("label") == 1).alias("n_links"), F.count_if(F.col("label") == 0).alias("n_negatives"),
        F.count("affinity").alias("n_scored")).withColumns(
        {"fits": F.lit(fitted.losses[-1] < 0.9 * constant), "separates": F.lit(mean[1] > mean[0])})


def random_search(spark: SparkSession, sf: str) -> DataFrame:
    """Trials fitted on all playlists of the train part and judged on all of the val part."""
    links, near, popularity, popular, _ = _coded_corpus(S.stored_links(spark, sf), FULL_NEAR, FULL_POPULAR)
    sizes, path = {"per_seed": FULL_NEAR, "max_cands": FULL_CANDS}, run_dir(spark, "trials")
    chosen, held = _part(links, "train"), _part(links, "val")
    table = candidates.candidate_features(links, near, popularity, popular, only=chosen, **sizes)
    valid = candidates.candidate_features(links, near, popularity, popular, only=held, **sizes)
    played = links.join(held, "pid", "left_semi")
    seeds = _seeds(played).select("pid", "track_uri")
    truth = materialise(played.select("pid", "track_uri").join(seeds, ["pid", "track_uri"], "left_anti"), "truth")
    # All links but the truth: validation playlists have factors, from their seeds.
    ratings = als.ratings_from(links.join(truth.distinct(), ["pid", "track_uri"], "left_anti"))
    best_trial, _ = ranking.random_search(table, valid.drop("label"), truth, n=2, grid=SMALL_GRID, log=path, ratings=ratings)
    log = spark.read.option("header", True).option("inferSchema", True).csv(path).withColumn("trial", F.col("trial").cast("bigint"))
    best = F.max("score").over(Window.partitionBy(F.lit(1)))  # a row per trial
    return log.select("trial", ((F.col("score") <= best) & (best == best_trial["score"])).alias("at_most_best"),
                      (F.col("score").between(0, 1) & (F.col("affinity_share") > 0)).alias("in_range"))


# -- metrics ----------------------------------------------------------------

def _judged(spark: SparkSession, sf: str, k: int) -> DataFrame:
    """Seeds are the first 30 % of a playlist, the rest is the truth."""
    links, lists, _, _, _ = _coded_corpus(S.stored_links(spark, sf), FULL_NEAR)
    roles = materialise(splits.seed_truth_split(links), "roles")
    preds = candidates.judged_candidates(roles, lists, k)
    truth = roles.filter(F.col("role") == "truth").select("pid", "track_uri")
    return metrics.hit_metrics(preds.withColumnRenamed("cand_rank", "rank"), truth, k)


def _metric(col: str, name: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _judged(spark, sf, K).select("pid", F.round(col, 4).alias(name))
    return run


def hit_rate_at_k(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.mean_metric(_judged(spark, sf, K), "hit_rate").select(
        F.round("mean_hit_rate", 4).alias("hit_rate"))


def ndcg_mean(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.mean_metric(_judged(spark, sf, 100), "ndcg").select(F.round("mean_ndcg", 4).alias("ndcg"))


# -- factorisation and serving ----------------------------------------------

def als_top10(spark: SparkSession, sf: str) -> DataFrame:
    """Lists of all playlists with what exact search cannot get wrong: ``n_missed`` counts tracks of the
    playlist itself that score above the last of its list without standing in it."""
    ratings = materialise(als.ratings_from(S.membership(spark, sf)), "ratings")
    rec = als.fit_als(ratings)
    recommended = materialise(als.recommend_all(rec, K), "recommended")
    scores = F.col("recommendations.rating")
    falls = F.forall(F.zip_with(F.slice(scores, 1, F.size(scores) - 1), F.slice(scores, 2, F.size(scores)),
                                lambda a, b: a >= b), lambda x: x)
    ordered = recommended.select("pid_numeric", falls.alias("ordered"), F.array_min(scores).alias("least")).join(rec.users, "pid_numeric")
    decoded = als.decode_recs(recommended, rec.users, rec.items)
    lists = materialise(decoded.join(ordered, "pid"), "lists")
    own = foldin.score_pairs(ratings.select("pid", "track_uri"), foldin.user_vectors(rec), foldin.item_vectors(rec))
    missed = (own.join(lists, "pid").filter((F.col("affinity") > F.col("least") + 1e-4)
                                            & ~F.array_contains("recommendations", F.col("track_uri")))
              .groupBy("pid").agg(F.count(F.lit(1)).alias("n_missed")))
    return lists.join(missed, "pid", "left").select(
        "pid", F.size("recommendations").cast("bigint").alias("n_tracks"),
        F.size(F.array_distinct("recommendations")).cast("bigint").alias("n_distinct"), "ordered",
        F.coalesce("n_missed", F.lit(0)).alias("n_missed"))


def als_rmse(spark: SparkSession, sf: str) -> DataFrame:
    ratings = materialise(splits.hash_split_rows(
        als.ratings_from(S.membership(spark, sf), "ones"), ["pid", "track_uri"], 80), "ratings")
    train, valid = (ratings.filter(F.col("part") == p).drop("part") for p in ("train", "validation"))
    predicted = materialise(als.predict(als.fit_als(train), valid), "predicted")
    error = als.rmse(predicted)
    return predicted.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("in_range", F.lit(0 < error < 1))


def _recommended(spark: SparkSession, sf: str) -> DataFrame:
    links, lists, _, _ = _corpus(spark, sf)
    return candidates.track_lists(candidates.candidates(_seeds(links), lists, K))


def recommendations_kv(spark: SparkSession, sf: str) -> DataFrame:
    return serving.to_kv(_recommended(spark, sf))


def lookup_recommendations(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "kv")
    write_table(recommendations_kv(spark, sf), path)
    return serving.lookup(spark.read.parquet(path), S.playlists(spark, sf)).withColumn(
        "recommended_tracks", F.concat_ws(",", "recommended_tracks"))


def lookup_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """A point lookup of the hundred most expensive playlists and of one that does not exist."""
    path = run_dir(spark, "served")
    serving.write_served(recommendations_kv(spark, sf), path)
    orders = S.table(spark, sf, "orders")
    ids = [r[0] for r in orders.orderBy(F.desc("o_totalprice"), "o_orderkey").select("o_orderkey").limit(100).collect()]
    return serving.lookup_ids(spark, path, [*ids, -1]).withColumn(
        "recommended_tracks", F.coalesce(F.concat_ws(",", "recommended_tracks"), F.lit("")))


def artist_playlists_by_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct playlists of each artist from daily bitmaps; the second half of the days is
    added to the bitmaps of the first without reading its rows again."""
    orders = S.table(spark, sf, "orders").select(F.col("o_orderkey").alias("pid"), F.to_date("o_orderdate").alias("day"))
    rows = S.links(spark, sf).join(orders, "pid").select("artist_uri", "pid", "day")
    middle = orders.agg(F.date_from_unix_date(F.percentile_approx(F.unix_date("day"), 0.5)).alias("m")).scalar()
    ids, held = None, []
    for part in (rows.filter(F.col("day") <= middle), rows.filter(F.col("day") > middle)):
        ids = materialise(bitmaps.append_ids(ids, part, "pid"), "playlist-ids")
        held.append(materialise(bitmaps.daily_bitmaps(part, ids, ["artist_uri"], "day", "pid"), "bitmaps"))
    return bitmaps.distinct_counts(held[0].unionByName(held[1]), ["artist_uri"], "n_playlists")


def publish_by_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Changes sent by a second and a third publish: of playlists with one priority the lists get
    shorter, those with another vanish; then nothing changes any more."""
    recs = materialise(_recommended(spark, sf), "recs")
    urgency = S.table(spark, sf, "orders").select(F.col("o_orderkey").alias("pid"), "o_orderpriority")
    shorter = F.when(F.col("o_orderpriority") == "1-URGENT", F.slice("recommendations", 1, 5)).otherwise(F.col("recommendations"))
    later = recs.join(urgency, "pid").filter("o_orderpriority <> '5-LOW'").select("pid", shorter.alias("recommendations"))
    snapshots, log = run_dir(spark, "published"), run_dir(spark, "changes")
    for version in (recs, later, later):
        publish.publish_changes(serving.to_kv(version), snapshots, publish.to_log(log))
    return publish.read_log(spark, log).filter("version > 1").select(
        F.col("version").cast("int").alias("version"), "key", "op", F.coalesce("value", F.lit("")).alias("value"))


def train_publish_chain(spark: SparkSession, sf: str) -> DataFrame:
    at = Locations(*(run_dir(spark, n) for n in ("features", "flat", "daily", "model", "kv", "state", "published")))
    sent = run_dir(spark, "sent")
    events = dedup_events(clean_events(S.messages(spark, sf)))
    windows.features_5m(events).write.parquet(at.features)
    write_table(S.flat(spark, sf), at.flat)
    run_chain(spark, at, K, sink=publish.to_log(sent))
    return serving.from_kv(publish.read_log(spark, sent).filter(F.col("op") == publish.PUT)).select(
        "pid", F.size("recommendations").alias("n_recommended"))


QUERIES = {
    "artist_country_join": artist_country_join,
    "artist_meta_join": artist_meta_join,
    "implicit_ratings": implicit_ratings,
    "track_popularity": track_popularity,
    "popular_tracks_top300": popular_tracks_top300,
    "index_labels": index_labels,
    "index_alpha": index_alpha,
    "row_split": row_split,
    "known_rows": known_rows,
    "lookup_unseen_default": lookup_unseen_default,
    "sample_rows": sample_rows,
    "random_row_split": random_row_split,
    "split_playlists": split_playlists,
    "splits_roundtrip": splits_roundtrip,
    "eval_sets_roundtrip": eval_sets_roundtrip,
    "sample_playlists": sample_playlists,
    "min_tracks": min_tracks,
    "seed_truth_split": seed_truth_split,
    "negative_samples": negative_samples,
    "positive_candidates": positive_candidates,
    "playlist_sequences": playlist_sequences,
    "vector_neighbours": vector_neighbours,
    "track2vec_neighbours": track2vec_neighbours,
    "skipgram_neighbours": skipgram_neighbours,
    "factor_neighbours": factor_neighbours,
    "context_similarity": context_similarity,
    "seed_tracks": seed_tracks,
    "candidate_scores": candidate_scores,
    "candidate_union": candidate_union,
    "candidate_features": candidate_features,
    "candidate_features_unlabelled": candidate_features_unlabelled,
    "candidate_features_unseeded": candidate_features_unseeded,
    "candidate_features_full": candidate_features_full,
    "affinity_coverage": affinity_coverage,
    "rank_blend": rank_blend,
    "rank_topk": rank_topk,
    "rank_playlists": rank_playlists,
    "rank_unseen_playlists": rank_unseen_playlists,
    "fold_in_trained": fold_in_trained,
    "tower_affinity": tower_affinity,
    "random_search": random_search,
    "precision_at_k": _metric("precision", "precision"),
    "recall_at_k": _metric("recall", "recall"),
    "dcg_at_k": _metric("dcg", "dcg"),
    "ndcg_at_k": _metric("ndcg", "ndcg"),
    "average_precision": _metric("average_precision", "average_precision"),
    "hit_rate_at_k": hit_rate_at_k,
    "ndcg_mean": ndcg_mean,
    "als_top10": als_top10,
    "als_rmse": als_rmse,
    "recommendations_kv": recommendations_kv,
    "lookup_recommendations": lookup_recommendations,
    "lookup_pruned": lookup_pruned,
    "artist_playlists_by_bitmap": artist_playlists_by_bitmap,
    "publish_by_difference": publish_by_difference,
    "train_publish_chain": train_publish_chain,
}

_FLAT, _LINKS = f"WITH {Q.FLAT} ", f"WITH {Q.LINKS} "
_MEMBERS = "WITH members AS (SELECT l_orderkey AS pid, 'track:' || l_partkey AS track_uri FROM lineitem)"
_PART = f"""SELECT *, CASE WHEN {Q.hash_order("pid || '|' || track_uri")} % 100 < 80 THEN 'train'
  ELSE 'validation' END AS part FROM (SELECT DISTINCT * FROM members)"""
_SHUFFLED = f"""WITH shuffled AS (SELECT o_orderkey AS pid, row_number() OVER (
    ORDER BY {Q.hash_order("CAST(o_orderkey AS VARCHAR)")}, o_orderkey) - 1 AS rank,
    count(*) OVER () AS n FROM orders), parts AS (
  SELECT pid, rank, CASE WHEN rank < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
    WHEN rank < floor(n * CAST(0.7 AS DOUBLE)) + floor(n * CAST(0.15 AS DOUBLE)) THEN 'val'
    ELSE 'test' END AS split FROM shuffled)"""
_NEAR = f"WITH {Q.NEIGHBOURS.format(near=NEAR)}"
_NEAR_FULL = f"WITH {Q.NEIGHBOURS.format(near=FULL_NEAR)}"
_MERGED_FULL = (f"{_NEAR_FULL}, {Q.SEEDS}, {Q.SCORED.format(cands=FULL_CANDS)}, "
                f"{Q.MERGED.format(cands=FULL_CANDS, popular=FULL_POPULAR)}")
_SCORED = f"{_NEAR}, {Q.SEEDS}, {Q.SCORED.format(cands=CANDS)}"
_MERGED = f"{_SCORED}, {Q.MERGED.format(cands=CANDS, popular=POPULAR)}"
_FEATURED = f"{_MERGED}, {Q.FEATURED}"
_COLS = "pid, track_uri, CAST(cand_rank AS INTEGER) AS cand_rank, popularity, t2v_score, seed_overlap, playlist_len"
_FINAL = "round(0.75 * t2v_score + 0.25 * (CAST(1 AS DOUBLE) / (cand_rank + 1)), 10)"
_KV = f"""{_NEAR}, {Q.SEEDS}, {Q.SCORED.format(cands=K)}, recs AS (
  SELECT pid, list(track_uri ORDER BY cand_rank) AS recommendations FROM alike GROUP BY 1)"""

_UNSEEN = f"""{_SHUFFLED}, {Q.LINKS.replace("links AS", "all_links AS", 1)},
  links AS (SELECT l.* FROM all_links l JOIN parts USING (pid) WHERE split = 'train'),
  unseen AS (SELECT l.* FROM all_links l JOIN parts USING (pid) WHERE split = 'test'),
  {Q.NEIGHBOURS.removeprefix(Q.LINKS + ", ").format(near=FULL_NEAR)}, {Q.SEEDS.replace("FROM links", "FROM unseen")},
  {Q.SCORED.format(cands=FULL_CANDS)},
  {Q.MERGED.format(cands=FULL_CANDS, popular=FULL_POPULAR).replace("FROM links", "FROM unseen")}"""


def _judged_sql(k: int) -> str:
    """Per-playlist metrics from the first ``k`` similar tracks of the seeds."""
    roles = Q.ROLES.removeprefix(Q.LINKS + ", ")
    return f"""{_NEAR_FULL}, {roles}, seeds AS (SELECT pid, track_uri FROM roles WHERE role = 'seed'),
      {Q.SCORED.format(cands=k)}, truth AS (SELECT pid, track_uri FROM roles WHERE role = 'truth'),
      hits AS (SELECT pid, cand_rank AS i, CAST((pid, track_uri) IN (SELECT (pid, track_uri) FROM truth) AS INTEGER)
               AS rel FROM alike),
      ranked AS (SELECT *, sum(rel) OVER (PARTITION BY pid ORDER BY i) AS found,
                        row_number() OVER (PARTITION BY pid ORDER BY rel DESC, i) - 1 AS ideal_i FROM hits),
      sums AS (SELECT pid, sum(rel) AS n_hits, sum(rel / log2(i + 2)) AS dcg,
                      sum(rel / log2(ideal_i + 2)) AS idcg, sum(rel * found / (i + 1)) AS ap FROM ranked GROUP BY 1),
      judged AS (SELECT t.pid, coalesce(n_hits, 0) / {k} AS precision, coalesce(n_hits, 0) / n_truth AS recall,
                        coalesce(dcg, 0) AS dcg, CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0 END AS ndcg,
                        coalesce(ap, 0) / n_truth AS average_precision,
                        CASE WHEN n_hits > 0 THEN 1.0 ELSE 0.0 END AS hit_rate
                 FROM (SELECT pid, count(*) AS n_truth FROM truth GROUP BY 1) t LEFT JOIN sums USING (pid))"""


def _metric_sql(name: str) -> str:
    return _judged_sql(K) + f" SELECT pid, CAST(round({name}, 4) AS DOUBLE) AS {name} FROM judged"


ORACLES = {
    "artist_country_join": _FLAT + """SELECT pid, track_uri, track_name, f.artist_name, n_name AS country
      FROM flat f JOIN supplier ON artist_name = s_name JOIN nation ON s_nationkey = n_nationkey""",
    "artist_meta_join": _FLAT + """SELECT pid, track_uri, track_name, artist_name, country FROM flat JOIN (VALUES
      ('Supplier#000000000', 'CA'), ('Supplier#000000001', 'US'), ('Supplier#000000002', 'UK'),
      ('Supplier#000000003', 'BB')) meta(artist_name, country) USING (artist_name)""",
    "implicit_ratings": _MEMBERS + " SELECT pid, track_uri, count(*) AS rating FROM members GROUP BY 1, 2",
    "track_popularity": _MEMBERS + " SELECT track_uri, count(*) AS popularity FROM members GROUP BY 1",
    "popular_tracks_top300": _MEMBERS + """ SELECT track_uri, count(*) AS popularity FROM members GROUP BY 1
      ORDER BY popularity DESC, track_uri LIMIT 300""",
    "index_labels": _MEMBERS + """ SELECT track_uri, row_number() OVER (ORDER BY count(*) DESC, track_uri) - 1 AS idx
      FROM members GROUP BY track_uri""",
    "index_alpha": _MEMBERS + """ SELECT track_uri, row_number() OVER (ORDER BY track_uri) - 1 AS idx
      FROM (SELECT DISTINCT track_uri FROM members)""",
    "row_split": f"{_MEMBERS} {_PART}",
    "known_rows": f"""{_MEMBERS}, parts AS ({_PART}) SELECT * FROM parts WHERE part = 'validation'
      AND pid IN (SELECT pid FROM parts WHERE part = 'train')
      AND track_uri IN (SELECT track_uri FROM parts WHERE part = 'train')""",
    "lookup_unseen_default": f"""{_MEMBERS}, rows AS (SELECT DISTINCT * FROM members), parts AS ({_PART}), seen AS (
      SELECT track_uri, row_number() OVER (ORDER BY track_uri) - 1 AS idx FROM (SELECT DISTINCT track_uri FROM parts
      WHERE part = 'train'))
      SELECT pid, track_uri, coalesce(idx, -1) AS idx, coalesce(idx, (SELECT count(*) FROM seen)) AS idx_or_last
      FROM rows LEFT JOIN seen USING (track_uri)""",
    "split_playlists": _SHUFFLED + " SELECT pid, split FROM parts",
    "splits_roundtrip": _SHUFFLED + " SELECT split, count(*) AS n_playlists FROM parts GROUP BY 1",
    "eval_sets_roundtrip": f"""WITH {Q.ROLES} SELECT pid, pos // 1000 AS part,
      coalesce(string_agg(track_uri, ',' ORDER BY pos) FILTER (role = 'seed'), '') AS seed_tracks,
      coalesce(string_agg(track_uri, ',' ORDER BY pos) FILTER (role = 'truth'), '') AS gt_tracks FROM roles GROUP BY 1, 2""",
    "sample_playlists": _SHUFFLED + f" SELECT pid FROM parts WHERE rank < {TRAIN_PLAYLISTS}",
    "min_tracks": _MEMBERS + " SELECT pid, count(*) AS n_tracks FROM members GROUP BY 1 HAVING count(*) >= 5",
    "seed_truth_split": f"WITH {Q.ROLES} SELECT * FROM roles",
    "negative_samples": f"""{_MEMBERS}, codes AS (SELECT track_uri AS neg_track_uri, row_number() OVER (
        ORDER BY track_uri) - 1 AS idx, count(*) OVER () AS n FROM (SELECT DISTINCT track_uri FROM members)),
      draws AS (SELECT pid, track_uri, CAST(d AS INTEGER) AS draw FROM (SELECT DISTINCT * FROM members), range(1, 4) r(d))
      SELECT pid, track_uri, draw, neg_track_uri FROM draws JOIN codes
      ON idx = {Q.hash_order("pid || '|' || track_uri || '|' || draw")} % (SELECT count(*) FROM codes)""",
    "positive_candidates": _FEATURED + """ SELECT pid, track_uri, CAST(cand_rank AS INTEGER) AS cand_rank FROM featured
      WHERE label = 1""",
    "playlist_sequences": _LINKS + """SELECT pid, pos // 1000 AS chunk, string_agg(track_uri, ',' ORDER BY pos) AS tracks
      FROM links GROUP BY 1, 2""",
    "vector_neighbours": """SELECT vec_id, neighbour, round(score, 4) AS score, CAST(rank AS INTEGER) AS rank FROM (
      SELECT a.vec_id, b.vec_id AS neighbour, list_cosine_similarity(a.e, b.e) AS score, row_number() OVER (
        PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.e, b.e), 9) DESC, b.vec_id) AS rank
      FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) a
      JOIN (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) b ON a.vec_id <> b.vec_id)
      WHERE rank <= 5""",
    "context_similarity": _NEAR + """ SELECT track_uri, neighbour, score, CAST(rank AS INTEGER) AS rank FROM near""",
    "seed_tracks": f"WITH {Q.LINKS}, {Q.SEEDS} SELECT pid, track_uri, CAST(seed_no AS INTEGER) AS seed_no FROM seeds",
    "candidate_scores": _SCORED + """ SELECT pid, track_uri, t2v_score, CAST(cand_rank AS INTEGER) AS cand_rank
      FROM alike""",
    "candidate_union": _MERGED + " SELECT pid, track_uri, CAST(cand_rank AS INTEGER) AS cand_rank FROM merged",
    "candidate_features": f"{_FEATURED} SELECT {_COLS}, label FROM featured",
    "candidate_features_unlabelled": f"{_FEATURED} SELECT {_COLS} FROM featured",
    "candidate_features_unseeded": f"""{_FEATURED} SELECT pid, track_uri, seed_overlap,
      CASE WHEN seed_overlap = 1 THEN 0 ELSE label END AS label FROM featured""",
    "candidate_features_full": f"""WITH {Q.NEIGHBOURS.format(near=FULL_NEAR)}, {Q.SEEDS}, {Q.SCORED.format(cands=FULL_CANDS)},
      {Q.MERGED.format(cands=FULL_CANDS, popular=FULL_POPULAR)}, {Q.FEATURED} SELECT pid, count(*) AS n_candidates,
      CAST(sum(popularity) AS BIGINT) AS popularity, count(*) FILTER (t2v_score > 0) AS n_similar,
      CAST(sum(seed_overlap) AS BIGINT) AS n_seeds, CAST(sum(label) FILTER (seed_overlap = 0) AS BIGINT) AS n_relevant,
      max(playlist_len) AS playlist_len, arg_min(track_uri, cand_rank) AS first_track,
      arg_max(track_uri, cand_rank) AS last_track FROM featured GROUP BY pid""",
    "rank_playlists": f"""{_MERGED_FULL} SELECT pid, count(*) AS n_ranked, count(DISTINCT track_uri) AS n_distinct,
      true AS best_first FROM merged GROUP BY pid""",
    "affinity_coverage": f"{_MERGED_FULL} SELECT pid, true AS has_affinity, count(*) AS n_candidates FROM merged GROUP BY pid",
    **{name: _MEMBERS + f""" SELECT track_uri, least({FULL_NEAR}, count(*) OVER () - 1) AS n_neighbours,
      least({FULL_NEAR}, count(*) OVER () - 1) AS n_distinct, true AS no_self, true AS falls
      FROM (SELECT DISTINCT track_uri FROM members)"""
       for name in ("track2vec_neighbours", "skipgram_neighbours", "factor_neighbours")},
    "random_search": "SELECT CAST(t AS BIGINT) AS trial, true AS at_most_best, true AS in_range FROM range(1, 3) r(t)",
    "rank_unseen_playlists": f"""{_UNSEEN}, known AS (SELECT pid, count(DISTINCT track_uri) AS n_known FROM seeds
      WHERE track_uri IN (SELECT track_uri FROM links) GROUP BY 1)
      SELECT pid, count(*) AS n_ranked, count(DISTINCT track_uri) AS n_distinct, true AS best_first,
        coalesce(any_value(n_known), 0) AS n_known, coalesce(any_value(n_known), 0) > 0 AS has_affinity
      FROM merged LEFT JOIN known USING (pid) GROUP BY pid""",
    "fold_in_trained": _MEMBERS + " SELECT pid, count(DISTINCT track_uri) AS n_known, true AS agrees FROM members GROUP BY 1",
    "tower_affinity": _MEMBERS + """ SELECT pid, count(DISTINCT track_uri) AS n_links, 3 * count(DISTINCT track_uri) AS n_negatives,
      4 * count(DISTINCT track_uri) AS n_scored, true AS fits, true AS separates FROM members GROUP BY 1""",
    "als_top10": _MEMBERS + f""" SELECT pid, least({K}, (SELECT count(DISTINCT track_uri) FROM members)) AS n_tracks,
      least({K}, (SELECT count(DISTINCT track_uri) FROM members)) AS n_distinct, true AS ordered,
      CAST(0 AS BIGINT) AS n_missed FROM (SELECT DISTINCT pid FROM members)""",
    "als_rmse": f"""{_MEMBERS}, parts AS ({_PART}) SELECT count(*) AS n_rows, true AS in_range FROM parts
      WHERE part = 'validation' AND pid IN (SELECT pid FROM parts WHERE part = 'train')
      AND track_uri IN (SELECT track_uri FROM parts WHERE part = 'train')""",
    "rank_blend": f"{_MERGED} SELECT pid, track_uri, {_FINAL} AS final_score FROM merged",
    "rank_topk": f"""{_MERGED}, finals AS (SELECT pid, track_uri, {_FINAL} AS final_score FROM merged)
      SELECT pid, CAST(rank AS INTEGER) AS rank, track_uri, final_score FROM (SELECT *, row_number() OVER (
        PARTITION BY pid ORDER BY final_score DESC, track_uri) - 1 AS rank FROM finals) WHERE rank < {K}""",
    "precision_at_k": _metric_sql("precision"),
    "recall_at_k": _metric_sql("recall"),
    "dcg_at_k": _metric_sql("dcg"),
    "ndcg_at_k": _metric_sql("ndcg"),
    "average_precision": _metric_sql("average_precision"),
    "hit_rate_at_k": _judged_sql(K) + " SELECT round(avg(hit_rate), 4) AS hit_rate FROM judged",
    "ndcg_mean": _judged_sql(100) + " SELECT round(avg(ndcg), 4) AS ndcg FROM judged",
    "recommendations_kv": _KV + """ SELECT 'recommendations:' || pid AS key,
      '["' || array_to_string(recommendations, '","') || '"]' AS value FROM recs""",
    "lookup_pruned": _KV + """, asked AS (SELECT o_orderkey AS pid FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100)
      SELECT a.pid, recommendations IS NOT NULL AS found, coalesce(array_to_string(recommendations, ','), '') AS recommended_tracks
      FROM (SELECT pid FROM asked UNION ALL SELECT -1) a LEFT JOIN recs USING (pid)""",
    "artist_playlists_by_bitmap": """SELECT 'artist:' || l_suppkey AS artist_uri, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n_playlists
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "publish_by_difference": _KV + """ SELECT 2 AS version, 'recommendations:' || pid AS key,
      CASE WHEN o_orderpriority = '5-LOW' THEN 'remove' ELSE 'put' END AS op, CASE WHEN o_orderpriority = '5-LOW' THEN ''
      ELSE '["' || array_to_string(recommendations[1:5], '","') || '"]' END AS value
      FROM recs JOIN orders ON o_orderkey = pid
      WHERE o_orderpriority = '5-LOW' OR (o_orderpriority = '1-URGENT' AND len(recommendations) > 5)""",
    "train_publish_chain": f"""WITH {Q.F5M} SELECT pid, CAST(least({K}, (SELECT count(DISTINCT track_uri) FROM (
        SELECT 'track:' || l_partkey AS track_uri FROM lineitem UNION SELECT track_uri FROM f5m))) AS INTEGER) AS n_recommended
      FROM (SELECT l_orderkey AS pid FROM lineitem UNION SELECT pid FROM f5m)""",
    "lookup_recommendations": _KV + """ SELECT o_orderkey AS pid, recommendations IS NOT NULL AS found,
      coalesce(array_to_string(recommendations, ','), '') AS recommended_tracks
      FROM orders LEFT JOIN recs ON pid = o_orderkey""",
}
