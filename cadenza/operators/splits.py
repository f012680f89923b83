"""Samples and train/validation/test splits that any engine can reproduce."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.columns import hash_order
from cadenza.operators.indexing import index_alpha, size_of
from cadenza.operators.ordering import BLOCK, hash_rank
from cadenza.operators.skew import salted_join


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample."""
    return df.sample(fraction=fraction, seed=seed)


def split_rows(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    """Random row split. Pass a materialised frame: the parts re-evaluate it."""
    return df.randomSplit(weights, seed=seed)


def hash_split_rows(df: DataFrame, key: list[str], percent: int, seed: int = 42) -> DataFrame:
    """Row split by key hash: ``part`` is 'train' for ``percent`` of the keys."""
    share = hash_order(F.concat_ws("|", *key), seed) % 100
    return df.withColumn("part", F.when(share < percent, "train").otherwise("validation"))


def split_playlists(playlists: DataFrame, train: float = 0.7, val: float = 0.15,
                    seed: int = 42) -> DataFrame:
    """Whole playlists to train/val/test: floor counts, remainder to test."""
    n = size_of(playlists)
    n_train = F.floor(n * F.lit(train))
    n_val = F.floor(n * F.lit(val))
    part = (F.when(F.col("_rank") < n_train, "train")
            .when(F.col("_rank") < n_train + n_val, "val").otherwise("test"))
    return hash_rank(playlists, "pid", seed, "_rank").withColumn("split", part).drop("_rank")


def sample_playlists(playlists: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` random playlists: each task offers its own first ``n``, nothing is sorted whole."""
    return playlists.orderBy(hash_order(F.col("pid"), seed), "pid").limit(n)


def min_tracks(links: DataFrame, n: int) -> DataFrame:
    """Playlists with at least ``n`` tracks, with their length."""
    return (links.groupBy("pid").agg(F.count(F.lit(1)).alias("n_tracks"))
            .filter(F.col("n_tracks") >= n))


def seed_truth_split(links: DataFrame, ratio: float = 0.3, at_least: int = 5) -> DataFrame:
    """Role of every row of a long-enough playlist: the first
    max(1, int(n * ratio)) positions are 'seed', the rest 'truth'.

    Row form: no playlist is ever held in one value.
    """
    k = F.greatest(F.lit(1), F.floor(F.col("n_tracks") * F.lit(ratio)))
    return (salted_join(links, min_tracks(links, at_least), "pid", ["pos"])
            .withColumn("role", F.when(F.col("pos") < k, "seed").otherwise("truth")))


def eval_sets(roles: DataFrame, block: int = BLOCK) -> DataFrame:
    """(pid, part, seed_tracks, gt_tracks) of rows with a role, in order. A playlist longer than
    ``block`` goes on in further parts, so no record grows without bound."""
    part = F.floor(F.col("pos") / block)

    def of(role: str) -> Column:
        rows = F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("pos", "track_uri"))))
        return F.transform(rows, lambda r: r["track_uri"])

    return roles.groupBy("pid", part.alias("part")).agg(of("seed").alias("seed_tracks"), of("truth").alias("gt_tracks"))


def positives(df: DataFrame) -> DataFrame:
    return df.filter(F.col("label") == 1)


def negative_samples(pos: DataFrame, tracks: DataFrame, n: int = 3, seed: int = 42,
                     exclude: DataFrame | None = None) -> DataFrame:
    """``n`` random tracks per positive (pid, track_uri), drawn with replacement.

    A draw is a hash of (pid, track, draw number), so reruns agree; it may hit a
    positive unless ``exclude`` (pid, track_uri) is given. Draws are uniform
    over the dictionary, which keeps the join on the index even.
    """
    dictionary = index_alpha(tracks, "track_uri", "_idx").withColumnRenamed("track_uri", "neg_track_uri")
    drawn = pos.select("pid", "track_uri", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("draw"))
    key = F.concat_ws("|", F.col("pid").cast("string"), "track_uri", F.col("draw").cast("string"))
    picked = (drawn.withColumn("_idx", hash_order(key, seed) % size_of(dictionary))
              .join(dictionary, "_idx").drop("_idx"))
    if exclude is not None:
        taken = exclude.select("pid", F.col("track_uri").alias("neg_track_uri"))
        picked = picked.join(taken, ["pid", "neg_track_uri"], "left_anti")
    return picked.select("pid", "track_uri", "draw", "neg_track_uri")
