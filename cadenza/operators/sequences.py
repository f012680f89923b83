"""Playlist sequences and what stands near what in them, block by block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.features import track_popularity
from cadenza.operators.ordering import BLOCK, dense_index, first_per_key
from cadenza.operators.skew import salted_join
from cadenza.workspace import materialise


def playlist_sequences(links: DataFrame, block: int = BLOCK, overlap: int = 0) -> DataFrame:
    """(pid, chunk, tracks): ordered tracks in runs of at most ``block``, each
    followed by the first ``overlap`` tracks of the next one.

    A long playlist becomes several consecutive runs, so no row and no task
    holds a whole one.
    """
    own = F.floor(F.col("pos") / F.lit(block)).cast("bigint")
    placed = links.withColumn("chunk", own)
    if overlap:
        runs = F.when((F.col("pos") % block < overlap) & (own > 0), F.array(own - 1, own)).otherwise(F.array(own))
        placed = links.withColumn("chunk", F.explode(runs))
    return (placed.groupBy("pid", "chunk")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "track_uri"))).alias("_run"))
            .select("pid", "chunk", F.col("_run.track_uri").alias("tracks")))


def _met(links: DataFrame, window: int, block: int, carry: list[str]) -> DataFrame:
    """(a_track_uri, b_track_uri, n): how often the smaller track a and the larger b stand within ``window``
    positions, with what each carries (a_..., b_...), columns that depend on the track alone.
    Plain columns take less room in a shuffle than structs.

    Every row meets at most ``window`` followers. Each block also receives the
    first ``window`` rows of the next one, so nothing is lost at the seams and
    no task needs more than ``block + window`` rows of one playlist.
    """
    own = F.floor(F.col("pos") / F.lit(block))
    halo = F.when((F.col("pos") % block < window) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    track = F.struct("track_uri", *carry)
    placed = links.select("pid", track.alias("t"), "pos", own.alias("_own"), F.explode(halo).alias("_block"))
    order = Window.partitionBy("pid", "_block").orderBy("pos")
    followers = F.array(*[F.lead("t", d).over(order) for d in range(1, window + 1)])
    met = (placed.withColumn("_next", followers).filter(F.col("_own") == F.col("_block"))
           .select("t", F.explode(F.array_compact("_next")).alias("u"))
           .filter(F.col("t.track_uri") != F.col("u.track_uri")))
    # Combine one direction first: half the rows to shuffle.
    pairs = met.select(F.least("t", "u").alias("a"), F.greatest("t", "u").alias("b"))
    return pairs.groupBy(*[F.col(f"{e}.{c}").alias(f"{e}_{c}") for e in "ab" for c in ("track_uri", *carry)]).agg(F.count(F.lit(1)).alias("n"))


def _both_ways(once: DataFrame, kept: str, *carry: str) -> DataFrame:
    """(track_uri, neighbour, kept) and what the neighbour carries: every pair from either end."""
    ends = [F.struct(F.col(f"{t}_track_uri").alias("track_uri"), F.col(f"{u}_track_uri").alias("neighbour"),
                     *[F.col(f"{u}_{c}").alias(c) for c in carry]) for t, u in ("ab", "ba")]
    return once.select(kept, F.explode(F.array(*ends)).alias("p")).select("p.track_uri", "p.neighbour", kept, *[f"p.{c}" for c in carry])


def context_pairs(links: DataFrame, window: int = 5, block: int = BLOCK) -> DataFrame:
    """(track_uri, neighbour, n): how often two tracks stand within ``window``
    positions of each other in a playlist."""
    return _both_ways(_met(links, window, block, []), "n")


def code_tracks(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links with a number for each track, in the order of the tracks, and its popularity; and the dictionary
    (track_uri, popularity, code). Numbers take less room in pairs and lists; null stays null."""
    tracks = materialise(dense_index(track_popularity(links), ["track_uri"], "code")
                         .withColumn("code", F.when(F.col("track_uri").isNotNull(), F.col("code").cast("int"))), "tracks")
    coded = salted_join(links.select("pid", "track_uri", "pos"), tracks, "track_uri", ["pid", "pos"], how="left")
    return coded.select("pid", F.col("code").alias("track_uri"), "pos", "popularity"), tracks


def named(edges: DataFrame, tracks: DataFrame, both: bool = True) -> DataFrame:
    """``edges`` (track_uri, neighbour, ...) with numbers of ``code_tracks`` back as tracks, those of neighbours
    alone without ``both``; pass a stored table."""
    for col, other in (("neighbour", "track_uri"), ("track_uri", "neighbour"))[:1 + both]:
        names = tracks.select(F.col("code").alias(col), F.col("track_uri").alias("_name"))
        edges = salted_join(edges, names, col, [other], count_on=None if col == "neighbour" else edges).drop(col).withColumnRenamed("_name", col)
    return edges


def context_similarity(links: DataFrame, k: int = 200, window: int = 5, popularity: bool = False) -> DataFrame:
    """(track_uri, neighbour, score, rank): the ``k`` tracks most often met
    nearby, scored n / sqrt(popularity x popularity), ties by id.

    Popularity is joined to the links, of which there are far fewer than pairs, and
    travels with each track, unless they bring it; ``popularity`` adds that of the neighbour.
    """
    counted = links if "popularity" in links.columns else salted_join(links.select("pid", "track_uri", "pos"), track_popularity(links), "track_uri", ["pid", "pos"], how="left")
    carried = ["popularity"] if popularity else []
    coded = counted.schema["track_uri"].dataType.typeName() == "integer"
    if coded:  # number and popularity in one, in the order of the numbers
        met = _met(counted.withColumn("track_uri", _joint()), window, BLOCK, [])
        spread = [F.col(f"{e}_track_uri").bitwiseAND(F.lit(_LOW)) for e in "ab"]
    else:
        met = _met(counted, window, BLOCK, ["popularity"])
        spread = [F.col("a_popularity"), F.col("b_popularity")]
    # Scores of six digits are shuffled as whole numbers, which take less room.
    score = F.round(F.col("n") / F.sqrt(spread[0] * spread[1]), 6)
    whole = met.withColumn("millionths", F.round(score * 1_000_000).cast("bigint"))
    scored = _both_ways(whole, "millionths", *([] if coded else carried))
    if coded:
        scored = scored.withColumn("track_uri", F.shiftright("track_uri", 32).cast("int"))
    best = first_per_key(scored, "track_uri", [F.desc("millionths"), "neighbour"], k)
    if coded:
        best = best.withColumns({"popularity": F.col("neighbour").bitwiseAND(F.lit(_LOW)),
                                 "neighbour": F.shiftright("neighbour", 32).cast("int")})
    return best.select("track_uri", "neighbour", (F.col("millionths") / F.lit(1e6)).alias("score"), "rank", *carried)


_LOW = (1 << 32) - 1


def _joint() -> Column:
    """A track's number above its popularity, which must be below 2^32."""
    low = F.when(F.col("popularity") <= F.lit(_LOW), F.col("popularity")).when(
        F.col("popularity").isNotNull(), F.raise_error(F.lit("a track stands in 2^32 places or more")).cast("bigint"))
    return F.shiftleft(F.col("track_uri").cast("bigint"), 32).bitwiseOR(low)
