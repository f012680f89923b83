"""MinHash near-duplicates by a multi-index Hamming join.

A document's set of word shingles gives ``symbols`` minima, each cut to 16
bits. The signature distance of two documents is the number of symbols that
differ. The signature is split into ``chunks`` ranges; if at most
``2 * chunks - 1`` symbols differ, some range has at most one error, so the
two agree on that range with one position left out. Every document therefore
files itself under each (range, omitted position, other symbols), and every
pair under the distance threshold meets in at least one bucket.

Buckets are never expanded into all pairs. First each member is held against
its bucket's smallest member; confirmed links join most of a bucket into one
component. Members of one bucket that are still in different components are
then held against each other by size and signature, without their texts; those
with a near partner are paired, in the first bucket that they share. Each link is confirmed
on the full sets, so missing a link takes a signature that misjudges a pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import lower_words, mix, word_hashes
from cadenza.llm.components import components
from cadenza.workspace import materialise

SYMBOLS, CHUNKS = 48, 11
BLOCK = 512  # documents on one side of a block pair
SIGNED_BLOCK = 4096  # signatures on one side of a block pair, without texts
_LANES = SYMBOLS // 4  # 16-bit symbols, four to a long
_SEEDS = np.random.default_rng(20240501).integers(1, 2**63, SYMBOLS).astype(np.uint64)
_CHUNK_STARTS = np.array([part[0] for part in np.array_split(np.arange(SYMBOLS), CHUNKS)])
_CHUNK_OF = np.repeat(np.arange(CHUNKS), np.diff([*_CHUNK_STARTS, SYMBOLS]))
_SLICE = 8192  # shingles hashed at a time: bounded memory for any text


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of word shingles; the whole sequence counts
    as one where there are fewer words than ``size``."""
    words = word_hashes(lower_words(text))
    if not len(words):
        return words
    width = min(size, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[i:len(words) - width + 1 + i], i + 1)
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Packed signature: ``_LANES`` longs of four 16-bit minima."""
    least = np.full(SYMBOLS, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), _SLICE):
        hashed = (shingles[None, at:at + _SLICE] ^ _SEEDS[:, None]) * np.uint64(0xFF51AFD7ED558CCD)
        hashed ^= hashed >> np.uint64(32)
        hashed *= np.uint64(0xC4CEB9FE1A85EC53)
        least = np.minimum(least, hashed.min(axis=1))
    low = (least & np.uint64(0xFFFF)).reshape(_LANES, 4)
    return (low << (np.arange(4, dtype=np.uint64) * np.uint64(16))).sum(axis=1, dtype=np.uint64).view(np.int64)


_LANE_COLS = [f"s{i}" for i in range(_LANES)]


def _symbol(i: int) -> Column:
    return F.shiftrightunsigned(f"s{i // 4}", 16 * (i % 4)).bitwiseAND(F.lit(0xFFFF))


def _bucket_keys() -> Column:
    """One key for every range and omitted position in it: as many as symbols, in their order."""
    keys = []
    for chunk, members in enumerate(np.array_split(np.arange(SYMBOLS), CHUNKS)):
        for omitted in members:
            keys.append(F.xxhash64(F.lit(chunk), F.lit(int(omitted)),
                                   *[_symbol(int(i)) for i in members if i != omitted]))
    return F.array(*keys)


def _differing(left: str, right: str) -> Column:
    """Differing symbols of two packed signatures."""
    total = F.lit(0)
    for lane in _LANE_COLS:
        x = F.col(f"{left}.{lane}").bitwiseXOR(F.col(f"{right}.{lane}"))
        for shift in range(0, 64, 16):
            total = total + F.when(F.shiftrightunsigned(x, shift).bitwiseAND(F.lit(0xFFFF)) != 0, 1).otherwise(0)
    return total


def _shingled(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                found = shingle_set(text, size)
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None
                rows.append((len(found), digest, *(signature(found).tolist() if digest else [None] * _LANES)))
            out = pd.DataFrame(rows, columns=["n_shingles", "digest", *_LANE_COLS])
            out[_LANE_COLS] = out[_LANE_COLS].astype("Int64")
            yield pd.concat([pdf[["id", "text_hash"]].reset_index(drop=True), out], axis=1)

    lanes = ", ".join(f"{c} long" for c in _LANE_COLS)
    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                        F.xxhash64(text_col).alias("text_hash"))
            .mapInPandas(run, f"id long, text_hash long, n_shingles long, digest binary, {lanes}"))


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, last_set = None, None
        for pdf in batches:
            keep = []
            for a, text_a, text_b in zip(pdf["a"], pdf["text_a"], pdf["text_b"]):
                if a != last:
                    last, last_set = a, shingle_set(text_a, size)
                other = shingle_set(text_b, size)
                both = len(last_set) + len(other) - len(np.union1d(last_set, other))
                keep.append(100 * both >= percent * (len(last_set) + len(other) - both))
            yield pdf.loc[keep, ["a", "b"]]

    right = texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b"))
    left = texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a"))
    return pairs.join(right, "b").join(left, "a").mapInPandas(run, "a long, b long")


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs within the signature distance that the buckets guarantee, and of
    sizes that allow the similarity."""
    signed = classes.select("cls", "size", F.struct(*_LANE_COLS).alias("sig"))
    sizes = F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * percent
    return (pairs.join(signed.toDF("a", "size_a", "sig_a"), "a").join(signed.toDF("b", "size_b", "sig_b"), "b")
            .filter(sizes & (_differing("sig_a", "sig_b") < 2 * CHUNKS)).select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    ``component_id`` is the smallest id reachable over links of ``percent`` or
    more of shared shingles, the row's own included; ``kept`` marks that row.
    Null, empty and blank texts have no shingles and are linked with nothing.
    Rows that repeat an id and text are copies of each other, all kept or none.
    A null id is larger than any other: it represents only a component of its
    own, and ``kept`` is then true. Other columns are ignored.
    """
    rows = materialise(_shingled(docs, id_col, text_col, shingle), "shingled")
    classes = materialise(
        rows.filter("n_shingles > 0").groupBy("digest")
        .agg(F.first("n_shingles").alias("size"), F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("first"),
             *[F.first(c).alias(c) for c in _LANE_COLS])
        .select(F.monotonically_increasing_id().alias("cls"), "digest", "size", "first.id", "first.text_hash",
                *_LANE_COLS),
        "classes")

    filed = classes.select("cls", F.posexplode(_bucket_keys()).alias("slot", "key"))
    # What was aggregated is stored before it is joined back: Spark splits a hot
    # bucket only where both sides of the join are plain shuffles.
    shared = materialise(filed.groupBy("key").agg(F.min("cls").alias("leader"), F.max("cls").alias("last"))
                         .filter("leader < last").select("key", "leader"), "shared")
    buckets = materialise(filed.join(shared, "key"), "buckets")
    wanted = classes.join(buckets.select("cls").distinct(), "cls", "left_semi").select("cls", "id", "text_hash")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                         F.xxhash64(text_col).alias("text_hash"))
    texts = materialise(
        wanted.withColumnsRenamed({"id": "_id"})
        .join(source, (F.col("_id").eqNullSafe(F.col("id"))) & (wanted["text_hash"] == source["text_hash"]))
        .select("cls", "text"), "texts")

    to_leader = buckets.filter("cls <> leader").select(F.col("leader").alias("a"), F.col("cls").alias("b")).distinct()
    links = materialise(_confirm(_near(to_leader, classes, percent), texts, shingle, percent), "links")
    more = materialise(_missed(buckets, components(links), classes, texts, shingle, percent), "links")
    roots = components(links.unionByName(more))

    named = classes.join(roots.withColumnRenamed("id", "cls"), "cls", "left").select(
        "digest", "id", F.coalesce("root", "cls").alias("root"))
    smallest = materialise(named.groupBy("root").agg(F.min("id").alias("component_id")), "smallest")
    known = named.join(smallest, "root").select("digest", "component_id")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return (rows.select("id", "n_shingles", "digest").join(known, "digest", "left")
            .select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                    F.col("id").eqNullSafe(component).alias("kept")))


def _missed(buckets: DataFrame, roots: DataFrame, classes: DataFrame, texts: DataFrame,
            size: int, percent: int) -> DataFrame:
    """Links (a, b) between members of a bucket that no chain of links joins so far.

    A member outside the component of its bucket's leader is a straggler.
    Stragglers, in blocks, are held against each other and against the blocks of
    the other members; all have been held against the leader. Signatures tell first
    which of them have a near partner at all: only these come with their texts.
    """
    of_leader = roots.toDF("leader", "leader_root")
    tagged = (buckets.join(roots.toDF("cls", "root"), "cls", "left").join(of_leader, "leader", "left")
              .filter("cls <> leader")
              .select("key", "slot", "cls", F.coalesce("root", "cls").alias("root"),
                      (F.coalesce("root", "cls") != F.coalesce("leader_root", "leader")).alias("strays")))
    # A crowd that shares a passage meets in many buckets and is far apart in all of them.
    signed = _dealt(tagged, SIGNED_BLOCK).join(classes.select("cls", "size", *_LANE_COLS), "cls")
    close = materialise(_by_task(signed, _close_members(percent), "key long, cls long").distinct(), "close")
    dealt = _dealt(tagged.join(close, ["key", "cls"], "left_semi"), BLOCK)
    full = dealt.join(classes.select("cls", "size", *_LANE_COLS), "cls").join(texts, "cls")
    return _by_task(full, lambda rows: _block_links(rows, size, percent), "a long, b long").distinct()


_TASK = ["key", "kind", "i", "j"]


def _dealt(tagged: DataFrame, size: int) -> DataFrame:
    """(cls, root, key, slot, kind, i, j, side): members of buckets, once for each block pair they take part in.

    A pair of kind "s" holds blocks of stragglers, or one of them (side 2) with itself and
    with the first block of other members; one of kind "m" holds a block of stragglers (side 0) and one of
    the later blocks of others (side 1).
    """
    counts = materialise(
        tagged.groupBy("key").agg(F.count_if("strays").alias("n_s"), F.count_if(~F.col("strays")).alias("n_m"))
        .filter("n_s > 0 and n_s + n_m > 1")
        .select("key", F.ceil(F.col("n_s") / size).cast("int").alias("b_s"),
                F.greatest(F.ceil(F.col("n_m") / size).cast("int"), F.lit(1)).alias("b_m")), "crowded")

    def task(kind: Column, i: Column, j: Column, side: Column) -> Column:
        return F.struct(kind.alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))

    own = F.col("own")
    block = F.pmod(F.xxhash64("cls"), F.when(F.col("strays"), F.col("b_s")).otherwise(F.col("b_m"))).cast("int")
    among = F.transform(F.sequence(F.lit(0), F.col("b_s") - 1), lambda j: task(
        F.lit("s"), F.least(own, j), F.greatest(own, j), F.when(j == own, 2).when(own < j, 0).otherwise(1)))
    against = F.transform(F.slice(F.sequence(F.lit(0), F.col("b_m") - 1), F.lit(2), F.col("b_m")),
                          lambda j: task(F.lit("m"), own, j, F.lit(0)))
    offered = F.transform(F.sequence(F.lit(0), F.col("b_s") - 1), lambda i: task(
        F.when(own == 0, "s").otherwise("m"), i, F.when(own == 0, i).otherwise(own), F.lit(1)))
    tasks = F.when(F.col("strays"), F.concat(among, against)).otherwise(offered)
    return (tagged.join(counts, "key").withColumn("own", block)
            .select("cls", "root", "key", "slot", F.explode(tasks).alias("t")).select("cls", "root", "key", "slot", "t.*"))


def _by_task(rows: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``work`` on the rows of each block pair."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            last = (pdf[_TASK] == pdf[_TASK].iloc[-1]).all(axis=1) if len(pdf) else None
            if last is None or last.all():
                held = pdf
                continue
            held = pdf[last]
            for _, task_rows in pdf[~last].groupby(_TASK, sort=False):
                yield work(task_rows)
        if held is not None and len(held):
            yield work(held)

    return rows.repartition(*_TASK).sortWithinPartitions(*_TASK).mapInPandas(run, schema)


def _near_here(symbols: np.ndarray, own: np.ndarray, slot: int) -> np.ndarray:
    """Which signatures are within the distance of ``own`` and first meet it under this range and omitted
    position (``slot``): a pair shares many buckets, and one of them is enough."""
    off = symbols != own
    at = np.flatnonzero(off.sum(axis=1) < 2 * CHUNKS)
    off = off[at]
    wrong = np.add.reduceat(off, _CHUNK_STARTS, axis=1, dtype=np.int64)
    chunk = (wrong <= 1).argmax(axis=1)
    omitted = (off & (_CHUNK_OF == chunk[:, None])).argmax(axis=1)
    first = np.where(wrong[np.arange(len(at)), chunk] == 0, _CHUNK_STARTS[chunk], omitted)
    return at[first == slot]


def _close_members(percent: int):
    """Members of a block pair that have a partner of another component on the other side, near by size and signature."""
    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ignore_index=True)
        side, sizes, roots, slots = (pdf[c].to_numpy() for c in ("side", "size", "root", "slot"))
        symbols = np.ascontiguousarray(pdf[_LANE_COLS].to_numpy(np.int64)).view(np.uint16)
        right = np.flatnonzero(side > 0)
        r_sizes, r_roots, r_symbols = sizes[right], roots[right], symbols[right]
        close = np.zeros(len(pdf), bool)
        left = np.flatnonzero(side != 1)
        # Sizes ascend, so partners of a size that allows the similarity are one run.
        starts = np.searchsorted(r_sizes * 100, sizes[left] * percent)
        ends = np.searchsorted(r_sizes * percent, sizes[left] * 100, side="right")
        for x, lo, hi in zip(left.tolist(), starts.tolist(), ends.tolist()):
            near = lo + np.flatnonzero(r_roots[lo:hi] != roots[x])
            near = near[_near_here(r_symbols[near], symbols[x], slots[x])]
            if len(near):
                close[x] = True
                close[right[near]] = True
        return pd.DataFrame({"key": pdf["key"], "cls": pdf["cls"]})[close]
    return work


def _block_links(pdf: pd.DataFrame, size: int, percent: int) -> pd.DataFrame:
    """Links between the two sides of a block pair, one for each pair of
    components that they join."""
    side, names, sizes, slots = (pdf[c].to_numpy() for c in ("side", "cls", "size", "slot"))
    roots, texts = pdf["root"].to_numpy().copy(), pdf["text"].to_numpy()
    symbols = np.ascontiguousarray(pdf[_LANE_COLS].to_numpy(np.int64)).view(np.uint16)
    sets: dict[int, np.ndarray] = {}

    def full_set(x: int) -> np.ndarray:
        if x not in sets:
            sets[x] = shingle_set(texts[x], size)
        return sets[x]

    found = []
    right = np.flatnonzero(side > 0)
    for x in np.flatnonzero(side != 1):
        near = right[(right > x) | (side[right] == 1)] if side[x] == 2 else right
        near = near[(roots[near] != roots[x])
                    & (np.minimum(sizes[near], sizes[x]) * 100 >= np.maximum(sizes[near], sizes[x]) * percent)]
        near = near[_near_here(symbols[near], symbols[x], slots[x])]
        for y in near:
            if roots[y] == roots[x]:
                continue
            a, b = full_set(x), full_set(y)
            both = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * both >= percent * (len(a) + len(b) - both):
                found.append((names[x], names[y]))
                roots[roots == roots[y]] = roots[x]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")
