"""The prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns. The trie becomes one linked list,
the Euler tour: every node has an enter and an exit arc, and each arc knows the
one before it. The list is ranked distributedly: tasks chain the arcs they hold
into segments, the list of segments is contracted by random mates until a
bounded rest (``REST`` segments) is ranked at once, and the rounds are undone.
Prefix sums along the tour at a node's exit minus those at its enter give
leaves and savings of its subtree, whatever its size or depth.

No step holds a whole conversation, node or subtree in one task: prefix hashes
are scans over a range-sorted table, with one row per partition carried over;
joins on nodes that may have very many children are salted; the ids of
conversations that end at one node meet as chunks, which are hashed in a stream.
Sequences are told apart by two 64-bit hashes of (position, role, text).

Nulls: rows without a conversation id belong to none and are left out; a null
role or text counts as empty; a null turn comes first. Ties: turns with the same number go by
role, then text; repeated rows are turns of their own. A turn's length does not matter, its
text is read once. An empty table gives no node. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import fold_bucket
from cadenza.operators.skew import salted_join
from cadenza.workspace import materialise

# Segments of the contracted tour that are ranked in one place.
REST = 1 << 14
# Ids of one chunk of conversations that end at the same node.
CHUNK = 4096
# A key of a join above so many rows is dealt out over several tasks.
HOT_ROWS = 2_000


# -- turns, their positions and prefix hashes --------------------------------

def _local_scan(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Running count and exclusive-ors within each conversation of a sorted partition."""
    part = TaskContext.get().partitionId()
    last, row, held = None, 0, {"n": 0, "x1": 0, "x2": 0}
    for b in batches:
        if not len(b):
            continue
        conv = b["conv_id"].to_numpy()
        starts = np.append(True, conv[1:] != conv[:-1])
        starts[0] = last is None or conv[0] != last
        at = np.maximum.accumulate(np.where(starts, np.arange(len(b)), -1))  # where a row's conversation begins here
        n = np.arange(1, len(b) + 1) - np.where(at < 0, -held["n"], at)
        out = {"part": np.full(len(b), part), "row": np.arange(row, row + len(b)), "conv_id": conv, "n": n}
        for x, v in (("x1", "v1"), ("x2", "v2")):
            run = np.bitwise_xor.accumulate(b[v].to_numpy())
            before = np.where(at <= 0, 0, run[np.maximum(at - 1, 0)])
            out[x] = run ^ np.where(at < 0, held[x], before)
        out |= {c: b[c].to_numpy() for c in ("v1", "v2", "n_bytes")}
        last, row, held = conv[-1], row + len(b), {c: int(out[c][-1]) for c in held}
        yield pd.DataFrame(out)


def _scan(turns: DataFrame, order: list[Column]) -> DataFrame:
    """(conv_id, n, x1, x2, v1, v2, n_bytes): count and hashes of a conversation's turns up to each.

    Range-sorted, so a conversation of any length spreads over partitions;
    what a partition's first conversation has in earlier ones is added after.
    """
    ordered = turns.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    schema = "part int, row long, conv_id long, n long, x1 long, x2 long, v1 long, v2 long, n_bytes long"
    stored = materialise(ordered.select("conv_id", "v1", "v2", "n_bytes").mapInPandas(_local_scan, schema), "turn-scan")
    ends = stored.groupBy("part").agg(
        F.min("conv_id").alias("first"), F.max(F.struct("row", "conv_id", "n", "x1", "x2")).alias("end")).collect()
    carried, last, held = [], None, (0, 0, 0)
    for p in sorted(ends, key=lambda p: p["part"]):
        if p["first"] != last:
            held = (0, 0, 0)
        elif any(held):
            carried.append((p["part"], p["first"], *held))
        here, last = p["end"], p["end"]["conv_id"]
        if last != p["first"]:
            held = (0, 0, 0)
        held = (held[0] + here["n"], held[1] ^ here["x1"], held[2] ^ here["x2"])
    shift = stored.sparkSession.createDataFrame(carried, "part int, conv_id long, _n long, _x1 long, _x2 long")
    zero = F.lit(0).cast("long")
    return stored.join(F.broadcast(shift), ["part", "conv_id"], "left").select(
        "conv_id", (F.col("n") + F.coalesce("_n", zero)).alias("n"),
        *[F.col(x).bitwiseXOR(F.coalesce(f"_{x}", zero)).alias(x) for x in ("x1", "x2")], "v1", "v2", "n_bytes")


def number_turns(convs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """(conv_id, pos, h1, h2, n_bytes): turns with their place from 0, hashed; stored."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    turns = convs.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), by.alias("role"), said.alias("text"))
    hashed = turns.withColumns({"v1": F.xxhash64("role", "text"), "v2": F.xxhash64(F.lit(1), "text", "role"),
                                "n_bytes": F.octet_length("text").cast("long")})
    counted = _scan(hashed, [F.asc_nulls_first("turn"), F.col("role"), F.col("text")])
    return materialise(counted.select("conv_id", (F.col("n") - 1).alias("pos"), F.col("v1").alias("h1"),
                                      F.col("v2").alias("h2"), "n_bytes"), "turns")


def lengths(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))


def branch(turns: DataFrame, sizes: DataFrame, family: int = 5, openings: int = 9) -> DataFrame:
    """Numbered turns of conversations that share openings.

    Conversation c begins with the first h turns of ``c - c % family`` (all if
    fewer, none if absent) and goes on with its own after its first h, where h is
    the crc32 of its decimal id modulo ``openings``.
    """
    h = fold_bucket("conv_id", openings)
    heads = turns.filter(F.col("pos") < openings - 1).withColumnRenamed("conv_id", "_base")
    born = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("_base"), h.alias("_h"))
    opening = born.join(heads, "_base").filter(F.col("pos") < F.col("_h")).select("conv_id", "pos", "h1", "h2", "n_bytes")
    has = sizes.select(F.col("conv_id").alias("_base"), F.col("n").alias("_n"))
    shift = born.join(has, "_base", "left").select(
        "conv_id", (F.least(F.col("_h"), F.coalesce("_n", F.lit(0))) - F.col("_h")).alias("_shift"))
    own = salted_join(turns.filter(F.col("pos") >= h), shift, "conv_id", ["pos"], rows_per_salt=HOT_ROWS,
                      count_on=turns, min_rows=HOT_ROWS)
    return opening.unionByName(own.withColumn("pos", F.col("pos") + F.col("_shift")).drop("_shift"))


# -- nodes ------------------------------------------------------------------

def _nodes(turns: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with key, parent, smallest member and counts; the node at which each member ends."""
    placed = turns.withColumns({"v1": F.xxhash64("h1", "pos"), "v2": F.xxhash64("pos", "h2")})
    rows = materialise(_scan(placed, [F.col("pos")]).select(
        "conv_id", "n_bytes", F.struct("n", "x1", "x2").alias("node"),
        F.struct((F.col("n") - 1).alias("n"), F.col("x1").bitwiseXOR(F.col("v1")).alias("x1"),
                 F.col("x2").bitwiseXOR(F.col("v2")).alias("x2")).alias("parent")), "trie-rows")
    zero = F.lit(0).cast("long")
    top = F.struct(zero.alias("n"), zero.alias("x1"), zero.alias("x2"))
    found = rows.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                     F.max("n_bytes").alias("n_bytes"), F.min("parent").alias("parent"))
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        top.alias("node"), "conv_id", "n_convs", zero.alias("n_bytes"), F.lit(None).cast(rows.schema["parent"].dataType).alias("parent"))
    nodes = materialise(found.unionByName(root), "trie-nodes")
    names = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    linked = salted_join(nodes, names, "parent", ["node"], how="left", rows_per_salt=HOT_ROWS, min_rows=HOT_ROWS)
    linked = materialise(linked.withColumn("depth", F.col("node.n")), "trie-linked")
    below = linked.filter("depth > 0").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    out = linked.join(below, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", zero))
    last = rows.groupBy("conv_id").agg(F.max("node").alias("node"))  # the deepest, as depth leads the key
    ends = members.select("conv_id").join(last, "conv_id", "left").withColumn("node", F.coalesce("node", top))
    return materialise(out.drop("parent"), "trie"), ends


# -- the tour ---------------------------------------------------------------

def _siblings(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Neighbours among the children of one parent, within a sorted partition."""
    b = pd.concat(list(batches), ignore_index=True)
    if not len(b):
        return
    parent = b[["parent_conv_id", "depth"]].to_numpy()
    same = np.append(False, (parent[1:] == parent[:-1]).all(axis=1))
    conv = b["conv_id"].to_numpy()
    yield b.assign(part=TaskContext.get().partitionId(), row=np.arange(len(b)), end=np.arange(len(b)) == len(b) - 1,
                   first=~same, before=np.append(0, conv[:-1]), last=np.append(~same[1:], True))


def _arcs(trie: DataFrame) -> DataFrame:
    """(c, e, has, pc, pe, leaf, save): arcs of the tour and the arc before each.

    The enter arc of node (conv_id, depth) is (conv_id, 2 depth), its exit arc
    (conv_id, 2 depth + 1). Children are toured by smallest member.
    """
    spark = trie.sparkSession
    weighed = trie.select("conv_id", "depth", "parent_conv_id", (F.col("n_children") == 0).alias("leaf"),
                          ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("save"))
    order = ["parent_conv_id", "depth", "conv_id"]
    below = weighed.filter("depth > 0").repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ("conv_id long, depth long, parent_conv_id long, leaf boolean, save long, part int, row long, "
              "end boolean, first boolean, before long, last boolean")
    stored = materialise(below.mapInPandas(_siblings, schema), "trie-siblings")
    edges = stored.groupBy("part").agg(F.min(F.struct("row", *order)).alias("a"), F.max(F.struct("row", *order)).alias("z")).collect()
    edges.sort(key=lambda p: p["part"])
    joined = [(p, q) for p, q in zip(edges, edges[1:]) if p["z"][1:3] == q["a"][1:3]]
    mend = {p["part"]: [None, False] for pair in joined for p in pair}
    for p, q in joined:
        mend[p["part"]][1], mend[q["part"]][0] = True, p["z"]["conv_id"]
    fixes = spark.createDataFrame([(k, *v) for k, v in mend.items()], "part int, _before long, _more boolean")
    rows = stored.join(F.broadcast(fixes), "part", "left").withColumns({
        "before": F.when(~F.col("first"), F.col("before")).when(F.col("row") == 0, F.col("_before")),
        "last": F.col("last") & ~(F.col("end") & F.coalesce("_more", F.lit(False)))})
    c, d, p = F.col("conv_id"), 2 * F.col("depth"), F.col("parent_conv_id")
    zero = F.lit(0).cast("long")

    def arc(c: Column, e: Column, pc: Column, pe: Column, leaf: Column = zero, save: Column = zero, has: bool = True) -> Column:
        return F.struct(c.alias("c"), e.alias("e"), F.lit(has).alias("has"), pc.alias("pc"), pe.alias("pe"),
                        leaf.alias("leaf"), save.alias("save"))

    leaf = F.col("leaf").cast("long")
    enter = arc(c, d, F.coalesce("before", p), F.when(F.col("before").isNull(), d - 2).otherwise(d + 1), leaf, F.col("save"))
    turn, up = F.when(F.col("leaf"), arc(c, d + 1, c, d)), F.when(F.col("last"), arc(p, d - 1, c, d + 1))
    top = F.array_compact(F.array(arc(c, zero, zero, zero, leaf, F.col("save"), False), F.when(F.col("leaf"), arc(c, zero + 1, c, zero))))
    arcs = rows.select(F.explode(F.array_compact(F.array(enter, turn, up))).alias("a")).unionByName(
        weighed.filter("depth = 0").select(F.explode(top).alias("a")))
    return arcs.select("a.*")


_SUMS = ("rank", "leaf", "save")


def _chain(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chains of the arcs of one partition: each arc's segment and its sums from the segment's head."""
    b = pd.concat(list(batches), ignore_index=True)
    if not len(b):
        return
    convs, code = np.unique(b["c"].to_numpy(), return_inverse=True)
    width = int(max(b["e"].max(), b["pe"].max())) + 1
    key = code * width + b["e"].to_numpy()  # rising: the partition is sorted
    at = np.searchsorted(convs, b["pc"].to_numpy()).clip(max=len(convs) - 1)
    wanted = at * width + b["pe"].to_numpy()
    found = np.searchsorted(key, wanted).clip(max=len(key) - 1)
    here = b["has"].to_numpy() & (convs[at] == b["pc"].to_numpy()) & (key[found] == wanted)
    index = np.arange(len(b))
    sums = np.stack([np.ones(len(b), np.int64), b["leaf"].to_numpy(), b["save"].to_numpy()], axis=1)
    behind, head = np.where(here, found, -1), np.where(here, found, index)
    while (behind >= 0).any():
        on = np.flatnonzero(behind >= 0)
        sums[on] += sums[behind[on]]
        behind[on] = behind[behind[on]]
        head = head[head]
    tail = np.ones(len(b), bool)
    tail[found[here]] = False
    part = TaskContext.get().partitionId()
    yield b[["c", "e", "has", "pc", "pe"]].assign(
        head=~here, tail=tail, seg=(np.int64(part) << 32) + head, **{n: sums[:, i] for i, n in enumerate(_SUMS)})


def _solve(rows: list) -> list[tuple]:
    """Sums before each element of a list that fits one place."""
    after = {r["pred"]: r for r in rows}
    out, at, before = [], None, (0, 0, 0)
    while at in after:
        r = after[at]
        before = tuple(b + r[f"a_{n}"] for b, n in zip(before, _SUMS))
        out.append((r["id"], *before))
        at = r["id"]
    return out


def rank_list(links: DataFrame, rest: int = REST) -> DataFrame:
    """(id, rank, leaf, save): sums of ``a_rank``, ``a_leaf`` and ``a_save`` from the head of a linked list.

    ``links`` is (id, pred, a_...); the head's ``pred`` is null. In each round an
    element leaves if its coin shows 1 and that of the one before it 0, a quarter of
    them on average; who follows it takes over its link and sums. No two neighbours
    leave at once, so every join is one to one. What left comes back in reverse order.
    """
    spark, left = links.sparkSession, []
    names = [f"a_{n}" for n in _SUMS]
    here = materialise(links.select("id", "pred", *names), "tour-segments")
    while here.count() > rest:
        coin = [F.pmod(F.xxhash64(c, F.lit(len(left))), F.lit(2)) for c in ("id", "pred")]
        leaves = F.coalesce(F.col("pred").isNotNull() & (coin[0] == 1) & (coin[1] == 0), F.lit(False))
        gone = here.filter(leaves)
        over = gone.select(F.col("id").alias("pred"), F.col("pred").alias("_pred"), *[F.col(n).alias(f"_{n}") for n in names])
        stay = here.filter(~leaves).join(over, "pred", "left").select(
            "id", F.coalesce("_pred", "pred").alias("pred"),
            *[(F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in names])
        left.append(gone)
        here = materialise(stay, "tour-contracted")
    known = spark.createDataFrame(_solve(here.collect()), "id long, " + ", ".join(f"{n} long" for n in _SUMS))
    for gone in reversed(left):
        back = gone.join(known.withColumnRenamed("id", "pred"), "pred").select(
            "id", *[(F.col(n) + F.col(f"a_{n}")).alias(n) for n in _SUMS])
        known = materialise(known.unionByName(back), "tour-ranked")
    return known


def tour(arcs: DataFrame, rest: int = REST) -> DataFrame:
    """(c, e, rank, leaf, save): place of every arc on the tour and sums up to it."""
    schema = ("c long, e long, has boolean, pc long, pe long, head boolean, tail boolean, seg long, "
              "rank long, leaf long, save long")
    ordered = arcs.repartitionByRange("c", "e").sortWithinPartitions("c", "e")
    chained = materialise(ordered.mapInPandas(_chain, schema), "tour-arcs")
    ends = chained.filter("tail").select(F.col("c").alias("pc"), F.col("e").alias("pe"), F.col("seg").alias("pred"),
                                         *[F.col(n).alias(f"a_{n}") for n in _SUMS])
    heads = chained.filter("head and has").select("seg", "pc", "pe").join(ends, ["pc", "pe"])
    links = heads.select(F.col("seg").alias("id"), "pred", *[f"a_{n}" for n in _SUMS]).unionByName(
        chained.filter("not has").select(F.col("seg").alias("id"), F.lit(None).cast("long").alias("pred"),
                                         *[F.lit(0).cast("long").alias(f"a_{n}") for n in _SUMS]))
    before = rank_list(links, rest).select(F.col("id").alias("seg"), *[F.col(n).alias(f"_{n}") for n in _SUMS])
    return chained.join(before, "seg").select("c", "e", *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in _SUMS])


# -- conversations that end at a node ----------------------------------------

def _listed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ids of a sorted partition as comma-joined chunks of one node each."""
    for b in batches:
        if not len(b):
            continue
        key = b[["n", "x1", "x2"]].to_numpy()
        new = np.append(True, (key[1:] != key[:-1]).any(axis=1))
        cuts = [i for start, stop in zip(np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(b)))
                for i in range(start, stop, CHUNK)]
        ids = b["conv_id"].astype(str).tolist()
        yield b.iloc[cuts].assign(ids=[",".join(ids[i:j]) for i, j in zip(cuts, [*cuts[1:], len(b)])])


def _digested(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's chunks in order, one chunk in memory at a time."""
    at, state = None, None
    for b in batches:
        done = []
        for n, x1, x2, ids in zip(b["n"], b["x1"], b["x2"], b["ids"]):
            if (n, x1, x2) != at:
                if at is not None:
                    done.append((*at, state.hexdigest()))
                at, state = (n, x1, x2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pd.DataFrame(done, columns=["n", "x1", "x2", "ends_sha256"])
    if at is not None:
        yield pd.DataFrame([(*at, state.hexdigest())], columns=["n", "x1", "x2", "ends_sha256"])


def _end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of nodes at which conversations end, ids ascending."""
    key = ["n", "x1", "x2"]
    ordered = materialise(ends.select("node.*", "conv_id"), "trie-ends").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    chunks = ordered.mapInPandas(_listed, "n long, x1 long, x2 long, conv_id long, ids string")
    hashed = chunks.repartition(*key).sortWithinPartitions(*key, "conv_id").mapInPandas(
        _digested, "n long, x1 long, x2 long, ends_sha256 string")
    return hashed.select(F.struct(*key).alias("node"), "ends_sha256")


def trie_of(turns: DataFrame, members: DataFrame, rest: int = REST) -> DataFrame:
    """Nodes of numbered ``turns`` (conv_id, pos, h1, h2, n_bytes) of ``members`` (conv_id, each once),
    which may have no turn: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, first_rank (place of the enter arc on the tour)."""
    trie, ends = _nodes(turns, members)
    side, at = F.col("e") % 2, F.floor(F.col("e") / 2)
    sums = tour(_arcs(trie), rest).groupBy(F.col("c").alias("conv_id"), at.alias("depth")).agg(
        *[F.max(F.when(side == 0, F.col(n))).alias(f"in_{n}") for n in _SUMS],
        *[F.max(F.when(side == 1, F.col(n))).alias(f"out_{n}") for n in _SUMS])
    out = trie.join(sums, ["conv_id", "depth"]).join(_end_digests(ends), "node", "left")
    own_leaf, own_save = (F.col("n_children") == 0).cast("long"), (F.col("n_convs") - 1) * F.col("n_bytes")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("out_leaf") - F.col("in_leaf") + own_leaf).alias("n_leaves"),
        (F.col("out_save") - F.col("in_save") + own_save).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        F.col("in_rank").alias("first_rank"))


def prefix_trie(convs: DataFrame, rest: int = REST, **columns: str) -> DataFrame:
    """The trie of conversations as they are (``columns`` as in ``number_turns``)."""
    turns = number_turns(convs, **columns)
    return trie_of(turns, lengths(turns), rest)
