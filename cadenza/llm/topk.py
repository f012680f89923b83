"""Exact top-k by integer inner product: a Voronoi kNN join.

With one more dimension, sqrt(M - |v|^2) for data (M the largest squared
length) and 0 for queries, the largest inner product is the smallest distance.
Data and queries fall into the cells of pivots. From each cell's summary (its
radius and the distances of its k + 1 members nearest to the pivot) every cell
of queries gets a distance within which its neighbours must lie, so of other
cells only the ring that can reach it is needed. Groups of query cells meet
the needed data block by block; each block returns k + 1 rows per query.

The bounds only save work: results do not depend on the pivots. Equal
vectors are searched once, with their k + 1 smallest ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.workspace import materialise

BLOCK, GROUP = 4096, 1024  # data vectors, and queries, that a task holds
MAX_PIVOTS = 1024  # the driver holds MAX_PIVOTS ** 2 distances


def quantised(column: str, factor: int = 256) -> Column:
    """floor(factor * x) of each component; null where a component is null or not finite."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(fine, F.transform(column, lambda x: F.floor(x.cast("double") * factor).cast("double")))


def _matrix(rows: pd.Series, dims: int) -> np.ndarray:
    """Rows as a matrix; vectors shorter than the longest are filled up with zeros."""
    out = np.zeros((len(rows), dims))
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _products(q: np.ndarray, v: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of integers: by floats while all sums fit 53 bits."""
    if exact:
        return (q @ v.T).astype(np.int64)
    return (q.astype(np.int64).astype(object) @ v.astype(np.int64).astype(object).T).astype(np.int64)


def _blocks(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each cell: small cells share one."""
    first, span, block, held = np.zeros(len(sizes), int), np.ones(len(sizes), int), 0, 0
    for cell, size in enumerate(sizes):
        if held and held + size > BLOCK:
            block, held = block + 1, 0
        first[cell], span[cell] = block, max(1, -(-size // BLOCK))
        held += size
        if span[cell] > 1:
            block, held = block + span[cell], 0
    return first, span


def top_k(data: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "vector") -> DataFrame:
    """(query_id, rank, id, score): the k rows of highest inner product for each query, not counting
    rows that bear its own id; ties go to the smaller id; all rows where there are fewer.

    Vectors hold integers as doubles. Null vectors and null ids take no part;
    rows that repeat an id and vector count once. An empty table gives no rows.
    """
    rows = data.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).dropna().distinct()
    asked = queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(vec_col).alias("v")).dropna().distinct()
    order = Window.partitionBy("v").orderBy("id")
    distinct = materialise(
        rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
        .groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")), "vectors")
    asked = materialise(asked, "queries")
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    shape = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims"), F.max(length).alias("m")).first()
    of_queries = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims"), F.max(length).alias("m")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not shape.n or not of_queries.n:
        return data.sparkSession.createDataFrame([], schema)
    dims, most = max(shape.dims, of_queries.dims), shape.m
    exact = math.sqrt(shape.m) * math.sqrt(of_queries.m) < 2**52
    wanted = min(MAX_PIVOTS, max(1, math.isqrt(shape.n)))
    picked = distinct.orderBy(F.xxhash64("v"), "v").limit(wanted).select("v").toPandas()["v"]  # MAX_PIVOTS rows at most

    def lifted(v: np.ndarray) -> np.ndarray:
        return np.hstack([v, np.sqrt(np.maximum(most - (v * v).sum(axis=1), 0))[:, None]])

    pivots = lifted(_matrix(picked, dims))

    def place(as_data: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                m = _matrix(pdf["v"], dims)
                away = _distances(lifted(m) if as_data else np.hstack([m, np.zeros((len(m), 1))]), pivots)
                cell = away.argmin(axis=1) if len(m) else np.zeros(0, int)
                yield pdf.assign(cell=cell.astype("int32"), away=away[np.arange(len(m)), cell])
        return run

    placed = materialise(distinct.mapInPandas(place(True), "v array<double>, ids array<long>, cell int, away double"), "cells")
    asked = materialise(asked.mapInPandas(place(False), "query_id long, v array<double>, cell int, away double"), "query-cells")

    # Summaries: a few numbers per cell.
    p = len(pivots)
    nearest = Window.partitionBy("cell").orderBy("away")
    close = (placed.select("cell", "away").withColumn("n", F.row_number().over(nearest)).filter(F.col("n") <= k + 1)
             .toPandas())
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).toPandas().set_index("cell")["n"]
    sizes = sizes.reindex(range(p), fill_value=0).to_numpy()
    reach = asked.groupBy("cell").agg(F.max("away").alias("r"), F.count(F.lit(1)).alias("n")).toPandas().set_index("cell")
    between = _distances(pivots, pivots)
    slack = 1e-6 * (1 + math.sqrt(most) + math.sqrt(of_queries.m))
    low, high = np.full((p, p), np.inf), np.full((p, p), -np.inf)
    for i, r in reach["r"].items():
        bounds = np.sort(r + between[i, close["cell"].to_numpy()] + close["away"].to_numpy())
        theta = bounds[k] if len(bounds) > k else np.inf
        low[i], high[i] = between[i] - r - theta - slack, between[i] + r + theta + slack

    # Query cells that lie together form a group of about GROUP queries.
    group = np.full(p, -1)
    held, number = 0, 0
    for i in sorted(reach.index, key=lambda c: (between[c, 0], c)):
        if held and held + reach["n"][i] > GROUP:
            number, held = number + 1, 0
        group[i], held = number, held + reach["n"][i]
    groups = number + 1
    # A crowded query cell is cut into parts of its own group.
    parts = np.ones(groups, int)
    for g in range(groups):
        parts[g] = -(-int(reach["n"][[c for c in reach.index if group[c] == g]].sum()) // (2 * GROUP))
    least = np.stack([low[group == g].min(axis=0) for g in range(groups)])
    furthest = np.stack([high[group == g].max(axis=0) for g in range(groups)])
    first, span = _blocks(sizes)
    needed = [[b for j in np.flatnonzero((sizes > 0) & np.isfinite(furthest[g]) | (furthest[g] == np.inf))
               for b in range(first[j], first[j] + span[j])] for g in range(groups)]
    needed = [sorted(set(blocks)) for blocks in needed]

    def route_data(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cell, away = pdf["cell"].to_numpy(), pdf["away"].to_numpy()
            spread = pd.util.hash_array(pdf["ids"].map(lambda x: x[0]).to_numpy(np.int64)) if len(pdf) else cell
            block = first[cell] + (spread % span[cell].astype(np.uint64)).astype(int) if len(pdf) else cell
            for g in range(groups):
                keep = (away >= least[g, cell]) & (away <= furthest[g, cell])
                for part in range(parts[g]):
                    yield pdf.loc[keep, ["v", "ids"]].assign(group=g, part=part, block=block[keep])

    def route_queries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own = group[pdf["cell"].to_numpy()]
            blocks = [needed[g] for g in own]
            part = pd.util.hash_array(pdf["query_id"].to_numpy(np.int64)) % parts[own].astype(np.uint64)
            yield pdf[["query_id", "v"]].assign(group=own, part=part.astype(int), block=blocks).explode("block").dropna()

    sent = placed.mapInPandas(route_data, "v array<double>, ids array<long>, group int, part int, block int")
    sought = asked.mapInPandas(route_queries, "query_id long, v array<double>, group int, part int, block int")

    def solve(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(d):
            return pd.DataFrame(columns=["query_id", "ids", "score"], dtype=object)
        d = d.iloc[np.argsort(d["ids"].map(lambda x: x[0]).to_numpy(), kind="stable")]
        score = _products(_matrix(q["v"], dims), _matrix(d["v"], dims), exact)
        n = min(k + 1, len(d))
        kth = -np.partition(-score, n - 1, axis=1)[:, n - 1]
        at, to = np.nonzero(score >= kth[:, None])
        order = np.lexsort((to, -score[at, to], at))
        at, to = at[order], to[order]
        keep = np.arange(len(at)) - np.searchsorted(at, at) < n
        at, to = at[keep], to[keep]
        return pd.DataFrame({"query_id": q["query_id"].to_numpy()[at], "ids": d["ids"].to_numpy()[to], "score": score[at, to]})

    keys = ["group", "part", "block"]
    best = (sought.groupBy(*keys).cogroup(sent.groupBy(*keys))
            .applyInPandas(solve, "query_id long, ids array<long>, score long"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.select("query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id <> query_id").distinct()
            .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
