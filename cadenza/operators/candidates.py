"""Recommendation candidates: seeds, similar tracks, popular backfill, features.

Per playlist everything after the seed step is bounded by parameters (seeds x
neighbours, the candidate cap), unless the caller brings its own seeds.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.operators.ordering import BLOCK, first_per_key
from cadenza.operators.skew import salted_join
from cadenza.workspace import materialise


def seed_tracks(links: DataFrame, n: int = 5) -> DataFrame:
    """(pid, track_uri, seed_no): the first tracks of each playlist by position."""
    return (first_per_key(links, "pid", ["pos", "track_uri"], n, "seed_no")
            .select("pid", "track_uri", "seed_no"))


def attach_popularity(rows: DataFrame, popularity: DataFrame, on: str, spread_by: list[str]) -> DataFrame:
    """Popularity of the track in column ``on``, 0 if unknown."""
    known = popularity.select(F.col("track_uri").alias(on), "popularity")
    return (salted_join(rows, known, on, spread_by, how="left")
            .withColumn("popularity", F.coalesce("popularity", F.lit(0).cast("bigint"))))


def neighbour_lists(neighbours: DataFrame, popularity: DataFrame | None, k: int, millionths: bool = False) -> DataFrame:
    """One row per track with its ``k`` best neighbours.

    Popularity is attached here, once per similarity edge, and travels with
    the neighbour; joining it to the candidates would shuffle every one of
    them, with the same few popular tracks in every playlist. Neighbours that
    bring it are not joined at all; without ``popularity`` and it the lists have none; lists made already come back as they are.
    ``millionths`` stores scores of at most six digits as whole numbers, exactly, unless the neighbours
    bring them, and a list as one array for each field, which takes less room than an array of structs.
    """
    if "near" in neighbours.columns:
        return neighbours
    edges = neighbours.filter(F.col("rank") <= k)
    if "popularity" not in edges.columns and popularity is not None:
        edges = attach_popularity(edges, popularity, "neighbour", ["track_uri"])
    spread = [c for c in ("popularity",) if c in edges.columns]
    score = F.col("score")
    if millionths:
        score = F.col("millionths") if "millionths" in edges.columns else whole_scores().alias("millionths")
    lists = edges.groupBy("track_uri").agg(F.collect_list(F.struct("neighbour", score, *spread)).alias("near"))
    if not millionths:
        return lists
    return lists.withColumn("near", F.struct(*[F.col(f"near.{c}").alias(c) for c in ("neighbour", "millionths", *spread)]))


def whole_scores() -> Column:
    """Scores of at most six digits as whole numbers, exactly."""
    return F.round(F.col("score") * 1_000_000).cast("bigint")


def _whole(lists: DataFrame) -> bool:
    """Whether the lists hold whole scores, an array for each field."""
    return lists.schema["near"].dataType.typeName() == "struct"


def _fields(lists: DataFrame) -> list[str]:
    return lists.schema["near"].dataType.names


def expand_seeds(seeds: DataFrame, lists: DataFrame, few_seeds: bool = True) -> DataFrame:
    """(pid, track_uri, score, popularity): every neighbour of every seed. A
    track that is a seed of very many playlists is split over several tasks.
    ``seeds`` is read several times; pass a stored table. With few seeds their lists
    are shuffled by playlist whole, one record a seed, and taken apart after."""
    held = salted_join(seeds, lists, "track_uri", ["pid"]).select("pid", "near")
    whole = _whole(lists)
    near = F.arrays_zip(*[F.col(f"near.{f}").alias(f) for f in _fields(lists)]) if whole else F.col("near")
    spread = F.col("c.popularity") if not whole or "popularity" in _fields(lists) else F.lit(None).cast("bigint").alias("popularity")
    score = (F.col("c.millionths") / F.lit(1e6)).alias("score") if whole else F.col("c.score")
    return ((held.repartition("pid") if few_seeds else held)
            .select("pid", F.explode(near).alias("c"))
            .select("pid", F.col("c.neighbour").alias("track_uri"), score, spread))


def sum_similarity(expanded: DataFrame) -> DataFrame:
    """Summed similarity per (playlist, candidate).

    Rows of few seeds (seeds x neighbours a playlist) come shuffled by playlist, not
    by pair, and need no further shuffle, also for the ranking that
    follows. With seeds in unlimited number the rows are combined and shuffled
    by pair, so that a very long playlist is not one task.
    """
    return (expanded.groupBy("pid", "track_uri")
            .agg(F.round(F.sum("score"), 6).alias("t2v_score"), F.max("popularity").alias("popularity")))


def top_candidates(scores: DataFrame, k: int = 500) -> DataFrame:
    """Best ``k`` candidates of each playlist with a zero-based rank."""
    best = first_per_key(scores, "pid", [F.desc("t2v_score"), "track_uri"], k, "cand_rank")
    return best.withColumn("cand_rank", F.col("cand_rank") - 1)


def candidates(seeds: DataFrame, lists: DataFrame, k: int = 500, few_seeds: bool = True) -> DataFrame:
    """Best ``k`` similar tracks of each playlist. With few seeds and lists of whole scores, tasks that
    hold playlists whole add and rank them; otherwise rows do."""
    if few_seeds and _whole(lists):
        return _by_playlist(seeds, lists, k)
    return top_candidates(sum_similarity(expand_seeds(seeds, lists, few_seeds)), k)


_CANDIDATE = "track_uri {0}, t2v_score double, popularity bigint, cand_rank int"


def track_lists(best: DataFrame) -> DataFrame:
    """(pid, recommendations): the tracks of ``candidates`` of each playlist, best first. Rows of a playlist stand
    side by side, if lists of whole scores gave them, so that they need no shuffle."""
    kind = best.schema["track_uri"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_playlists(batches):
            own = _runs(table["pid"])
            table = table.take(pa.array(np.lexsort((_numbers(table["cand_rank"].combine_chunks()), own))))
            starts = np.searchsorted(own, np.arange(own[-1] + 2))
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), table["track_uri"].combine_chunks())
            yield pa.RecordBatch.from_arrays([table["pid"].combine_chunks().take(pa.array(starts[:-1])), lists], ["pid", "recommendations"])

    return best.select("pid", "track_uri", "cand_rank").mapInArrow(
        run, f"pid {best.schema['pid'].dataType.simpleString()}, recommendations array<{kind}>")


def first_of_playlists(scored: DataFrame, by: str, k: int, name: str) -> DataFrame:
    """The ``k`` rows of each playlist with the highest ``by``, ties by track, numbered from 0, where rows of a playlist
    stand side by side, as candidates from lists of whole scores do: nothing is shuffled."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_playlists(batches):
            own = _runs(table["pid"])
            known = table["track_uri"].is_valid().cast(pa.int8())  # a null track goes first
            keys = pa.table([pa.array(own), table[by], known, table["track_uri"]], ["own", "by", "known", "track"])
            order = pc.sort_indices(keys, sort_keys=[("own", "ascending"), ("by", "descending"), ("known", "ascending"),
                                                     ("track", "ascending")]).to_numpy(zero_copy_only=False).astype(np.int64)
            at = own[order]
            rank = np.arange(len(at)) - np.searchsorted(at, at)
            kept = table.take(pa.array(order[rank < k])).append_column(name, pa.array(rank[rank < k], pa.int32()))
            yield from kept.combine_chunks().to_batches()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in scored.schema)
    return scored.mapInArrow(run, f"{fields}, `{name}` int")


def _by_playlist(seeds: DataFrame, lists: DataFrame, k: int, playlists: DataFrame | None = None,
                 popular: DataFrame | None = None, cap: int = 500, label: Iterable[str] = ()) -> DataFrame:
    """Candidates from whole scores, playlists side by side: (pid, track_uri, t2v_score, popularity, cand_rank).

    One shuffle brings the packed lists of a playlist's seeds together, sorted by playlist, so that a task holds
    those of a batch and of one playlist more. Scores are added as whole numbers. With ``playlists`` their
    popular tracks follow as in ``merge_candidates``, for these playlists only and with their other columns;
    arrays of tracks become flags: ``_seeds`` becomes ``seed_overlap``, those named in ``label`` together become it.
    ``popular`` is a top-n list; without it nothing follows.
    """
    held = salted_join(seeds.select("pid", "track_uri"), _packed(lists), "track_uri", ["pid"]).select("pid", "_list")
    pid_type, track_type = (df.schema[c].dataType.simpleString() for df, c in ((held, "pid"), (seeds, "track_uri")))
    spread = "popularity" in _fields(lists)
    schema, carried, flags, listed = f"pid {pid_type}, {_CANDIDATE.format(track_type)}", [], {}, []
    if playlists is not None:
        flags = {name: of for name, of in (("seed_overlap", [c for c in ("_seeds",) if c in playlists.columns]), ("label", [*label])) if of}
        carried = [c for c in playlists.columns if c not in ("pid", "_seeds", *label)]
        schema += "".join(f", `{c}` {playlists.schema[c].dataType.simpleString()}" for c in carried)
        schema += "".join(f", {name} int" for name in flags)
        # Best first, as ``popular_list`` orders them.
        listed = sorted(((-r["popularity"], r["track_uri"] is not None, r["track_uri"]) for r in (popular.collect() if popular else [])),
                        key=lambda r: (r[0], r[1], _sort_key(r[2])))
        held = (held.filter("pid is not null").withColumn("_listed", F.lit(False))
                .unionByName(playlists.withColumn("_listed", F.lit(True)), allowMissingColumns=True))
    rows = held.repartition("pid").sortWithinPartitions("pid")
    kind = pa.string() if track_type == "string" else pa.int64() if track_type == "bigint" else pa.int32()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_playlists(batches):
            yield from _ranked(table, k, cap, [(t, -p) for p, _, t in listed], carried, flags, spread, kind)

    return rows.mapInArrow(run, schema)


def _sort_key(track: str | int | None) -> bytes | int:
    """Key that orders tracks as Spark does."""
    return track.encode("utf-8", "surrogatepass") if isinstance(track, str) else track or 0


def _whole_playlists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by playlist, cut between playlists only."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        at = _runs(held["pid"])
        cut = int(np.searchsorted(at, at[-1]))
        if cut:
            yield held.slice(0, cut).combine_chunks()
            held = held.slice(cut)
    if held is not None:
        yield held.combine_chunks()


def _runs(pids: pa.ChunkedArray) -> np.ndarray:
    """Number of each row's playlist, rising from 0 as rows are sorted; null is one of its own."""
    codes = pids.combine_chunks().dictionary_encode(null_encoding="encode").indices
    return np.asarray(codes.to_numpy(zero_copy_only=False), np.int64)


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _numbers(values: pa.Array) -> np.ndarray:
    return pc.fill_null(values, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _packed(lists: DataFrame) -> DataFrame:
    """(track_uri, _list): lists of whole scores as one binary value each, since they are shuffled once for
    every seed. A neighbour that is null is left out."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = pa.array(_pack(batch.column("near")), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("track_uri"), packed], ["track_uri", "_list"])

    kind = lists.schema["track_uri"].dataType.simpleString()
    return lists.mapInArrow(run, f"track_uri {kind}, _list binary")


_END = b"\xff"  # in no text


def _pack(near: pa.StructArray) -> list[bytes]:
    """Tracks and numbers of each list, after the length of the former, best first, so that numbers hardly change from one place to the next. Texts lose
    what all of a list begin with, which is stored once; whole numbers are stored byte by byte, the first of all, then the second."""
    fields = {near.type.field(i).name: near.field(i) for i in range(near.type.num_fields)}
    tracks, numbers = fields["neighbour"].flatten(), [_numbers(fields[f].flatten()) for f in ("millionths", "popularity") if f in fields]
    of = np.repeat(np.arange(len(near)), _lengths(fields["neighbour"]))
    order = np.lexsort((*reversed(numbers[1:]), -numbers[0], of))
    order = order[tracks.is_valid().to_numpy(zero_copy_only=False)[order]]
    of, tracks = of[order], tracks.take(pa.array(order))
    bounds = np.searchsorted(of, np.arange(len(near) + 1))
    some = bounds[:-1] < bounds[1:]
    firsts, lasts = bounds[:-1][some], bounds[1:][some] - 1
    numbers = [c[order] for c in numbers]
    if len(numbers) == 2:
        # A score of n / sqrt(popularity x popularity) is stored as n and what that is off by, as a rule 0.
        millionths, popularity = numbers
        scale = np.ones(len(near), np.int64)
        scale[of[lasts]] = np.rint(np.clip(1e12 / (np.maximum(millionths[lasts], 1).astype(float) ** 2 * np.maximum(popularity[lasts], 1)), 1, 1e15))
        unit = _unit(scale[of], popularity)
        n = np.rint(np.clip(millionths / unit, -1e9, 1e9)).astype(np.int64)
        numbers = [n, millionths - _expected(n, unit), popularity]
    for c in numbers:
        begin = c[firsts]
        c[:] = np.diff(c, prepend=0)
        c[firsts] = begin
    coded = tracks.to_numpy(zero_copy_only=False) if pa.types.is_integer(tracks.type) else tracks.cast(pa.binary()).to_pylist()

    def names(texts: list[bytes]) -> bytes:
        start = os.path.commonprefix(texts) if texts else b""
        return _END.join([start, *[t[len(start):] for t in texts]])

    spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
    pack = names if isinstance(coded, list) else _planes
    heads = [_planes(scale[i:i + 1]) if b > a else b"" for i, (a, b) in enumerate(spans)] if len(numbers) == 3 else [b""] * len(spans)
    out = []
    for h, (a, b) in zip(heads, spans):
        own = _deflated(pack(coded[a:b]))
        out.append(b"".join([len(own).to_bytes(4, "little"), own, _deflated(b"".join([h, *(_planes(c[a:b]) for c in numbers)]))]))
    return out


def _unit(scale: np.ndarray, popularity: np.ndarray) -> np.ndarray:
    """Millionths of a score that one meeting is worth."""
    return 1e6 / np.sqrt(scale.astype(float) * np.maximum(popularity, 1))


def _expected(n: np.ndarray, unit: np.ndarray) -> np.ndarray:
    return np.floor(n * unit + 0.5).astype(np.int64)


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _deflated(value: bytes) -> bytes:
    coder = zlib.compressobj(6, zlib.DEFLATED, -15)
    return coder.compress(value) + coder.flush()


def _inflated(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, one after the other, and the length of each."""
    values = [zlib.decompress(v, -15) if v else b"" for v in values]
    return np.frombuffer(b"".join(values), np.uint8), np.array([len(v) for v in values], np.int64)


def _unpacked(table: pa.Table, track_type: pa.DataType, spread: bool) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Lengths of the lists of all rows, and their tracks, scores and popularities side by side."""
    packed = [v or b"" for v in table["_list"].to_pylist()]
    ends = [4 + int.from_bytes(v[:4], "little") for v in packed]
    flat, sizes = _inflated([v[end:] for v, end in zip(packed, ends)])
    head = 8 if spread else 0
    n = np.maximum(sizes - head, 0) // (24 if spread else 8)
    some = n > 0
    starts = (np.cumsum(n) - n)[some]

    def summed(plane: int) -> np.ndarray:
        """Differences added up from the start of each list."""
        total = np.cumsum(_from_planes(flat, n, sizes, plane, head))
        return total - np.repeat(np.concatenate([[0], total])[starts], n[some])

    if spread:
        meetings, off, popularity = (summed(8 * i) for i in range(3))
        scale = np.repeat(_from_planes(flat, some.astype(np.int64), sizes, 0), n[some])
        millionths = _expected(meetings, _unit(scale, popularity)) + off
    else:
        millionths = summed(0)
        popularity = np.zeros_like(millionths)
    raw, sizes = _inflated([v[4:end] for v, end in zip(packed, ends)])
    tracks = pa.array(_from_planes(raw, n, sizes, 0)) if pa.types.is_integer(track_type) else _texts(raw, sizes, n)
    return n, tracks.cast(track_type), millionths, popularity


def _from_planes(flat: np.ndarray, n: np.ndarray, sizes: np.ndarray, plane: int, head: int = 0) -> np.ndarray:
    """Whole numbers of all lists from eight planes of bytes after ``head`` bytes, ``plane`` and those after it."""
    at = np.arange(n.sum()) + np.repeat(np.cumsum(sizes) - sizes + head + plane * n - (np.cumsum(n) - n), n)
    step, out = np.repeat(n, n), np.zeros(len(at), np.int64)
    for i in range(8):
        out |= flat[at].astype(np.int64) << (8 * i)
        at += step
    return out


def _texts(raw: np.ndarray, sizes: np.ndarray, n: np.ndarray) -> pa.Array:
    """Texts of all lists: what stands between two marks of a list is first what its texts begin with, then the rest of each."""
    some = np.flatnonzero(sizes + n > 0)
    if not len(some):
        return pa.array([], pa.string())
    # A list of m texts has m marks; one more text ends where the list ends, and takes no byte.
    marks = np.flatnonzero(raw == _END[0])
    lists = np.repeat(some, n[some] + 1)
    last = np.cumsum(n[some] + 1) - 1
    ends = np.empty(len(lists), np.int64)
    inner = np.ones(len(lists), bool)
    inner[last] = False
    ends[inner], ends[last] = marks, np.cumsum(sizes)[some]
    marked = np.cumsum(inner)  # marks up to and with the own one are no bytes of texts
    offsets = np.concatenate([[0], ends - (marked - inner)])
    kept = raw[raw != _END[0]].tobytes()
    pieces = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(kept)])
    first = np.cumsum(n[some] + 1) - (n[some] + 1)
    rest = np.ones(len(lists), bool)
    rest[first] = False
    heads = pieces.take(pa.array(np.repeat(first, n[some])))
    return pc.binary_join_element_wise(heads, pieces.filter(pa.array(rest)), pa.scalar(b"", pa.large_binary())).cast(pa.large_string())


def _ranked(table: pa.Table, k: int, cap: int, popular: list[tuple], carried: list[str], flags: dict[str, list[str]],
            spread: bool, track_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Candidates of whole playlists, see ``_by_playlist``."""
    def column(name: str) -> pa.Array:
        held = table[name]
        return held.combine_chunks() if held.num_chunks != 1 else held.chunk(0)

    own = _runs(table["pid"])
    n = int(own[-1]) + 1
    lengths, neighbours, scores, spreads = _unpacked(table, track_type, spread)
    of = np.repeat(own, lengths)
    sets = [*dict.fromkeys(c for of_flag in flags.values() for c in of_flag)]
    parts = [neighbours, *[column(c).flatten() for c in sets]]
    extra = pa.array([t for t, _ in popular], track_type)
    # One number for each track, in the order of the tracks.
    coded = pa.concat_arrays([*parts, extra]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
    tracks = coded.dictionary.take(pa.array(order))
    place = np.empty(len(order) + 1, np.int64)
    place[order], place[len(order)] = np.arange(len(order)), -1  # -1 for null
    codes = place[pc.fill_null(coded.indices, len(order)).to_numpy(zero_copy_only=False)]
    bounds = np.cumsum([len(p) for p in parts])
    codes, *marked, listed = np.split(codes, bounds)
    width = max(len(tracks), 1)

    # Sums over the seeds, whole numbers all the way.
    key = of * width + codes
    by_key = np.argsort(key, kind="stable")
    key = key[by_key]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    pairs = total = counted = key[starts]
    if len(starts):
        total, counted = np.add.reduceat(scores[by_key], starts), np.maximum.reduceat(spreads[by_key], starts)
    best = np.lexsort((pairs, -total, pairs // width))
    at, track = pairs[best] // width, pairs[best] % width
    rank = np.arange(len(at)) - np.searchsorted(at, at)
    kept = rank < k
    at, track, rank, total, counted = at[kept], track[kept], rank[kept], total[best][kept], counted[best][kept]
    take, known = track, np.ones(len(track), bool)

    if "_listed" in table.column_names:
        rows = np.full(n, -1)
        is_playlist = column("_listed").to_numpy(zero_copy_only=False).astype(bool)
        rows[own[is_playlist]] = np.flatnonzero(is_playlist)
        ok = (rows[at] >= 0) & (rank < cap)
        at, track, rank, total, counted = at[ok], track[ok], rank[ok], total[ok], counted[ok]
        # Popular tracks that are not candidates yet, in their order, as long as there is room.
        spot = np.full(width + 1, -1)
        spot[listed] = np.arange(len(listed))  # the last place is that of a null track
        free = np.ones((n, len(listed)), bool)
        met = spot[track] >= 0
        free[at[met], spot[track[met]]] = False
        filled = np.bincount(at, minlength=n)
        later = np.cumsum(free, axis=1)
        free &= (later <= (cap - filled)[:, None]) & (rows >= 0)[:, None]
        more_at, more = np.nonzero(free)
        more_rank = filled[more_at] + later[more_at, more] - 1
        counts = np.array([p for _, p in popular], np.int64)
        track, take = np.concatenate([track, listed[more]]), np.concatenate([track, len(tracks) + more])
        at, rank = np.concatenate([at, more_at]), np.concatenate([rank, more_rank])
        total = np.concatenate([total, np.zeros(len(more), np.int64)])
        counted = np.concatenate([counted, counts[more]]) if len(popular) else counted
        known = track >= 0
        inside = np.lexsort((rank, at))
        at, track, take, rank, total, counted, known = (x[inside] for x in (at, track, take, rank, total, counted, known))

    lead = np.searchsorted(own, np.arange(n))  # a row of each playlist
    out = [column("pid").take(pa.array(lead[at])), pa.concat_arrays([tracks, extra]).take(pa.array(take)),
           pa.array(total / 1e6), pa.array(counted, pa.int64(), mask=~known if spread else known | True), pa.array(rank, pa.int32())]
    names = ["pid", "track_uri", "t2v_score", "popularity", "cand_rank"]
    for name in carried:
        out.append(column(name).take(pa.array(rows[at])))
        names.append(name)
    members = {c: np.repeat(own, _lengths(column(c))) * width + found for c, found in zip(sets, marked)}
    for flag, of_flag in flags.items():
        among = np.isin(at * width + track, np.concatenate([members[c] for c in of_flag])) & known
        # A null track is in no list of seeds, nor outside of one.
        out.append(pa.array(among.astype(np.int32), pa.int32(), mask=~known if flag == "seed_overlap" else None))
        names.append(flag)
    yield from pa.Table.from_arrays(out, names).to_batches(1 << 16)


def candidates_any(seeds: DataFrame, lists: DataFrame, k: int = 500, few: int = 100) -> DataFrame:
    """Candidates for seeds in any number: those of playlists with at most ``few`` go by
    playlist in one shuffle of lists, those of longer ones by pair."""
    seeds = materialise(seeds, "seeds")
    long = materialise(seeds.groupBy("pid").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > few).select("pid"), "long")
    if long.isEmpty():
        return candidates(seeds, lists, k)
    return candidates(seeds.join(long, "pid", "left_anti"), lists, k).unionByName(
        candidates(materialise(seeds.join(long, "pid", "left_semi"), "long-seeds"), lists, k, few_seeds=False))


def judged_candidates(roles: DataFrame, lists: DataFrame, k: int = 500, few: int = 100, bound: int = BLOCK) -> DataFrame:
    """Candidates of the rows of ``roles`` (pid, track_uri, pos, role) that are seeds, with ``label`` 1 for those among the
    playlist's rows that are truth, else 0. Seeds and truth of playlists of at most ``bound`` rows and ``few`` seeds travel
    together, so that candidates are not shuffled again; those of longer ones go by pair. ``roles`` should be stored."""
    is_seed = F.col("role") == "seed"
    first = first_per_key(roles.filter("pid is not null").select("pid", "track_uri", "pos", "role"), "pid", ["pos", "track_uri"], bound + 1, "_at")
    held = materialise(first.groupBy("pid").agg(
        F.collect_list(F.when(is_seed, F.col("track_uri"))).alias("_own"),
        F.collect_set(F.when(F.col("role") == "truth", F.col("track_uri"))).alias("_truth"), F.count(F.lit(1)).alias("_kept")), "roles-by-playlist")
    is_long = (F.col("_kept") > bound) | (F.size("_own") > few)
    short = held.filter(~is_long)
    found = _by_playlist(short.select("pid", F.explode("_own").alias("track_uri")), lists, k, short.select("pid", "_truth"), None, k, ["_truth"])
    cols = ["pid", "track_uri", "t2v_score", "cand_rank", "label"]
    long = materialise(held.filter(is_long).select("pid"), "long")
    if long.isEmpty():
        return found.select(*cols)
    rest = materialise(roles.join(long, "pid", "left_semi"), "long-roles")
    pairs = candidates_any(rest.filter(is_seed).select("pid", "track_uri"), lists, k, few)
    return found.select(*cols).unionByName(
        flag_member(pairs, rest.filter(F.col("role") == "truth"), "label").select(*cols))


def popular_list(popular: DataFrame) -> Column:
    """The bounded popular list, best first, as a scalar inside a query."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("popularity")).alias("p"), "track_uri")))
    return popular.agg(ordered.getField("track_uri").alias("tracks")).scalar()


def not_seen(popular: Column, similar: Column) -> Column:
    """Popular tracks that are not candidates yet, order kept."""
    return F.array_except(popular, similar)


def merge_candidates(similar: DataFrame, playlists: DataFrame, popular: DataFrame, cap: int = 500) -> DataFrame:
    """(pid, track_uri, cand_rank, t2v_score, popularity): similar tracks first,
    then popular ones without repeats, ``cap`` in all, for every playlist.

    ``popular`` is a top-n list, so the broadcast at the end has n rows.
    """
    ranked = F.array_sort(F.collect_list(F.struct("cand_rank", "track_uri", "t2v_score", "popularity")))
    per = similar.groupBy("pid").agg(ranked.alias("_sim"))
    known = F.coalesce(F.col("_sim.track_uri"), F.array().cast("array<string>"))
    lists = playlists.join(per, "pid", "left").withColumn("_more", not_seen(popular_list(popular), known))
    scored = F.transform(F.col("_sim"), lambda s: F.struct(
        s["track_uri"].alias("track_uri"), s["t2v_score"].alias("t2v_score"),
        s["popularity"].alias("popularity")))
    backfill = F.transform("_more", lambda t: F.struct(
        t.alias("track_uri"), F.lit(0.0).alias("t2v_score"), F.lit(None).cast("bigint").alias("popularity")))
    empty = F.array().cast("array<struct<track_uri:string,t2v_score:double,popularity:bigint>>")
    merged = F.slice(F.concat(F.coalesce(scored, empty), backfill), 1, cap)
    rows = (lists.select(*playlists.columns, merged.alias("_merged"))
            # The plain form would add a filter that builds every list twice.
            .select(*playlists.columns, F.posexplode_outer("_merged").alias("cand_rank", "c"))
            .filter(F.col("cand_rank").isNotNull())
            .select(*playlists.columns, "cand_rank", "c.*"))
    listed = popular.select("track_uri", F.col("popularity").alias("_popular"))
    return (rows.join(F.broadcast(listed), "track_uri", "left")
            .withColumn("popularity", F.coalesce("popularity", "_popular")).drop("_popular"))


def flag_member(cands: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """1 where the (pid, track_uri) pair occurs in ``links``, else 0."""
    member = links.select("pid", "track_uri").distinct().withColumn("_in", F.lit(1))
    return (cands.join(member, ["pid", "track_uri"], "left")
            .withColumn(name, F.coalesce("_in", F.lit(0))).drop("_in"))


def _bounded_sets(links: DataFrame, bound: int) -> DataFrame:
    """(pid, _truth): the distinct tracks of each playlist, of longer ones ``bound`` + 1 of them."""
    some = first_per_key(links.select("pid", "track_uri").distinct(), "pid", ["track_uri"], bound + 1)
    return some.groupBy("pid").agg(F.collect_list("track_uri").alias("_truth"))


def merged_candidates(seeds: DataFrame, lists: DataFrame, playlists: DataFrame, popular: DataFrame, k: int = 500,
                      cap: int = 500) -> DataFrame:
    """``merge_candidates`` of the best ``k`` of each playlist; from lists of whole scores in one shuffle."""
    if _whole(lists):
        return _by_playlist(seeds, lists, k, playlists, popular, cap)
    return merge_candidates(candidates(seeds, lists, k), playlists, popular, cap)


def candidate_features(links: DataFrame, neighbours: DataFrame, popularity: DataFrame,
                       popular: DataFrame, *, only: DataFrame | None = None, labels: bool = True,
                       top_seed: int = 5, per_seed: int = 200, max_cands: int = 500,
                       truth: DataFrame | None = None, seeds_in_truth: bool = False, bound: int = BLOCK) -> DataFrame:
    """Feature row per (playlist, candidate).

    ``only`` restricts the playlists scored; popularity and neighbours always
    come from the whole corpus. ``truth`` defaults to the tracks of the
    playlist without its seeds; ``seeds_in_truth`` counts them too. A truth of at
    most ``bound`` tracks travels with its playlist, so that labels need no shuffle
    of the candidates; playlists with more are joined with it by pair. ``neighbours``
    may be the lists of ``neighbour_lists``, with ``per_seed`` neighbours each.
    """
    rows = links if only is None else links.join(only.select("pid"), "pid", "left_semi")
    own_truth = labels and truth is None  # the tracks of the playlist themselves, so that one shuffle brings seeds and truth
    per_playlist = materialise(_playlists(rows, top_seed, max(top_seed, bound + 1) if own_truth else top_seed, own_truth), "playlists")
    seeds = per_playlist.select("pid", F.explode("_seeds").alias("track_uri"))
    lists = neighbour_lists(neighbours, popularity, per_seed)
    cols = ["pid", "track_uri", "cand_rank", "popularity", "t2v_score", "seed_overlap", "playlist_len"]

    def merged(own: DataFrame, playlists: DataFrame, label: list[str]) -> DataFrame:
        if _whole(lists):
            return _by_playlist(own, lists, max_cands, playlists, popular, max_cands, label)
        found = merge_candidates(candidates(own, lists, max_cands), playlists, popular, max_cands)
        found = found.withColumn("seed_overlap", F.array_contains("_seeds", F.col("track_uri")).cast("int"))
        if not label:
            return found
        belongs = F.array_contains(F.concat(*[F.coalesce(F.col(c), F.array().cast("array<string>")) for c in label]), F.col("track_uri"))
        return found.withColumn("label", F.coalesce(belongs.cast("int"), F.lit(0)))

    if not labels:
        return merged(seeds, per_playlist.drop("_kept"), []).select(*cols)
    if own_truth:
        held, label = per_playlist, ["_seeds", "_rest"] if seeds_in_truth else ["_rest"]
        long = held.filter(F.col("_kept") > bound)
    else:
        held, label = materialise(per_playlist.join(_bounded_sets(truth, bound), "pid", "left"), "truth"), ["_truth"]
        long = held.filter(F.size("_truth") > bound)
    some_long = not long.isEmpty()
    short, own = held, seeds
    if some_long:
        short, own = held.join(long.select("pid"), "pid", "left_anti"), seeds.join(long.select("pid"), "pid", "left_anti")
    if own_truth:
        short = short.withColumnRenamed("_kept", "playlist_len")  # a short playlist was kept whole
    table = merged(own, short.drop("_kept"), label).select(*cols, "label")
    if some_long:
        long = long.drop("_kept", "_truth", "_rest")
        if own_truth:
            sizes = rows.join(long.select("pid"), "pid", "left_semi").groupBy("pid").agg(F.count(F.lit(1)).alias("playlist_len"))
            long = long.join(sizes, "pid")
            truth = rows if seeds_in_truth else rows.join(seeds, ["pid", "track_uri"], "left_anti")
        rest = merged(seeds.join(long.select("pid"), "pid", "left_semi"), long, [])
        table = table.unionByName(flag_member(rest, truth, "label").select(*cols, "label"))
    return table


def _playlists(rows: DataFrame, top_seed: int, keep: int, rest: bool) -> DataFrame:
    """(pid, _seeds, _kept): the tracks of the first ``top_seed`` rows of each playlist and how many of its first ``keep``
    rows there are; with ``rest`` also the other tracks of those rows, each once (_rest), without it how many rows there
    are in all (playlist_len). One shuffle of rows."""
    first = first_per_key(rows.select("pid", "track_uri", "pos").filter("pid is not null"), "pid", ["pos", "track_uri"], keep, "_at")
    is_seed = F.col("_at") <= top_seed
    per = first.groupBy("pid").agg(
        F.collect_list(F.when(is_seed, F.col("track_uri"))).alias("_seeds"), F.count(F.lit(1)).alias("_kept"),
        *([F.collect_set(F.when(~is_seed, F.col("track_uri"))).alias("_rest")] if rest else []))
    if rest:
        return per.withColumn("_rest", F.array_except("_rest", "_seeds"))
    return per.join(rows.groupBy("pid").agg(F.count(F.lit(1)).alias("playlist_len")), "pid")
