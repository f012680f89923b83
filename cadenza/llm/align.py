"""Alignment of the token ids of two tokenizers over one corpus.

Both tokenizers cut the same bytes. Byte offsets where tokens of both end cut a
text into groups; tokens of a group whose byte ranges overlap are linked.

An array made once maps each A id to the B id of the same bytes. Groups of one
such pair, the bulk, are counted in vectors as long as the vocabulary and scored
from vectors again; they are never rows. All other groups are kept per document
as distinct groups with counts: what a group links follows from its ids, so
pairs are looked up once per distinct group of the corpus, not per occurrence.
Groups common enough that fewer than ``COMMON`` can be are scored from a
broadcast list, the others through a join without hot keys.

Nulls and empty texts have no tokens and count nothing, as has a text whose
tokens do not spell a space and the text. Ties of counts are all best. Repeated
rows and ids are rows of their own, also with null ids. Texts of any length are taken whole. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import fresh
from cadenza.operators.skew import salted_join
from cadenza.workspace import materialise

# Groups above 1/COMMON of all occurrences are common, if their ids take LONGEST bytes at most.
COMMON, LONGEST = 1 << 16, 64
# Stretches of text that a worker remembers in one generation of its cache (there are two), and the longest.
REMEMBERED, LONG_STRETCH = 1 << 17, 256
# New stretches that are encoded as one text.
RUN = 64
# A key of a join above so many rows is dealt out over several tasks.
HOT_ROWS = 2_000


def byte_alphabet() -> dict[str, int]:
    """Characters of byte-level tokens: printable Latin-1 stands for itself, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


# A single space between two other characters: no token of either side holds both.
GAP = re.compile(r" (?=\S)(?<=\S )")


class Aligned(NamedTuple):
    """What a stretch of text comes to; ``whole`` unless its tokens spell something else."""

    whole: bool
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    spelled: str = ""
    same: bytes = b""           # A ids of identical pairs, 32 bits each
    odd: tuple[bytes, ...] = ()  # keys of the other groups


class Aligner:
    """Two tokenizers with the bytes of their tokens, and their identity map.

    Where both files allow it, texts are cut at single spaces and each distinct
    stretch is aligned once; a full cache becomes the older of two generations,
    from which what is still in use moves on.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        letters = byte_alphabet()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.vocab_size())))]
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        # Where a byte and a piece spell the same, the piece.
        named = {x: i for i, x in enumerate(self.bytes_b) if self.b.is_byte(i)}
        named |= {x: i for i, x in enumerate(self.bytes_b) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))}
        self.identity = np.array([named.get(x, -1) for x in self.bytes_a], np.int64)
        self.spelled = [f"{i}|{j}" for i, j in enumerate(self.identity.tolist())]
        self.dtype = np.dtype("<u2" if max(len(self.bytes_a), len(self.bytes_b)) <= 1 << 16 else "<u4")
        self.cuts = self._cuts_at_spaces()
        self.cache: dict[str, Aligned] = {}
        self.older: dict[str, Aligned] = {}

    def _cuts_at_spaces(self) -> bool:
        """Whether no token of A or B reaches over a space that follows something else."""
        spec = json.loads(self.a.to_str())
        before = spec.get("pre_tokenizer") or {}
        plain = not spec.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex")
        return bool(plain and not before.get("add_prefix_space")
                    and not any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(self.b.vocab_size())))

    def group_key(self, a: bytes, b: bytes) -> bytes:
        return len(a).to_bytes(4, "little") + a + b

    def group_ids(self, key: bytes) -> tuple[np.ndarray, np.ndarray]:
        cut = 4 + int.from_bytes(key[:4], "little")
        return np.frombuffer(key[4:cut], self.dtype).astype(np.int64), np.frombuffer(key[cut:], self.dtype).astype(np.int64)

    def links(self, key: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Linked ids of a group. No inner end is shared, so each stretch between
        two ends, of whichever side, is the overlap of exactly one pair."""
        a, b = self.group_ids(key)
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        stops = np.sort(np.concatenate([ends_a, ends_b[:-1]]))
        return a[np.searchsorted(ends_a, stops)], b[np.searchsorted(ends_b, stops)]

    def _whole(self, text: bytes, a: list[int], b: list[int]) -> bool:
        return (b"".join(map(self.bytes_a.__getitem__, a)) == text) and (b"".join(map(self.bytes_b.__getitem__, b)) == text)

    def _align_run(self, parts: list[str]) -> list[Aligned]:
        """Stretches with single spaces between them, encoded some at a time; each one's end is an end on both sides."""
        texts = [" ".join(parts[i:i + RUN]) for i in range(0, len(parts), RUN)]
        raw = b"".join((" " + t).encode("utf-8", "surrogatepass") for t in texts)
        list_a = list(chain.from_iterable(x.ids for x in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)))
        list_b = list(chain.from_iterable(self.b.encode(texts, num_threads=1)))
        if not self._whole(raw, list_a, list_b):
            half = len(parts) // 2
            return self._align_run(parts[:half]) + self._align_run(parts[half:]) if half else [Aligned(False)]
        a, b = np.array(list_a, np.int64), np.array(list_b, np.int64)
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        at = np.searchsorted(ends_b, ends_a)
        stop_a = np.flatnonzero(ends_b[at] == ends_a)
        stop_b = at[stop_a]
        start_a, start_b = np.append(0, stop_a[:-1] + 1), np.append(0, stop_b[:-1] + 1)
        same = (start_a == stop_a) & (start_b == stop_b) & (self.identity[a[stop_a]] == b[stop_b])
        odd = np.flatnonzero(~same)
        width, raw_a, raw_b = self.dtype.itemsize, a.astype(self.dtype).tobytes(), b.astype(self.dtype).tobytes()
        cuts = np.stack([start_a[odd], stop_a[odd] + 1, start_b[odd], stop_b[odd] + 1], axis=1).tolist()
        keys = [self.group_key(raw_a[i * width:j * width], raw_b[k * width:m * width]) for i, j, k, m in cuts]
        identical = a[stop_a[same]].astype("<u4").tobytes()
        spelled = list(map(self.spelled.__getitem__, a[stop_a].tolist()))
        for g, (i, j, k, m) in zip(odd.tolist(), cuts):
            spelled[g] = ",".join(map(str, list_a[i:j])) + "|" + ",".join(map(str, list_b[k:m]))
        bytes_to = np.cumsum([len(p.encode("utf-8", "surrogatepass")) + 1 for p in parts])
        to_a, to_b = np.searchsorted(ends_a, bytes_to) + 1, np.searchsorted(ends_b, bytes_to) + 1
        ends = np.searchsorted(stop_a, to_a)  # groups up to each part's end
        alike = np.append(0, np.cumsum(same))[ends].tolist()
        out, x, y, g, s = [], 0, 0, 0, 0
        for x2, y2, h, t in zip(to_a.tolist(), to_b.tolist(), ends.tolist(), alike):
            out.append(Aligned(True, x2 - x, y2 - y, h - g, ";".join(spelled[g:h]), identical[4 * s:4 * t], tuple(keys[g - s:h - t])))
            x, y, g, s = x2, y2, h, t
        return out

    def _align_each(self, parts: list[str]) -> dict[str, Aligned]:
        """Distinct stretches; those with white space at an end go alone, as spaces beside it would join it."""
        alone = [p for p in parts if p[0].isspace() or p[-1].isspace() or not self.cuts]
        out = {p: self._align_run([p])[0] for p in alone}
        run = [p for p in parts if p not in out]
        return out | dict(zip(run, self._align_run(run) if run else ()))

    def _remember(self, parts: set[str]) -> None:
        new = [p for p in parts if p not in self.cache]
        if len(self.cache) + len(new) > REMEMBERED:
            self.older, self.cache = self.cache, {}
            new = list(parts)
        self.cache.update((p, self.older[p]) for p in new if p in self.older)
        self.cache.update(self._align_each([p for p in new if p not in self.older]))

    def align(self, texts: list[str | None]) -> list[Aligned]:
        """Each text's alignment; nothing for a text that is null, empty or not spelled by its tokens."""
        cut = [GAP.split(t) if self.cuts and t else [t or ""] for t in texts]
        parts = set(chain.from_iterable(cut)) - {""}
        long = {p for p in parts if len(p) > LONG_STRETCH}
        self._remember(parts - long)
        held = self._align_each(list(long))
        return [self._joined(t, list(map(self.cache.get, c)) if held.keys().isdisjoint(c) else
                             [held.get(p) or self.cache[p] for p in c]) if t else Aligned(False) for t, c in zip(texts, cut)]

    def _joined(self, text: str, found: list[Aligned]) -> Aligned:
        if len(found) == 1:
            return found[0]
        if not all(map(itemgetter(0), found)):
            return self._align_run([text])[0]
        n_a, n_b, n_groups = (sum(map(itemgetter(i), found)) for i in (1, 2, 3))
        return Aligned(True, n_a, n_b, n_groups, ";".join(map(itemgetter(4), found)),
                       b"".join(map(itemgetter(5), found)), tuple(chain.from_iterable(map(itemgetter(6), found))))


_OPEN: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner for two files, kept between tasks."""
    if (path_a, path_b) not in _OPEN:
        _OPEN[path_a, path_b] = Aligner(path_a, path_b)
    return _OPEN[path_a, path_b]


# -- tasks ------------------------------------------------------------------

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _aligned(paths: tuple[str, str], id_type: pa.DataType):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*paths)
        gc.disable()  # counts of references free a batch; a collector would walk the cache again and again
        for batch in batches:
            out = own.align(batch.column(1).to_pylist())
            odd = [Counter(x.odd) for x in out]
            same = [np.unique(np.frombuffer(x.same, "<u4"), return_counts=True) for x in out]
            counts = [(x.n_a, x.n_b, x.n_groups, x.n_a + x.n_b - x.n_groups) for x in out]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(id_type), *[pa.array([c[i] for c in counts], pa.int64()) for i in range(4)],
                pa.array([hashlib.sha256(x.spelled.encode()).hexdigest() if x.n_a else "" for x in out], pa.string()),
                pa.array([ids.tobytes() for ids, _ in same], pa.binary()),
                pa.array([n.astype("<u4").tobytes() for _, n in same], pa.binary()),
                pa.array([list(c) for c in odd], pa.list_(pa.binary())),
                pa.array([list(c.values()) for c in odd], pa.list_(pa.int32()))],
                names=["doc", *_COUNTS, "digest", "same", "same_n", "odd", "odd_n"])
    return run


def _same_counts(size: int):
    """A vector as long as the vocabulary per task, sent once."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            ids, n = (b"".join(batch.column(i).to_pylist()) for i in (0, 1))
            np.add.at(total, np.frombuffer(ids, "<u4"), np.frombuffer(n, "<u4"))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["a", "n"])
    return run


def _linked(paths: tuple[str, str]):
    """Distinct pairs of each group with the times it links them."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*paths)
        for batch in batches:
            found = [np.unique((a << 32) | b, return_counts=True) for a, b in map(own.links, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(2), pa.array([p.tolist() for p, _ in found], pa.list_(pa.int64())),
                pa.array([n.tolist() for _, n in found], pa.list_(pa.int64()))], names=["gid", "key", "n", "pairs", "times"])
    return run


def _scored(vectors: Broadcast):
    """Sums over identical pairs and common groups; the groups left over."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best, common = vectors.value
        for batch in batches:
            row, same, same_n, odd, odd_n = (batch.column(i).to_pylist() for i in range(5))
            out = []
            for ids, n, keys, times in zip(same, same_n, odd, odd_n):
                ids, n = np.frombuffer(ids, "<u4"), np.frombuffer(n, "<u4").astype(np.int64)
                total, top = int((count[ids] * n).sum()), int((best[ids] * n).sum())
                rest, rest_n = [], []
                for key, k in zip(keys, times):
                    known = common.get(key)
                    if known is None:
                        rest.append(key)
                        rest_n.append(k)
                    else:
                        total += known[0] * k
                        top += known[1] * k
                out.append((total, top, rest, rest_n))
            total, top, rest, rest_n = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([
                pa.array(row, pa.int64()), pa.array(total, pa.int64()), pa.array(top, pa.int64()),
                pa.array(rest, pa.list_(pa.binary())), pa.array(rest_n, pa.list_(pa.int32()))],
                names=["row", "count_sum", "n_best", "odd", "odd_n"])
    return run


# -- the operator -----------------------------------------------------------

def _exploded(docs: DataFrame) -> DataFrame:
    return docs.select("row", F.explode(F.arrays_zip("odd", "odd_n")).alias("g")).select(
        "row", F.col("g.odd").alias("key"), F.col("g.odd_n").cast("long").alias("k"))


def link_counts(aligned: DataFrame, groups: DataFrame, own: Aligner) -> DataFrame:
    """(pair, count, best): all linked id pairs of the corpus, ``pair`` = A id << 32 | B id."""
    spark = aligned.sparkSession
    same = aligned.select("same", "same_n").mapInArrow(_same_counts(len(own.bytes_a)), "a long, n long")
    pairs = spark.createDataFrame([(i, (i << 32) | j) for i, j in enumerate(own.identity.tolist()) if j >= 0], "a long, pair long")
    odd = groups.select("n", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        F.col("p.pairs").alias("pair"), (F.col("n") * F.col("p.times")).alias("n"))
    one = same.groupBy("a").agg(F.sum("n").alias("n")).join(F.broadcast(pairs), "a").select("pair", "n")
    counts = materialise(odd.unionByName(one).groupBy("pair").agg(F.sum("n").alias("count")), "link-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    top = counts.groupBy(b.alias("b")).agg(F.max("count").alias("top"))  # a row for each B id at most
    return materialise(counts.withColumn("b", b).join(F.broadcast(top), "b").select(
        "pair", "count", (F.col("count") == F.col("top")).alias("best")), "links")


def _group_values(groups: DataFrame, links: DataFrame) -> DataFrame:
    """(gid, key, n, total, top) of every distinct group."""
    rows = materialise(groups.select("gid", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "gid", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")), "group-pairs")
    valued = salted_join(rows, links, "pair", ["gid"], rows_per_salt=HOT_ROWS, min_rows=HOT_ROWS)
    sums = valued.groupBy("gid").agg(F.sum(F.col("times") * F.col("count")).alias("total"),
                                     F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("top"))
    return materialise(groups.select("gid", "key", "n").join(sums, "gid"), "group-values")


def align_tokens(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """A row per document (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), and the corpus's links (pair, count, best)."""
    spark, paths = docs.sparkSession, (path_a, path_b)
    own = aligner(*paths)
    kind = docs.schema[id_col].dataType
    schema = (f"doc {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, digest string, same binary, "
              "same_n binary, odd array<binary>, odd_n array<int>")
    from pyspark.sql.pandas.types import to_arrow_type

    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    aligned = materialise(texts.mapInArrow(_aligned(paths, to_arrow_type(kind)), schema)
                          .withColumn("row", F.monotonically_increasing_id()), "aligned")
    seen = materialise(_exploded(aligned).groupBy("key").agg(F.sum("k").alias("n"))
                       .withColumn("gid", F.monotonically_increasing_id()), "odd-groups")
    groups = materialise(seen.select("gid", "key", "n").mapInArrow(
        _linked(paths), "gid long, key binary, n long, pairs array<long>, times array<long>"), "linked-groups")
    links = link_counts(aligned, groups, own)
    values = _group_values(groups, links)
    occurrences = F.lit(seen.agg(F.sum("n")).first()[0] or 0)
    is_common = (F.col("n") * COMMON > occurrences) & (F.octet_length("key") <= LONGEST)
    common = {bytes(r["key"]): (r["total"], r["top"]) for r in values.filter(is_common).collect()}
    count, best = np.zeros(len(own.bytes_a), np.int64), np.zeros(len(own.bytes_a), bool)
    ids = spark.createDataFrame([((i << 32) | j,) for i, j in enumerate(own.identity.tolist()) if j >= 0], "pair long")
    for r in links.join(F.broadcast(ids), "pair").collect():  # a row for each A id at most
        count[r["pair"] >> 32], best[r["pair"] >> 32] = r["count"], r["best"]
    vectors = spark.sparkContext.broadcast((count, best, common))
    scored = materialise(aligned.select("row", "same", "same_n", "odd", "odd_n").mapInArrow(
        _scored(vectors), "row long, count_sum long, n_best long, odd array<binary>, odd_n array<int>"), "scored")
    rare = (_exploded(scored).join(values.filter(~is_common).select("key", "total", "top"), "key").groupBy("row")
            .agg(F.sum(F.col("k") * F.col("total")).alias("_total"), F.sum(F.col("k") * F.col("top")).alias("_top")))
    id_name = fresh([*_COUNTS, "n_best", "count_sum", "groups_sha256"], id_col)
    out = (aligned.select("row", "doc", *_COUNTS, "digest").join(scored.select("row", "count_sum", "n_best"), "row")
           .join(rare, "row", "left"))
    return out.select(
        F.col("doc").alias(id_name), *_COUNTS, (F.col("n_best") + F.coalesce("_top", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_total", F.lit(0))).alias("count_sum"), F.col("digest").alias("groups_sha256")), links
