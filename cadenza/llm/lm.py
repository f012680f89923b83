"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

The model is a folder of sorted arrays in the shared folder, one file per
shard of the hash space, which workers map into memory:

  vocab   word hashes (sorted) with their counts; a word's id is its rank
  follow  by word id: followers seen once, twice, three times or more, and
          the number of distinct words before it (the continuation count)
  pairs   scrambled (context id, word id) keys (sorted) with their counts

Counts leave a task as one sorted block per shard, so what is shuffled is a
few large rows, and a shard's task merges blocks of a bounded size: the number
of shards follows the corpus. Nothing is capped and nothing but the sizes of
shards and counts of counts reaches the driver.

A word is scored as  max(c(v w) - D, 0) / c(v) + gamma(v) * P(w),  P(w) the
same over continuation counts, its rest spread over the vocabulary and one
unknown word. After a context that was never seen, P(w) alone is used.
"""

from __future__ import annotations

import json
import resource
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from cadenza.llm.common import lower_words, mounted_dir, word_hashes, write_once

END = np.uint64(xxh3_64_intdigest(b"\n"))  # no word holds white space
SHARD_CHARS, MIN_SHARDS = 1 << 23, 64
_FLUSH = 1 << 22  # tokens counted at a time
_SCRAMBLE = 0x9E3779B97F4A7C15
_UNSCRAMBLE = pow(_SCRAMBLE, -1, 1 << 64)
_KEY = np.dtype([("key", "<u8"), ("n", "<u8")])
_PAIR = np.dtype([("key", "<u8"), ("n", "<u4")])


@dataclass
class Stats:
    """What every task needs beside the arrays; a few numbers per shard."""
    path: str
    bits: int
    offsets: list[int]  # first id of each vocab shard, and the vocabulary size
    documents: int
    tokens: int
    pair_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    word_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    pairs: int = 0
    rest: float = 1.0  # mass that the continuation level leaves to all words

    @property
    def vocabulary(self) -> int:
        return self.offsets[-1]


def discounts(of_counts: list[int]) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of n-grams seen 1 to 4 times."""
    n1, n2, n3, n4 = map(float, of_counts)
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    wanted = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.1), k) for d, k in zip(wanted, (0.9, 1.9, 2.9)))


def _cut(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each shard begins in sorted keys, and the end."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _count_blocks(docs: DataFrame, bits: int, keys_of: Callable[[list[np.ndarray]], np.ndarray]) -> DataFrame:
    """(shard, keys, counts, documents): sorted distinct keys of many documents."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def flush(held: list[np.ndarray]) -> pd.DataFrame:
            keys, n = np.unique(keys_of(held), return_counts=True)
            at = _cut(keys, bits)
            rows = [(s, keys[a:b].tobytes(), n[a:b].astype("<u4").tobytes())
                    for s, (a, b) in enumerate(zip(at, at[1:])) if b > a]
            return pd.DataFrame(rows, columns=["shard", "keys", "counts"])

        held, size = [], 0
        for pdf in batches:
            for text in pdf["text"]:
                held.append(np.append(word_hashes(lower_words(text)), END))
                size += len(held[-1])
                if size >= _FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return docs.select("text").mapInPandas(run, "shard int, keys binary, counts binary")


def _merged(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([np.frombuffer(b, "<u8") for b in pdf["keys"]])
    n = np.concatenate([np.frombuffer(b, "<u4") for b in pdf["counts"]]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(n, first)


def _table(kind: np.dtype, keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.empty(len(keys), kind)
    out["key"], out["n"] = keys, n
    return out


class Arrays:
    """The mapped arrays of a model, opened as they are needed."""

    def __init__(self, stats: Stats) -> None:
        self.stats = stats
        self.open: dict[tuple[str, int], np.ndarray] = {}
        most = resource.getrlimit(resource.RLIMIT_NOFILE)[1]
        resource.setrlimit(resource.RLIMIT_NOFILE, (most, most))

    def shard(self, name: str, i: int) -> np.ndarray:
        if (name, i) not in self.open:
            try:
                self.open[name, i] = np.load(f"{self.stats.path}/{name}/{i:06d}.npy", mmap_mode="r")
            except FileNotFoundError:  # a shard without keys has no file
                self.open[name, i] = np.empty(0, _PAIR if name == "pairs" else _KEY)
        return self.open[name, i]

    def find(self, name: str, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each sorted distinct key (0: absent), and its place in its shard plus the shard's offset."""
        n, at = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        cut = _cut(keys, self.stats.bits)
        for i in np.flatnonzero(np.diff(cut)):
            part = slice(cut[i], cut[i + 1])
            stored = self.shard(name, i)
            if not len(stored):
                continue
            place = np.minimum(np.searchsorted(stored["key"], keys[part]), len(stored) - 1)
            hit = stored["key"][place] == keys[part]
            n[part] = np.where(hit, stored["n"][place], 0)
            at[part] = place + self.stats.offsets[i]
        return n, at

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and id of each token; id -1 for an unknown word."""
        distinct, back = np.unique(hashes, return_inverse=True)
        n, at = self.find("vocab", distinct)
        return n[back], np.where(n > 0, at, -1)[back]

    def followers(self, ids: np.ndarray) -> np.ndarray:
        """Rows (once, twice, more, before) of known ids."""
        distinct, back = np.unique(ids, return_inverse=True)
        out = np.zeros((len(distinct), 4), np.int64)
        shard = np.minimum(np.searchsorted(self.stats.offsets, distinct, side="right") - 1, (1 << self.stats.bits) - 1)
        for i in np.unique(shard):
            part = shard == i
            out[part] = self.shard("follow", i)[distinct[part] - self.stats.offsets[i]]
        return out[back]

    def pairs(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        distinct, back = np.unique(scramble(context, word), return_inverse=True)
        return self.find("pairs", distinct)[0][back]


_OPEN: dict[str, Arrays] = {}


def arrays(stats: Stats) -> Arrays:
    """The worker's arrays of a model, kept between tasks."""
    key = json.dumps([stats.path, stats.pairs])
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = Arrays(stats)
    return _OPEN[key]


def scramble(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A pair's key: a permutation of 64-bit numbers, so shards fill evenly."""
    return ((context.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)) * np.uint64(_SCRAMBLE)


def _contexts(ids: np.ndarray, lengths: list[int], start: int) -> np.ndarray:
    """The word before each token; ``start`` before the first of a document."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    out[np.cumsum([0, *lengths[:-1]])] = start
    return out


def train(docs: DataFrame, path: str, text_col: str = "text") -> Stats:
    """Count ``docs`` into arrays below ``path``. Null texts are empty ones."""
    docs = docs.select(F.col(text_col).alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"), F.count(F.lit(1)).alias("n")).first()
    bits = (max(MIN_SHARDS, -(-size.chars // SHARD_CHARS)) - 1).bit_length()
    if size.n >= 1 << 32:
        raise ValueError("document counts must fit 32 bits")

    def vocab(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        keys, n = _merged(pdf)
        write_once(f"{path}/vocab/{key[0]:06d}.npy", _table(_KEY, keys, n))
        return pd.DataFrame({"shard": [key[0]], "words": [len(keys)], "tokens": [int(n.sum())]})

    made = (_count_blocks(docs, bits, np.concatenate).groupBy("shard")
            .applyInPandas(vocab, "shard int, words long, tokens long").toPandas().set_index("shard"))
    words = made["words"].reindex(range(1 << bits), fill_value=0)
    stats = Stats(path, bits, [0, *np.cumsum(words).tolist()], size.n, int(made["tokens"].sum()))
    if stats.vocabulary >= 1 << 32:
        raise ValueError("word ids must fit 32 bits")
    if not size.n:
        return stats

    def pair_keys(held: list[np.ndarray]) -> np.ndarray:
        _, ids = arrays(stats).words(np.concatenate(held))
        return scramble(_contexts(ids, list(map(len, held)), stats.vocabulary), ids)

    def pairs(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        keys, n = _merged(pdf)
        write_once(f"{path}/pairs/{key[0]:06d}.npy", _table(_PAIR, keys, n))
        plain = keys * np.uint64(_UNSCRAMBLE)
        out = []
        for role, ids in ((0, plain >> np.uint64(32)), (1, plain & np.uint64(0xFFFFFFFF))):
            distinct, back = np.unique(ids.astype(np.int64), return_inverse=True)
            columns = ([np.bincount(back, n == 1), np.bincount(back, n == 2), np.bincount(back, n > 2)] if role == 0
                       else [np.bincount(back)])
            shard = np.minimum(np.searchsorted(stats.offsets, distinct, side="right") - 1, (1 << bits) - 1)
            edges = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])).tolist() + [len(shard)]
            for a, b in zip(edges, edges[1:]):
                local = distinct[a:b] - stats.offsets[shard[a]]
                block = np.array([np.diff(local, prepend=0), *[c[a:b] for c in columns]]).astype("<u4")
                out.append((int(shard[a]), role, block.tobytes(), b - a))
        of_counts = [int((n == k).sum()) for k in (1, 2, 3, 4)]
        frame = pd.DataFrame(out, columns=["shard", "role", "block", "rows"])
        # One row of role 2 per shard: counts of counts and the number of pairs.
        totals = np.array([*of_counts, len(n)], "<u8").tobytes()
        return pd.concat([frame, pd.DataFrame([(-1 - key[0], 2, totals, 0)], columns=frame.columns)])

    blocks = (_count_blocks(docs, bits, pair_keys).groupBy("shard")
              .applyInPandas(pairs, "shard int, role int, block binary, rows int"))

    def follow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        i = key[0]
        if i < 0:
            return pd.DataFrame({"kind": ["pairs"], "totals": [np.frombuffer(pdf["block"].iloc[0], "<u8").astype(np.int64)]})
        last = i == (1 << bits) - 1
        table = np.zeros((stats.offsets[i + 1] - stats.offsets[i] + last, 4), np.uint32)  # the last: also the start
        for role, block, rows in zip(pdf["role"], pdf["block"], pdf["rows"]):
            found = np.frombuffer(block, "<u4").reshape(-1, rows)
            at = np.cumsum(found[0].astype(np.int64))
            if role == 0:
                table[at, :3] += found[1:].T
            else:
                table[at, 3] += found[1]
        write_once(f"{path}/follow/{i:06d}.npy", table)
        before = table[:, 3]
        return pd.DataFrame({"kind": ["words"], "totals": [
            np.array([*[(before == k).sum() for k in (1, 2, 3, 4)], (before > 2).sum()], np.int64)]})

    totals = (blocks.groupBy("shard").applyInPandas(follow, "kind string, totals array<long>")
              .select("kind", F.posexplode("totals").alias("i", "n")).groupBy("kind", "i").agg(F.sum("n").alias("n"))
              .toPandas().set_index(["kind", "i"])["n"])
    stats.pairs = int(totals["pairs", 4])
    stats.pair_discounts = discounts([totals["pairs", i] for i in range(4)])
    stats.word_discounts = discounts([totals["words", i] for i in range(4)])
    d = stats.word_discounts
    stats.rest = (d[0] * totals["words", 0] + d[1] * totals["words", 1] + d[2] * totals["words", 4]) / stats.pairs
    return stats


def _discounted(n: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(n - np.array([0.0, *d])[np.minimum(n, 3)], 0.0)


def log_probabilities(model: Arrays, held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of the tokens of documents, one after the other: training counts and log10 probabilities."""
    stats = model.stats
    hashes, lengths = np.concatenate(held), list(map(len, held))
    if not stats.documents:
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes))  # one unknown word of probability 1
    n, ids = model.words(hashes)
    known = ids >= 0
    context = _contexts(ids, lengths, stats.vocabulary)
    unigram = np.full(len(ids), stats.rest / (stats.vocabulary + 1))
    before = model.followers(ids[known])[:, 3]
    unigram[known] += _discounted(before, stats.word_discounts) / stats.pairs
    p = unigram.copy()
    led = context >= 0
    after = model.followers(context[led])[:, :3]
    total = np.empty(len(ids), np.int64)
    total[1:] = n[:-1]
    total[context == stats.vocabulary] = stats.documents
    gamma = after @ np.array(stats.pair_discounts) / total[led]
    p[led] *= gamma
    both = led & known
    p[both] += _discounted(model.pairs(context[both], ids[both]), stats.pair_discounts) / total[both]
    return n, np.log10(p)


def score(docs: DataFrame, stats: Stats, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score, perplexity) per row of ``docs``.

    Null and empty texts are their end alone. Rows are independent; null ids
    and repeated rows come out as they went in. Other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    floor = float(np.log10(stats.tokens + stats.vocabulary + 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = arrays(stats)
        for pdf in batches:
            if not len(pdf):
                continue
            held = [np.append(word_hashes(lower_words(t)), END) for t in pdf["text"]]
            n, logs = log_probabilities(model, held)
            first = np.cumsum([0, *map(len, held[:-1])])
            out = pd.DataFrame({
                "id": pdf["id"].to_numpy(), "n_tokens": list(map(len, held)),
                "n_known": np.add.reduceat((n > 0).astype(np.int64), first), "train_tokens": stats.tokens,
                "base_score": np.add.reduceat(np.log10(n + 1) - floor, first), "score": np.add.reduceat(logs, first)})
            yield out.assign(perplexity=10 ** np.minimum(-out["score"] / out["n_tokens"], 300))

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInPandas(run, f"id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, "
                              "score double, perplexity double").withColumnRenamed("id", id_col))


def train_and_score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows where ``held_out`` is not true, score all, and say which were held out."""
    marked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                         F.coalesce(held_out, F.lit(False)).alias("held_out"))
    stats = train(marked.filter("not held_out"), mounted_dir(docs.sparkSession, "language-model"))
    packed = marked.select(F.struct("id", "held_out").alias("key"), "text")
    return (score(packed, stats, "key").select(F.col("key.id").alias(id_col), "key.held_out", "n_tokens", "n_known",
                                               "train_tokens", "base_score", "score", "perplexity"))
