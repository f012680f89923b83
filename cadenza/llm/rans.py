"""Token ids in a compact file: static range asymmetric numeral system.

One frequency table, counted over the whole corpus, serves all blocks. A block
is coded in ``lanes`` interleaved states, so every step codes one id per lane.
Blocks are independent, and each holds checkpoints (all lane states and the
place in the word stream) from which decoding can start, and a checksum.

Block layout, little-endian:
  magic "RNS1", crc32 of all that follows, crc32 of the table, scale bits,
  ids, lanes, rows between checkpoints, checkpoints, words    (9 x 32 bits)
  checkpoints: word offset (u32) each, then states (u64 x lanes) each
  words: u32 each
A row of the written table is a run of whole documents: their ids and
lengths, and the blocks that hold their tokens.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.tokens import joined, tokenizer
from cadenza.workspace import materialise, run_dir

SCALE = 18
LANES = 512
BLOCK_IDS = 1 << 18
CHECKPOINT_ROWS = 128
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4s8I")


class Table:
    """Frequencies scaled to 2**SCALE; every counted token has at least 1."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(tokens)
        tokens, counts = np.asarray(tokens)[order], np.asarray(counts, float)[order]
        total = 1 << SCALE
        if len(tokens) > total:
            raise ValueError(f"more than {total} distinct tokens")
        freq = np.maximum(1, np.floor(counts / max(counts.sum(), 1) * total)).astype(np.int64)
        off = total - int(freq.sum())
        by_size = np.argsort(-counts, kind="stable")
        while off and len(tokens):  # what rounding left or took goes to or from the most frequent
            for i in by_size:
                step = off if off > 0 else -min(-off, int(freq[i]) // 2)
                freq[i] += step
                off -= step
                if not off:
                    break
        self.tokens = tokens.astype(np.uint32)
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.crc = zlib.crc32(self.tokens.tobytes() + self.freq.tobytes())
        self.index = np.zeros(int(tokens.max()) + 1 if len(tokens) else 1, np.uint32)  # place of a token
        self.index[tokens] = np.arange(len(tokens), dtype=np.uint32)
        self.slots = np.repeat(np.arange(len(tokens), dtype=np.uint32), freq)
        self.common = int(by_size[0]) if len(tokens) else 0


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    lanes = max(1, min(LANES, len(ids) // 32))
    rows = -(-len(ids) // lanes)
    index = table.index[ids]
    grid = np.full(rows * lanes, table.common)
    grid[:len(ids)] = index
    grid = grid.reshape(rows, lanes)
    x = np.full(lanes, _LOW)
    words: list[np.ndarray] = [np.empty(0, np.uint32)] * rows
    states = {}
    shift, word = np.uint64(SCALE), np.uint64(32)
    freqs, starts = table.freq[grid], table.start[grid]
    for row in range(rows - 1, -1, -1):
        freq, start = freqs[row], starts[row]
        full = x >= freq << np.uint64(63 - SCALE)
        words[row] = x[full].astype(np.uint32)  # the low 32 bits
        x[full] >>= word
        whole = x // freq
        x = (whole << shift) + (x - whole * freq) + start
        if row % CHECKPOINT_ROWS == 0:
            states[row] = x.copy()
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.uint32)
    at = sorted(states)
    stream = np.concatenate(words) if rows else np.empty(0, np.uint32)
    body = (offsets[at].astype("<u4").tobytes()
            + b"".join(states[r].astype("<u8").tobytes() for r in at) + stream.astype("<u4").tobytes())
    tail = struct.pack("<7I", table.crc, SCALE, len(ids), lanes, CHECKPOINT_ROWS, len(at), len(stream)) + body
    return b"RNS1" + struct.pack("<I", zlib.crc32(tail)) + tail


def decode_block(blob: bytes, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of a block, or of its checkpoints ``first`` to before ``last``."""
    magic, crc, table_crc, scale, n_ids, lanes, every, marks, n_words = _HEAD.unpack_from(blob)
    if magic != b"RNS1" or zlib.crc32(blob[8:]) != crc:
        raise ValueError("block is damaged")
    if table_crc != table.crc or scale != SCALE:
        raise ValueError("block was coded with another table")
    rows = -(-n_ids // lanes)
    end = rows if last is None else min(rows, last * every)
    if first * every >= end:
        return np.empty(0, np.uint32)
    offsets = np.frombuffer(blob, "<u4", marks, _HEAD.size)
    states = np.frombuffer(blob, "<u8", marks * lanes, _HEAD.size + 4 * marks).reshape(marks, lanes)
    stream = np.frombuffer(blob, "<u4", n_words, _HEAD.size + 4 * marks + 8 * marks * lanes)
    x, at = states[first].astype(np.uint64), int(offsets[first])
    mask, shift, word = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
    out = np.empty((end - first * every, lanes), np.uint32)
    for row in range(len(out)):
        slot = x & mask
        index = table.slots[slot]
        out[row] = index
        x = table.freq[index] * (x >> shift) + slot - table.start[index]
        short = np.flatnonzero(x < _LOW)
        x[short] = (x[short] << word) | stream[at:at + len(short)]
        at += len(short)
    return table.tokens[out.ravel()[:n_ids - first * every * lanes]]


def token_records(docs: DataFrame, tokenizer_path: str, end: int | None, id_col: str, text_col: str) -> DataFrame:
    """Runs of whole documents in ascending id order, about BLOCK_IDS ids each:
    (part, record, start, n_ids, doc_ids, lengths, ids); ``start`` counts from
    the beginning of the part, parts ascend with the ids. The last row of a part has
    the record -1 and, instead of documents, the tokens of the part (``lengths``) and how
    often they occur (``doc_ids``)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok, part = tokenizer(tokenizer_path), TaskContext.get().partitionId()
        record, start, held, names, pieces = 0, 0, 0, [], []
        total = np.zeros(0, np.int64)

        def row(number: int, n_ids: int, doc_ids: list, lengths: list, ids: bytes) -> pd.DataFrame:
            return pd.DataFrame({"part": [part], "record": [number], "start": [start], "n_ids": [n_ids],
                                 "doc_ids": [doc_ids], "lengths": [lengths], "ids": [ids]})

        def flush() -> pd.DataFrame:
            nonlocal total
            ids = np.concatenate(pieces)
            seen = np.bincount(ids, minlength=len(total))
            seen[:len(total)] += total
            total = seen
            return row(record, held, names, [len(p) for p in pieces], ids.tobytes())

        for pdf in joined(batches, "text"):
            for name, ids in zip(pdf["id"].astype(object).where(pdf["id"].notna(), None), tok.ids_of_all(pdf["text"], end)):
                names.append(None if name is None else int(name))
                pieces.append(ids)
                held += len(pieces[-1])
                if held >= BLOCK_IDS:
                    yield flush()
                    start, record, held, names, pieces = start + held, record + 1, 0, [], []
        if pieces:
            yield flush()
        used = np.flatnonzero(total)
        yield row(-1, 0, total[used].tolist(), used.tolist(), b"")

    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
               .repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("text")))
    return ordered.mapInPandas(run, "part int, record int, start long, n_ids long, doc_ids array<long>, "
                                    "lengths array<long>, ids binary")


def frequency_table(records: DataFrame) -> Table:
    """The table over all ids, from the counts of the parts: at most one row per vocabulary entry reaches the driver."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, np.int64)
        for pdf in batches:
            for tokens, times in zip(pdf["lengths"], pdf["doc_ids"]):
                if len(tokens):
                    seen = np.bincount(tokens, times, minlength=len(total)).astype(np.int64)
                    seen[:len(total)] += total
                    total = seen
        used = np.flatnonzero(total)
        yield pd.DataFrame({"token": used, "n": total[used]})

    counted = (records.filter("record < 0").select("lengths", "doc_ids").mapInPandas(run, "token long, n long")
               .groupBy("token").agg(F.sum("n").alias("n")).toPandas())
    return Table(counted["token"].to_numpy(np.int64), counted["n"].to_numpy(np.int64))


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end: int | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` below ``path``: ``blocks`` (the runs) and ``table``.

    Documents are in ascending id order, null ids first, rows that repeat an id
    one after the other. A null or empty text has only the end id, if any.
    Empty tables give empty files. Other columns are not written.
    """
    width = tokenizer(tokenizer_path).dtype.str
    records = materialise(token_records(docs, tokenizer_path, end, id_col, text_col), "token-records")
    table = frequency_table(records)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            blocks = []
            for blob in pdf.pop("ids"):
                ids = np.frombuffer(blob, width)
                blocks.append([encode_block(ids[i:i + BLOCK_IDS], table) for i in range(0, len(ids), BLOCK_IDS)])
            yield pdf.assign(blocks=blocks)

    (records.filter("record >= 0").mapInPandas(run, "part int, record int, start long, n_ids long, doc_ids array<long>, "
                              "lengths array<long>, blocks array<binary>")
     .write.parquet(f"{path}/blocks"))
    spark = docs.sparkSession
    (spark.createDataFrame(pd.DataFrame({"token": table.tokens.astype(np.int64), "freq": table.freq.astype(np.int64)}),
                           "token long, freq long").coalesce(1).write.parquet(f"{path}/table"))


def read_table(docs: DataFrame) -> Table:
    stored = docs.toPandas()
    table = Table(stored["token"].to_numpy(np.int64), stored["freq"].to_numpy(np.int64))
    return table


def read_tokens(spark, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document, decoded and checked."""
    return _decoded(spark, path, lambda ids: ids.astype(np.int32), "ids array<int>")


def token_digests(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the decoded ids."""
    return _decoded(spark, path, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), "ids_crc32 long")


def _decoded(spark, path: str, value, column: str) -> DataFrame:
    table = read_table(spark.read.parquet(f"{path}/table"))
    blocks = spark.read.parquet(f"{path}/blocks")
    # One row per part, as many as the table was written with.
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").toPandas()
    base = dict(zip(sizes["part"], np.cumsum(sizes["n"]) - sizes["n"]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                at = int(row.start) + int(base[row.part])
                ids = (decode_block(b, table) for b in row.blocks)
                held, out = np.empty(0, np.uint32), []
                for name, length in zip(row.doc_ids, row.lengths):
                    while len(held) < length:
                        held = np.concatenate([held, next(ids)])
                    out.append((name, at, length, value(held[:length])))
                    held, at = held[length:], at + int(length)
                frame = pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", column.split()[0]])
                yield frame.assign(doc_id=frame["doc_id"].astype("Int64"))

    return (blocks.select("part", "start", "doc_ids", "lengths", "blocks")
            .mapInPandas(run, f"doc_id long, start long, n_tokens long, {column}"))


def roundtrip(docs: DataFrame, tokenizer_path: str, end: int) -> DataFrame:
    """Write ``docs`` to a fresh folder and report what is read back."""
    path = run_dir(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_path, end)
    return token_digests(docs.sparkSession, path)
