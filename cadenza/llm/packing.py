"""Cost-balanced packing of documents into sequences of a fixed token capacity.

A piece of n tokens costs ``n + n * n / QUADRATIC``: the linear part of a
transformer layer and the attention that grows with the square. Documents are
cut at the capacity; what is left of each is packed in windows of about
``WINDOW`` tokens: largest cost first, to the sequence of lowest cost that has
room for it. Where none has, the piece is cut to fill the cheapest one. Every
window opens exactly as many sequences as its tokens fill, the rest going to
sequences of powers of two, so nothing is padded.

A window lies inside one input partition: no shuffle, bounded memory, and a
lost task is redone alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.tokens import joined, tokenizer

CAPACITY = 2048
WINDOW = 1 << 20
QUADRATIC = 1024  # tokens at which attention costs as much as the linear part


def cost(n: np.ndarray | int) -> np.ndarray | float:
    return n + n * n / QUADRATIC


def sequence_sizes(total: int, capacity: int = CAPACITY) -> list[int]:
    """Full sequences, then the rest as powers of two, largest first."""
    rest = total % capacity
    return [capacity] * (total // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(lengths: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(item, start in item, length, sequence, offset) for every piece."""
    sizes = np.array(sequence_sizes(int(lengths.sum()), capacity), np.int64)
    room, spent = sizes.copy(), np.zeros(len(sizes))
    # What has the full capacity fills the first sequences and needs no search.
    out = []
    for item in np.argsort(-cost(lengths.astype(float)), kind="stable"):
        start, left = 0, int(lengths[item])
        while left:
            fits = np.flatnonzero(room >= left)
            if not len(fits):
                fits = np.flatnonzero(room > 0)
            to = fits[spent[fits].argmin()]
            n = min(left, int(room[to]))
            out.append((int(item), start, n, int(to), int(sizes[to] - room[to])))
            room[to] -= n
            spent[to] += cost(n)
            start, left = start + n, left - n
    return out


def pack(docs: DataFrame, tokenizer_path: str, end: int | None = None, capacity: int = CAPACITY,
         window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are the end id alone; a document without any id has no
    piece. Rows that repeat an id are documents of their own. ``with_ids`` adds
    the piece's ids. Other columns are ignored.
    """
    if capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = tokenizer(tokenizer_path)
        sequence = TaskContext.get().partitionId() << 40

        def rows(pieces: list[tuple], first: int) -> pd.DataFrame:
            out = [(name, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, first + seq, at,
                    *([ids.astype(np.int32)] if with_ids else []))
                   for name, start, ids, total, seq, at in pieces]
            frame = pd.DataFrame(out, columns=columns)
            return frame.assign(**{id_col: frame[id_col].astype("Int64")})

        open_docs, held, full = [], 0, []

        def close() -> tuple[list, int]:
            lengths = np.array([len(d[2]) for d in open_docs], np.int64)
            placed = [(open_docs[i][0], open_docs[i][1] + s, open_docs[i][2][s:s + n], open_docs[i][3], seq, at)
                      for i, s, n, seq, at in assign(lengths, capacity)]
            return placed, len(sequence_sizes(int(lengths.sum()), capacity))

        for pdf in joined(batches, text_col):
            names = pdf[id_col].astype(object).where(pdf[id_col].notna(), None)
            for name, ids in zip(names, tok.ids_of_all(pdf[text_col], end)):
                whole = len(ids) // capacity * capacity
                full += [(name, s, ids[s:s + capacity], len(ids), i, 0)
                         for i, s in enumerate(range(0, whole, capacity), len(full))]
                if len(ids) > whole:
                    open_docs.append((name, whole, ids[whole:], len(ids)))
                    held += len(ids) - whole
                if held >= window:
                    placed, used = close()
                    yield rows(placed, sequence)
                    sequence, open_docs, held = sequence + used, [], 0
                if full:
                    if len(full) >= 256:
                        yield rows(full, sequence)
                        sequence, full = sequence + len(full), []
        if full:
            yield rows(full, sequence)
            sequence += len(full)
        if open_docs:
            placed, _ = close()
            yield rows(placed, sequence)

    columns = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = ", ".join(f"`{c}` {'array<int>' if c == 'ids' else 'long'}" for c in columns)
    return (docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias(text_col))
            .mapInPandas(run, schema))
