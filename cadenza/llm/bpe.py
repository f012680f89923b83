"""Byte-pair encoding and decoding with a rank array per word.

Reads the vocabulary and merges of a tokenizers file whose normaliser is NFC,
white-space folding and lower case, and whose pieces are cut by one pattern
and spelled in printable bytes. A short piece is encoded over contiguous
arrays: the boundaries of its parts and the merge ranks of neighbours. The
lowest rank is found by a scan, its boundary is deleted and the two ranks
beside it are looked up again. Long pieces, where that would turn quadratic,
use a heap over linked parts with the same order of merges.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cadenza.llm.tokens import latin_pattern

SHORT = 64
# Pieces and characters of one generation of the cache; there are two.
CACHE_WORDS, CACHE_CHARS = 1 << 19, 1 << 24
_NONE = 1 << 40


def _printable_bytes() -> list[str]:
    """The printable stand-in of each byte: itself where Latin-1 prints it,
    else the next character from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def _is_latin(text: str) -> bool:
    """Whether all characters are of Latin-1: composed as they are, each with a plain lower case."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class BytePairs:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or model["unk_token"] or model["continuing_subword_prefix"]:
            raise ValueError(f"{path} is not of the supported kind")
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((self.vocab[left], self.vocab[right]), (rank, self.vocab[left + right]))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.latin = latin_pattern(spec)[0]
        self.library = Tokenizer.from_file(path)
        self.names = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.printable = _printable_bytes()
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.chars = 0

    def _parts(self, piece: str) -> list[int]:
        shown = [self.printable[b] for b in piece.encode("utf-8")]
        shown[-1] += self.suffix
        return [self.vocab[s] for s in shown if s in self.vocab]

    def _rank(self, left: int, right: int) -> int:
        found = self.merges.get((left, right))
        return found[0] if found else _NONE

    def piece(self, text: str) -> list[int]:
        parts = self._parts(text)
        return self._merge_short(parts) if len(parts) <= SHORT else self._merge_long(parts)

    def _merge_short(self, parts: list[int]) -> list[int]:
        bounds = list(range(len(parts) + 1))  # where each part begins, and the end
        ranks = [self._rank(a, b) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            at = ranks.index(least)
            parts[bounds[at]] = self.merges[parts[bounds[at]], parts[bounds[at + 1]]][1]
            del bounds[at + 1], ranks[at]
            for i in (at - 1, at):
                if 0 <= i < len(ranks):
                    ranks[i] = self._rank(parts[bounds[i]], parts[bounds[i + 1]])
        return [parts[b] for b in bounds[:-1]]

    def _merge_long(self, parts: list[int]) -> list[int]:
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self._rank(parts[i], parts[i + 1]), i, parts[i], parts[i + 1]) for i in range(n - 1)]
        heap = [h for h in heap if h[0] != _NONE]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i] if parts[i] == left else n
            if j >= n or parts[j] != right:
                continue
            parts[i], parts[j] = self.merges[left, right][1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (rank := self._rank(parts[a], parts[b])) != _NONE:
                    heapq.heappush(heap, (rank, a, parts[a], parts[b]))
        return [p for p in parts if p >= 0]

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text, special tokens among them."""
        out = []
        runs = self.cut_special.split(text) if self.cut_special and any(s in text for s in self.special) else [text]
        for run in runs:
            if run in self.special:
                out.append(run)
            elif self.latin and _is_latin(run):
                out += self.latin.findall(run.lower())
            elif not run.isascii() and any(unicodedata.category(c) == "Cn" for c in set(run)):
                # Characters newer than Python's tables: the library knows their class and case.
                plain = self.library.normalizer.normalize_str(run)
                out += [plain[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(plain)]
            else:
                plain = unicodedata.normalize("NFC", run)
                # Each character by itself: no final sigma.
                plain = "".join(map(str.lower, plain)) if "Σ" in plain else plain.lower()
                out += self.pattern.findall(plain)
        return out

    def encode(self, text: str | None) -> np.ndarray:
        pieces = self.pieces(text or "")
        new = {p for p in pieces if p not in self.cache}
        if new:
            if len(self.cache) + len(new) > CACHE_WORDS or self.chars > CACHE_CHARS:
                # Pieces still in use move on from the older generation.
                self.older, self.cache, self.chars, new = self.cache, {}, 0, set(pieces)
            self.cache.update((p, self.older[p] if p in self.older else np.array(self._ids(p), "<i4").tobytes())
                              for p in new)
            self.chars += sum(map(len, new))
        return np.frombuffer(b"".join(map(self.cache.__getitem__, pieces)), "<i4")

    def _ids(self, piece: str) -> list[int]:
        return [self.special[piece]] if piece in self.special else self.piece(piece)

    def decode(self, ids: np.ndarray) -> str:
        """Tokens as they stand in the vocabulary, one space between them."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


_OPEN: dict[str, BytePairs] = {}


def byte_pairs(path: str) -> BytePairs:
    if path not in _OPEN:
        _OPEN[path] = BytePairs(path)
    return _OPEN[path]


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every whole text; null and empty texts give no ids.

    Rows are independent: repeated rows and null ids come out as they went in.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = byte_pairs(tokenizer_path)
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "ids": [pairs.encode(t) for t in pdf["text"]]})

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInPandas(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col))


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids; null ids give null."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != into)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = byte_pairs(tokenizer_path)
        for pdf in batches:
            yield pdf.assign(**{into: [None if ids is None else pairs.decode(ids) for ids in pdf[ids_col]]})

    return encoded.drop(into).mapInPandas(run, f"{kinds}, `{into}` string")
