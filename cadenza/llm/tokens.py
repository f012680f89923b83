"""Token ids of whole texts by the tokenizers library, with repeated words looked up."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Of one generation of the cache; there are two.
CACHE_WORDS, CACHE_CHARS = 1 << 19, 1 << 24
# New pieces that are encoded as one text.
RUN = 128


class WordTokenizer:
    """Ids of a text under a tokenizer that never joins what white space parts.

    Each distinct piece goes through the library once and its ids are kept as
    bytes. Texts are cut at ASCII white space; where the file only folds case and
    cuts at one pattern, Latin-1 words are cut again at that pattern, so a
    piece is the same whatever its case and the marks around it.
    A full cache becomes the older of two generations, from which pieces still
    in use move on: memory does not grow with the vocabulary.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.pattern, self.special = latin_pattern(json.loads(self.library.to_str()))
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.chars = 0
        self.covers = _covers(self.pattern)
        # For pieces that are cut and folded already: the library without these two steps.
        self.plain = Tokenizer.from_str(self.library.to_str())
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        self.last = np.zeros(max(self.library.get_vocab().values(), default=0) + 1, bool)
        self.last[[i for t, i in self.library.get_vocab(False).items() if suffix and t.endswith(suffix)]] = True

    def _pieces(self, word: str) -> list[str]:
        if self.pattern and not any(s in word for s in self.special):
            try:
                word.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                return self.pattern.findall(word.lower())
        return [word]

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece, runs of them at a time."""
        match = self.pattern.match if self.pattern else lambda p: None
        whole = [p for p in pieces if p.isascii() and (m := match(p)) and m.end() == len(p)]
        text = " ".join(whole)
        if not whole or text != text.lower() or any(s in text for s in self.special):
            return self._encode_marked(pieces)
        known = dict(zip(whole, self._encode_plain(whole)))
        rest = [p for p in pieces if p not in known]
        known.update(zip(rest, self._encode_marked(rest)))
        return [known[p] for p in pieces]

    def _encode_plain(self, pieces: list[str]) -> list[bytes]:
        """Ids of lower-case pieces that the pattern leaves whole; the last token of each tells that it is."""
        runs = [" ".join(pieces[i:i + RUN]) for i in range(0, len(pieces), RUN)]
        encoded = self.plain.encode_batch_fast(runs, add_special_tokens=False)
        flat = np.fromiter(chain.from_iterable(e.ids for e in encoded), self.dtype)
        ends = np.flatnonzero(self.last[flat]) + 1
        if len(ends) != len(pieces):  # the vocabulary lacks a character, or does not mark last tokens
            return self._encode_marked(pieces)
        raw, stops = flat.tobytes(), (ends * self.dtype.itemsize).tolist()
        return [raw[i:j] for i, j in zip([0, *stops], stops)]

    def _encode_marked(self, pieces: list[str]) -> list[bytes]:
        """Ids of any pieces, with a special token after each to tell them apart."""
        mark = next((t for t in self.special if self.library.token_to_id(t) is not None), None)
        if mark and len(pieces) > 1:
            runs = [mark.join(pieces[i:i + RUN]) + mark for i in range(0, len(pieces), RUN)]
            encoded = self.library.encode_batch_fast(runs, add_special_tokens=False)
            flat = np.fromiter(chain.from_iterable(e.ids for e in encoded), self.dtype)
            ends = np.flatnonzero(flat == self.library.token_to_id(mark))
            if len(ends) == len(pieces) == sum(r.count(mark) for r in runs):  # no piece holds the mark itself
                raw, width = flat.tobytes(), self.dtype.itemsize
                stops = (ends * width).tolist()
                return [raw[i:j] for i, j in zip([0, *(e + width for e in stops)], stops)]
        encoded = self.library.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in encoded]

    def _know(self, pieces: list[str]) -> list[bytes]:
        """Ids of each of ``pieces``, all different; new ones go to the cache."""
        found = list(map(self.cache.get, pieces))
        new = [p for p, ids in zip(pieces, found) if ids is None]
        if not new:
            return found
        if len(self.cache) + len(new) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self.older, self.cache, self.chars, new = self.cache, {}, 0, pieces
        self.cache.update((w, self.older[w]) for w in new if w in self.older)
        listed = [w for w in new if w not in self.older]
        self.cache.update(zip(listed, self._encode(listed)))
        self.chars += sum(map(len, new))
        return list(map(self.cache.__getitem__, pieces))

    def ids(self, text: str | None, end: int | None = None) -> np.ndarray:
        """Ids of ``text`` (null: none), then ``end`` if given."""
        return self.ids_of_all([text], end)[0]

    def ids_of_all(self, texts: Iterable[str | None], end: int | None = None) -> list[np.ndarray]:
        """``ids`` of each text. Each different word of them is cut once and each different piece
        looked up once; new ones are encoded together."""
        listed = pc.ascii_split_whitespace(pc.fill_null(pa.array(texts, pa.large_string()), ""))
        words, bounds = listed.values.dictionary_encode(), listed.offsets.to_numpy()
        cut = pc.ascii_split_whitespace(self._spaced(words.dictionary))
        pieces, marks = cut.values.dictionary_encode(), cut.offsets.to_numpy()
        parts = self._know(_strings(pieces.dictionary))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // self.dtype.itemsize
        of_words, at = _gather(np.frombuffer(b"".join(parts), self.dtype), _stops(sizes), pieces.indices.to_numpy())
        ids, at = _gather(of_words, at[marks], words.indices.to_numpy())
        ends = at[bounds[1:]]
        if end is not None:
            ids = np.insert(ids, ends, end)
            ends = ends + np.arange(1, len(ends) + 1)
        return [ids[i:j] for i, j in zip([0, *ends.tolist()], ends.tolist())]

    def _spaced(self, words: pa.Array) -> pa.Array:
        """Words with white space between their pieces, which hold none."""
        if not self.covers:
            return pa.array([" ".join(self._pieces(w)) for w in _strings(words)], pa.large_string())
        spaced = pc.replace_substring_regex(pc.utf8_lower(words), self.pattern.pattern, r"\0 ")
        odd = pc.match_substring_regex(words, "[^!-~¡-ÿ]")
        for special in self.special:
            odd = pc.or_(odd, pc.match_substring(words, special))
        if pc.any(odd).as_py():
            rest = [" ".join(self._pieces(w)) for w in _strings(words.filter(odd))]
            spaced = pc.replace_with_mask(spaced, odd, pa.array(rest, pa.large_string()))
        return spaced


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


def _stops(sizes: np.ndarray) -> np.ndarray:
    """Bounds of runs of these sizes, one after the other."""
    return np.concatenate([[0], np.cumsum(sizes)])


def _gather(held: np.ndarray, bounds: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbered runs of ``held`` one after the other, and their bounds there."""
    sizes = np.diff(bounds)[runs]
    stops = _stops(sizes)
    return held[np.repeat(bounds[:-1][runs] - stops[:-1], sizes) + np.arange(stops[-1])], stops


def _covers(pattern: re.Pattern | None) -> bool:
    """Whether every printable Latin-1 character is in a match, whatever is beside it, and Arrow can match the pattern."""
    if pattern is None or not all(pattern.fullmatch(chr(c).lower()) for c in (*range(0x21, 0x7F), *range(0xA1, 0x100))):
        return False
    try:
        pc.match_substring_regex(pa.array([""]), pattern.pattern)
    except pa.ArrowInvalid:
        return False
    return True


def latin_pattern(spec: dict) -> tuple[re.Pattern | None, list[str]]:
    """The pattern that cuts pieces of Latin-1 texts, if nothing but case, composition
    and white space is normalised, and the special tokens, which are cut before it."""
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    special = [t["content"] for t in spec.get("added_tokens", [])]
    if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        return None, special
    split = cuts[0]
    if steps[1].get("content") != " " or not split.get("invert") or split.get("behavior") != "Removed" or cuts[1]["use_regex"]:
        return None, special
    pattern = split["pattern"]["Regex"]
    if regex.search(r"\\[A-Za-z]", regex.sub(r"\[[^\]]*\]", "", pattern)):
        return None, special  # a class outside brackets
    for name in (r"\p{L}", r"\p{N}", r"\s"):  # spelled out, for the standard library's faster matcher
        pattern = pattern.replace(name, "".join(f"\\x{c:02x}" for c in range(256) if regex.fullmatch(name, chr(c))))
    return re.compile(pattern), special


def joined(batches: Iterable[pd.DataFrame], text_col: str, chars: int = 1 << 22) -> Iterator[pd.DataFrame]:
    """The batches, in order, put together until their texts hold ``chars`` or more: words repeat more in a larger one."""
    held, size = [], 0
    for pdf in batches:
        held.append(pdf)
        size += int(pdf[text_col].str.len().sum()) if len(pdf) and pdf[text_col].notna().any() else 0
        if size >= chars:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


_OPEN: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer for a file, kept between tasks."""
    if path not in _OPEN:
        _OPEN[path] = WordTokenizer(path)
    return _OPEN[path]
