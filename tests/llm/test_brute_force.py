"""Registered queries over whole small tables, against plain Python."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from cadenza.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall())


@pytest.fixture(scope="module")
def ids(texts):
    tok = Tokenizer.from_file(queries.tokenizer_file())
    return {i: tok.encode(t, add_special_tokens=False).ids for i, t in texts.items()}


def rows(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_lm_score(spark, texts):
    found = {r.doc_id: r for r in rows(spark, "op2_lm_score")}
    tokens = {i: t.encode().lower().split() + [b"\n"] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts, pairs = Counter(), Counter()
    for i, words in tokens.items():
        if not held[i]:
            counts.update(words)
            pairs.update(zip([None, *words], words))
    total, size = sum(counts.values()), len(counts)

    def discounts(values):
        n = [sum(v == k for v in values) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        raw = (1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2])
        return [0.0, *(min(max(d, 0.1), top) for d, top in zip(raw, (0.9, 1.9, 2.9)))]

    before, after, starts = Counter(w for _, w in pairs), defaultdict(list), Counter()
    for (v, w), n in pairs.items():
        after[v].append(n)
        starts[v] += n
    d2, d1 = discounts(pairs.values()), discounts(before.values())
    rest = sum(d1[min(n, 3)] for n in before.values()) / len(pairs)

    def unigram(w):
        n = before[w]
        return (max(n - d1[min(n, 3)], 0) if n else 0) / len(pairs) + rest / (size + 1)

    def probability(v, w):
        if v not in after:
            return unigram(w)
        n = pairs[v, w]
        gamma = sum(d2[min(m, 3)] for m in after[v]) / starts[v]
        return (max(n - d2[min(n, 3)], 0) if n else 0) / starts[v] + gamma * unigram(w)

    assert sum(probability(b"the", w) for w in counts) + probability(b"the", b"\0new") == pytest.approx(1)
    assert len(found) == len(texts)
    for i, words in tokens.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(words), total)
        assert r.n_known == sum(counts[w] > 0 for w in words)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + size + 1)) for w in words))
        assert r.score == pytest.approx(sum(math.log10(probability(v, w)) for v, w in zip([None, *words], words)))
    unseen = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_token_file(spark, ids):
    start = 0
    found = {r.doc_id: r for r in rows(spark, "op3_token_file")}
    for i in sorted(ids):
        want = [*ids[i], 1]
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (start, len(want), crc(want))
        start += len(want)
    assert len(found) == len(ids)


def test_packing(spark, ids):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows(spark, "op5_packing"):
        want = [*ids[r.doc_id], 1]
        assert r.doc_tokens == len(want) and r.ids_crc32 == crc(want[r.start:r.start + r.length])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for parts, total in [(pieces[i], len(ids[i]) + 1) for i in ids] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == total if total else at <= 2048 and at & (at - 1) == 0


def test_bpe(spark, ids):
    tok = Tokenizer.from_file(queries.tokenizer_file())
    found = rows(spark, "op8_bpe")
    for r in found:
        want = ids[r.doc_id]
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        decoded = tok.decode(want, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert len(found) == len(ids)


def test_language_id_on_held_out_rows(spark):
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    found = [r for r in rows(spark, "op10_language_id") if r.held_out]
    assert all(0 <= r.score <= 1 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in found)
    assert sum(r.lang_pred == langs[r.doc_id] for r in found) >= 0.95 * len(found)


def test_line_dedup(spark, texts):
    """Whatever is removed stays once, and what is left unchanged is byte for byte the text."""
    found = {r.doc_id: r for r in rows(spark, "op6_line_dedup")}
    assert set(found) == set(texts)
    all_left = "\0".join(found[i].text for i in sorted(found))
    for i, r in found.items():
        assert (r.text == texts[i]) == (r.n_removed == 0)
        if r.n_removed:
            for line in re.split("\n", texts[i]):
                assert len(line) < 200 or line in r.text or line[60:-60][:40] in all_left


def test_license_scan(spark, texts):
    named = {"MIT": "MIT License", "Apache-2.0": "Apache License", "GPL-3.0": "General Public License, version 3",
             "CC-BY-NC-4.0": "CC BY-NC 4.0", "Proprietary": "All rights reserved"}
    found = rows(spark, "op7_license_scan")
    for r in found:
        assert (r.notice is not None) == any(n in texts[r.doc_id] for n in named.values())
        assert r.notice is None or named[r.notice] in texts[r.doc_id]
        assert r.licence_dir is None or r.path.startswith(r.licence_dir)
    assert len(found) == len(texts)
