"""The pipeline's stages, each against plain Python on what its predecessor kept."""

import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cadenza.llm.common import documents
from cadenza.llm.packing import CAPACITY
from cadenza.llm.quality import RULES, STOP_WORDS
from cadenza.llm.queries import tokenizer_file
from cadenza.workspace import materialise

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tables(spark):
    """The documents, then what each stage returns."""
    out = [documents(spark, SF)]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], SF), name))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def passes(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    if len(words) < 10 or 100 * len(covered) > 20 * len(words):
        return False
    lines = [x for x in text.split("\n") if WORD.search(x)]
    stops = {f for w in STOP_WORDS for f in (w, w.capitalize())}
    ratios = {"words": len(words), "mean_word_chars": sum(map(len, words)) / len(words),
              "symbols_per_word": sum(c in "#*$%&|<>" for c in text) / len(words),
              "stop_word_share": (sum(w in stops for w in words) + 1) / len(words),
              "dup_line_share": (len(lines) - len(set(lines))) / len(lines), "words_per_line": len(words) / len(lines)}
    return all((low is None or ratios[n] >= low) and (high is None or ratios[n] <= high) for n, low, high in RULES)


def test_language_stage(tables):
    before, after = texts(tables[0]), texts(tables[1])
    assert all(after[i] == before[i] for i in after)
    assert {i for i, t in before.items() if any(map(str.isalpha, t))} >= set(after)
    assert len(after) >= 0.98 * len(before)


def test_quality_stage(tables):
    before = texts(tables[1])
    assert texts(tables[2]) == {i: t for i, t in before.items() if passes(t)}


def test_line_stage(tables):
    before, after = texts(tables[2]), texts(tables[3])
    corpus = "\0".join(after.values())
    for i, text in before.items():
        left = after.get(i, "")
        if left == text:
            continue
        at = 0
        for char in left:  # what is left is the text without some runs
            at = text.index(char, at) + 1
        for unit in re.split(r"(?<=\n)|(?<=[.!?|] )", text):
            assert unit in left or unit in corpus


def test_minhash_stage(tables):
    before = texts(tables[3])
    sets = {}
    for i, t in before.items():
        words = t.encode().lower().split()
        n = min(5, len(words))
        sets[i] = {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if n else set()
    holders, shared = defaultdict(list), Counter()
    for i, s in sorted(sets.items()):
        for g in s:
            shared.update((j, i) for j in holders[g])
            holders[g].append(i)
    root = {i: i for i in before}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            hi, lo = sorted((find(a), find(b)), reverse=True)
            root[hi] = lo
    assert texts(tables[4]) == {i: t for i, t in before.items() if find(i) == i}


def test_packing_stage_and_run(spark, tables):
    tok = Tokenizer.from_file(tokenizer_file())
    lengths = {i: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in texts(tables[4]).items()}
    held, used = defaultdict(int), defaultdict(int)
    rows = tables[5].collect()
    for r in rows:
        held[r.doc_id] += r.length
        used[r.sequence_id] += r.length
    assert held == lengths
    sizes = np.array(list(used.values()))
    assert ((sizes == CAPACITY) | ((sizes & (sizes - 1)) == 0)).all()
    again = corpus_pipeline.run(spark, SF).collect()
    key = lambda r: (r.doc_id, r.start)
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sum(r.length for r in again) == sum(r.length for r in rows)
    assert {r.doc_id: r.doc_tokens for r in again} == {r.doc_id: r.doc_tokens for r in rows}
    assert sorted(map(key, again))[0] == sorted(map(key, rows))[0] and set(columns) <= set(again[0].asDict())
