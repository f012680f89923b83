"""Alignment of two tokenizers against plain Python."""

import hashlib
import os
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm import align, queries

SF = "/root/testdata/sf0.001"
PATHS = tuple(queries.tokenizer_file(name) for name in queries.ALIGNED)
OWN = align.Aligner(*PATHS)


def spans(sizes, ids):
    out, at = [], 0
    for i in ids:
        out.append((at, at + sizes[i], i))
        at += sizes[i]
    return out


def plain(text):
    """Spans of both sides, overlapping pairs and spelled groups, by walking the bytes."""
    if not text:
        return [], [], [], []
    a = OWN.a.encode(" " + text, add_special_tokens=False).ids
    b = OWN.b.encode(text)
    whole = (" " + text).encode()
    if b"".join(OWN.bytes_a[i] for i in a) != whole or b"".join(OWN.bytes_b[i] for i in b) != whole:
        return [], [], [], []
    a, b = spans([len(x) for x in OWN.bytes_a], a), spans([len(x) for x in OWN.bytes_b], b)
    pairs, j = [], 0
    for start, stop, i in a:
        while b[j][1] <= start:
            j += 1
        k = j
        while k < len(b) and b[k][0] < stop:
            pairs.append((i, b[k][2]))
            k += 1
    groups, left, right = [], [], []
    cuts = {s for _, s, _ in a} & {s for _, s, _ in b}
    at_b = 0
    for _, stop, i in a:
        left.append(str(i))
        if stop in cuts:
            while at_b < len(b) and b[at_b][1] <= stop:
                right.append(str(b[at_b][2]))
                at_b += 1
            groups.append(",".join(left) + "|" + ",".join(right))
            left, right = [], []
    return a, b, pairs, groups


def expected(texts):
    per = [plain(t) for t in texts]
    counts = Counter(p for _, _, pairs, _ in per for p in pairs)
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    rows = [(len(a), len(b), len(g), len(p), sum(counts[x] == top[x[1]] for x in p), sum(counts[x] for x in p),
             hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for a, b, p, g in per]
    return rows, counts, top


def held(frame):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((str(r["doc_id"]), *[r[n] for n in names]) for r in frame.collect())


@given(st.text(max_size=40) | st.text("a b\n\t▁é<|endoftext|>漢🙂\x00 ́</s>", max_size=40))
@settings(max_examples=400, deadline=None)
def test_one_text(text):
    found, whole = OWN.align([text])[0], OWN._align_run([text])[0] if text else None
    a, b, pairs, groups = plain(text)
    assert (found.n_a, found.n_b, found.n_groups, found.spelled) == (len(a), len(b), len(groups), ";".join(groups))
    assert whole is None or whole == found
    linked = Counter((int(x), int(OWN.identity[x])) for x in np.frombuffer(found.same, "<u4"))
    for key in found.odd:
        linked.update(zip(*(x.tolist() for x in OWN.links(key))))
    assert linked == Counter(pairs)


def test_cuts_and_generations(monkeypatch):
    monkeypatch.setattr(align, "REMEMBERED", 8)
    own = align.Aligner(*PATHS)
    assert own.cuts
    texts = [f"the  cat's {w} sat\n on {w}, {w}{w} \x1c{w} end " for w in ("a", "bé", "c" * 300, "漢", "d", "e")] * 2
    for one, many in zip([own.align([t])[0] for t in texts], own.align(texts)):
        assert one == many
    assert [x.spelled for x in own.align(texts)] == [";".join(plain(t)[3]) for t in texts]


def test_identity_map():
    for i, j in enumerate(OWN.identity.tolist()):
        assert j < 0 or OWN.bytes_a[i] == OWN.bytes_b[j]
    assert (OWN.identity >= 0).sum() > 5000
    assert sorted(align.byte_alphabet().values()) == list(range(256))


@pytest.mark.parametrize("common", [align.COMMON, 3])
def test_edges_equal_plain_python(spark, edge_docs, monkeypatch, common):
    monkeypatch.setattr(align, "COMMON", common)
    frame, links = align.align_tokens(edge_docs, *PATHS)
    rows = edge_docs.select("doc_id", "text").collect()
    want, counts, top = expected([r.text for r in rows])
    assert held(frame) == sorted((str(r.doc_id), *w) for r, w in zip(rows, want))
    found = {(r["pair"] >> 32, r["pair"] & 0xFFFFFFFF): (r["count"], r["best"]) for r in links.collect()}
    assert found == {p: (n, n == top[p[1]]) for p, n in counts.items()}


def test_empty_table(no_docs):
    frame, links = align.align_tokens(no_docs, *PATHS)
    assert frame.collect() == [] and links.collect() == []


def test_a_long_text_without_common_ends(spark):
    texts = ["漢" * 30_000, "x" * 50_000, "▁ sign of the other side", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert held(align.align_tokens(frame, *PATHS)[0]) == sorted((str(i), *w) for i, w in enumerate(expected(texts)[0]))


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")
def test_registered_query(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    want = sorted((str(i), *w) for (i, _), w in zip(rows, expected([t for _, t in rows])[0]))
    assert held(queries.op12_token_alignment(spark, SF)) == want
