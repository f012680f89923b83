"""Operators on their own: properties, ties, damage, skew."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cadenza.llm import bpe, components, langid, licenses, lines, minhash, packing, quality, rans, topk
from cadenza.llm.queries import tokenizer_file
from cadenza.llm.tokens import WordTokenizer
from cadenza.workspace import materialise

LIBRARY = Tokenizer.from_file(tokenizer_file())
OWN = bpe.BytePairs(tokenizer_file())
WORDS = WordTokenizer(tokenizer_file())


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@given(st.text(max_size=60) | st.text("aàéß'sİΣσ ́  \x1c\n\t<|endoftxstar>1½", max_size=80))
@settings(max_examples=600, deadline=None)
def test_encoders_equal_the_library(text):
    assert OWN.encode(text).tolist() == library_ids(text)
    assert WORDS.ids(text).tolist() == library_ids(text)
    assert OWN.decode(OWN.encode(text)) == LIBRARY.decode(library_ids(text), skip_special_tokens=False)


def test_a_repeated_word_is_cut_once(monkeypatch):
    texts = ["Sigma Σίγμα, it's " * 300, None, "", "x\xa0y ½ a\x85b 'sta'rem <|endoftext|>z\x0bq été-ÉTÉ\xad " * 300]
    tok, cut = WordTokenizer(tokenizer_file()), []
    monkeypatch.setattr(tok, "_pieces", lambda word, own=tok._pieces: (cut.append(len(word)), own(word))[1])
    assert [x.tolist() for x in tok.ids_of_all(texts, 1)] == [[*library_ids(t or ""), 1] for t in texts]
    assert sum(cut) < 200


@given(st.lists(st.text("abcXYZ 'st-.,!09\n\t", max_size=40), max_size=6))
@settings(max_examples=200, deadline=None)
def test_texts_of_a_batch_encode_alone(texts):
    assert [x.tolist() for x in WORDS.ids_of_all(texts)] == [library_ids(t) for t in texts]


def test_special_tokens_and_long_words():
    text = "a<|endoftext|>b <|startoftext|> " + "abcdefghij" * 500 + " " + "ß" * 3000
    assert OWN.encode(text).tolist() == library_ids(text)


@given(st.text("abcdeinrst", min_size=1, max_size=120))
@settings(max_examples=100, deadline=None)
def test_short_and_long_merges_agree(word):
    assert OWN._merge_short(OWN._parts(word)) == OWN._merge_long(OWN._parts(word))


@pytest.mark.parametrize("n", [0, 1, 31, 33, 5000, 200_000])
def test_rans_round_trip_and_checkpoints(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 40_000).astype(np.uint32)
    table = rans.Table(*np.unique(np.append(ids, 7), return_counts=True))
    assert int(table.freq.sum()) == 1 << rans.SCALE and table.freq.min() > 0
    blob = rans.encode_block(ids, table)
    assert rans.decode_block(blob, table).tolist() == ids.tolist()
    parts = [rans.decode_block(blob, table, i, i + 1) for i in range(8)]
    assert np.concatenate(parts).tolist() == ids.tolist()[:sum(map(len, parts))]
    if n > 10_000:
        assert len(blob) < 2 * n


def test_rans_finds_damage():
    ids = np.arange(1000, dtype=np.uint32)
    table = rans.Table(*np.unique(ids, return_counts=True))
    blob = bytearray(rans.encode_block(ids, table))
    blob[-5] ^= 1
    with pytest.raises(ValueError):
        rans.decode_block(bytes(blob), table)


@given(st.lists(st.integers(1, 2047), max_size=80))
@settings(max_examples=80, deadline=None)
def test_packing_fills_every_sequence(lengths):
    sizes = packing.sequence_sizes(sum(lengths))
    used, covered = defaultdict(int), defaultdict(int)
    for item, start, n, to, offset in packing.assign(np.array(lengths, np.int64)):
        assert start == covered[item] and offset == used[to] and n > 0
        covered[item] += n
        used[to] += n
    assert [used[i] for i in range(len(sizes))] == sizes
    assert [covered[i] for i in range(len(lengths))] == lengths


def test_packing_balances_cost():
    lengths = np.random.default_rng(1).integers(10, 2047, 2000)
    spent = defaultdict(float)
    for _, _, n, to, _ in packing.assign(lengths):
        spent[to] += packing.cost(n)
    full = [spent[i] for i, s in enumerate(packing.sequence_sizes(int(lengths.sum()))) if s == packing.CAPACITY]
    assert np.std(full) < 0.25 * np.mean(full)


def test_signature_distance_covers_similar_sets():
    rng = np.random.default_rng(5)
    far = 0
    for _ in range(300):
        shared, left, right = (rng.integers(1, 2**63, n).astype(np.uint64) for n in (160, 20, 20))
        a, b = (minhash.signature(np.concatenate([shared, x])).view(np.uint16) for x in (left, right))
        far += (a != b).sum() > 2 * minhash.CHUNKS - 1
    assert far == 0


def test_minhash_of_a_crowded_group(spark):
    """One long chain of near copies, exact copies, and a reader that is like none."""
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in rng.integers(0, 10**6, 120)]
    texts = []
    for i in range(700):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 6)):
            words[at] = f"x{rng.integers(0, 10**6)}"
        texts.append(" ".join(words))
    texts += [texts[3]] * 50 + [" ".join(reversed(base))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, shingle=4).collect()}
    sets = [frozenset(zip(*[t.split()[i:] for i in range(4)])) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                hi, lo = sorted((find(i), find(j)), reverse=True)
                root[hi] = lo
    assert got == {i: find(i) for i in range(len(texts))}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (129, 200), (200, 201)]
    got = {r.id: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in [*range(100, 130), 200, 201]}}


def test_topk_ties_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(3)
    vectors = {i: rng.integers(-3, 4, 4).astype(float).tolist() for i in range(400)}
    vectors |= {i: [1.0, 1.0, 1.0, 1.0] for i in range(400, 600)}
    rows = [*vectors.items(), (600, None), (601, [1.0, None, 1.0, 1.0]), (602, [float("nan")] * 4), (None, [1.0] * 4), (5, vectors[5])]
    table = spark.createDataFrame(rows, "vec_id long, x array<double>").select("vec_id", topk.quantised("x", 1).alias("vector"))
    got = defaultdict(list)
    for r in topk.top_k(table, table.filter("vec_id % 20 = 0"), 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    for q in [q for q in vectors if q % 20 == 0]:
        scores = sorted((-int(np.dot(vectors[q], v)), i) for i, v in vectors.items() if i != q)[:5]
        assert got[q] == [(i, -s) for s, i in scores]
    assert set(got) == {q for q in vectors if q % 20 == 0}


def test_topk_over_several_groups_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "GROUP", 16)
    rng = np.random.default_rng(4)
    m = np.round(np.concatenate([rng.normal(c, 3, (150, 6)) for c in rng.normal(0, 60, (6, 6))]))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, vector array<double>")
    got = defaultdict(list)
    for r in topk.top_k(table, table.filter("vec_id % 5 = 0"), 3).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    scores = (m @ m.T).astype(int)
    for q in range(0, len(m), 5):
        assert got[q] == [(i, -s) for s, i in sorted((-scores[q, i], i) for i in range(len(m)) if i != q)[:3]]


SENTENCES = [f"Sentence {i} of the {w} passage goes on for some words." for i in range(14) for w in ("shared",)]


def test_a_shared_passage_stays_once(spark):
    """Shift-resistant: other text before, after and around; 14 sentences in the middle of a line."""
    passage = " ".join(SENTENCES)
    own = [" ".join(f"Text {d} has its own line number {i}, unlike any other." for i in range(6)) for d in range(4)]
    texts = [own[0] + " " + passage, own[1][:150] + ". " + passage + "\n" + own[1], passage, own[3]]
    out = lines.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: r for r in out.collect()}
    assert got[0].text == texts[0] and got[3].text == texts[3]
    for d in (1, 2):
        assert got[d].n_removed > 0 and sum(s in got[d].text for s in SENTENCES) <= 7
    assert own[1] in got[1].text


def test_quality_thresholds_are_a_table(spark):
    docs = spark.createDataFrame([(0, "the cat sat on the mat and it was of the house by a tree"),
                                  (1, "## $$ ## $$ the ## $$ of ## $$ and ## $$"), (2, "a b")], "doc_id long, text string")
    got = {r.doc_id: r for r in quality.evaluate(docs).collect()}
    assert got[0].kept and got[0].failed_rules == []
    assert "symbols_per_word" in got[1].failed_rules and not got[1].kept
    assert got[2].base_failed and "words" in got[2].failed_rules
    assert {r.doc_id for r in quality.evaluate(docs, rules=()).filter("kept").collect()} == {0, 1} - {
        r.doc_id for r in got.values() if r.base_failed}


def test_licences_are_inherited_from_the_nearest_directory(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    body = " ".join(f"statement number {i} does something;" for i in range(40))
    files = [("LICENSE", mit), ("a/x.py", body), ("a/b/LICENSE", apache), ("a/b/c/d/y.py", body), ("a/b/z.py", f"{mit}\n{body}"),
             ("top.py", body), (None, body), ("e/f.py", None)]
    out = licenses.scan_licences(spark.createDataFrame(files, "path string, text string"))
    got = {r.path: (r.notice, r.licence, r.licence_dir) for r in out.collect()}
    assert got["a/x.py"] == (None, "MIT", "") and got["top.py"] == (None, "MIT", "") and got["e/f.py"] == (None, "MIT", "")
    assert got["a/b/c/d/y.py"] == (None, "Apache-2.0", "a/b") and got["a/b/z.py"] == ("MIT", "MIT", None)
    assert got[None] == (None, None, None)


def test_gram_counts_do_not_depend_on_chunks(monkeypatch):
    text = "Straße über café 12 and more " * 40
    whole = langid.gram_counts(text)
    for size in (2, 3, 7, 100):
        monkeypatch.setattr(langid, "_CHUNK", size)
        assert (langid.gram_counts(text) == whole).all()


def test_language_rejection(spark):
    rows = [(i, "the of and to in is that for it as was with", "en") for i in range(8)] + \
        [(10 + i, "le la les et des du dans qui sur pas au plus", "fr") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    new = spark.createDataFrame([(0, "the cat was in it"), (1, "les chats dans la rue"), (2, "жжжж щщщщ"), (3, "123"), (4, None)],
                                "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.rejected) for r in langid.predict(new, model).collect()}
    assert got[0] == ("en", False) and got[1] == ("fr", False) and got[2][1]
    assert got[3] == got[4] == ("und", True)


def test_texts_without_repeated_chunks_are_not_cut_again(spark):
    shared = "The shared line is long enough to be one. It goes on in a second sentence.\n"
    texts = [shared * 2 + "Some words of the first text. And others.\n", "Alone with its own words here. Nothing repeats.\n", shared * 2, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = lines.dedup_lines(docs)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == plan.count("CASE WHEN isnull(marks") == 1
    rows = {r.doc_id: r for r in out.collect()}
    cut = {r.doc_id: r.c for r in docs.select("doc_id", lines.chunks(docs.text).alias("c")).collect()}
    assert all(rows[i].n_chunks == len(cut[i]) for i in rows)
    assert [rows[i].text for i in (1, 3, 4)] == [texts[1], "", None]


def test_a_crowd_is_dealt_out_once(spark):
    tagged = spark.range(1300).selectExpr("7L key", "0 slot", "id cls", "id root", "id % 5 > 0 strays")
    assert minhash._dealt(tagged, minhash.SIGNED_BLOCK).count() == 1300


def test_block_pairs_meet_each_pair_once(spark):
    tagged = spark.range(60).selectExpr("id % 2 key", "0 slot", "id cls", "if(id % 3 > 0, id, 0L) root", "id % 3 > 0 strays")
    met = Counter()
    for task in minhash._dealt(tagged, 4).toPandas().groupby(["key", "kind", "i", "j"]):
        rows = list(zip(task[1]["side"], task[1]["cls"], task[1]["root"]))
        for x, (side, a, root) in enumerate(rows):
            for y, (other, b, other_root) in enumerate(rows):
                if side != 1 and other > 0 and root != other_root and (side != 2 or y > x or other == 1):
                    met[min(a, b), max(a, b)] += 1
    wanted = {(a, b) for a in range(60) for b in range(a + 1, 60) if a % 2 == b % 2 and a % 3 + b % 3 > 0}
    assert set(met) == wanted and set(met.values()) == {1}


@pytest.mark.parametrize("off", [0, 1, 5, 13, 21, 22, 40])
def test_near_signatures_meet_first_under_one_key(off):
    rng = np.random.default_rng(off)
    parts = np.array_split(np.arange(minhash.SYMBOLS), minhash.CHUNKS)
    for _ in range(40):
        own = rng.integers(0, 1 << 16, minhash.SYMBOLS).astype(np.uint16)
        other = own.copy()
        other[rng.permutation(minhash.SYMBOLS)[:off]] ^= 1
        here = [s for s in range(minhash.SYMBOLS) if len(minhash._near_here(other[None], own, s))]
        assert len(here) == (off < 2 * minhash.CHUNKS)
        for slot in here:
            kept = [i for part in parts if slot in part for i in part if i != slot]
            assert (own[kept] == other[kept]).all()


def test_stars_need_no_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components, "materialise", lambda df, label: (written.append(label), materialise(df, label))[1])
    stars = spark.createDataFrame([(1, 2), (1, 3), (5, 9)], "a long, b long")
    assert sorted(map(tuple, components.components(stars).collect())) == [(1, 1), (2, 1), (3, 1), (5, 5), (9, 5)]
    assert written == ["edges", "roots"]
    chain = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(30, 30)], "a long, b long")
    assert sorted(map(tuple, components.components(chain).collect())) == [(i, 0) for i in range(21)]
