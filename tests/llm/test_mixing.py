"""Mixing: budgets, caps, seams, repeats, nulls, against plain Python."""

import hashlib
import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cadenza.llm import mixing

SCHEMA = "doc_id long, text string, source string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, weights=(1, 2, 3), epochs=3):
    """{position of row: (size, source_size, target, taken)} by resharing the excess again and again."""
    docs = []
    for i, (doc, text, source) in enumerate(rows):
        ident, t = "" if doc is None else str(doc), text or ""
        digest = hashlib.md5(f"{ident}|{hashlib.md5(t.encode()).hexdigest()}|0".encode()).hexdigest()
        marks = sum(c in mixing.MARKS for c in t)
        quality = max((len(t) - marks) / max(len(t), 1), mixing.LEAST_QUALITY)
        key = -math.log((int(digest[:13], 16) + 0.5) / 2 ** 52) / quality
        docs.append((i, source, key, ident, len(WORD.findall(t))))
    size = defaultdict(int)
    for _, source, _, _, n in docs:
        size[source] += n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal, open_, left = {}, set(order), sum(size.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > epochs * size[s]}
        goal |= {s: epochs * size[s] for s in over} if over else {s: level * weight[s] for s in open_}
        left -= sum(epochs * size[s] for s in over)
        open_ = open_ - over if over else set()
    out = {}
    for s in order:
        want = math.floor(goal[s] + 0.5)
        whole = want // size[s] if size[s] else 0
        rest, units = want - whole * size[s], defaultdict(list)
        for i, source, key, ident, n in docs:
            if source == s:
                units[key, ident, n].append(i)
        for (_, _, n), members in sorted(units.items()):
            share = n if rest >= n * len(members) else max(rest, 0) // len(members)
            rest -= n * len(members)
            out |= {i: (n, size[s], goal[s], whole * n + share) for i in members}
    return out


def run(spark, rows):
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", n_extra long")
    got = mixing.mix_plan(frame).select("doc_id", "source", "size", "source_size", F.round("target", 6), "taken")
    want = [(r[0], r[2], n, s, round(float(t), 6), taken) for r, (n, s, t, taken) in
            zip(rows, (v for _, v in sorted(plain(rows).items())))]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    return frame


def corpus():
    rows = [(i, " ".join(["word"] * (1 + i * 7 % 40)), "big") for i in range(300)]
    rows += [(1000 + i, "a b c", "tiny") for i in range(2)]          # stops at three times its size
    rows += [(2000 + i, "x 1 # y " * (i + 1), None) for i in range(9)]
    rows += [(3000, None, "void"), (3001, "", "void"), (3002, " \n\t", "void")]
    rows += [(4000, "same text here", "again")] * 25 + [(None, None, None), (None, "no id", "big"), (None, "no id", "big")]
    return rows + [(5000, "lorem ipsum " * 20_000, "long"), (5001, "héé ﬁ 漢字 \x0b x", "Ünï")]


def test_plan_equals_plain_python(spark):
    run(spark, corpus())


def test_words_meet_targets_and_caps(spark):
    frame = run(spark, corpus())
    plan = mixing.mix_plan(frame)
    assert plan.filter("taken > 3 * size or taken < 0").count() == 0
    for row in plan.groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t"),
                                          F.count("*").alias("docs")).collect():
        assert abs(row.n - row.t) <= (25 if row.source == "again" else 0.5)


def test_mix_holds_the_words_of_the_plan(spark):
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(corpus())], SCHEMA + ", _key long")
    copies = mixing.mix(frame.withColumnRenamed("_key", "key"))
    assert set(copies.columns) == {"doc_id", "text", "source", "key", "epoch"}
    found = copies.groupBy("key").agg(F.sum(mixing.n_words(F.col("text"))).alias("n")).collect()
    want = {i: v[3] for i, v in plain(corpus()).items()}
    assert {r.key: r.n for r in found if r.n} == {i: n for i, n in want.items() if n}
    cut = copies.filter("doc_id = 5000").collect()
    assert all("lorem ipsum " * 20_000 == r.text or ("lorem ipsum " * 20_000).startswith(r.text) for r in cut)


def test_quality_moves_documents_forward(spark):
    rows = [(i, "w " * 10, "s") for i in range(2000)] + [(i, "w " * 10, "t") for i in range(2000, 4000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.mix_plan(frame, F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.1), weights=(1, 3), max_epochs=3)
    taken = dict(plan.filter("source = 's'").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("taken")).collect())
    assert taken[0] > 3 * taken[1]


def test_empty_and_rerun(spark):
    assert mixing.mix_plan(spark.createDataFrame([], SCHEMA)).collect() == []
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    frame = spark.createDataFrame(corpus(), SCHEMA)
    once, twice = (sorted(map(str, mixing.mix_plan(f).collect())) for f in (frame, frame.repartition(13)))
    assert once == twice


@pytest.mark.parametrize("text,n", [("a  b c ", 2), (" a b", 1), ("a", 5), ("", 1)])
def test_first_words(spark, text, n):
    cut = spark.range(1).select(mixing.first_words(F.lit(text), F.lit(n)).alias("t")).first().t
    assert WORD.findall(cut) == WORD.findall(text)[:n] and text.startswith(cut)
