"""Prefix tries against plain Python: paths, stars, copies, ties, nulls, contraction rounds."""

import hashlib
import os
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from cadenza.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string"
SF = "/root/testdata/sf0.001"


def plain(convs):
    """{(conv_id, depth): the other columns} of {conv_id: [(role, text), ...]}, deepest nodes first."""
    members, below, sums = defaultdict(list), defaultdict(list), {}
    name = {c: [hashlib.sha256(b"").digest()] for c in convs}
    parent, size = {}, {}
    for c, turns in convs.items():
        for d, turn in enumerate(turns, start=1):
            key = hashlib.sha256(name[c][-1] + repr(turn).encode()).digest()
            parent[key], size[key] = name[c][-1], (d, len(turn[1].encode()))
            name[c].append(key)
        for key in name[c]:
            members[key].append(c)
    root = hashlib.sha256(b"").digest()
    size[root] = (0, 0)
    for key, up in parent.items():
        below[up].append(key)
    out = {}
    for key in sorted(members, key=lambda k: -size[k][0]):
        leaves = sum(sums[k][0] for k in below[key]) or 1
        save = (len(members[key]) - 1) * size[key][1] + sum(sums[k][1] for k in below[key])
        sums[key] = leaves, save
        depth = size[key][0]
        ends = ",".join(str(c) for c in sorted(members[key]) if len(convs[c]) == depth)
        out[min(members[key]), depth] = (min(members[parent[key]]) if key in parent else None, len(members[key]), len(below[key]),
                                         leaves, save, hashlib.sha256(ends.encode()).hexdigest())
    return out


def gathered(rows):
    convs = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        if c is not None:
            convs[c].append((role or "", text or ""))
    return dict(convs)


def found(frame):
    names = ["parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rows = frame.collect()
    out = {(r.conv_id, r.depth): tuple(r[n] for n in names) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.fixture
def many_partitions(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


def corpus(seed=3):
    rng, rows = random.Random(seed), []
    for c in range(120):  # a bushy part, from few words
        rows += [(c, t, rng.choice("ua"), rng.choice(["x", "yy", "zé"])) for t in range(rng.randrange(1, 7))]
    rows += [(1000 + c, t, "u", f"copy {t}") for c in range(40) for t in range(3)]      # copies of one conversation
    rows += [(2000 + c, 0, "u", "hello") for c in range(30)] + [(2000 + c, 1, "a", f"own {c}") for c in range(30)]  # a star
    rows += [(3000, t, "u", f"turn {t % 7}") for t in range(400)]                        # a path
    rows += [(3001, t, "u", f"turn {t % 7}" if t < 250 else "end") for t in range(260)]
    rows += [(-5, None, None, None), (-5, None, "a", "null turn"), (-5, 3, "u", None), (-5, 3, "u", None), (-4, 1, "", "")]
    rows += [(None, 0, "u", "nobody"), (4000, 0, "u", "long " * 50_000), (4001, 0, "u", "long " * 50_000)]
    return rows


@pytest.mark.parametrize("rest", [trie.REST, 3])
def test_trie_equals_plain_python(spark, many_partitions, rest):
    rows = corpus()
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit(1), "node": F.lit("x"), "part": F.lit("y")})
    assert found(trie.prefix_trie(frame, rest=rest)) == plain(gathered(rows))


def test_places_on_the_tour(spark):
    nodes = trie.prefix_trie(spark.createDataFrame(corpus(), SCHEMA)).collect()
    ranks = sorted(r.first_rank for r in nodes)
    assert ranks[0] == 1 and len(set(ranks)) == len(nodes) and ranks[-1] < 2 * len(nodes)


def test_list_ranking_undoes_its_rounds(spark):
    order = list(range(500))
    random.Random(1).shuffle(order)
    rows = [(x, None if i == 0 else order[i - 1], int(i > 0), x, 2 * x) for i, x in enumerate(order)]
    links = spark.createDataFrame(rows, "id long, pred long, a_rank long, a_leaf long, a_save long")
    got = {r.id: (r["rank"], r.leaf, r.save) for r in trie.rank_list(links, rest=20).collect()}
    total = 0
    for i, x in enumerate(order):
        total += x
        assert got[x] == (i, total, 2 * total)


@pytest.mark.parametrize("rows", [[], [(None, 1, "u", "x")], [(7, 0, "u", "x")]])
def test_small_tables(spark, rows):
    assert found(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == (plain(gathered(rows)) if rows and rows[0][0] else {})


def test_turnless_conversations_are_members_of_the_root(spark):
    turns = trie.number_turns(spark.createDataFrame([], SCHEMA))
    nodes = trie.trie_of(turns, spark.createDataFrame([(5,), (3,)], "conv_id long"))
    assert found(nodes) == plain({3: [], 5: []})


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")
def test_registered_query(spark):
    own = gathered(duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall())
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    assert found(queries.op11_prefix_trie(spark, SF)) == plain(rebuilt)
