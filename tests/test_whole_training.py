"""The learned scorers are fitted and judged on all playlists of their part."""

import datetime

import pytest

from cadenza.operators import ranking, splits
from cadenza.plans import recommend

N = 40


class Stop(Exception):
    pass


@pytest.fixture
def tables(spark, folder):
    """Playlists of four tracks each."""
    orders = [(i, i % 3, "O", 1.0, datetime.datetime(2024, 1, 1), "1-URGENT") for i in range(N)]
    lines = [(i, (3 * i + j) % 25, j % 4, j, 1.0) for i in range(N) for j in range(4)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                          "l_extendedprice double").write.parquet(f"{folder}/lineitem.parquet")
    return folder


def of_part(spark, sf, part):
    rows = splits.split_playlists(spark.read.parquet(f"{sf}/orders.parquet").selectExpr("o_orderkey AS pid"))
    return {r.pid for r in rows.filter(f"split = '{part}'").collect()}


def pids(df):
    return {r.pid for r in df.select("pid").distinct().collect()}


def test_search_is_fitted_and_judged_on_whole_parts(spark, tables, monkeypatch):
    seen = {}

    def search(train, valid, truth, **options):
        seen.update(train=pids(train), valid=pids(valid))
        raise Stop

    monkeypatch.setattr(recommend, "TRAIN_PLAYLISTS", 3)
    monkeypatch.setattr(recommend, "VALID_PLAYLISTS", 2, raising=False)
    monkeypatch.setattr(ranking, "random_search", search)
    with pytest.raises(Stop):
        recommend.random_search(spark, tables)
    assert seen == {"train": of_part(spark, tables, "train"), "valid": of_part(spark, tables, "val")}


def test_unseen_playlists_are_ranked_by_trees_fitted_on_the_whole_train_part(spark, tables, monkeypatch):
    seen = {}

    def fit(features, **options):
        seen.update(train=pids(features))
        raise Stop

    monkeypatch.setattr(recommend, "TRAIN_PLAYLISTS", 3)
    monkeypatch.setattr(ranking, "fit_ranker", fit)
    with pytest.raises(Stop):
        recommend.rank_unseen_playlists(spark, tables)
    assert seen["train"] == of_part(spark, tables, "train")


def test_every_tree_sees_all_rows(spark):
    rows = [(i % 50, i, i / 7, i % 2, 4, int(i % 5 == 0)) for i in range(200)]
    table = spark.createDataFrame(rows, "cand_rank int, popularity bigint, t2v_score double, seed_overlap int, playlist_len bigint, label int")
    assert ranking.fit_ranker(table, 2, 0.1, 2).stages[-1].getSubsamplingRate() == 1.0
