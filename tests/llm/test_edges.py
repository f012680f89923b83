"""Every operator and stage over nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cadenza.llm import bpe, langid, licenses, lines, lm, minhash, packing, quality, rans, topk
from cadenza.llm.common import fold_bucket
from cadenza.llm.queries import tokenizer_file

OPERATORS = {
    "minhash": lambda d: minhash.near_duplicates(d),
    "lm": lambda d: lm.train_and_score(d, fold_bucket("doc_id", 7) == 2),
    "rans": lambda d: rans.roundtrip(d, tokenizer_file(), 1),
    "quality": lambda d: quality.evaluate(d),
    "packing": lambda d: packing.pack(d, tokenizer_file(), 1),
    "lines": lambda d: lines.dedup_lines(d),
    "licenses": lambda d: licenses.scan_licences(d),
    "bpe": lambda d: bpe.decode(bpe.encode(d, tokenizer_file()), tokenizer_file()),
    "topk": lambda d: topk.top_k(d.select("doc_id", F.array("doc_id").cast("array<double>").alias("vector")),
                                 d.select("doc_id", F.array("doc_id").cast("array<double>").alias("vector")), 2, "doc_id"),
    "langid": lambda d: langid.predict(d, langid.fit(d)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(no_docs, name):
    assert OPERATORS[name](no_docs).collect() == []


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"packing", "topk"}))
def test_a_row_for_each_row(edge_docs, name):
    assert OPERATORS[name](edge_docs).count() == edge_docs.count()


@pytest.mark.parametrize("name", ["quality", "lines", "langid", "licenses"])
def test_other_columns_pass_through(edge_docs, name):
    out = OPERATORS[name](edge_docs)
    replaced = {"quality": {"kept", "n_words"}, "langid": {"score"}, "licenses": {"text", "Notice"}}.get(name, set())
    for column in set(edge_docs.columns) - replaced - {"text"}:
        assert sorted(map(str, out.select(F.col(column)).collect())) == \
            sorted(map(str, edge_docs.select(F.col(column)).collect()))


@pytest.mark.parametrize("at", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, edge_docs, no_docs, at):
    name, stage = corpus_pipeline.STAGES[at]
    out = stage(spark, edge_docs, "")
    if name != "packing":
        assert out.columns == edge_docs.columns
    assert 0 < out.count()
    assert stage(spark, no_docs, "").collect() == []
