"""Stages of the corpus pipeline; all but packing return the columns they are given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import langid, lines, minhash, packing, quality
from cadenza.llm.common import prepare
from cadenza.llm.queries import END_ID, tokenizer_file


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; learned from those that are labelled."""
    prepare(spark)
    model = langid.fit(docs)
    return langid.predict(docs, model).filter("not rejected").select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all rules."""
    prepare(spark)
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages they repeat; one left without a word goes."""
    prepare(spark)
    out = lines.dedup_lines(docs)
    left = (F.col("n_removed") == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    n_chars = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return out.filter(left).withColumns(n_chars).select(*docs.columns)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, whole: the one with the smallest id."""
    prepare(spark)
    kept = minhash.near_duplicates(docs).filter("kept").select("doc_id").distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences."""
    prepare(spark)
    return packing.pack(docs, tokenizer_file(), END_ID)
