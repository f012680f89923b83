"""The registered queries of this subpackage and their SQL.

Each applies one operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import align, bpe, langid, licenses, lines, lm, minhash, mixing, packing, quality, rans, sqltext, topk, trie
from cadenza.llm.common import documents, fold_bucket, prepare
from cadenza.workspace import materialise

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), shingle=4, percent=80)


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.train_and_score(documents(spark, sf_dir), fold_bucket("doc_id", 7) == 2)


def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.roundtrip(documents(spark, sf_dir), tokenizer_file(), END_ID)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.evaluate(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_file(), END_ID)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of their source's folders, a thousand and fifty ids to a folder."""
    path = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 50), "doc_id")
    files = documents(spark, sf_dir).select("doc_id", path.alias("path"), "text")
    return licenses.scan_licences(files).select(
        "doc_id", "path", "notice", F.round("cosine", 9).alias("cosine"), "is_licence_file", "licence", "licence_dir")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(documents(spark, sf_dir), tokenizer_file())
    decoded = bpe.decode(encoded, tokenizer_file())
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet").select(
        "vec_id", topk.quantised("embedding").alias("vector"))
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(fold_bucket("doc_id", 4) == 2, F.lit(False))
    model = langid.fit(docs.filter(~held_out))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    turns = trie.number_turns(convs)
    sizes = materialise(trie.lengths(turns), "conversations")
    return trie.trie_of(trie.branch(turns, sizes), sizes).drop("first_rank")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = [tokenizer_file(name) for name in ALIGNED]
    return align.align_tokens(documents(spark, sf_dir), *files)[0]


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_minhash_dedup, op2_lm_score, op3_token_file, op4_quality_rules, op5_packing,
                            op6_line_dedup, op7_license_scan, op8_bpe, op9_topk, op10_language_id, op11_prefix_trie,
                            op12_token_alignment, op13_mixing)}
# The others hash, learn or tokenise; tests/llm holds them against brute force.
ORACLES: dict[str, str] = {
    "op1_minhash_dedup": sqltext.MINHASH, "op4_quality_rules": sqltext.QUALITY, "op9_topk": sqltext.TOP_K,
    "op11_prefix_trie": sqltext.TRIE, "op13_mixing": sqltext.MIXING}
