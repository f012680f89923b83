"""A text corpus in stages: each takes (spark, docs, sf_dir) and returns a DataFrame.

``run`` writes each stage's result as Parquet in the shared folder and hands
the reread table to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadenza.llm import stages
from cadenza.llm.common import documents
from cadenza.workspace import materialise

STAGES = [
    ("language_id", stages.language_id),
    ("quality_rules", stages.quality_rules),
    ("line_dedup", stages.line_dedup),
    ("minhash_dedup", stages.minhash_dedup),
    ("packing", stages.packing_stage),
]

# No SQL: the stages hash, learn and tokenise. tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole documents table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
