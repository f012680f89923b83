"""What several operators share: session settings, words, shared files."""

from __future__ import annotations

import os
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from cadenza.session import configure
from cadenza.workspace import run_dir

# A word is a run of bytes other than the six ASCII white-space characters,
# which is what bytes.split() without arguments cuts at.
WORD_GAP = "[\\x20\\x09-\\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Library settings, and small Arrow batches: texts may be long."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def fresh(columns: list[str], name: str) -> str:
    """``name``, or a longer one that no column has."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name = "_" + name
    return name


def fold_bucket(id_col: str, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def lower_words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case, all other bytes as they are."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser: a permutation of the 64-bit numbers for each seed."""
    x = x ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def mounted_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared one, as a path every worker can open.

    Memory-mapped files need a mounted file system; a store without one is refused.
    """
    uri = run_dir(spark, label)
    path = uri.removeprefix("file:")
    if ":" in path.split("/")[0]:
        raise ValueError(f"spark.checkpoint.dir must be on a mounted file system to map files: {uri}")
    return "/" + path.lstrip("/")


def write_once(path: str, array: np.ndarray) -> None:
    """Save an array so that retried and speculative tasks leave one whole file."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        np.save(out, array)
    os.replace(part, path)
