"""Language of a text by the nearest centroid of TF-IDF character n-grams.

N-grams of 1 to 3 characters are hashed to ``DIMS`` dimensions, weighted by
idf and scaled to length 1. Each language has a few centroids, found by
spherical k-means. A text takes the language of the centroid of highest
cosine. It is rejected if it is farther from that centroid than labelled texts
are, see ``stretched``. Grams without a letter tell no languages apart and count
towards a text's length only.

Fitted on at most ``per_language`` labelled rows of each language (chosen by a
hash of the id); predictions use the text alone and cover every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import fresh
from cadenza.workspace import materialise

DIMS = 4096
PER_LANGUAGE = 400
CENTROIDS = 4
MAX_DISTANCE = 0.9
# A centroid's limit: a quantile of its own labelled rows' distances, and the slack
# beyond it. Under FEW_ROWS rows the language's quantile holds. The bounds keep a
# small or a damaged sample from setting it: text of a learned language was found up
# to 0.46, prose in languages that were not learned from 0.61 on.
QUANTILE, SLACK, LEAST_LIMIT, MOST_LIMIT, FEW_ROWS = 0.99, 1.5, 0.5, 0.6, 50
SHORT = 128  # grams at which sampling alone takes a cosine of 1 to 0.7
_SHARPNESS = 20.0  # of the score: e-fold for 0.05 of cosine
_CHUNK = 1 << 18  # characters hashed at a time
_ROWS = 64  # texts whose vectors a task holds at a time


@dataclass
class Centroids:
    languages: list[str]  # of each row of ``rows``
    rows: np.ndarray
    idf: np.ndarray
    limits: np.ndarray  # of each row: the largest stretched distance of a text in the language


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def gram_counts(text: str | None) -> np.ndarray:
    """Counts of hashed n-grams; all ASCII other than letters counts as a blank."""
    out = np.zeros(DIMS, np.int64)
    text = (text or "").lower()
    for at in range(0, len(text), _CHUNK):
        codes = np.frombuffer(text[max(0, at - 2):at + _CHUNK].encode("utf-32-le", "surrogatepass"), "<u4")
        codes = np.where((codes < 128) & ~((codes >= 97) & (codes <= 122)), 32, codes).astype(np.uint32)
        grown = codes
        for n in (1, 2, 3):
            if n > 1:
                grown = grown[:-1] * np.uint32(0x01000193) + codes[n - 1:]
            if not len(grown):
                break
            # The chunk begins two characters early: grams that end there are counted already.
            fresh = grown if at == 0 else grown[min(2, at) - (n - 1):]
            hashed = (fresh ^ np.uint32(n * 0x9E3779B)) * np.uint32(0x85EBCA6B)
            hashed ^= hashed >> np.uint32(13)
            hashed *= np.uint32(0xC2B2AE35)
            out += np.bincount(hashed >> np.uint32(20), minlength=DIMS)
    return out


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm > 0, norm, 1)


def stretched(cosine: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Distance without what is due to a text's length: few grams are a small
    sample, whose cosine to its own source falls as 1 / sqrt(1 + SHORT / grams)."""
    return 1 - np.minimum(cosine * np.sqrt(1 + SHORT / np.maximum(grams, 1)), 1)


def _limits(distance: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    whole = np.quantile(distance, QUANTILE)
    each = [np.quantile(distance[own == c], QUANTILE) if (own == c).sum() >= FEW_ROWS else whole for c in range(k)]
    return np.clip(SLACK * np.array(each), LEAST_LIMIT, MOST_LIMIT)


def _cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from rows far apart from each other."""
    centres = [vectors[0]]
    while len(centres) < min(k, len(vectors)):
        nearest = (vectors @ np.array(centres).T).max(axis=1)
        centres.append(vectors[nearest.argmin()])
    centres = np.array(centres)
    for _ in range(rounds):
        own = (vectors @ centres.T).argmax(axis=1)
        centres = _unit(np.array([vectors[own == c].sum(axis=0) if (own == c).any() else centres[c]
                                  for c in range(len(centres))]))
    return centres


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, clusters: int = CENTROIDS, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang") -> Centroids:
    """Centroids from ``labelled``; rows without language or without a letter are left out.

    ``per_language`` bounds what is learned from; each language is clustered in
    a task of its own, and only centroids and idf reach the driver.
    """
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).alias("lang"),
                           F.col(text_col).alias("text")).filter("lang is not null and text is not null")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = (rows.select("id", "lang").withColumn("n", F.row_number().over(order))
              .filter(F.col("n") <= per_language).select("id", "lang").distinct())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf[pdf["text"].map(has_letter)]
            yield pd.DataFrame({"lang": pdf["lang"], "grams": [gram_counts(t).astype("<u4").tobytes() for t in pdf["text"]]})

    # ``chosen`` has at most per_language rows a language.
    sample = materialise(rows.join(F.broadcast(chosen), ["id", "lang"], "left_semi")
                         .mapInPandas(count, "lang string, grams binary"), "language-sample")

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(DIMS, np.int64), 0
        for pdf in batches:
            for grams in pdf["grams"]:
                total += np.frombuffer(grams, "<u4") > 0
                n += 1
        yield pd.DataFrame({"gram": np.append(np.arange(DIMS), -1), "n": np.append(total, n)})

    seen = (sample.select("grams").mapInPandas(present, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
            .toPandas().set_index("gram")["n"])
    total = seen.get(-1, 0)
    idf = np.log((1 + total) / (1 + seen.reindex(range(DIMS), fill_value=0).to_numpy())) + 1
    idf[np.flatnonzero(gram_counts("   "))] = 0

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = np.stack([np.frombuffer(g, "<u4") for g in pdf["grams"]])
        vectors = _unit(counts * idf)
        centres = _cluster(vectors[np.lexsort(vectors[:, :64].T)], clusters)
        cosine = vectors @ centres.T
        limits = _limits(stretched(cosine.max(axis=1), counts.sum(axis=1)), cosine.argmax(axis=1), len(centres))
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centre": [c.tobytes() for c in centres], "limit": limits})

    learned = (sample.groupBy("lang").applyInPandas(learn, "lang string, centre binary, limit double")
               .orderBy("lang", "centre").collect())
    return Centroids([r.lang for r in learned],
                     np.array([np.frombuffer(r.centre) for r in learned]).reshape(len(learned), DIMS), idf,
                     np.array([r.limit for r in learned]))


def classified(texts: pd.Series, model: Centroids, max_distance: float = MAX_DISTANCE) -> pd.DataFrame:
    """lang_pred, score and rejected of each text; vectors are held of ``_ROWS`` texts at a time."""
    names = sorted(set(model.languages))
    owner = np.array([names.index(x) for x in model.languages], int)
    known = texts.map(has_letter).to_numpy(bool)
    pred, score, distance = np.full(len(texts), "und", object), np.zeros(len(texts)), np.ones(len(texts))
    strange = np.zeros(len(texts), bool)
    rows = np.flatnonzero(known) if names else []
    for part in (rows[i:i + _ROWS] for i in range(0, len(rows), _ROWS)):
        counts = np.stack([gram_counts(t) for t in texts.iloc[part]])
        vectors = _unit(counts * model.idf)
        cosine = vectors @ model.rows.T
        best = np.stack([cosine[:, owner == i].max(axis=1) for i in range(len(names))], axis=1)
        pred[part] = np.array(names, object)[best.argmax(axis=1)]
        share = np.exp(_SHARPNESS * (best - best.max(axis=1, keepdims=True)))
        score[part] = 1 / share.sum(axis=1)
        distance[part] = 1 - best.max(axis=1)
        strange[part] = stretched(cosine.max(axis=1), counts.sum(axis=1)) > model.limits[cosine.argmax(axis=1)]
    return pd.DataFrame({"lang_pred": pred, "score": score, "rejected": (pred == "und") | (distance > max_distance) | strange})


def predict(docs: DataFrame, model: Centroids, max_distance: float = MAX_DISTANCE, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and rejected; columns of these names are replaced.

    Null texts and texts without a letter are ``und``, score 0, rejected; so is
    everything where nothing was learned. Others are rejected beyond their
    centroid's limit or ``max_distance``. Equal cosines go to the language first
    in the alphabet.
    """
    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield classified(texts, model, max_distance)

    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    held = fresh(docs.columns, "_found")
    return docs.select(*kept, found(F.col(text_col)).alias(held)).select(*kept, f"{held}.*")
