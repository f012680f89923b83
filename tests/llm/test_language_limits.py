"""Rejection by distance: languages that were not learned, noise, and labelled rows that stay."""

import os
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from cadenza.llm import langid
from cadenza.llm.common import documents, fold_bucket

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")

FOREIGN = [
    "Wczoraj wieczorem poszliśmy do kina na nowy film, ale niestety wszystkie bilety zostały już sprzedane.",
    "Eilen illalla menimme elokuviin katsomaan uutta elokuvaa, mutta valitettavasti kaikki liput oli jo myyty.",
    "Dün akşam yeni filmi izlemek için sinemaya gittik ama ne yazık ki bütün biletler satılmıştı.",
    "Včera večer jsme šli do kina na nový film, ale bohužel všechny lístky už byly vyprodané.",
    "ذهبنا أمس إلى السينما لمشاهدة الفيلم الجديد",
    "xqzj vvkq zzxj", "xqzj vvkq zzxj qwkj zxcv kjqx vbzk jjqz wxkv", "1234 5678 9012 3456 7890 1234 a 5678",
]
OWN = [
    "Yesterday evening we went to the cinema to see a new film, but sadly all tickets had been sold.",
    "Gestern Abend gingen wir ins Kino, aber leider waren alle Karten schon verkauft.",
]


def test_foreign_languages_and_noise_are_rejected_and_labelled_rows_stay(spark):
    docs = documents(spark, SF)
    held_out = fold_bucket("doc_id", 4) == 2
    model = langid.fit(docs.filter(~held_out))
    new = spark.createDataFrame(list(enumerate(FOREIGN + OWN)), "doc_id long, text string")
    got = {r.doc_id: r.rejected for r in langid.predict(new, model).collect()}
    assert [got[i] for i in range(len(got))] == [True] * len(FOREIGN) + [False] * len(OWN)
    kept = [not r.rejected for r in langid.predict(docs.filter(held_out), model).collect()]
    print("labelled held-out rows kept", sum(kept), "of", len(kept))
    assert sum(kept) >= 0.98 * len(kept)


def test_a_batch_of_texts_is_not_held_as_vectors_whole():
    rng = np.random.default_rng(1)
    rows = rng.random((8, langid.DIMS))
    model = langid.Centroids(["a", "b"] * 4, rows / np.linalg.norm(rows, axis=1, keepdims=True), np.ones(langid.DIMS), np.full(8, 0.6))
    texts = pd.Series([None, "123", *OWN, *FOREIGN] * 43)
    tracemalloc.start()
    got = langid.classified(texts, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16_000_000  # 512 vectors of 4096 doubles are 17 MB, and four such arrays were held
    alone = pd.concat([langid.classified(texts[i:i + 12], model) for i in range(0, len(texts), 12)], ignore_index=True)
    assert (got.lang_pred == alone.lang_pred).all() and np.allclose(got.score, alone.score) and (got.rejected == alone.rejected).all()
