"""Licence scan: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

Every line of a file is a sparse vector over the words of the templates; words
that no template has count towards its length. A line close enough to a
template is a licence notice. A short file that holds one and little else is a
licence file and speaks for its directory. A file without a notice of its own
takes the licence of the nearest directory above it that has such a file,
found by joining directories with their ancestors.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.operators.skew import salted_join
from cadenza.workspace import materialise

MIN_COSINE = 0.6
LICENCE_FILE_WORDS = 40
_WORD = re.compile(r"[^\W_]+(?:[.\-+][^\W_]+)*")

# Notices as their licences ask for them; fixed values.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("Proprietary", "Copyright. All rights reserved."),
)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Matcher:
    """Cosine of lines to templates, for given line counts of the template words."""

    def __init__(self, templates: tuple[tuple[str, str], ...], lines: int, with_word: dict[str, int]) -> None:
        self.names = [name for name, _ in templates]
        texts = [words(text) for _, text in templates]
        self.vocabulary = sorted({w for t in texts for w in t})
        self.idf = {w: np.log((1 + lines) / (1 + with_word.get(w, 0))) + 1 for w in self.vocabulary}
        self.other = np.log(1 + lines) + 1  # of a word that no template has
        self.postings: dict[str, list[tuple[int, float]]] = {}
        for i, text in enumerate(texts):
            tf = Counter(text)
            norm = np.sqrt(sum((n * self.idf[w]) ** 2 for w, n in tf.items()))
            for w, n in tf.items():
                self.postings.setdefault(w, []).append((i, n * self.idf[w] / norm))

    def best(self, line: list[str]) -> tuple[float, int]:
        """Highest cosine and its template, the first of equal ones."""
        tf = Counter(line)
        known = [(w, n) for w, n in tf.items() if w in self.postings]
        if not known:
            return 0.0, -1
        norm = sum((n * self.idf.get(w, self.other)) ** 2 for w, n in tf.items()) ** 0.5
        dots: dict[int, float] = {}
        for w, n in known:
            for i, weight in self.postings[w]:
                dots[i] = dots.get(i, 0.0) + n * self.idf[w] * weight
        top = max(sorted(dots), key=lambda i: round(dots[i], 12))
        return min(dots[top] / norm, 1.0), top


def _count(texts: DataFrame, vocabulary: set[str]) -> tuple[int, dict[str, int]]:
    """Lines of the corpus, and how many hold each template word."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for pdf in batches:
            for text in pdf["text"]:
                for line in (text or "").split("\n"):
                    if found := set(words(line)):
                        seen[""] += 1
                        seen.update(found & vocabulary)
        yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    # As many rows as the templates have words.
    counted = texts.mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    found = dict(zip(counted["word"], counted["n"]))
    return int(found.pop("", 0)), found


def notices(files: DataFrame, templates: tuple = TEMPLATES, min_cosine: float = MIN_COSINE,
            text_col: str = "text") -> DataFrame:
    """The columns of ``files`` but the text, as ``row``, and what was found in each whole text:
    notice (licence or null), cosine, notice_line, n_words."""
    vocabulary = set(Matcher(templates, 0, {}).vocabulary)
    matcher = Matcher(templates, *_count(files.select(F.col(text_col).alias("text")), vocabulary))

    @F.pandas_udf("notice string, cosine double, notice_line string, n_words long")
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            top, name, where, total = 0.0, None, None, 0
            for line in (text or "").split("\n"):
                found = words(line)
                total += len(found)
                cosine, i = matcher.best(found)
                if cosine > top + 1e-9:
                    top, name, where = cosine, matcher.names[i], line
            rows.append((name, top, where, total) if top >= min_cosine else (None, top, None, total))
        return pd.DataFrame(rows, columns=["notice", "cosine", "notice_line", "n_words"])

    row = F.struct(*[c for c in files.columns if c != text_col])
    return files.select(row.alias("row"), scan(text_col).alias("n")).select("row", "n.*")


def parent(path: Column) -> Column:
    """The directory of a path; the empty string is the root."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan_licences(files: DataFrame, path_col: str = "path", text_col: str = "text",
                  templates: tuple = TEMPLATES) -> DataFrame:
    """``files`` without the text but with notice, cosine, is_licence_file, licence and licence_dir.

    ``licence`` is the file's own notice, else that of the nearest directory
    above with a licence file (of several, the one first by path), else null;
    ``licence_dir`` names that directory. Null and empty texts have no notice; a
    null path is in no directory. Repeated rows are treated alike. Columns of
    these names are replaced.
    """
    new = ("notice", "cosine", "is_licence_file", "licence", "licence_dir")
    columns = [c for c in files.columns if c.lower() not in new]
    short = F.col("notice").isNotNull() & (F.col("n_words") <= LICENCE_FILE_WORDS)
    path = F.col("row").getField(path_col)
    scanned = materialise(
        notices(files.select(*columns), templates, text_col=text_col)
        .withColumns({"is_licence_file": short, "path": path, "dir": parent(path)}), "licences")
    speaking = (scanned.filter("is_licence_file and dir is not null").groupBy("dir")
                .agg(F.min(F.struct("path", "notice")).alias("f"))
                .select(F.col("dir").alias("above"), F.col("f.notice").alias("inherited")))
    directories = scanned.filter("dir is not null").select("dir").distinct()
    parts = F.split("dir", "/")
    above = F.array_distinct(F.concat(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))))
    nearest = (directories.select("dir", F.posexplode(above).alias("depth", "above")).join(speaking, "above")
               .groupBy("dir").agg(F.max(F.struct("depth", "above", "inherited")).alias("n"))
               .select("dir", "n.above", "n.inherited"))
    joined = salted_join(scanned, nearest, "dir", ["path"], how="left", count_on=scanned.select("dir"))
    return joined.select(
        *[F.col("row").getField(c).alias(c) for c in columns if c != text_col], "notice", "cosine", "is_licence_file",
        F.coalesce("notice", "inherited").alias("licence"), F.when(F.col("notice").isNull(), F.col("above")).alias("licence_dir"))
