"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Each rule is (name, low, high) over a ratio of the text's counts. Counts and
verdict are expressions over the text column: no user function, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import WORD_GAP, fresh

WINDOW = 5
SYMBOLS = "#*$%&|<>"
# Function words of the corpus languages (English, Spanish, French, German).
STOP_WORDS = (
    "the of and to in is that for it as was with be by on not he his but at are this have from or an they which a "
    "de la que el en y los se del las un por con no una su para es al lo como "
    "le les des et du dans qui sur pas au plus par une pour ne ce il est "
    "der die und das den von zu mit sich auf für ist im dem nicht ein eine als auch").split()
# name, least, most; None leaves a side open.
RULES = (
    ("words", 10, None),
    ("mean_word_chars", 2.0, 14.0),
    ("symbols_per_word", None, 0.1),
    ("stop_word_share", 0.03, None),
    ("dup_line_share", None, 0.5),
    ("words_per_line", 1.5, None),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated(hashes: Column, windows: Column) -> Column:
    """Words inside windows that occur twice or more, from the windows' hashes."""
    def covered(ordered: Column) -> Column:
        def equal(x: Column, k: Column) -> Column:
            before, after = F.get(ordered, k - 1), F.get(ordered, k + 1)
            return F.coalesce(before["g"] == x["g"], F.lit(False)) | F.coalesce(after["g"] == x["g"], F.lit(False))

        positions = F.array_sort(F.transform(F.filter(ordered, equal), lambda x: x["i"]))
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            positions, start,
            lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")),
            lambda acc: acc["n"])

    marked = F.array_sort(F.transform(windows, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_let(marked, covered))


def _windows(hashes: Column) -> Column:
    whole = F.slice(hashes, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0)))
    return F.transform(whole, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)]))


def counts(text: Column, stop_words: tuple[str, ...] = tuple(STOP_WORDS)) -> Column:
    """Struct of all counts of a text; a null text counts as an empty one."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    stops = sorted({f for w in stop_words for f in (w, w.capitalize())})

    def of_words(w: Column) -> Column:
        hashes = F.transform(w, lambda x: F.xxhash64(x))
        repeated = _let(hashes, lambda h: _let(_windows(h), lambda g: _repeated(h, g)))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.size(F.filter(w, lambda x: x.isin(*stops))).cast("long").alias("n_stop_words"),
            repeated.cast("long").alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"),
                        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    symbols = F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]+", ""))
    return F.struct(_let(words, of_words).alias("w"), _let(lines, of_lines).alias("l"),
                    symbols.cast("long").alias("n_symbols"))


_COUNTS = ("n_words", "word_chars", "n_stop_words", "n_repeat_words", "n_lines", "n_dup_lines", "n_symbols")


def _ratios(c: dict[str, Column]) -> dict[str, Column]:
    words, lines = F.greatest(c["n_words"], F.lit(1)), F.greatest(c["n_lines"], F.lit(1))
    return {
        "words": c["n_words"].cast("double"),
        "mean_word_chars": c["word_chars"] / words,
        "symbols_per_word": c["n_symbols"] / words,
        # One more than seen: a short text without any is no evidence.
        "stop_word_share": (c["n_stop_words"] + 1) / words,
        "dup_line_share": c["n_dup_lines"] / lines,
        "words_per_line": c["n_words"] / lines,
    }


def compile_rules(rules: tuple[tuple[str, float | None, float | None], ...], c: dict[str, Column]) -> Column:
    """Names of the rules that the counts ``c`` fail, in the table's order."""
    ratios = _ratios(c)
    failed = []
    for name, low, high in rules:
        bad = F.lit(False)
        if low is not None:
            bad = bad | (ratios[name] < F.lit(float(low)))
        if high is not None:
            bad = bad | (ratios[name] > F.lit(float(high)))
        failed.append(F.when(bad, F.lit(name)))
    return F.array_compact(F.array(*failed))


def verdict(text: Column, rules: tuple = RULES) -> Column:
    """Struct of all counts, base_failed, failed_rules and kept. One expression,
    in which the counts are bound once: a filter on ``kept`` computes them once."""
    def judged(found: Column) -> Column:
        c = {name: found["w"][name] for name in _COUNTS[:4]} | {name: found["l"][name] for name in _COUNTS[4:6]}
        c["n_symbols"] = found["n_symbols"]
        base = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
        failed = compile_rules(rules, c)
        return F.struct(*[c[name].alias(name) for name in _COUNTS], base.alias("base_failed"),
                        failed.alias("failed_rules"), (~base & (F.size(failed) == 0)).alias("kept"))

    return _let(counts(text), judged)


def evaluate(docs: DataFrame, rules: tuple = RULES, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``failed_rules`` and ``kept``.

    Rows are independent. A null, empty or blank text has no words and fails.
    Columns that bear one of these names are replaced.
    """
    new = {*_COUNTS, "base_failed", "failed_rules", "kept"}
    kept, found = [c for c in docs.columns if c.lower() not in new], fresh(docs.columns, "_verdict")
    return docs.select(*kept, verdict(F.col(text_col), rules).alias(found)).select(*kept, f"{found}.*")


def keep(docs: DataFrame, rules: tuple = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, unchanged."""
    return docs.filter(verdict(F.col(text_col), rules)["kept"])
