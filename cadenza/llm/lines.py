"""Line dedup: content-defined chunks of lines, repeated ones removed after byte comparison.

A text is cut into lines: at line ends, and inside long paragraphs after
sentence marks. A rolling polynomial over the hashes of ``WINDOW`` lines
picks boundaries at its local minima, so they depend on nearby lines alone and
an inserted line shifts no boundary elsewhere. A chunk has two lines or more.
Chunks are counted by hash over the whole corpus; of a repeated one the first
occurrence (by id) stays, and another is removed only if its bytes equal the
first one's. Cutting keeps all separators: what is not removed is unchanged.

Only DataFrame functions are used. Texts cross the network once, keyed by
document; the count of chunks moves hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.workspace import materialise

LINE_END = "(?<=[\\n ])(?<=\\n|[.!?|] )"  # the first condition fails fast at most characters
WINDOW = 2
MIN_CHARS = 40
_PRIME, _BASE = 2147483647, 1000003


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def chunks(text: Column) -> Column:
    """Array of chunk texts; their concatenation is the text."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), LINE_END, -1), lambda x: x != "")

    def rolled(hashes: Column) -> Column:
        # The polynomial of the last WINDOW line hashes; fewer at the start.
        def at(h: Column, i: Column) -> Column:
            value = h
            for back in range(1, WINDOW):
                earlier = F.coalesce(F.get(hashes, i - back), F.lit(0).cast("long"))
                value = (value + earlier * F.lit(pow(_BASE, back, _PRIME)).cast("long") % _PRIME) % _PRIME
            return value
        return F.transform(hashes, at)

    def cut(x: Column) -> Column:
        hashes = F.transform(x, lambda line: F.pmod(F.xxhash64(line), F.lit(_PRIME).cast("long")))

        def starts(r: Column) -> Column:
            def minimum(i: Column) -> Column:
                return (F.get(r, i) < F.get(r, i - 1)) & (F.get(r, i) < F.get(r, i + 1))
            inner = F.when(F.size(x) >= 4, F.filter(F.sequence(F.lit(2), F.size(x) - 2), minimum))
            return F.concat(F.array(F.lit(0)), F.coalesce(inner, F.array().cast("array<int>")))

        def sliced(b: Column) -> Column:
            return F.transform(b, lambda at, k: F.array_join(
                F.slice(x, at + 1, F.coalesce(F.get(b, k + 1), F.size(x)) - at), ""))

        whole = _let(_let(hashes, rolled), lambda r: _let(starts(r), sliced))
        return F.when(F.size(x) == 0, F.array().cast("array<string>")).otherwise(whole)

    return _let(lines, cut)  # bound once: an expression that names the split twice splits twice


def _is_multi_line(chunk: Column) -> Column:
    return (F.length(chunk) >= MIN_CHARS) & F.rtrim(chunk).rlike("[\\n.!?|]\\s*[^\\n]")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text left after removal, ``n_chunks`` and ``n_removed``.

    Null texts stay null and empty ones empty, with no chunks. Rows that repeat
    id and text are one document: all are treated alike. Null ids come last, so
    what they repeat is removed from them. Columns named ``n_chunks`` or
    ``n_removed`` are replaced; all others pass through.
    """
    columns = [c for c in docs.columns if c.lower() not in ("n_chunks", "n_removed")]
    keyed = docs.select(F.struct(*columns).alias("row"), F.col(id_col).cast("long").alias("_i"),
                        F.xxhash64(text_col).alias("_t"))
    whole = F.col("row").getField(text_col)
    order = [F.col("_i").isNull().alias("no_id"), F.col("_i").alias("i"), F.col("_t").alias("t"), F.col("k")]

    # Cutting is most of the work: here for every text, later only for texts that hold or lose a repeated chunk.
    def hashed(chunk: Column, k: Column) -> Column:
        return F.when(_is_multi_line(chunk), F.struct(k.alias("k"), F.xxhash64(chunk).alias("h"), F.length(chunk).alias("n")))

    cut = materialise(keyed.select("_i", "_t", F.explode(F.array(chunks(whole))).alias("c"))
                      .select("_i", "_t", F.size("c").alias("n_chunks"),
                              F.filter(F.transform("c", hashed), lambda x: x.isNotNull()).alias("c")), "chunks")
    seen = cut.select("_i", "_t", F.explode("c").alias("c")).select("_i", "_t", "c.*")
    # What is aggregated by chunk is stored before it is joined back: Spark splits a
    # chunk that very many documents share only between two plain shuffles.
    often = materialise(seen.groupBy("h", "n").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("h", "n"),
                        "often")
    repeated = materialise(seen.join(often, ["h", "n"]), "repeated")
    first = materialise(repeated.groupBy("h", "n").agg(F.min(F.struct(*order)).alias("f")).select("h", "n", "f.*"), "first")

    def of_document(rows: DataFrame, value: Column) -> DataFrame:
        return rows.groupBy("_i", "_t").agg(F.array_sort(F.collect_list(value)).alias("marks"))

    def with_marks(marks: DataFrame, how: str) -> DataFrame:
        m = marks.withColumnsRenamed({"_i": "_mi", "_t": "_mt"})
        return keyed.join(m, F.col("_i").eqNullSafe(F.col("_mi")) & (F.col("_t") == F.col("_mt")), how).drop("_mi", "_mt")

    held = of_document(first.select(F.col("i").alias("_i"), F.col("t").alias("_t"), "k", "h", "n"),
                       F.struct("k", "h", "n"))
    originals = materialise(
        with_marks(held, "inner")
        .select(F.explode(_let(chunks(whole), lambda c: F.transform("marks", lambda m: F.struct(
            m["h"].alias("h"), m["n"].alias("n"), F.get(c, m["k"]).alias("original"))))).alias("o"))
        .select("o.*").groupBy("h", "n").agg(F.min("original").alias("original")), "originals")
    later = (repeated.join(first.select("h", "n", "i", "t", F.col("k").alias("fk")), ["h", "n"])
             .filter(~(F.col("_i").eqNullSafe(F.col("i")) & (F.col("_t") == F.col("t")) & (F.col("k") == F.col("fk"))))
             .select("_i", "_t", "k", "h", "n").distinct())
    losing = of_document(later.join(originals, ["h", "n"]), F.struct("k", "original")).withColumnsRenamed({"_i": "_li", "_t": "_lt"})
    marks = (cut.groupBy("_i", "_t").agg(F.max("n_chunks").alias("n_chunks"))
             .join(losing, F.col("_i").eqNullSafe(F.col("_li")) & (F.col("_t") == F.col("_lt")), "left").drop("_li", "_lt"))

    def cleaned(c: Column) -> Column:
        # A mark counts only if the chunk's bytes equal the original's.
        gone = F.transform(F.filter("marks", lambda m: F.get(c, m["k"]) == m["original"]), lambda m: m["k"])
        kept = F.when(F.size(gone) == 0, F.array_join(c, "")).otherwise(
            F.array_join(F.filter(c, lambda x, i: ~F.array_contains(gone, i)), ""))
        return F.struct(kept.alias("text"), F.size(c).alias("n_chunks"), F.size(gone).alias("n_removed"))

    marked = with_marks(marks, "left")
    unchanged = F.struct(F.coalesce(whole, F.lit("")).alias("text"), F.col("n_chunks"), F.lit(0).alias("n_removed"))
    # Generated, not projected: a later filter on the outcome does not compute it again.
    out = marked.select("row", F.explode(F.array(
        F.when(F.col("marks").isNull(), unchanged).otherwise(_let(chunks(whole), cleaned)))).alias("_r"))
    text = F.when(whole.isNotNull(), F.col("_r.text"))
    return out.select(*[(text if c == text_col else F.col("row").getField(c)).alias(c) for c in columns],
                      F.col("_r.n_chunks").alias("n_chunks"), F.col("_r.n_removed").alias("n_removed"))
