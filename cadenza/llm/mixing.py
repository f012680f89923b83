"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a budget of words. What the budget holds of the whole source
is taken as complete epochs; the rest is a weighted sample without replacement:
a document's key is ``-ln(u) / quality`` with ``u`` from a hash, the keys are
sorted within the source and sizes summed up along them until the budget is
met. The document at the seam gives its first words, so a source's words meet
its budget exactly.

Only ids, sizes and keys are sorted, by range over all sources together, so a
source of any size spreads over tasks; texts are never shuffled. Result and
rerun agree: nothing is random but hashes of ids and texts.

Nulls: a null text has size 0; a null source is a source of its own, ranked
last; a null id counts as an empty one. A quality that is null or below
``LEAST_QUALITY`` counts as that. Ties of keys go by id. Rows with the same source, id and text
are one unit: at the seam they share what is left evenly, rounded down. Long texts are only counted. An
empty table gives an empty mix. Columns of ``docs`` are kept; columns made here replace those of
the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.ordering import dense_index
from cadenza.operators.skew import salted_join
from cadenza.workspace import materialise

WEIGHTS = (1, 2, 3)  # of the sources in order, repeating
MAX_EPOCHS = 3
LEAST_QUALITY = 0.05
MARKS = "#*$%&|<>{}[]\\^~_=0123456789"
# A key of a join above so many rows is dealt out over several tasks.
HOT_ROWS = 2_000

_BLANK = "\t\n\u000b\f\r "


def n_words(text: Column) -> Column:
    """Words of a text; runs of white space count as one gap."""
    gap, word = "[\\x20\\x09-\\x0D]*", "[^\\x20\\x09-\\x0D]+"
    marks = F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), gap + word, "x"), _BLANK, "")
    return F.length(marks).cast("long")


def quality_of(text: Column) -> Column:
    """Share of a text's characters that are neither digits nor symbols."""
    return F.length(F.translate(text, MARKS, "")) / F.greatest(F.length(text), F.lit(1))


def sampling_key(key: Column, quality: Column, seed: int = 0) -> Column:
    """Exponential key of rate ``quality`` from 52 bits of a hash: the smaller, the earlier."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"|{seed}"))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / F.greatest(F.coalesce(quality, F.lit(0.0)), F.lit(LEAST_QUALITY))


def measured(docs: DataFrame, quality: Column | None = None, seed: int = 0, id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source") -> dict[str, Column]:
    """Expressions of a row's source key, id key, size and sampling key."""
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # The prefix keeps a null source apart from every text.
    source = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("~"))
    key = F.concat_ws("|", ident, F.md5(text))
    weight = quality_of(F.col(text_col)) if quality is None else quality.cast("double")
    return {"_src": source, "_id": ident, "_size": n_words(F.col(text_col)), "_key": sampling_key(key, weight, seed)}


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(_src, source_size, target) from (_src, source_size), a row a source.

    Sources in code-point order take the weights in turn. A target is
    ``min(max_epochs * size, level * weight)`` at the level at which the
    targets add up to all words: sharing the excess again and again ends there.
    Each round sends three sums to the driver.
    """
    ranked = dense_index(sizes, ["_src"], "_rank")
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    held = materialise(ranked.select("_src", "source_size", pick.alias("_w"),
                                     (F.col("source_size") * max_epochs).alias("_cap")), "mix-sources")
    level, full = 0.0, -1
    while True:
        over = F.col("_cap") < F.lit(level) * F.col("_w")
        total, capped, rest, n = held.agg(
            F.sum("source_size"), F.sum(F.when(over, F.col("_cap"))), F.sum(F.when(~over, F.col("_w"))), F.count_if(over)).first()
        if n == full or not rest or not total:
            break
        level, full = (total - (capped or 0)) / rest, n
    share = F.lit(float(level)) * F.col("_w")
    return held.select("_src", "source_size", F.least(F.col("_cap").cast("double"), share).alias("target"))


def budgets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """A row a source: size, target, whole epochs and the document at the seam.

    ``rows`` (_src, _id, _size, _key) is read several times; pass a stored
    table. Rows alike are one unit of several copies. Sorted by range, a unit's
    place in its source is the sum of the partitions before plus that of its
    own; only the one partition of a source that holds the seam is summed row by row.
    """
    sizes = rows.groupBy("_src").agg(F.sum("_size").alias("source_size"))
    want = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(want / F.col("source_size"))).otherwise(F.lit(0))
    plan = targets(sizes, weights, max_epochs).withColumn("epochs", epochs.cast("long")).withColumn(
        "_rest", (want - F.col("epochs") * F.col("source_size")).cast("long"))
    plan = materialise(plan, "mix-plan")
    order = ["_src", "_key", "_id", "_size"]
    units = rows.groupBy(*order).agg(F.count(F.lit(1)).alias("_copies"))
    ranged = materialise(units.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "mix-ranges")
    words = F.col("_size") * F.col("_copies")
    before = F.sum("_words").over(Window.partitionBy("_src").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = ranged.groupBy("_src", "_part").agg(F.sum(words).alias("_words"))
    seam_part = (parts.withColumn("_before", F.coalesce(before, F.lit(0))).join(plan.select("_src", "_rest"), "_src")
                 .filter((F.col("_before") < F.col("_rest")) & (F.col("_rest") <= F.col("_before") + F.col("_words")))
                 .select(F.col("_src").alias("_s"), F.col("_part").alias("_p"), "_before", "_rest"))
    along = F.sum(words).over(Window.partitionBy("_src").orderBy("_key", "_id", "_size")
                              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = (ranged.join(seam_part, (F.col("_src") == F.col("_s")) & (F.col("_part") == F.col("_p")))
              .withColumn("_upto", F.col("_before") + along)
              .filter((F.col("_upto") >= F.col("_rest")) & (F.col("_upto") - words < F.col("_rest"))))
    seam = inside.select("_src", F.struct("_key", "_id", "_size").alias("_seam"),
                         F.floor((F.col("_rest") - F.col("_upto") + words) / F.col("_copies")).cast("long").alias("_share"))
    return materialise(plan.drop("_rest").join(seam, "_src", "left"), "mix-budgets")


def _taken(rows: DataFrame, plan: DataFrame, count_on: DataFrame | None = None) -> DataFrame:
    """``rows`` with their source's plan, ``epochs`` and ``extra`` words beyond them."""
    joined = salted_join(rows, plan, "_src", ["_id", "_key"], rows_per_salt=HOT_ROWS, count_on=count_on, min_rows=HOT_ROWS)
    here = F.struct("_key", "_id", "_size")
    extra = F.when(here < F.col("_seam"), F.col("_size")).when(here == F.col("_seam"), F.col("_share"))
    return joined.withColumn("extra", F.coalesce(extra, F.lit(0)).cast("long")).drop("_seam", "_share")


def mix_plan(docs: DataFrame, quality: Column | None = None, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
             seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, size, source_size, target, epochs, extra, taken), a row a document, without texts."""
    cols = measured(docs, quality, seed, id_col, text_col, source_col)
    rows = materialise(docs.select(F.col(id_col).alias("_doc"), F.col(source_col).alias("_source"),
                                   *[c.alias(name) for name, c in cols.items()]), "mix-rows")
    out = _taken(rows, budgets(rows, weights, max_epochs), rows)
    return out.select(F.col("_doc").alias(id_col), F.col("_source").alias(source_col), F.col("_size").alias("size"),
                      "source_size", "target", "epochs", "extra",
                      (F.col("epochs") * F.col("_size") + F.col("extra")).alias("taken"))


def mix(docs: DataFrame, quality: Column | None = None, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: a row for every copy taken, ``epoch`` from 0, complete
    epochs first; the copy at a source's seam keeps its first words only."""
    cols = measured(docs, quality, seed, id_col, text_col, source_col)
    rows = materialise(docs.select(*[c.alias(name) for name, c in cols.items()]), "mix-rows")
    plan = budgets(rows, weights, max_epochs).withColumn("_plan", F.struct("epochs", "_seam", "_share")).select("_src", "_plan")
    kept = [c for c in docs.columns if c != "epoch"]
    tagged = docs.select(*kept, *[c.alias(name) for name, c in cols.items()])
    joined = salted_join(tagged, plan, "_src", ["_id", "_key"], rows_per_salt=HOT_ROWS, count_on=rows, min_rows=HOT_ROWS)
    here, seam = F.struct("_key", "_id", "_size"), F.col("_plan._seam")
    extra = F.coalesce(F.when(here < seam, F.col("_size")).when(here == seam, F.col("_plan._share")), F.lit(0))
    last = F.col("_plan.epochs").cast("int")
    copies = F.sequence(F.lit(0), last + F.when(extra > 0, 0).otherwise(-1))
    copies = F.when((last > 0) | (extra > 0), copies).otherwise(F.array().cast("array<int>"))
    out = joined.withColumn("_extra", extra).withColumn("epoch", F.explode(copies))
    cut = (F.col("epoch") == last) & (F.col("_extra") < F.col("_size"))
    return out.withColumn(text_col, F.when(cut, first_words(F.col(text_col), F.col("_extra"))).otherwise(F.col(text_col))).select(
        *kept, "epoch")


def first_words(text: Column, n: Column) -> Column:
    """The beginning of a text up to the end of its ``n``-th word."""
    words = F.regexp_extract_all(text, F.lit("([\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+)"), F.lit(1))
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")
