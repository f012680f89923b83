"""Hot keys: exact detection with a proven size bound, and joins that split them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot above 1/MAX_HOT_KEYS of all rows, so at most as many are.
MAX_HOT_KEYS = 100_000
MIN_HOT_ROWS = 200_000


def hot_keys(df: DataFrame, keys: list[str], max_keys: int = MAX_HOT_KEYS,
             min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Keys holding more than 1/``max_keys`` of all rows, with ``hot_rows``.

    Fewer than ``max_keys`` keys can pass that test whatever the data looks
    like, so the result may be broadcast. Counting combines on the map side.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("hot_rows"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.filter(
        (F.col("hot_rows") > F.lit(min_rows)) & (F.col("hot_rows") * F.lit(max_keys) > total))


def salted_join(left: DataFrame, right: DataFrame, on: str, spread_by: list[str],
                how: str = "inner", rows_per_salt: int = MIN_HOT_ROWS,
                count_on: DataFrame | None = None, **hot: int) -> DataFrame:
    """Equi-join where single keys of ``left`` may hold a large share of the rows.

    A hot key is spread over ``ceil(rows / rows_per_salt)`` salts and only its
    right rows are repeated, once per salt; all other keys join as usual. The
    salt is a hash of ``spread_by``, so a retried task routes rows the same way.
    A null key matches nothing: in a left join its rows are spread over all
    tasks by ``spread_by``. ``count_on`` is a cheaper frame with the same key counts, for a ``left``
    that should not be computed twice.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    salts = (hot_keys(left if count_on is None else count_on, [on], **hot)
             .select(on, F.ceil(F.col("hot_rows") / F.lit(rows_per_salt)).cast("int").alias("_salts")))
    hashed = F.xxhash64(*spread_by)
    # Rows without a key get salts no key has, so they are dealt out evenly.
    spread = (F.when(F.col(on).isNull(), -1 - F.pmod(hashed, F.lit(1 << 16)))
              .otherwise(F.pmod(hashed, F.coalesce("_salts", F.lit(1)))).cast("int"))
    lhs = (left.join(F.broadcast(salts), on, "left")
           .withColumn("_salt", spread).drop("_salts"))
    rhs = (right.join(F.broadcast(salts), on, "left")
           .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
           .drop("_salts"))
    return lhs.join(rhs, [on, "_salt"], how).drop("_salt")
