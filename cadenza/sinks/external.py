"""Sinks whose client or connector the deployment provides."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

KV_BATCH = 1000


def write_collection(df: DataFrame, name: str, fmt: str, options: dict[str, str]) -> None:
    """Overwrite one collection of a document store (or any Spark format)."""
    df.write.format(fmt).mode("overwrite").options(**options).option("collection", name).save()


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               replace: bool = False) -> None:
    """Append to a JDBC table; ``replace`` empties it first but keeps its keys."""
    if replace:
        df.write.option("truncate", True).jdbc(url, table, mode="overwrite", properties=properties or {})
    else:
        df.write.jdbc(url, table, mode="append", properties=properties or {})


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that would break a primary key, with how often they occur."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def publish_kv(kv: DataFrame, connect: Callable[[], object], batch: int = KV_BATCH) -> None:
    """Put (key, value) rows from every partition, ``batch`` records per flush.

    ``connect`` runs on the executor and returns a client with
    ``put_many(list[tuple[str, str]])`` and ``close()``. Puts are keyed, so a
    retried task overwrites the same records.
    """
    def put(rows: Iterator[Row]) -> None:
        client = connect()
        try:
            pending: list[tuple[str, str]] = []
            for row in rows:
                pending.append((row["key"], row["value"]))
                if len(pending) == batch:
                    client.put_many(pending)
                    pending = []
            if pending:
                client.put_many(pending)
        finally:
            client.close()

    kv.select("key", "value").foreachPartition(put)
