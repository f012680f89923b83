"""Job metrics gathered while the job's own write runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` that counts itself on the way to its sink (no separate count job)."""
    observation = Observation(name)
    columns = [F.count(F.lit(1)).alias("rows")] + [c.alias(k) for k, c in metrics.items()]
    return df.observe(observation, *columns), observation
