"""Session settings every job relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Event times are zone-less UTC strings and day keys are derived from them, so
# the session zone is part of the result, not a preference.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Per-key top lists of any length asked for are cut before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    # Dedup and window state beyond the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Shuffled bytes one task should get before adaptive coalescing.
SHUFFLE_TASK_BYTES = 128 * 1024 ** 2


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Initial shuffle partitions for an input: enough for small tasks, which
    adaptive execution merges where they turn out smaller still."""
    return max(cores, -(-input_bytes // SHUFFLE_TASK_BYTES))


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session with the engine's settings and no web UI."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
