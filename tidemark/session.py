"""Session settings the library is tuned for; any existing session works too."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # one clock for "which day is this instant on"
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: coalesce small partitions, split skewed ones
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


# a sort or hash table of this much input fits an executor core's memory share
PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int, cores: int = 1) -> int:
    """Partitions that keep a shuffle of the given size within a task's memory.

    Meant as an upper start: the adaptive planner merges what turns out small.
    """
    return max(cores, -(-shuffled_bytes // PARTITION_BYTES))


def build_session(
    name: str = "tidemark",
    master: str | None = None,
    shuffled_bytes: int | None = None,
    **extra: str,
) -> SparkSession:
    """Session with the settings above; `extra` uses `__` for dots in keys.

    `shuffled_bytes` is the size of the largest shuffle to expect: the daily table for
    a full refresh, the raw load for a partitioned write.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    if shuffled_bytes:
        builder = builder.config(
            "spark.sql.shuffle.partitions", shuffle_partitions(shuffled_bytes, 200)
        )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
