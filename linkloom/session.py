"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: partition sizes, join strategy, and the split of skewed join keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Where every partition of the smaller side of a shuffle join turns out to fit this size,
    # hash it instead of sorting both sides: the larger one is the whole record table. The size is
    # that of compressed shuffle blocks, of which rows in memory take up to fifty times.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "8MB",
    # A writer per slice, which saves sorting the table by slice before it is written.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Timestamps in harvest metadata are UTC.
    "spark.sql.session.timeZone": "UTC",
    # A rerun of one harvest replaces that run's partition and no other.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: For a cluster only. Adaptive execution merges small shuffle partitions but splits only skewed ones,
#: so it has to start with many.
CLUSTER_SETTINGS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000"}


def build_session(app_name: str, master: str | None = None, **overrides: str) -> SparkSession:
    """Session with :data:`SETTINGS`; on a cluster leave ``master`` to spark-submit.

    Without ``master`` it has :data:`CLUSTER_SETTINGS` as well.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = SETTINGS if master is not None else SETTINGS | CLUSTER_SETTINGS
    for key, value in {**settings, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
