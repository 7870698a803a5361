"""Harvest metadata on records, and the checks on its key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.fixed_values import DUPLICATE_EXAMPLES
from linkloom.functions import unescape_slashes


def attach_metadata(
    records: DataFrame, metadata: DataFrame, flag: str | None = None
) -> DataFrame:
    """Left join of records to their file's URL and download time.

    ``flag`` names a further column that says whether metadata lists the file. A record without metadata keeps NULLs; a path listed twice doubles its records, which
    :func:`key_uniqueness` and ``compare_counts`` detect. No join strategy is forced: metadata
    that fits the broadcast threshold is broadcast, and beyond it the shuffle join splits the
    files that hold most of the rows.
    """
    meta = metadata.select(
        F.col("path").alias("meta_path"),
        F.col("url").alias("beacon_uri"),
        F.col("download_time_utc").alias("beacon_harvest_timestamp"),
    )
    joined = records.join(
        meta, unescape_slashes(records["source_file"]) == meta["meta_path"], "left"
    )
    if flag is not None:
        joined = joined.withColumn(flag, F.col("meta_path").isNotNull())
    return joined.drop("meta_path")


def records_without_metadata(records: DataFrame, metadata: DataFrame) -> int:
    """How many records are of files that metadata does not list, counted file by file."""
    files = records.groupBy(unescape_slashes(F.col("source_file")).alias("path")).agg(
        F.count(F.lit(1)).alias("n")
    )
    listed = metadata.select("path").distinct()
    return files.join(listed, "path", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]


def key_uniqueness(df: DataFrame, key: str = "path") -> DataFrame:
    """One row: items, distinct keys, surplus items (NULL keys among them), uniqueness."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_items"),
        F.count(key).alias("distinct_paths"),
    )
    surplus = F.col("total_items") - F.col("distinct_paths")
    return counts.select(
        "total_items",
        "distinct_paths",
        surplus.alias("duplicate_items"),
        (surplus == 0).alias("is_unique"),
    )


def duplicate_keys(df: DataFrame, key: str = "path", n: int = DUPLICATE_EXAMPLES) -> DataFrame:
    """The ``n`` keys that occur most often, if more than once; ties in key order."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
        .orderBy(F.desc("occurrences"), F.asc(key))
        .limit(n)
    )
