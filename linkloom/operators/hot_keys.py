"""Keys that hold a large share of a table, found by a sketch, and a join that deals their rows out.

Adaptive execution splits a hot key by sizes it sees after a shuffle, if its thresholds say so. Here the hot keys
are known before: their rows on the large side are dealt over several tasks, those of the small side are repeated
in each of them, and the result is the same whatever the sketch has found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds this share of the rows that have one; there are at most as many as its inverse.
HOT_SHARE = 0.001
#: Counters of the sketch for every key that may be hot: an estimate is off by at most a tenth of the share.
COUNTERS = 10
#: Over how many tasks the rows of a hot key are dealt.
WAYS = 64


def hot_keys(df: DataFrame, key: Column, share: float = HOT_SHARE) -> list[str]:
    """The keys that hold at least ``share`` of the rows with a key: one aggregate over that column.

    The list has at most ``1 / share`` keys. A key near the share may be left out or let in.
    """
    most = int(1 / share)
    keys = df.select(key.alias("key")).where(F.col("key").isNotNull())
    found = keys.agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(key, {most}, {COUNTERS * most})").alias("top")
    )
    rows = found.select("rows", F.inline("top")).where(F.col("count") >= share * F.col("rows"))
    return [row.item for row in rows.collect()]


def dealt(df: DataFrame, key: Column, hot: Sequence[str], ways: int = WAYS) -> DataFrame:
    """``df``, the large side, with ``way``: rows of hot keys and of none are dealt in turn, others have 0."""
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(ways)).cast("int")
    return df.withColumn("way", F.when(key.isNull() | key.isin(list(hot)), turn).otherwise(F.lit(0)))


def repeated(df: DataFrame, key: Column, hot: Sequence[str], ways: int = WAYS) -> DataFrame:
    """``df``, the small side, with ``way``: rows of hot keys once for every way, others with 0."""
    last = F.when(key.isin(list(hot)), F.lit(ways - 1)).otherwise(F.lit(0))
    return df.withColumn("way", F.explode(F.sequence(F.lit(0), last)))
