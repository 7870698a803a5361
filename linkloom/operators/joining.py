"""What a join needs so that its hot keys can be split."""

from __future__ import annotations

from pyspark.sql import DataFrame


def shuffled_anew(df: DataFrame) -> DataFrame:
    """The same rows in a partitioning that Spark does not know.

    Adaptive execution splits the hot keys of a shuffle join only if it has just shuffled both
    sides for it. A side that an aggregate left partitioned by the key would be used as it
    lies, and then every row of a hot key on the other side goes to one task. Use it on the
    small side: its rows are moved once more, those of the large side are not.
    """
    return df.hint("rebalance")
