"""Previews and samples.

The first ``n`` rows of a table, or of each of its slices, come out of one scan, and no task sees more than
``n`` rows of each of :data:`DEALS` others: see :func:`first_rows`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.fixed_values import PREVIEW_ROWS, SAMPLE_ROWS, SAMPLE_SEED
from linkloom.functions import is_orderable, sample_key
from linkloom.operators.slices import split_slices

#: Over how many tasks the rows that scanning tasks keep are dealt before the last one takes them.
DEALS = 64
#: Rows that one group of a spread limit has, about, as long as there are no more groups than this.
DEAL_ROWS = 100_000
MOST_DEALS = 65_536


def first_rows(df: DataFrame, n: int, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows in the order of some columns, of every group of ``by``, from one scan.

    A task that scans keeps ``n`` rows of each group (Spark limits a group before it is shuffled).
    What it keeps goes to one of :data:`DEALS` tasks, together; each of those keeps ``n`` again, so
    that the last task sees ``DEALS`` times ``n`` rows of a group, however many tasks have scanned.
    Spark limits groups early up to ``spark.sql.optimizer.windowGroupLimitThreshold`` rows. Beyond that
    a table without groups is sorted with a limit, and groups are numbered whole. NULLs come first.
    """
    sorting = [F.asc_nulls_first(f"`{name}`") for name in order]
    early = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    dealt = df.withColumn("__deal", F.pmod(F.spark_partition_id(), F.lit(DEALS)))
    for groups in ((*by, "__deal"), by):
        if groups and n <= early or by:
            place = F.row_number().over(Window.partitionBy(*groups).orderBy(*sorting))
            dealt = dealt.withColumn("__place", place).where(F.col("__place") <= n).drop("__place")
    dealt = dealt.drop("__deal")
    return dealt if by else dealt.orderBy(*sorting).limit(n)


def preview(df: DataFrame, n: int = PREVIEW_ROWS, order_by: Sequence[str] = ()) -> DataFrame:
    """``n`` rows: any, or the first in an order."""
    return first_rows(df, n, order_by) if order_by else df.limit(n)


def _in_random_order(df: DataFrame, seed: int | None) -> tuple[DataFrame, list[str]]:
    """The rows with what puts them in a random order, and the names of the columns that do.

    With a seed that is a digest of the row and the seed. Rows of equal digest are ordered by their
    columns, so that only identical rows can stand in for each other.
    """
    if seed is None:
        return df.withColumn("__digest", F.rand()), ["__digest"]
    ties = [f.name for f in df.schema.fields if is_orderable(f.dataType)]
    return df.withColumn("__digest", sample_key(df.columns, seed)), ["__digest", *ties]


def random_sample(df: DataFrame, n: int = SAMPLE_ROWS, seed: int | None = None) -> DataFrame:
    """``n`` random rows; the same rows on every run and every layout if a seed is given."""
    rows, order = _in_random_order(df, seed)
    return first_rows(rows, n, order).drop("__digest")


def sample_per_slice(
    records: DataFrame, n: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED, stored_slices: bool = False
) -> DataFrame:
    """Up to ``n`` random rows of every slice: all rows of a slice that has no more.

    The table is scanned once, be it stored by slice or not.
    """
    rows, order = _in_random_order(split_slices(records, stored_slices), seed)
    return first_rows(rows, n, order, ["slice"]).drop("__digest")


def spread_limit(df: DataFrame, n: int) -> DataFrame:
    """``n`` rows of ``df``, or all of them if there are fewer.

    A plain limit below an aggregate moves up to ``n`` rows of every partition into one task.
    Here rows are first thinned, at random, to slightly more than ``n`` over the whole table,
    with a margin of ten standard deviations. Counting them first is cheap on Parquet. What is left is
    dealt, at random, into groups of about :data:`DEAL_ROWS`, and each group gives its share of ``n`` or,
    where the table was too small to be thinned, gives up its share of the rows too many.
    """
    deals = min(-(-n // DEAL_ROWS), MOST_DEALS)
    wanted = n + 10 * (n * deals) ** 0.5 + 100 * deals
    total = df.agg(F.count(F.lit(1)).cast("double")).scalar()
    thinned = df.where(F.rand(0) * total < wanted)
    if deals <= 1:
        return thinned.limit(n)

    def share(rows: Column) -> Column:
        return F.floor(rows * (F.col("__deal") + 1) / deals) - F.floor(rows * F.col("__deal") / deals)

    place = F.row_number().over(Window.partitionBy("__deal").orderBy("__deal"))
    stays = (
        F.when(total <= n, F.lit(True))
        .when(total <= wanted, F.col("__place") > share(total - n))
        .otherwise(F.col("__place") <= share(F.lit(float(n))))
    )
    dealt = thinned.withColumn("__deal", F.floor(F.rand(1) * deals)).withColumn("__place", place)
    return dealt.where(stays).drop("__deal", "__place")
