"""Distinct counts that add up: a stored sketch per group and column, merged without another scan.

A sketch of a run, a slice or both is a few kilobytes whatever the rows behind it. The distinct values of
any union of groups are estimated from their sketches alone, so that a new run costs the scan of that run. The
relative standard error is about ``1.04 / sqrt(2 ** precision)``, 1.6 % by default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRECISION = 12


def distinct_sketches(
    df: DataFrame,
    by: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    precision: int = PRECISION,
) -> DataFrame:
    """A row per group of ``by`` and column: the group, column_name, row_count, null_count, sketch.

    One aggregate over one scan; values are compared as strings. Without ``by`` all rows are one
    group, which an empty table has as well, with counts of 0.
    """
    names = list(columns if columns is not None else [c for c in df.columns if c not in by])
    measures = [F.count(F.lit(1)).alias("row_count")]
    for i, name in enumerate(names):
        value = F.col(f"`{name}`").cast("string")
        measures += [
            F.hll_sketch_agg(value, precision).alias(f"sketch{i}"),
            F.count_if(value.isNull()).alias(f"nulls{i}"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"nulls{i}").alias("null_count"),
            F.col(f"sketch{i}").alias("sketch"),
        )
        for i, name in enumerate(names)
    ]
    groups = df.groupBy(*[F.col(f"`{c}`") for c in by]).agg(*measures)
    return groups.select(*[F.col(f"`{c}`") for c in by], "row_count", F.inline(F.array(*rows)))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of larger groups: those of ``by``, or of all rows."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_union_agg("sketch").alias("sketch"),
    )


def distinct_counts(sketches: DataFrame) -> DataFrame:
    """The same rows with ``approx_distinct`` in place of the sketch."""
    return sketches.withColumn("approx_distinct", F.hll_sketch_estimate("sketch")).drop("sketch")
