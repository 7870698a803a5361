"""Classification of records by which fields they have."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.fixed_values import SLICES


def slice_tests() -> dict[str, Column]:
    """For every slice, the NULL tests that make it; a Parquet scan can evaluate them."""
    present = {c: F.col(c).isNotNull() for c in ("TARGET", "col1", "col2", "col3")}
    shapes = [
        present["col1"] & ~present["col2"] & ~present["col3"],
        present["col1"] & present["col2"] & ~present["col3"],
        present["col1"] & present["col2"] & present["col3"],
    ]
    tests = [t & s for t in (~present["TARGET"], present["TARGET"]) for s in shapes]
    return dict(zip(SLICES, tests, strict=True))


def slice_name() -> Column:
    """Slice of a record, or NULL if its fields fit none of the six patterns."""
    case = F
    for name, test in slice_tests().items():
        case = case.when(test, F.lit(name))
    return case


def with_slice(records: DataFrame, stored: bool = False) -> DataFrame:
    """Add the ``slice`` column, in place of any other of that name.

    ``stored`` says that the records have it from ``write_slices``; it is kept, so that reads stay
    pruned. The same holds for the other functions with this argument.
    """
    if stored:
        return records
    return records.withColumn("slice", slice_name())


def rows_of_slice(records: DataFrame, name: str, stored: bool = False) -> DataFrame:
    """The records of one slice, labelled: its partition if stored so, else by its NULL tests."""
    if stored:
        return records.where(F.col("slice") == name)
    return records.where(slice_tests()[name]).withColumn("slice", F.lit(name))


def split_slices(records: DataFrame, stored: bool = False) -> DataFrame:
    """The records that are in a slice, labelled; write with ``write_slices``."""
    if stored:
        return records.where(F.col("slice").isNotNull())
    gap = F.col("col2").isNull() & F.col("col3").isNotNull()
    return with_slice(records.where(F.col("col1").isNotNull() & ~gap))


def slice_counts(records: DataFrame, stored: bool = False) -> DataFrame:
    """Rows per non-empty slice."""
    return split_slices(records, stored).groupBy("slice").agg(F.count(F.lit(1)).alias("row_count"))


def rows_with_pattern(
    df: DataFrame, null_columns: Sequence[str], present_columns: Sequence[str]
) -> DataFrame:
    """Rows in which all of one set of columns are NULL and none of another is."""
    tests = [F.col(c).isNull() for c in null_columns]
    tests += [F.col(c).isNotNull() for c in present_columns]
    return df.where(reduce(and_, tests, F.lit(True)))


def null_patterns(records: DataFrame) -> DataFrame:
    """Rows per NULL pattern of col1..col3, with and without TARGET: eight counts, one pass."""
    patterns = {
        "col1-2-3": (True, True, True),
        "col1-2": (True, True, False),
        "col1": (True, False, False),
        "col2": (False, True, False),
    }
    cases = []
    for target, has_target in (("null", False), ("notnull", True)):
        for pattern, shape in patterns.items():
            wanted = dict(zip(("TARGET", "col1", "col2", "col3"), (has_target, *shape), strict=True))
            test = reduce(
                and_,
                [F.col(c).isNotNull() if v else F.col(c).isNull() for c, v in wanted.items()],
            )
            cases.append((target, pattern, F.count_if(test)))
    counts = records.agg(*[count.alias(f"n{i}") for i, (_, _, count) in enumerate(cases)])
    rows = [
        F.struct(
            F.lit(target).alias("target"),
            F.lit(pattern).alias("pattern"),
            F.col(f"n{i}").alias("row_count"),
        )
        for i, (target, pattern, _) in enumerate(cases)
    ]
    return counts.select(F.inline(F.array(*rows)))
