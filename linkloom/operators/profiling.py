"""Column profiles and file statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.fixed_values import PREVIEW_ROWS, SAMPLE_ROWS, STATS_ROWS
from linkloom.functions import is_orderable
from linkloom.operators.counts import row_count
from linkloom.operators.sampling import preview, random_sample, spread_limit

STATS_MODES = ("none", "sample", "full")


def describe_table(df: DataFrame) -> DataFrame:
    """One row per column: ordinal, column_name, data_type, and the rows of the table."""
    rows = [
        F.struct(
            F.lit(i).cast("bigint").alias("ordinal"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    return row_count(df).select(F.inline(F.array(*rows)), "row_count")


def profile_columns(
    df: DataFrame,
    distinct_columns: Sequence[str] | None = (),
    sample_rows: int | None = None,
    rsd: float = 0.05,
) -> DataFrame:
    """One row per column: NULL count, approximate distinct count, minimum and maximum.

    All of it is one aggregate over one scan. ``distinct_columns`` says for which columns
    distinct values are estimated (``None``: all); other columns, and extremes of types
    without an order, are NULL. ``sample_rows`` limits the rows looked at. Extremes are
    strings. The NULL count of an empty table is NULL.
    """
    if sample_rows is not None:
        df = spread_limit(df, sample_rows)
    counted = set(df.columns if distinct_columns is None else distinct_columns)
    measures, rows = [], []
    for i, field in enumerate(df.schema.fields):
        column = F.col(f"`{field.name}`")
        measures.append(F.sum(F.when(column.isNull(), 1).otherwise(0)).alias(f"nulls{i}"))
        distinct = low = high = F.lit(None)
        if field.name in counted:
            measures.append(F.approx_count_distinct(column, rsd).alias(f"distinct{i}"))
            distinct = F.col(f"distinct{i}")
        if is_orderable(field.dataType):
            measures += [F.min(column).alias(f"min{i}"), F.max(column).alias(f"max{i}")]
            low, high = F.col(f"min{i}"), F.col(f"max{i}")
        rows.append(
            F.struct(
                F.lit(i).cast("bigint").alias("ordinal"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col(f"nulls{i}").alias("null_count"),
                distinct.cast("bigint").alias("approx_distinct"),
                low.cast("string").alias("min_value"),
                high.cast("string").alias("max_value"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def approx_distinct(
    df: DataFrame, columns: Sequence[str] | None = None, rsd: float = 0.05
) -> DataFrame:
    """One row per column: its approximate number of distinct values.

    ``rsd`` is the relative standard deviation of the estimates.
    """
    names = list(columns or df.columns)
    estimates = df.agg(
        *[F.approx_count_distinct(f"`{c}`", rsd).alias(f"d{i}") for i, c in enumerate(names)]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"d{i}").alias("approx_distinct"))
        for i, c in enumerate(names)
    ]
    return estimates.select(F.inline(F.array(*rows)))


def file_stats(df: DataFrame) -> DataFrame:
    """One row per file that ``df`` scans: name, size, modification time, rows."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    ).agg(F.count(F.lit(1)).alias("row_count"))


@dataclass(frozen=True)
class Inspection:
    """Lazy frames of one inspection; those not asked for are None."""

    columns: DataFrame
    preview: DataFrame
    random_sample: DataFrame
    row_count: DataFrame | None
    file_stats: DataFrame | None
    column_stats: DataFrame | None


def inspect(
    df: DataFrame,
    *,
    preview_rows: int = PREVIEW_ROWS,
    random_sample_rows: int = SAMPLE_ROWS,
    sample_seed: int | None = None,
    compute_row_count: bool = True,
    stats_mode: str = "sample",
    sample_rows_for_stats: int = STATS_ROWS,
    columns_for_distinct: Sequence[str] | None = None,
    include_file_metadata: bool = True,
) -> Inspection:
    """Everything there is to know about a table at first sight.

    File statistics need a table read from files; elsewhere they are left out.
    """
    if stats_mode not in STATS_MODES:
        raise ValueError("stats_mode must be one of: 'none', 'sample', 'full'")
    stats = None
    if stats_mode != "none":
        limit = sample_rows_for_stats if stats_mode == "sample" else None
        stats = profile_columns(df, columns_for_distinct or None, limit)
    return Inspection(
        columns=describe_table(df),
        preview=preview(df, preview_rows),
        random_sample=random_sample(df, random_sample_rows, sample_seed),
        row_count=row_count(df) if compute_row_count else None,
        file_stats=file_stats(df) if include_file_metadata and _scans_files(df) else None,
        column_stats=stats,
    )


def _scans_files(df: DataFrame) -> bool:
    try:
        return bool(df.select("_metadata").schema)
    except AnalysisException:
        return False
