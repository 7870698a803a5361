"""Column profiles that add up: a row per file, merged into the table's without another scan.

A file's profile keeps typed extremes, the NULL count and a distinct sketch of every column. The profile
of a table is the merge of its files' profiles, so that files which have been profiled are not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType, TimestampType

from linkloom.functions import is_orderable
from linkloom.operators.sketches import PRECISION

FILE = "__file"


def profile_schema(table: StructType) -> StructType:
    """The columns of file profiles: the file and its rows, then a structure per column of the table."""
    file = StructType().add("file_path", "string").add("file_size", LongType()).add("modified", TimestampType())
    out = StructType([StructField(FILE, file.add("row_count", LongType()))])
    for field in table.fields:
        parts = StructType().add("null_count", LongType()).add("sketch", BinaryType())
        if is_orderable(field.dataType):
            parts = parts.add("low", field.dataType).add("high", field.dataType)
        out = out.add(field.name, parts)
    return out


def file_profiles(df: DataFrame, precision: int = PRECISION) -> DataFrame:
    """A profile per file that ``df`` scans and that has rows: one aggregate over one scan."""
    measures = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        parts = [
            F.count_if(column.isNull()).alias("null_count"),
            F.hll_sketch_agg(column.cast("string"), precision).alias("sketch"),
        ]
        if is_orderable(field.dataType):
            parts += [F.min(column).alias("low"), F.max(column).alias("high")]
        measures.append(F.struct(*parts).alias(field.name))
    file = [
        F.col("_metadata.file_path").alias("__path"),
        F.col("_metadata.file_size").alias("__size"),
        F.col("_metadata.file_modification_time").alias("__modified"),
    ]
    found = df.groupBy(*file).agg(F.count(F.lit(1)).alias("__rows"), *measures)
    state = F.struct(
        F.col("__path").alias("file_path"),
        F.col("__size").alias("file_size"),
        F.col("__modified").alias("modified"),
        F.col("__rows").alias("row_count"),
    )
    return found.select(state.alias(FILE), *[F.col(f"`{name}`") for name in df.columns])


def merge_profiles(profiles: DataFrame, table: StructType) -> DataFrame:
    """The profile of all files, in the form of ``profile_columns``.

    A column that a file's profile lacks was added to the table later: its values there are NULL.
    """
    rows_of_file = F.col(f"{FILE}.row_count")
    measures, rows = [F.sum(rows_of_file).alias("rows")], []
    for i, field in enumerate(table.fields):
        column = F.col(f"`{field.name}`")
        measures += [
            F.sum(F.coalesce(column["null_count"], rows_of_file)).alias(f"nulls{i}"),
            F.hll_union_agg(column["sketch"]).alias(f"sketch{i}"),
        ]
        low = high = F.lit(None)
        if is_orderable(field.dataType):
            measures += [F.min(column["low"]).alias(f"min{i}"), F.max(column["high"]).alias(f"max{i}")]
            low, high = F.col(f"min{i}"), F.col(f"max{i}")
        rows.append(
            F.struct(
                F.lit(i).cast("bigint").alias("ordinal"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.when(F.col("rows") > 0, F.col(f"nulls{i}")).alias("null_count"),
                F.hll_sketch_estimate(f"sketch{i}").alias("approx_distinct"),
                low.cast("string").alias("min_value"),
                high.cast("string").alias("max_value"),
            )
        )
    return profiles.agg(*measures).select(F.inline(F.array(*rows)))
