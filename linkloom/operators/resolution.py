"""Resolution of every slice to one form, and the merge of the slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linkloom.fixed_values import METADATA_COLUMNS, RECORD_COLUMNS, RESOLVABLE_SLICES
from linkloom.functions import fill_template, last_segment
from linkloom.operators.slices import with_slice


def resolve_links(records: DataFrame, stored_slices: bool = False) -> DataFrame:
    """Add target_uri, target_id and authority_id by the rule of the record's slice.

    ============================  ======================  ======================  ============
    slice                         target_uri              target_id               authority_id
    ============================  ======================  ======================  ============
    target-notnull, three fields  TARGET filled (col1)    col3                    col1
    target-notnull, one or two    TARGET filled (col1)    col1                    col1
    target-null, three fields     col3                    last segment of col3    col1
    target-null, two fields       col2                    last segment of col2    col1
    target-null, one field        not resolved, dropped
    ============================  ======================  ======================  ============

    Harvest metadata columns follow if the records have them, and ``slice`` comes last.
    ``stored_slices`` says that records have their slice from ``write_slices``.
    """
    sliced = _resolvable(records, stored_slices)
    templated = F.col("slice").startswith("target-notnull")
    three = F.col("slice").endswith("col1-2-3")
    link = F.when(three, F.col("col3")).otherwise(F.col("col2"))
    metadata = [c for c in METADATA_COLUMNS if c in records.columns]
    return sliced.select(
        *RECORD_COLUMNS,
        F.when(templated, fill_template(F.col("TARGET"), F.col("col1")))
        .otherwise(link)
        .alias("target_uri"),
        F.when(templated, F.when(three, F.col("col3")).otherwise(F.col("col1")))
        .otherwise(last_segment(link))
        .alias("target_id"),
        F.col("col1").alias("authority_id"),
        *metadata,
        "slice",
    )


def _resolvable(records: DataFrame, stored_slices: bool) -> DataFrame:
    """Records of the five slices that have a rule.

    A stored slice column prunes partitions. Otherwise the test is put in terms of the fields,
    which a Parquet scan can evaluate, rather than of the label made from them.
    """
    if stored_slices:
        return records.where(F.col("slice").isin(RESOLVABLE_SLICES))
    has = {c: F.col(c).isNotNull() for c in ("TARGET", "col1", "col2", "col3")}
    return with_slice(
        records.where(has["col1"])
        .where(has["TARGET"] | has["col2"])
        .where(has["col2"] | ~has["col3"])
    )


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema``, cast and in its order; extra ones dropped, a missing one an error."""
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from an input of the merge: {', '.join(missing)}")
    return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def merge_slices(*tables: DataFrame) -> DataFrame:
    """All rows of all tables in the schema of the first one."""
    if not tables:
        raise ValueError("no tables to merge")
    schema = tables[0].schema
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionAll(align(table, schema))
    return merged
