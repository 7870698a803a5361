"""What gives rows an order: a reproducible random one, or that of their columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def sample_key(columns: Sequence[str], seed: int) -> Column:
    """Digest of the row and the seed: independent of partitioning, files and cluster size."""
    values = [F.col(f"`{c}`").cast("string") for c in columns]
    return F.md5(F.concat_ws("|", *values, F.lit(str(seed))))


def is_orderable(data_type: DataType) -> bool:
    """Whether Spark can take the minimum of a column of this type."""
    if isinstance(data_type, ArrayType):
        return is_orderable(data_type.elementType)
    if isinstance(data_type, StructType):
        return all(is_orderable(field.dataType) for field in data_type.fields)
    return not isinstance(data_type, MapType | VariantType)
