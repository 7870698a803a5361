"""Explicit schemas. Only the source list is inferred, because its extra fields are free."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from linkloom.fixed_values import RECORD_COLUMNS

RECORDS = StructType([StructField(name, StringType()) for name in RECORD_COLUMNS])

# ``block`` is where the file split starts that a line was read from; ``ord`` rises with the
# line number inside one split. Together they order the lines of a file.
LINES = StructType(
    [
        StructField("source_file", StringType()),
        StructField("block", LongType()),
        StructField("ord", LongType()),
        StructField("line", StringType()),
    ]
)

HARVEST_METADATA = StructType(
    [
        StructField("url", StringType()),
        StructField("filename", StringType()),
        StructField("path", StringType()),
        StructField("size_bytes", LongType()),
        StructField("download_time_utc", StringType()),
        StructField("status", StringType()),
    ]
)

AUTHORITY_DUMP = StructType(
    [
        StructField("id", StringType()),
        StructField("gndIdentifier", StringType()),
        StructField("type", ArrayType(StringType())),
        StructField("oldAuthorityNumber", ArrayType(StringType())),
    ]
)
