"""Lines of JSON that do not say what they should: told apart from the others, not lost and not fatal.

An entry is a JSON object whose known fields have their types. A line (or element of an array)
that is none is rejected with its text and the reason; everything else goes on as it does without.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Why a line is rejected.
NO_OBJECT, MALFORMED, WRONG_TYPE = "no object", "malformed", "wrong type"
_TEXT = "__rejected"


def json_entries(lines: DataFrame, schema: StructType, line: str = "line") -> DataFrame:
    """Every line that is not blank, parsed once: the columns of ``lines``, ``entry``, ``reason``.

    ``reason`` is NULL for an entry. A rejected line has a NULL ``entry``, whatever of it could be read.
    """
    text = F.btrim(F.col(line), F.lit(" \t\r\n\ufeff"))
    reading = StructType([*schema.fields, StructField(_TEXT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _TEXT}
    whole = F.try_parse_json(text)
    parsed = (
        lines.where(text != "")
        .withColumn("__entry", F.from_json(text, reading, options))
        .withColumn("reason", _reason(text, F.col(f"__entry.{_TEXT}").isNotNull(), whole))
    )
    fields = [F.col(f"__entry.`{f.name}`").alias(f.name) for f in schema.fields]
    entry = F.when(F.col("reason").isNull(), F.struct(*fields))
    return parsed.withColumn("entry", entry).drop("__entry")


def _reason(text: Column, corrupt: Column, whole: Column) -> Column:
    """The first reason that applies; whether JSON is well-formed is asked of corrupt lines alone."""
    return (
        F.when(~text.startswith("{"), F.lit(NO_OBJECT))
        .when(corrupt & whole.isNull(), F.lit(MALFORMED))
        .when(corrupt, F.lit(WRONG_TYPE))
    )


def json_elements(documents: DataFrame, document: str = "value") -> DataFrame:
    """The elements of JSON arrays, one row each as text: the other columns, ``list_index``, ``line``.

    A document that is no well-formed array is one row with NULL ``list_index`` and all of its text:
    :func:`json_entries` takes a lone object for an entry, and rejects anything else whole.
    """
    text = F.btrim(F.col(document), F.lit(" \t\r\n\ufeff"))
    elements = F.from_json(text, "array<string>", {"mode": "PERMISSIVE"})
    fine = F.try_parse_json(text).isNotNull() & text.startswith("[")
    item = F.struct(F.lit(None).cast("int").alias("list_index"), text.alias("line"))
    listed = F.transform(elements, lambda e, i: F.struct(i.alias("list_index"), F.coalesce(e, F.lit("null")).alias("line")))
    others = [F.col(c) for c in documents.columns if c != document]
    return documents.select(*others, F.inline(F.when(fine, listed).otherwise(F.array(item))))


def accepted(entries: DataFrame) -> DataFrame:
    """The fields of the entries among :func:`json_entries`."""
    return entries.where(F.col("reason").isNull()).select("entry.*")


def rejected(entries: DataFrame) -> DataFrame:
    """The lines among :func:`json_entries` that are none, with the reason."""
    return entries.where(F.col("reason").isNotNull()).drop("entry")
