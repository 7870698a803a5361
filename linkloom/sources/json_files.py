"""Readers for the JSON inputs: source list, harvest metadata, authority dump."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from linkloom import schemas
from linkloom.operators.rejects import json_elements, json_entries


def _existing(load, path: str) -> DataFrame:
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"File not found: {path}") from error
        raise


def read_source_list(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a JSON source list with their 0-based position as ``list_index``.

    The list is one JSON document, an array of objects with free extra fields. The position
    comes from the array itself, not from the order in which rows happen to be read. A list that
    is not well-formed JSON is an error.
    """
    reader = spark.read.options(multiLine=True, mode="FAILFAST")
    inferred = _existing(lambda: reader.json(path), path).schema
    document = spark.read.text(path, wholetext=True)
    text = F.btrim(F.col("value"), F.lit("\ufeff"))
    entries = document.select(
        F.posexplode(F.from_json(text, ArrayType(inferred), {"mode": "FAILFAST"})).alias("list_index", "entry")
    )
    return entries.select(F.col("list_index").cast("bigint").alias("list_index"), "entry.*")


def read_harvest_metadata(spark: SparkSession, path: str, parse_time: bool = True) -> DataFrame:
    """Harvest metadata, one row per landed file; malformed input is an error.

    A file named ``.jsonl`` or ``.jsonl.gz`` has an entry per line and is read in splits; any other
    is one array. With ``parse_time`` the download time is a timestamp, NULL if it is none, and its
    text stays beside it as ``download_time_text``.
    """
    by_line = path.removesuffix(".gz").endswith(".jsonl")
    reader = spark.read.schema(schemas.HARVEST_METADATA).options(multiLine=not by_line, mode="FAILFAST")
    metadata = _existing(lambda: reader.json(path), path)
    return with_times(metadata) if parse_time else metadata


def with_times(metadata: DataFrame) -> DataFrame:
    """Download times as timestamps, NULL if they are none, and their text beside them."""
    return metadata.withColumns(
        {
            "download_time_utc": F.col("download_time_utc").try_cast("timestamp"),
            "download_time_text": F.col("download_time_utc"),
        }
    )


def read_authority_dump(spark: SparkSession, path: str) -> DataFrame:
    """Authority dump (JSON lines, plain or gzip); the schema keeps only the four keys used.

    A line that is malformed, or in which one of them has another type, is an error.
    """
    reader = spark.read.schema(schemas.AUTHORITY_DUMP).option("mode", "FAILFAST")
    return _existing(lambda: reader.json(path), path)


def harvest_metadata_entries(spark: SparkSession, path: str) -> DataFrame:
    """Harvest metadata element by element: ``source_file, list_index, line, entry, reason``.

    Here a bad element costs only itself; ``accepted`` and ``rejected`` tell them apart.
    """
    by_line = path.removesuffix(".gz").endswith(".jsonl")
    text = _existing(lambda: spark.read.text(path, wholetext=not by_line), path)
    text = text.select(F.col("_metadata.file_path").alias("source_file"), "value")
    if by_line:
        lines = text.select("source_file", F.lit(None).cast("int").alias("list_index"), F.col("value").alias("line"))
    else:
        lines = json_elements(text)
    return json_entries(lines, schemas.HARVEST_METADATA)


def authority_dump_entries(spark: SparkSession, path: str) -> DataFrame:
    """An authority dump line by line: ``source_file, line, entry, reason``.

    Here a bad line costs only itself; ``accepted`` and ``rejected`` tell them apart.
    """
    text = _existing(lambda: spark.read.text(path), path)
    lines = text.select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("line"))
    return json_entries(lines, schemas.AUTHORITY_DUMP)
