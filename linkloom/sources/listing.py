"""Files of a folder by name, size and time, and which of them changed since they were last looked at."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What tells two states of a file apart.
STATE = ("file_name", "file_size", "modified")
#: The same where files of one name may lie in several folders.
STATE_IN_FOLDERS = ("file_path", "file_size", "modified")


def list_files(
    spark: SparkSession, directory: str, skip_suffixes: Sequence[str] = (), folders: bool = False
) -> DataFrame:
    """One row per file: path, file_path, file_name, file_size, modified. No file is opened.

    ``folders`` searches folders within as well, such as those of partitions. ``file_path`` is the
    path in the form of ``_metadata``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", folders).load(directory)
    for suffix in skip_suffixes:
        files = files.where(~F.col("_metadata.file_name").endswith(suffix))
    return files.select(
        "path",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified"),
    )


def changed_files(listed: DataFrame, known: DataFrame, key: Sequence[str] = STATE) -> DataFrame:
    """The listed files whose state is not among the known ones: new or altered."""
    return listed.join(known.select(*key), list(key), "left_anti").select(*listed.columns)


def literal_path(path: str) -> str:
    """A path that Spark takes as it is, though it may hold signs of a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)
