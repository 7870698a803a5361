"""Reader for directories of link-dump text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.fixed_values import SKIPPED_SUFFIXES
from linkloom.functions import percent_decode, without_gz
from linkloom.sources.listing import literal_path


def read_lines(
    spark: SparkSession,
    directory: str,
    skip_suffixes: Sequence[str] = SKIPPED_SUFFIXES,
    source_dir: str | None = None,
    files: Sequence[str] | None = None,
) -> DataFrame:
    """All lines of all files in ``directory`` as (source_file, block, ord, line).

    One scan covers every file, and big files are cut into splits. ``source_file`` is
    ``source_dir`` (by default the directory as given) plus the file name, the form under
    which harvest metadata lists it. Sub-folders and files starting with ``.`` or ``_`` are not
    read; files ending in ``.gz`` are read decompressed, each by one task, and listed without it. Bytes that are not
    UTF-8 become U+FFFD. ``files`` are the paths of those that are to be read, if not all are.
    """
    if files is None:
        scan = spark.read.text(directory)
    elif files:
        scan = spark.read.text([literal_path(path) for path in files])
    else:
        scan = spark.read.text(directory).where("false")
    for suffix in skip_suffixes:
        scan = scan.where(~F.col("_metadata.file_name").endswith(suffix))
    prefix = source_dir if source_dir is not None else directory
    return scan.select(
        source_file(F.col("_metadata.file_name"), prefix).alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("ord"),
        F.make_valid_utf8("value").alias("line"),
    )


def source_file(file_name: Column, prefix: str) -> Column:
    """The name under which harvest metadata lists a landed file."""
    name = percent_decode(file_name)
    name = F.when(name.endswith(".gz"), without_gz(name)).otherwise(name)
    return F.concat(F.lit(prefix.rstrip("/") + "/"), name)
