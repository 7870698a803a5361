"""From a folder of link dumps to records: all dumps, or those that changed since the last run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.fixed_values import SKIPPED_SUFFIXES
from linkloom.operators.parsing import file_headers, normalize_schema, parse_links, with_kind
from linkloom.sources import (
    STATE,
    broadcast_if_small,
    latest_stored_run,
    list_files,
    read_lines,
    source_file,
    stage,
    staging_area,
    write_records,
)

#: Dumps whose names are broadcast to find the current records; a name has a few hundred bytes.
BROADCAST_DUMPS = 100_000
MANIFEST = "source_file string, state array<struct<file_name: string, file_size: bigint, modified: timestamp>>, present boolean"


def ingest(
    spark: SparkSession,
    dumps_dir: str,
    records_path: str,
    run_id: str,
    skip_suffixes: Sequence[str] = SKIPPED_SUFFIXES,
    source_dir: str | None = None,
) -> DataFrame:
    """Parse a folder of dumps into the partition ``run_id`` of the record table.

    ``source_dir`` is the folder under which harvest metadata lists the dumps, if it is not the
    one they lie in now.

    Lines are staged with their kind: the passes that look for the end of each header then
    read a few narrow columns instead of the text, and the order of lines is settled. The header
    table is staged too, so that its size decides whether the data lines have to be shuffled.
    """
    with staging_area(spark) as area:
        write_records(parsed_lines(read_lines(spark, dumps_dir, skip_suffixes, source_dir), area), records_path, run_id)
    return _records_of_run(spark, records_path, run_id)


def parsed_lines(lines: DataFrame, area: str) -> DataFrame:
    """The records of lines, by way of tables staged in ``area``."""
    lines = stage(with_kind(lines), "lines", area=area)
    headers = stage(file_headers(lines, kinds_known=True), "headers", plain=True, area=area)
    return normalize_schema(parse_links(lines, broadcast_if_small(headers), kinds_known=True))


def _records_of_run(spark: SparkSession, records_path: str, run_id: str) -> DataFrame:
    schema = normalize_schema(spark.range(0)).schema.add("run_id", "string")
    table = spark.read.schema(schema).parquet(records_path)
    return table.where(F.col("run_id") == run_id).drop("run_id")


def ingest_changes(
    spark: SparkSession,
    dumps_dir: str,
    table_dir: str,
    run_id: str,
    skip_suffixes: Sequence[str] = SKIPPED_SUFFIXES,
    source_dir: str | None = None,
    staging: str | None = None,
) -> DataFrame:
    """Parse the dumps that are new or changed since the last run; the records of all present dumps.

    ``table_dir`` keeps the records of every run and, beside them, which dumps a run parsed or missed,
    by name, size and time of their files. Dumps that are gone lose their records, those that have not
    changed keep what an earlier run parsed. A run counts once its list is written, after its records: one that
    failed leaves records that nothing points at and is made good by the next. Runs follow one another by their
    ids, so an id at or below that of a finished run is refused.

    The driver gets the paths of changed files, which are fewer than those Spark lists for any scan.
    ``staging`` is the folder for staged tables if not the one of the session.
    """
    table_dir = table_dir.rstrip("/")
    last = latest_stored_run(spark, f"{table_dir}/dumps")
    if last is not None and run_id <= last:
        raise ValueError(f"run {run_id} does not follow run {last}")
    name = source_file(F.col("file_name"), source_dir if source_dir is not None else dumps_dir)
    listed = (
        list_files(spark, dumps_dir, skip_suffixes)
        .groupBy(name.alias("source_file"))
        .agg(F.sort_array(F.collect_list(F.struct(*STATE))).alias("state"), F.collect_list("path").alias("paths"))
    )
    known = _known_dumps(spark, table_dir).where("present").select("source_file", F.col("state").alias("known"))
    differ = ~F.col("state").eqNullSafe(F.col("known"))
    changes = listed.join(known, "source_file", "full_outer").where(differ)
    changes = changes.select("source_file", "state", F.col("state").isNotNull().alias("present"), "paths")
    with staging_area(spark, staging) as area:
        changes = stage(changes, "changes", area=area)
        paths = [row.path for row in changes.select(F.explode("paths").alias("path")).collect()]
        lines = read_lines(spark, dumps_dir, skip_suffixes, source_dir, files=paths)
        write_records(parsed_lines(lines, area), f"{table_dir}/records", run_id)
        write_records(changes.drop("paths"), f"{table_dir}/dumps", run_id)
    return current_records(spark, table_dir)


def _known_dumps(spark: SparkSession, table_dir: str) -> DataFrame:
    """The last that runs have found of every dump: source_file, state, present, run_id."""
    if latest_stored_run(spark, f"{table_dir}/dumps") is None:
        return spark.createDataFrame([], f"{MANIFEST}, run_id string")
    found = spark.read.schema(f"{MANIFEST}, run_id string").parquet(f"{table_dir}/dumps")
    last = F.max_by(F.struct("state", "present", "run_id"), "run_id").alias("last")
    return found.groupBy("source_file").agg(last).select("source_file", "last.*")


def current_records(spark: SparkSession, table_dir: str) -> DataFrame:
    """The records of every dump that the last run found, each from the run that parsed it last."""
    table_dir = table_dir.rstrip("/")
    current = _known_dumps(spark, table_dir).where("present").select("source_file", "run_id")
    if current.limit(BROADCAST_DUMPS + 1).count() <= BROADCAST_DUMPS:
        current = F.broadcast(current)
    schema = normalize_schema(spark.range(0)).schema.add("run_id", "string")
    records = spark.read.schema(schema).parquet(f"{table_dir}/records")
    return records.join(current, ["source_file", "run_id"], "left_semi").drop("run_id")
