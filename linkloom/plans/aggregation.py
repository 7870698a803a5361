"""From a folder of link dumps to the merged table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.fixed_values import RESOLVABLE_SLICES, SAMPLE_ROWS, SAMPLE_SEED
from linkloom.operators.counts import PassCounts, compare_counts
from linkloom.operators.matching import match_sources
from linkloom.operators.metadata import attach_metadata, key_uniqueness
from linkloom.operators.resolution import resolve_links
from linkloom.operators.sampling import sample_per_slice
from linkloom.plans.harvest import ingest, ingest_changes
from linkloom.sources import (
    broadcast_if_small,
    harvest_metadata_entries,
    read_harvest_metadata,
    read_source_list,
    split_rejects,
    stage,
    staging_area,
    with_times,
    write_report,
    write_slice_samples,
    write_slices,
)


def merged_links(records: DataFrame, metadata: DataFrame) -> DataFrame:
    """Records with metadata, classified, resolved and merged: one lazy plan, one pass."""
    return resolve_links(attach_metadata(records, metadata)).drop("slice")


@dataclass(frozen=True)
class Aggregation:
    """Where one aggregation left its results, how many records it joined, and how many found no metadata."""

    records_path: str
    merged_path: str
    samples_paths: dict[str, str]
    matches_path: str | None
    records: int
    without_metadata: int
    rejected_metadata: int = 0


def aggregate(
    spark: SparkSession,
    dumps_dir: str,
    metadata_path: str,
    out_dir: str,
    run_id: str,
    source_list_path: str | None = None,
    check_metadata: bool = False,
    source_dir: str | None = None,
    check_counts: bool = False,
    rebalance: bool = True,
    rejects_path: str | None = None,
    changed_only: bool = False,
) -> Aggregation:
    """Parse, attach metadata, resolve, merge; then sample every slice and match the source list.

    ``source_dir`` is the folder that metadata names, if the dumps were landed elsewhere;
    ``without_metadata`` of the result tells whether they met. ``check_counts`` refuses a join that
    changed the number of records; the merged table is then left behind, for a look. ``rebalance``
    shuffles the merged rows into few files per slice.

    Metadata with a bad element is an error; with ``rejects_path`` such elements are written there and
    the others are used. Records are counted before and after the join while they are written, and read once.

    ``changed_only`` parses no dump again that has not changed since the last run into ``out_dir``; the merged
    table has the records of all dumps either way.

    The merged table is written once, partitioned by slice. It serves as the resolved slices
    and, read without the slice column, as their merge. ``check_metadata`` refuses metadata
    that lists a path twice, which would double the records of that file.
    """
    out_dir = out_dir.rstrip("/")
    records_path = f"{out_dir}/harvest" if changed_only else f"{out_dir}/records"
    merged_path = f"{out_dir}/merged/{run_id}"
    rejected = 0
    with staging_area(spark) as area:
        if rejects_path is None:
            metadata = read_harvest_metadata(spark, metadata_path)
        else:
            entries = harvest_metadata_entries(spark, metadata_path)
            metadata, rejected = split_rejects(entries, rejects_path, area)
            metadata = with_times(metadata)
        if check_metadata and not key_uniqueness(metadata, "path").head().is_unique:
            raise ValueError("harvest metadata lists a path more than once")
        take_in = ingest_changes if changed_only else ingest
        records = take_in(spark, dumps_dir, records_path, run_id, source_dir=source_dir)
        metadata = metadata.select("path", "url", "download_time_utc")
        metadata = broadcast_if_small(stage(metadata, "metadata", plain=True, area=area))
        passing = PassCounts()
        joined = passing.watch(
            attach_metadata(passing.watch(records, "records"), metadata, flag="listed"),
            "joined",
            without=F.count_if(~F.col("listed")),
        )
        resolved = resolve_links(joined.drop("listed"))
        write_slices(resolved, merged_path, rebalance)
        if check_counts and passing["records"]["rows"] != passing["joined"]["rows"]:
            # What passed may have been counted twice after a loss; only this count is final.
            compare_counts(records, attach_metadata(records, metadata), strict=True).head()

    merged = spark.read.schema(resolved.schema).parquet(merged_path)
    samples = write_slice_samples(
        sample_per_slice(merged, SAMPLE_ROWS, SAMPLE_SEED, stored_slices=True),
        RESOLVABLE_SLICES,
        f"{out_dir}/samples/{run_id}.parquet",
    )
    matches = None
    if source_list_path is not None:
        matches = f"{out_dir}/matches/{run_id}.json"
        write_report(match_sources(read_source_list(spark, source_list_path), merged), matches)
    return Aggregation(
        records_path,
        merged_path,
        samples,
        matches,
        passing["records"]["rows"],
        passing["joined"]["without"],
        rejected,
    )
