"""From the merged table to the enriched one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.authority import (
    attach_types,
    authority_types,
    candidate_ids,
    examples_per_source,
    hot_ids,
    match_coverage,
)
from linkloom.sources import (
    BROADCAST_BYTES,
    authority_dump_entries,
    read_authority_dump,
    split_rejects,
    stage,
    staged_bytes,
    staging_area,
    write_table,
)


@dataclass(frozen=True)
class Enrichment:
    """The enriched table as written, lazy reports on it, and how many lines of the dump were rejected."""

    enriched: DataFrame
    coverage: DataFrame
    examples_with_type: DataFrame
    examples_without_type: DataFrame
    rejected: int = 0


def enrich(
    spark: SparkSession,
    merged_path: str,
    dump_path: str,
    out_path: str,
    normalize_candidates: bool = False,
    rejects_path: str | None = None,
    broadcast_limit: int = BROADCAST_BYTES,
) -> Enrichment:
    """Add entity types to a merged table and write it.

    A dump with a bad line is an error. With ``rejects_path`` such lines are written there, with the
    reason, and the others are used.

    The type table is staged, so that its size decides whether the merged table has to be
    shuffled to meet it. If so, the ids that hold much of it are looked for first and dealt over tasks.
    """
    merged = spark.read.parquet(merged_path)
    if "slice" in merged.columns:
        merged = merged.drop("slice")
    candidates = candidate_ids(merged, normalize_candidates)
    rejected = 0
    with staging_area(spark) as area:
        if rejects_path is None:
            dump = read_authority_dump(spark, dump_path)
        else:
            entries = authority_dump_entries(spark, dump_path)
            dump, rejected = split_rejects(entries, rejects_path, area)
        types = authority_types(dump, candidates)
        types = stage(types, "types", plain=True, area=area)
        if staged_bytes(types) <= broadcast_limit:
            found = attach_types(merged, F.broadcast(types))
        else:
            found = attach_types(merged, types, hot_ids(merged))
        write_table(found, out_path)
    enriched = spark.read.parquet(out_path)
    return Enrichment(
        enriched=enriched,
        coverage=match_coverage(enriched),
        examples_with_type=examples_per_source(enriched, matched=True),
        examples_without_type=examples_per_source(enriched, matched=False),
        rejected=rejected,
    )
