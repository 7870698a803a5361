"""The registered queries, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures
from catalog.round_trips import ROUND_TRIPS
from linkloom import schemas
from linkloom.fixed_values import RESOLVABLE_SLICES
from linkloom.functions import bare_id, entity_type, safe_prefix
from linkloom.operators import authority, counts, manifest, matching, metadata
from linkloom.operators import parsing, profiling, rejects, resolution, sampling, slices
from linkloom.plans import merged_links

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[query.__name__] = query
    return query


def listed(df: DataFrame, *names: str) -> DataFrame:
    """Arrays as comma-separated text, which both engines write alike."""
    return df.withColumns({name: F.array_join(name, ",") for name in names})


def merged(spark: SparkSession, sf: str) -> DataFrame:
    """Resolved records of all slices with harvest metadata."""
    return merged_links(fixtures.records(spark, sf), fixtures.harvest_metadata(spark, sf))


def enriched(spark: SparkSession, sf: str, normalize: bool = False) -> DataFrame:
    """Merged records with entity types."""
    dump = fixtures.authority_dump(spark, sf)
    return authority.enrich_types(merged(spark, sf), dump, normalize)


# ---- whole flows -----------------------------------------------------------------------


@register
def links_merged(spark, sf):
    return merged(spark, sf)


@register
def enrich_types(spark, sf):
    return listed(enriched(spark, sf), "gnd_type_list")


@register
def enrich_types_symmetric(spark, sf):
    return listed(enriched(spark, sf, normalize=True), "gnd_type_list")


@register
def enrich_types_split(spark, sf):
    """Types with hot ids dealt over tasks; by the small share nearly every id counts as hot."""
    records = merged(spark, sf)
    dump = fixtures.authority_dump(spark, sf)
    types = authority.authority_types(dump, authority.candidate_ids(records))
    return listed(authority.attach_types(records, types, authority.hot_ids(records, 0.0003)), "gnd_type_list")


# ---- parsing -----------------------------------------------------------------------------


@register
def file_headers(spark, sf):
    return parsing.file_headers(fixtures.dump_lines(spark, sf)).drop("data_block")


@register
def parse_links(spark, sf):
    return parsing.parse_links(fixtures.dump_lines(spark, sf))


@register
def parse_links_wide(spark, sf):
    return parsing.parse_links(fixtures.dump_lines(spark, sf), count=9)


@register
def raw_parts(spark, sf):
    parts = parsing.raw_parts(fixtures.dump_lines(spark, sf))
    return parts.select(
        "source_file",
        "ord",
        "is_header",
        "raw",
        F.size("parts").cast("bigint").alias("n_parts"),
        F.array_join("parts", "<|>").alias("parts"),
    )


@register
def normalize_schema(spark, sf):
    odd = fixtures.records(spark, sf).drop("FEED", "col4").withColumn("col6", F.lit("extra"))
    return parsing.normalize_schema(odd.select(*reversed(odd.columns)))


# ---- lines that are no entries -------------------------------------------------------------


@register
def accepted_lines(spark, sf):
    entries = rejects.json_entries(fixtures.dump_text(spark, sf), schemas.AUTHORITY_DUMP)
    return listed(rejects.accepted(entries), "type", "oldAuthorityNumber")


@register
def rejected_lines(spark, sf):
    entries = rejects.json_entries(fixtures.dump_text(spark, sf), schemas.AUTHORITY_DUMP)
    return rejects.rejected(entries)


# ---- source list and metadata ------------------------------------------------------------


@register
def safe_prefixes(spark, sf):
    pages = fixtures.table(spark, sf, "pages")
    return pages.select("page_id", safe_prefix(F.col("url")).alias("safe_prefix"))


@register
def harvest_manifest(spark, sf):
    return manifest.harvest_manifest(fixtures.source_list(spark, sf))


@register
def attach_metadata(spark, sf):
    escaped = fixtures.records(spark, sf).withColumn(
        "source_file", F.replace("source_file", F.lit("/fx/"), F.lit("\\/fx/"))
    )
    return metadata.attach_metadata(escaped, fixtures.harvest_metadata(spark, sf))


@register
def key_uniqueness(spark, sf):
    return metadata.key_uniqueness(fixtures.records(spark, sf), "source_file")


@register
def key_uniqueness_metadata(spark, sf):
    return metadata.key_uniqueness(fixtures.harvest_metadata(spark, sf), "path")


@register
def duplicate_keys(spark, sf):
    return metadata.duplicate_keys(fixtures.records(spark, sf), "source_file")


@register
def match_sources(spark, sf):
    matches = matching.match_sources(
        fixtures.short_source_list(spark, sf), fixtures.sliced_names(spark, sf)
    )
    return listed(matches, "matched_parquets")


# ---- slices and resolution -----------------------------------------------------------------


@register
def split_slices(spark, sf):
    return slices.split_slices(fixtures.sparse_records(spark, sf))


@register
def slice_counts(spark, sf):
    return slices.slice_counts(fixtures.records(spark, sf))


@register
def null_patterns(spark, sf):
    return slices.null_patterns(fixtures.sparse_records(spark, sf))


@register
def null_pattern_rows(spark, sf):
    records = fixtures.sparse_records(spark, sf)
    return slices.rows_with_pattern(records, ["col1", "col2", "col3", "col4"], ["TARGET"])


@register
def resolve_links(spark, sf):
    return resolution.resolve_links(fixtures.records(spark, sf))


@register
def merge_slices(spark, sf):
    resolved = resolution.resolve_links(fixtures.records(spark, sf))
    first, *rest = [
        resolved.where(F.col("slice") == name).drop("slice") for name in RESOLVABLE_SLICES
    ]
    drifted = [t.select(*reversed(t.columns), F.lit(i).alias("extra")) for i, t in enumerate(rest)]
    return resolution.merge_slices(first, *drifted)


# ---- authority types -----------------------------------------------------------------------


@register
def normalize_ids(spark, sf):
    records = fixtures.records(spark, sf)
    return records.select("col1", bare_id(F.col("col1")).alias("bare"))


@register
def classify_types(spark, sf):
    dump = fixtures.authority_dump(spark, sf)
    return dump.select("id", entity_type(F.col("type")).alias("gnd_type"))


@register
def candidate_ids(spark, sf):
    return authority.candidate_ids(resolution.resolve_links(fixtures.records(spark, sf)))


@register
def authority_types(spark, sf):
    candidates = authority.candidate_ids(resolution.resolve_links(fixtures.records(spark, sf)))
    types = authority.authority_types(fixtures.authority_dump(spark, sf), candidates)
    return listed(types, "gnd_type_list")


@register
def match_coverage(spark, sf):
    return authority.match_coverage(enriched(spark, sf))


@register
def examples_with_type(spark, sf):
    examples = authority.examples_per_source(enriched(spark, sf), matched=True)
    return listed(examples, "gnd_type_list")


@register
def examples_without_type(spark, sf):
    examples = authority.examples_per_source(enriched(spark, sf), matched=False)
    return listed(examples, "gnd_type_list")


# ---- counts, profiles, samples -----------------------------------------------------------------


@register
def row_count(spark, sf):
    return counts.row_count(fixtures.records(spark, sf))


@register
def compare_counts(spark, sf):
    records = fixtures.records(spark, sf)
    return counts.compare_counts(records, resolution.resolve_links(records))


@register
def analyze_table(spark, sf):
    return counts.analyze_table(fixtures.records(spark, sf))


@register
def analyze_by_fingerprint(spark, sf):
    return counts.analyze_by_fingerprint(fixtures.records(spark, sf).drop("col2"))


@register
def latest_run(spark, sf):
    return counts.latest_run(fixtures.records_of_runs(spark, sf))


@register
def describe_table(spark, sf):
    return profiling.describe_table(fixtures.records(spark, sf))


@register
def profile_columns(spark, sf):
    return profiling.profile_columns(fixtures.records(spark, sf)).drop("approx_distinct")


@register
def approx_distinct(spark, sf):
    records = fixtures.records(spark, sf)
    exact = records.agg(*[F.count_distinct(F.col(c)).alias(c) for c in records.columns])
    exact = exact.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_count"))
                    for c in records.columns
                ]
            )
        )
    )
    error = F.abs(F.col("approx_distinct") - F.col("distinct_count"))
    return (
        profiling.approx_distinct(records, rsd=0.05)
        .join(exact, "column_name")
        .select(
            "column_name",
            "distinct_count",
            (error <= 3 * 0.05 * F.col("distinct_count")).alias("within_three_errors"),
        )
    )


@register
def profile_columns_sampled(spark, sf):
    """A sample larger than the table is the whole table."""
    profile = profiling.profile_columns(fixtures.records(spark, sf), sample_rows=1_000_000_000)
    return profile.drop("approx_distinct")


@register
def file_stats(spark, sf):
    stats = profiling.file_stats(spark.read.parquet(f"{sf}/orders.parquet"))
    return stats.select("file_name", "row_count")


@register
def preview(spark, sf):
    records = fixtures.records(spark, sf)
    return sampling.preview(records, 10, order_by=records.columns)


@register
def random_sample(spark, sf):
    return sampling.random_sample(fixtures.records(spark, sf), 100, seed=42)


@register
def sample_per_slice(spark, sf):
    return sampling.sample_per_slice(fixtures.records(spark, sf), 100, seed=42)


# ---- readers and sinks ---------------------------------------------------------------------------

for query in ROUND_TRIPS:
    register(query)
