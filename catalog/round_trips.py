"""Queries through files: every reader and sink of the library writes or reads what the query returns.

Files go to a new folder under the one that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from catalog import fixtures
from linkloom import sources
from linkloom.fixed_values import SLICES
from linkloom.operators import authority, manifest, matching, metadata, parsing, profiling, resolution, sampling, sketches
from linkloom.plans import ingest_changes, merged_links, update_profiles


def folder(spark: SparkSession) -> str:
    """A new folder that executors share; a local session without the setting gets one of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="round-trips-")
    return f"{base.rstrip('/')}/round-trip-{uuid.uuid4().hex}"


def written_records(spark, sf):
    """Records of a run, written over an earlier try of it and beside another run."""
    path, records = folder(spark), fixtures.records(spark, sf)
    sources.write_records(records.union(records), path, "run 1")
    sources.write_records(records.where("false"), path, "run 2")
    sources.write_records(records, path, "run 1")
    return sources.read_tables(spark, path)


def written_slices(spark, sf):
    path = folder(spark)
    sources.write_slices(resolution.resolve_links(fixtures.records(spark, sf)), path, rebalance=True)
    return sources.read_tables(spark, path)


def written_table(spark, sf):
    path = folder(spark)
    merged = merged_links(fixtures.records(spark, sf), fixtures.harvest_metadata(spark, sf))
    sources.write_table(authority.enrich_types(merged, fixtures.authority_dump(spark, sf)), path)
    return sources.read_tables(spark, path).withColumn("gnd_type_list", F.array_join("gnd_type_list", ","))


def written_report(spark, sf):
    path = folder(spark)
    matches = matching.match_sources(fixtures.short_source_list(spark, sf), fixtures.sliced_names(spark, sf))
    sources.write_report(matches, path)
    report = spark.read.schema(matches.schema).json(path)
    return report.withColumn("matched_parquets", F.array_join("matched_parquets", ","))


def written_samples(spark, sf):
    """A file of samples per slice, read back together."""
    samples = sampling.sample_per_slice(fixtures.records(spark, sf), 100, seed=42)
    paths = sources.write_slice_samples(samples, SLICES, f"{folder(spark)}/records.parquet")
    return spark.read.schema(samples.schema).json(list(paths.values()))


def source_list_file(spark, sf):
    """The manifest of a source list that is one JSON array."""
    path, entries = folder(spark), fixtures.source_list(spark, sf)
    row = F.struct(F.col("list_index").alias("at"), F.struct("beacon_url", F.lit("x").alias("more")).alias("entry"))
    array = entries.agg(F.sort_array(F.collect_list(row)).alias("rows")).select(F.to_json("rows.entry", {"ignoreNullFields": "false"}))
    array.write.text(path)
    listed = sources.read_source_list(spark, path)
    return manifest.harvest_manifest(listed.drop("more"))


def metadata_file(spark, sf):
    """Records with metadata that is read from JSON lines."""
    path = f"{folder(spark)}.jsonl"
    fixtures.harvest_metadata(spark, sf).write.json(path)
    listed = sources.read_harvest_metadata(spark, path, parse_time=False)
    return metadata.attach_metadata(fixtures.records(spark, sf), listed)


def dump_file(spark, sf):
    """Types per id from a dump that is read from gzipped JSON lines."""
    path = folder(spark)
    fixtures.authority_dump(spark, sf).write.option("compression", "gzip").json(path)
    candidates = authority.candidate_ids(resolution.resolve_links(fixtures.records(spark, sf)))
    types = authority.authority_types(sources.read_authority_dump(spark, path), candidates)
    return types.withColumn("gnd_type_list", F.array_join("gnd_type_list", ","))


def _land_dumps(spark: SparkSession, sf: str, target: str, which: str) -> None:
    """Put gzipped dumps into a folder, one for every remainder ``f`` of customers; ``which`` selects orders."""
    orders = fixtures.table(spark, sf, "orders").selectExpr("o_custkey % 24 AS f", "o_orderkey + 10 AS n", "concat(o_orderkey, '| ', o_custkey) AS value")
    orders = orders.where(which)
    head = "named_struct('n', {n}L, 'value', {value})"
    header = ["concat('#NAME: src', f)", "'#TARGET: http://t.example/{ID}'", "''"]
    heads = ", ".join(head.format(n=n, value=value) for n, value in enumerate(header))
    heads = orders.select("f").distinct().selectExpr("f", f"inline(array({heads}))")
    lines = orders.unionByName(heads).repartition(24, "f").sortWithinPartitions("f", "n")
    by_file = folder(spark)
    lines.select("f", "value").write.partitionBy("f").option("compression", "gzip").text(by_file)
    _flatten(spark, by_file, target)


def dump_files(spark, sf):
    """Records parsed from a folder of gzipped dumps, one for every remainder of customers."""
    path = f"{folder(spark)}/dumps"
    _land_dumps(spark, sf, path, "true")
    lines = sources.read_lines(spark, path, source_dir="data/beacons")
    return parsing.normalize_schema(parsing.parse_links(lines))


def changed_dumps(spark, sf):
    """The same records after two runs: between them a third of the dumps grows, another third arrives."""
    path = folder(spark)
    _land_dumps(spark, sf, f"{path}/dumps", "f % 3 = 2 OR f % 3 = 1 AND n % 2 = 0")
    arguments = {"source_dir": "data/beacons", "staging": f"{path}/staging"}
    ingest_changes(spark, f"{path}/dumps", f"{path}/records", "run 1", **arguments)
    _land_dumps(spark, sf, f"{path}/dumps", "f % 3 < 2")
    return ingest_changes(spark, f"{path}/dumps", f"{path}/records", "run 2", **arguments)


def profile_by_files(spark, sf):
    """The profile of a table that has got a second run since it was first profiled."""
    path, records = folder(spark), fixtures.records(spark, sf)
    for run, rows in (("run 1", "source_file < 'data/beacons/fx/0012'"), ("run 2", "source_file >= 'data/beacons/fx/0012'")):
        sources.write_records(records.where(rows), f"{path}/table", run)
        profile = update_profiles(spark, f"{path}/table", f"{path}/profiles")
    return profile.where("column_name <> 'run_id'").drop("approx_distinct")


def _flatten(spark: SparkSession, by_file: str, target: str) -> None:
    """Give the one file of every folder ``f=<n>`` the name of a landed dump, all in one folder."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    files = path_of(by_file).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path_of(target))
    for part in files.globStatus(path_of(f"{by_file}/f=*/part-*")):
        number = part.getPath().getParent().getName().removeprefix("f=")
        landed = path_of(f"{target}/{int(number):04d}_beacon.txt.gz")
        files.delete(landed, False)
        files.rename(part.getPath(), landed)


def inspection(spark, sf):
    """What a full inspection says about every column."""
    found = profiling.inspect(fixtures.records(spark, sf), stats_mode="full")
    stats = found.column_stats.drop("column_name", "data_type", "approx_distinct")
    return found.columns.join(stats, "ordinal")


def distinct_by_sketches(spark, sf):
    """Distinct values over all runs, from stored sketches of each, beside the exact numbers."""
    path, records = folder(spark), fixtures.records_of_runs(spark, sf)
    sources.write_table(sketches.distinct_sketches(records, ["run_id"]), path)
    merged = sketches.distinct_counts(sketches.merge_sketches(sources.read_tables(spark, path)))
    names = [c for c in records.columns if c != "run_id"]
    exact = records.agg(*[F.count_distinct(F.col(c)).alias(c) for c in names])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_count")) for c in names]
    error = F.abs(F.col("approx_distinct") - F.col("distinct_count"))
    return merged.join(exact.select(F.inline(F.array(*rows))), "column_name").select(
        "column_name",
        "row_count",
        "null_count",
        "distinct_count",
        (error <= 3 * 1.04 / 2 ** (sketches.PRECISION / 2) * F.col("distinct_count")).alias("within_three_errors"),
    )


ROUND_TRIPS = (
    distinct_by_sketches,
    written_records,
    written_slices,
    written_table,
    written_report,
    written_samples,
    source_list_file,
    metadata_file,
    dump_file,
    dump_files,
    changed_dumps,
    profile_by_files,
    inspection,
)
