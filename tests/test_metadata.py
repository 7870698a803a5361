"""Metadata join, key checks, counts, source list and matches."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from linkloom.operators.counts import analyze_by_fingerprint, analyze_table, compare_counts, latest_run, row_count
from linkloom.operators.manifest import harvest_manifest
from linkloom.operators.matching import match_sources
from linkloom.operators.metadata import attach_metadata, duplicate_keys, key_uniqueness

META = "path string, url string, download_time_utc string"


def test_attach_metadata(spark):
    records = spark.createDataFrame([(r"d\/a",), ("d/b",), ("d/c",), (None,)], "source_file string")
    meta = spark.createDataFrame([("d/a", "ua", "t1"), ("d/b", "ub", "t2"), (None, "un", "t3")], META)
    got = attach_metadata(records, meta)
    assert got.columns == ["source_file", "beacon_uri", "beacon_harvest_timestamp"]
    assert set(got.collect()) == {
        (r"d\/a", "ua", "t1"),
        ("d/b", "ub", "t2"),
        ("d/c", None, None),
        (None, None, None),
    }


def test_a_path_listed_twice_doubles_its_records_and_is_detected(spark):
    records = spark.createDataFrame([("a",), ("b",)], "source_file string")
    meta = spark.createDataFrame([("a", "1", ""), ("a", "2", ""), (None, "3", "")], META)
    joined = attach_metadata(records, meta)
    assert compare_counts(records, joined).head() == (2, 3, 1, False)
    assert key_uniqueness(meta).head() == (3, 1, 2, False)
    assert duplicate_keys(meta).collect() == [("a", 2)]


def test_strict_comparison_fails_on_a_mismatch(spark):
    one, two = spark.range(1), spark.range(2)
    assert compare_counts(two, two, strict=True).head() == (2, 2, 0, True)
    with pytest.raises(PySparkException, match="before=2, after=1"):
        compare_counts(two, one, strict=True).collect()


def test_counts_of_empty_tables(spark):
    empty = spark.createDataFrame([], META)
    assert row_count(empty).head() == (0,)
    assert compare_counts(empty, empty).head() == (0, 0, 0, True)
    assert key_uniqueness(empty).head() == (0, 0, 0, True)
    assert analyze_table(empty).head() == (0, 3, 0, 0)


@pytest.mark.parametrize("prints", ["own", "all alike", "in two groups"])
def test_fingerprints_decide_the_work_and_not_the_result(spark, prints):
    """Planted collisions: rows that share a fingerprint are told apart as a whole."""
    df = spark.createDataFrame(
        [(None, "a", 0.0), ("a", None, -0.0), (None, "a", -0.0), ("a", "a", float("nan")), ("a", "a", float("nan"))]
        + [("b", str(n % 40), 1.0) for n in range(100)],
        "`x.1` string, y string, z double",
    ).repartition(3)
    chosen = {"own": None, "all alike": [F.lit(1), F.lit(2)], "in two groups": [F.length("y"), F.lit(0)]}[prints]
    assert analyze_by_fingerprint(df, chosen).head() == analyze_table(df).head() == (105, 3, 43, 62)
    assert analyze_by_fingerprint(df.limit(0), chosen).head() == (0, 3, 0, 0)


def test_rows_without_a_copy_are_not_moved_whole(spark, plan):
    df = spark.range(1000).selectExpr("id AS n", "repeat(cast(id AS string), 50) AS wide")
    by_print = analyze_by_fingerprint(df)
    assert by_print.head() == (1000, 2, 1000, 0)
    assert "BroadcastHashJoin LeftSemi" in plan(by_print)
    assert "SortMergeJoin" not in plan(by_print) and "ShuffledHashJoin" not in plan(by_print)


def test_analyze_table_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (1, "")], "a int, b string")
    assert analyze_table(df).head() == (4, 2, 3, 1)


def test_duplicate_keys_are_ordered_and_limited(spark):
    df = spark.createDataFrame([(k,) for k in "bbaaacz" + "z"], "path string")
    assert duplicate_keys(df).collect() == [("a", 3), ("b", 2), ("z", 2)]
    assert duplicate_keys(df, n=1).collect() == [("a", 3)]


def test_latest_run_prunes_partitions(spark, plan, tmp_path):
    path = str(tmp_path / "runs.parquet")
    runs = spark.range(10).withColumn("run_id", F.concat(F.lit("r"), F.col("id") % 3))
    runs.write.partitionBy("run_id").parquet(path)
    newest = latest_run(spark.read.parquet(path))
    assert {r.id for r in newest.collect()} == {2, 5, 8}
    assert "PartitionFilters: [isnotnull(run_id" in plan(newest)


def test_harvest_manifest_skips_but_counts_entries_without_url(spark):
    entries = spark.createDataFrame(
        [(0, None), (1, ""), (2, "http://x.example/a"), (12345, "http://x.example/b.gz")],
        "list_index bigint, beacon_url string",
    )
    got = [tuple(r) for r in harvest_manifest(entries).orderBy("list_index").collect()]
    assert got == [
        (2, "http://x.example/a", "0002_http_x_example_a_a.txt"),
        (12345, "http://x.example/b.gz", "12345_http_x_example_b_gz_b"),
    ]


def test_matches_equal_brute_force(spark):
    draw = random.Random(5)
    words = ["http", "x", "ex", "a1", "b", "beacon", "txt", "0001"]
    prefixes = {"_".join(draw.choices(words, k=draw.randint(1, 4))) for _ in range(80)}
    urls = [*prefixes, "a" * 90, "b" * 79 + "-c", None, "", "://", "a-b", "a-b"]
    names = []
    for _ in range(400):
        stem = "".join(
            w + draw.choice(["_", "_", "_", "__", ".", "-", "/"])
            for w in draw.choices(words, k=draw.randint(1, 9))
        )
        names.append((draw.choice(["s1", "target-notnull_col1-2", "target-null_col1-2"]), stem))
    names += [("s1", "x/" + "a" * 95 + "_q"), ("s1", "b" * 79 + "_c_"), ("s1", None), ("s1", "")]
    entries = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "n int, beacon_url string")
    sliced = spark.createDataFrame(names, "slice string, source_file string")
    rows = match_sources(entries, sliced).collect()
    assert len(rows) == len(urls)
    matched = 0
    for row in rows:
        prefix = row.safe_prefix
        want = {s for s, f in names if f is not None and prefix and prefix in f}
        assert set(row.matched_parquets) == want
        assert len(row.matched_parquets) == len(want)
        matched += len(want)
    assert matched > 50


def test_match_lists_follow_the_slice_order(spark):
    entries = spark.createDataFrame([("u", "a")], "beacon_url string, extra string")
    order = ["target-null_col1-2", "target-null_col1-2-3", "target-notnull_col1-only"]
    sliced = spark.createDataFrame([(s, "u_1") for s in reversed(order)] * 3, "slice string, source_file string")
    got = match_sources(entries, sliced)
    assert got.columns == ["beacon_url", "extra", "safe_prefix", "matched_parquets"]
    assert got.head().matched_parquets == order


def test_matching_needs_the_url_column(spark):
    with pytest.raises(PySparkException, match="beacon_url"):
        match_sources(spark.range(1), spark.createDataFrame([], "slice string, source_file string"))
