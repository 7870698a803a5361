"""Profiles, samples and previews."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from linkloom.operators import sampling
from linkloom.operators.profiling import (
    approx_distinct,
    describe_table,
    file_stats,
    inspect,
    profile_columns,
)
from linkloom.operators.sampling import preview, random_sample, sample_per_slice, spread_limit


@pytest.fixture
def numbers(spark):
    return spark.range(5000).select(
        F.when(F.col("id") % 10 != 0, F.col("id")).alias("n"),
        (F.col("id") % 7).cast("string").alias("text"),
        F.map_from_arrays(F.array(F.col("id")), F.array(F.col("id"))).alias("m"),
    )


def test_describe(numbers):
    assert [tuple(r) for r in describe_table(numbers).collect()] == [
        (0, "n", "bigint", 5000),
        (1, "text", "string", 5000),
        (2, "m", "map<bigint,bigint>", 5000),
    ]


def test_profile(numbers):
    rows = [tuple(r) for r in profile_columns(numbers).collect()]
    assert rows == [
        (0, "n", "bigint", 500, None, "1", "4999"),
        (1, "text", "string", 0, None, "0", "6"),
        (2, "m", "map<bigint,bigint>", 0, None, None, None),
    ]


def test_profile_of_an_empty_table_has_null_counts(numbers):
    assert {r.null_count for r in profile_columns(numbers.limit(0)).collect()} == {None}


def test_profile_is_one_aggregate_over_one_scan(numbers, plan, spark, tmp_path):
    path = str(tmp_path / "n.parquet")
    numbers.write.parquet(path)
    text = plan(profile_columns(spark.read.parquet(path), ["n", "text"]))
    assert text.count("Scan parquet") == 2  # once in the tree, once in the details


def test_approx_distinct_within_three_errors(numbers):
    rsd = 0.05
    got = {r.column_name: r.approx_distinct for r in approx_distinct(numbers, ["n", "text"], rsd).collect()}
    assert abs(got["n"] - 4500) <= 3 * rsd * 4500
    assert got["text"] == 7
    profiled = {r.column_name: r.approx_distinct for r in profile_columns(numbers, ["text"]).collect()}
    assert profiled == {"n": None, "text": 7, "m": None}


def test_spread_limit_takes_exactly_n_or_all(spark):
    df = spark.range(0, 50_000, 1, 40)
    assert spread_limit(df, 1000).count() == 1000
    assert spread_limit(df, 1000).distinct().count() == 1000
    assert spread_limit(df, 10).count() == 10
    assert spread_limit(df, 50_000).count() == 50_000
    assert spread_limit(df, 60_000).count() == 50_000
    assert spread_limit(df.limit(0), 10).count() == 0


@pytest.mark.parametrize("n", [150_000, 298_000, 299_999, 300_000, 10**9])
def test_spread_limit_moves_no_large_share_to_one_task(spark, settings, monkeypatch, n):
    """Below, near, at and beyond the number of rows; some values are null, and values repeat."""
    monkeypatch.setattr(sampling, "DEAL_ROWS", 10_000, raising=False)
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = spark.range(0, 300_000, 1, 6).select(F.when(F.col("id") % 7 > 0, F.col("id") % 1000).alias("v"), "id")
    taken = spread_limit(df, n).withColumn("task", F.spark_partition_id()).groupBy("task")
    tasks = taken.agg(F.count("*").alias("rows"), F.count_distinct("id").alias("ids")).collect()
    assert sum(r.rows for r in tasks) == sum(r.ids for r in tasks) == min(n, 300_000)
    assert max(r.rows for r in tasks) < 0.7 * min(n, 300_000)


def test_sampled_profile_looks_at_some_rows_only(spark):
    df = spark.range(50_000).select(F.lit(None).cast("string").alias("x"))
    assert profile_columns(df, sample_rows=2000).head().null_count == 2000


def test_random_sample_is_the_same_on_every_layout(spark):
    rows = [(str(i), None if i % 3 else i) for i in range(500)]
    df = spark.createDataFrame(rows, "a string, b int")

    def digest(row):
        return hashlib.md5("|".join(str(v) for v in (*row, 42) if v is not None).encode()).hexdigest()

    want = sorted(sorted(rows, key=digest)[:50], key=repr)
    for layout in (df, df.repartition(7), df.orderBy(F.desc("a"))):
        got = sorted((tuple(r) for r in random_sample(layout, 50, 42).collect()), key=repr)
        assert got == want
    assert random_sample(df, 50).count() == 50
    assert random_sample(df, 1000, 1).count() == 500


def test_samples_are_limited_where_rows_are_scanned(spark, plan):
    """The rows of a slice are limited in every task before any is moved, and again before the last."""
    some = F.when(F.rand() > 0.5, "x")
    df = spark.range(100).select(*[some.alias(c) for c in ("TARGET", "col1", "col2", "col3")])
    tree = plan(sample_per_slice(df, 10)).split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 4 and tree.count("Exchange") == 2
    assert tree.rindex("WindowGroupLimit") > tree.rindex("Exchange")


def test_large_samples_are_whole(spark):
    df = spark.range(5000).selectExpr("cast(id AS string) AS TARGET", "'a' AS col1", "'b' AS col2", "cast(NULL AS string) AS col3")
    assert random_sample(df, 3000, seed=1).distinct().count() == 3000
    assert sample_per_slice(df, 3000).distinct().count() == 3000
    assert random_sample(df, 9000, seed=1).count() == 5000


def test_sample_per_slice_takes_small_slices_whole(spark):
    df = spark.range(300).select(
        F.when(F.col("id") < 250, F.lit("t")).alias("TARGET"),
        F.col("id").cast("string").alias("col1"),
        F.lit(None).cast("string").alias("col2"),
        F.lit(None).cast("string").alias("col3"),
    )
    counts = {r.slice: r["count"] for r in sample_per_slice(df).groupBy("slice").count().collect()}
    assert counts == {"target-notnull_col1-only": 100, "target-null_col1-only": 50}


def test_preview(spark):
    df = spark.createDataFrame([(3,), (None,), (1,)], "a int")
    assert preview(df, 2).count() == 2
    assert [r.a for r in preview(df, 2, ["a"]).collect()] == [None, 1]


def test_inspect(spark, numbers, tmp_path):
    path = tmp_path / "n.parquet"
    numbers.coalesce(1).write.parquet(str(path))
    table = spark.read.parquet(str(path))
    found = inspect(table, sample_seed=42, stats_mode="full")
    assert found.row_count.head().row_count == 5000
    assert found.preview.count() == 10
    assert found.random_sample.columns == table.columns
    (stats,) = found.file_stats.collect()
    (file,) = path.glob("*.parquet")
    assert (stats.file_name, stats.file_size, stats.row_count) == (file.name, file.stat().st_size, 5000)
    assert [r.column_name for r in found.column_stats.collect()] == ["n", "text", "m"]
    assert found.column_stats.head().approx_distinct > 4000


def test_inspect_options(spark):
    df = spark.range(3)
    bare = inspect(df, compute_row_count=False, stats_mode="none")
    assert (bare.row_count, bare.column_stats, bare.file_stats) == (None, None, None)
    sampled = inspect(df, sample_rows_for_stats=2)
    assert sampled.column_stats.head().null_count == 0
    with pytest.raises(ValueError, match="stats_mode"):
        inspect(df, stats_mode="some")


def test_file_stats_has_a_row_per_file(spark, tmp_path):
    spark.range(0, 10, 1, 3).write.parquet(str(tmp_path / "t"))
    stats = file_stats(spark.read.parquet(str(tmp_path / "t"))).collect()
    assert len(stats) == 3
    assert sum(r.row_count for r in stats) == 10
