"""Stored sketches: unions of groups without another scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom.operators.sketches import PRECISION, distinct_counts, distinct_sketches, merge_sketches
from linkloom.sources import read_tables, write_records

THREE_ERRORS = 3 * 1.04 / 2 ** (PRECISION / 2)


def runs(spark, *numbers):
    rows = spark.range(0, 30_000).crossJoin(spark.createDataFrame([(n,) for n in numbers], "n int"))
    return rows.selectExpr("n AS run", "id % 3 AS slice", "id + n * 10000 AS value", "CASE WHEN id % 5 > 0 THEN id % 7 END AS few")


def by_column(df):
    return {r.column_name: r for r in distinct_counts(df).collect()}


def test_a_new_run_adds_its_sketches_and_nothing_is_scanned_again(spark, tmp_path, plan):
    path = str(tmp_path / "sketches")
    for n in (0, 1):
        write_records(distinct_sketches(runs(spark, n), ["slice"], ["value", "few"]), path, f"r{n}")
    stored = read_tables(spark, path)
    assert stored.count() == 2 * 3 * 2
    merged = merge_sketches(stored)
    assert plan(merged).count("Scan parquet") > 0 and "Range" not in plan(merged)
    got = by_column(merged)
    exact = runs(spark, 0, 1).agg(F.count_distinct("value")).first()[0]
    assert exact == 40_000 and abs(got["value"].approx_distinct - exact) <= THREE_ERRORS * exact
    assert (got["few"].approx_distinct, got["few"].row_count, got["few"].null_count) == (7, 60_000, 12_000)
    per_slice = distinct_counts(merge_sketches(stored, ["slice"])).where("column_name = 'value'").collect()
    assert sorted(r.slice for r in per_slice) == [0, 1, 2]
    counted = runs(spark, 0, 1).groupBy("slice").agg(F.count_distinct("value").alias("n")).collect()
    exact = {r.slice: r.n for r in counted}
    assert all(abs(r.approx_distinct - exact[r.slice]) <= THREE_ERRORS * exact[r.slice] for r in per_slice)


def test_a_union_counts_what_groups_share_once(spark):
    twice = distinct_sketches(runs(spark, 3)).unionByName(distinct_sketches(runs(spark, 3)))
    got = by_column(merge_sketches(twice))["value"]
    assert got.row_count == 60_000 and abs(got.approx_distinct - 30_000) <= THREE_ERRORS * 30_000


def test_empty_tables_and_columns_of_nulls(spark):
    empty = spark.createDataFrame([], "a string, b int")
    assert {c: (r.approx_distinct, r.row_count, r.null_count) for c, r in by_column(distinct_sketches(empty)).items()} == {
        "a": (0, 0, 0), "b": (0, 0, 0)
    }
    assert distinct_sketches(empty, ["a"]).count() == 0
    nulls = spark.createDataFrame([(None, 1), (None, 1)], "`a.b` string, b int")
    got = by_column(merge_sketches(distinct_sketches(nulls)))
    assert (got["a.b"].approx_distinct, got["a.b"].null_count, got["b"].approx_distinct) == (0, 2, 1)
