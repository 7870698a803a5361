"""Slices, resolution and merge on literal records."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from linkloom.fixed_values import RESOLVABLE_SLICES, SLICES
from linkloom.operators.resolution import merge_slices, resolve_links
from linkloom.operators.sampling import sample_per_slice
from linkloom.operators.slices import (
    null_patterns,
    rows_of_slice,
    rows_with_pattern,
    slice_counts,
    split_slices,
    with_slice,
)
from linkloom.schemas import RECORDS


def records(spark, *rows):
    """Records from (TARGET, col1, col2, col3)."""
    full = [("f", t, None, None, None, a, b, c, None, None) for t, a, b, c in rows]
    return spark.createDataFrame(full, RECORDS)


ALL = list(itertools.product((None, "http://t/"), (None, "1"), (None, "2"), (None, "3")))


def slice_by_hand(target, col1, col2, col3):
    """Slice by the definition."""
    shape = tuple(c is not None for c in (col1, col2, col3))
    shapes = {
        (True, False, False): "col1-only",
        (True, True, False): "col1-2",
        (True, True, True): "col1-2-3",
    }
    if shape not in shapes:
        return None
    return f"target-{'null' if target is None else 'notnull'}_{shapes[shape]}"


def test_slice_of_every_null_pattern(spark):
    rows = with_slice(records(spark, *ALL)).collect()
    assert len(rows) == 16
    for r in rows:
        assert r.slice == slice_by_hand(r.TARGET, r.col1, r.col2, r.col3)


def test_split_and_single_slices_agree(spark):
    df = records(spark, *ALL)
    expected = sorted(s for row in ALL if (s := slice_by_hand(*row)))
    assert sorted(r.slice for r in split_slices(df).collect()) == expected
    for name in SLICES:
        assert [r.slice for r in rows_of_slice(df, name).collect()] == [name]
        assert [r.slice for r in rows_of_slice(with_slice(df), name, stored=True).collect()] == [name]
    assert {r.slice: r.row_count for r in slice_counts(df).collect()} == dict.fromkeys(SLICES, 1)


def test_empty_text_counts_as_present(spark):
    df = records(spark, (None, "a", "", "c"), (None, "a", "", None))
    assert {r.slice for r in with_slice(df).collect()} == {
        "target-null_col1-2-3",
        "target-null_col1-2",
    }


def test_null_patterns(spark):
    got = {(r.target, r.pattern): r.row_count for r in null_patterns(records(spark, *ALL)).collect()}
    assert got == {
        (t, p): 1 for t in ("null", "notnull") for p in ("col1-2-3", "col1-2", "col1", "col2")
    }
    assert {r.row_count for r in null_patterns(records(spark)).collect()} == {0}


def test_rows_with_pattern(spark):
    df = records(spark, *ALL)
    got = rows_with_pattern(df, ["col1", "col2", "col3"], ["TARGET"]).collect()
    assert [(r.TARGET, r.col1) for r in got] == [("http://t/", None)]
    assert rows_with_pattern(df, [], []).count() == 16


RESOLVED = [
    (("http://x/{ID}?a={ID}", "7", None, None), ("http://x/7?a=7", "7")),
    (("http://x", "7", None, None), ("http://x/7", "7")),
    (("http://x/", "7", None, None), ("http://x/7", "7")),
    (("http://x/", "7", "l", None), ("http://x/7", "7")),
    (("http://x/{id}", "7", "l", None), ("http://x/{id}/7", "7")),
    (("http://x/", "7", "l", "9"), ("http://x/7", "9")),
    (("http://x/{ID}", "", "", ""), ("http://x/", "")),
    ((None, "7", "http://l/a/b", None), ("http://l/a/b", "b")),
    ((None, "7", "12", None), ("12", "12")),
    ((None, "7", "", None), ("", "")),
    ((None, "7", "", "http://l/a/"), ("http://l/a/", "")),
]


@pytest.mark.parametrize(("record", "expected"), RESOLVED)
def test_resolution_rules(spark, record, expected):
    row = resolve_links(records(spark, record)).head()
    assert (row.target_uri, row.target_id) == expected
    assert row.authority_id == record[1]


def test_resolution_keeps_five_slices_of_every_pattern(spark):
    df = records(spark, *ALL)
    kept = sorted(r.slice for r in resolve_links(df).collect())
    assert kept == sorted(RESOLVABLE_SLICES)
    assert sorted(r.slice for r in resolve_links(with_slice(df), stored_slices=True).collect()) == kept


def test_resolution_passes_metadata_through(spark):
    df = records(spark, ("t", "1", None, None)).withColumns(
        {"beacon_uri": F.lit("u"), "beacon_harvest_timestamp": F.lit("t"), "other": F.lit(1)}
    )
    assert resolve_links(df).columns[10:] == [
        "target_uri",
        "target_id",
        "authority_id",
        "beacon_uri",
        "beacon_harvest_timestamp",
        "slice",
    ]


def test_null_tests_reach_the_scan(spark, plan, tmp_path):
    path = str(tmp_path / "records.parquet")
    records(spark, *ALL).write.parquet(path)
    stored = spark.read.parquet(path)
    text = plan(resolve_links(stored))
    assert "IsNotNull(col1)" in text
    assert "Or(IsNotNull(col2),And(IsNotNull(TARGET),IsNull(col3)))" in text
    assert "IsNull(TARGET)" in plan(rows_of_slice(stored, SLICES[0]))


def test_stored_slices_prune_partitions(spark, plan, tmp_path):
    path = str(tmp_path / "slices.parquet")
    split_slices(records(spark, *ALL)).write.partitionBy("slice").parquet(path)
    stored = spark.read.parquet(path)
    # Samples of all slices are one scan, and each partition is read once in it.
    text = plan(sample_per_slice(stored, 1, stored_slices=True))
    assert text.count("PartitionFilters: [isnotnull(slice") == 1 and text.split("\n\n")[0].count("Scan parquet") == 1
    one = plan(rows_of_slice(stored, SLICES[0], stored=True))
    assert "(slice#" in one and f"= {SLICES[0]})" in one.split("PartitionFilters")[1].split("\n")[0]


def test_merge_aligns_to_the_first_table(spark):
    first = spark.createDataFrame([("1", 2)], "a string, b bigint")
    second = spark.createDataFrame([(3, 4, 5)], "b int, extra int, a int")
    merged = merge_slices(first, second)
    assert merged.schema == first.schema
    assert sorted(merged.collect()) == [("1", 2), ("5", 3)]
    with pytest.raises(ValueError, match="missing"):
        merge_slices(first, second.drop("b"))
    with pytest.raises(ValueError, match="no tables"):
        merge_slices()


def test_a_foreign_slice_column_changes_nothing(spark):
    plain = records(spark, *ALL)
    foreign = plain.withColumn("slice", F.lit("piece"))
    assert sorted(map(tuple, split_slices(foreign).collect()), key=repr) == sorted(map(tuple, split_slices(plain).collect()), key=repr)
    assert sorted(map(tuple, resolve_links(foreign).collect()), key=repr) == sorted(map(tuple, resolve_links(plain).collect()), key=repr)
    for name in SLICES:
        assert rows_of_slice(foreign, name).count() == rows_of_slice(plain, name).count()
