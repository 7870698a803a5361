"""Every registered query against its DuckDB SQL, in the plans small and large data get."""

from __future__ import annotations

import pytest
from oracle import connect, rows_of_duckdb, rows_of_spark

import __spark_entry__ as entries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entries.QUERIES
ORACLES = entries.ORACLES


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    assert rows_of_spark(QUERIES[name](spark, SF_DIR)) == rows_of_duckdb(duck, ORACLES[name])


JOINING = [
    "attach_metadata",
    "authority_types",
    "enrich_types",
    "examples_with_type",
    "file_headers",
    "links_merged",
    "match_sources",
    "parse_links",
    "raw_parts",
]


@pytest.mark.parametrize("name", JOINING)
def test_query_equals_oracle_without_broadcast(spark, settings, duck, name):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    assert rows_of_spark(QUERIES[name](spark, SF_DIR)) == rows_of_duckdb(duck, ORACLES[name])


@pytest.mark.parametrize("name", JOINING)
def test_query_equals_oracle_with_sort_merge_and_split_keys(spark, settings, duck, name):
    """Every shuffle partition counts as skewed, so the split of hot keys is exercised."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold="0",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="0.1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2KB",
    )
    assert rows_of_spark(QUERIES[name](spark, SF_DIR)) == rows_of_duckdb(duck, ORACLES[name])


#: Samples number rows, but only those that a limit has left of every group.
LIMITED = ["preview", "random_sample", "sample_per_slice"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_rows_or_numbers_them(spark, plan, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF"):
        assert operator not in text
    if name not in LIMITED:
        assert "Window" not in text


@pytest.mark.parametrize("name", LIMITED)
def test_samples_are_limited_before_rows_are_shuffled(spark, plan, name):
    tree = plan(QUERIES[name](spark, SF_DIR)).split("\n\n")[0]
    assert tree.count("Scan parquet") == 1
    levels = [word for word in tree.replace("(", " ").split() if word in ("WindowGroupLimit", "Exchange")]
    # The lowest exchange has a limit below it.
    assert levels[-1] == "WindowGroupLimit"


@pytest.mark.parametrize(("name", "scans"), [("file_headers", 1), ("parse_links", 2), ("parse_links_wide", 2)])
def test_lines_are_scanned_once_for_headers_and_once_for_data(spark, plan, name, scans):
    df = QUERIES[name](spark, SF_DIR)
    df.collect()
    final = plan(df).split("+- == Initial Plan ==")[0]
    assert final.count("Scan parquet") == scans


def test_entry_is_the_merged_table(spark):
    result = entries.entry(spark)
    assert result.columns[:2] == ["source_file", "TARGET"]
    assert len(result.columns) == 15
    assert result.count() == 1374


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
