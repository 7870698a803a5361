"""Harvests that parse only what has changed, and the newest run by the names of folders."""

from __future__ import annotations

import os

import pytest

from linkloom.operators.parsing import normalize_schema
from linkloom.plans import aggregate, current_records, ingest, ingest_changes
from linkloom.sources import latest_stored_run, read_latest_run, write_records


def land(folder, name, *lines, at):
    path = folder / name
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (at, at))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def dumps(tmp_path):
    folder = tmp_path / "dumps"
    folder.mkdir()
    land(folder, "a_beacon.txt", "#NAME: a", "1|x|http://a/1", "2", at=1000)
    land(folder, "b[1]*_beacon.txt", "#NAME: b", "#TARGET: http://b/{ID}", "3", "3", at=1000)
    land(folder, "c%20d_beacon.txt", "5", at=1000)
    land(folder, "e_beacon.txt", at=1000)
    return folder


def test_a_second_run_reads_only_what_changed(spark, tmp_path, dumps):
    table = str(tmp_path / "harvest")
    first = ingest_changes(spark, str(dumps), table, "run 1")
    assert rows(first) == rows(ingest(spark, str(dumps), str(tmp_path / "full"), "1"))
    land(dumps, "a_beacon.txt", "#NAME: a", "9", at=2000)
    land(dumps, "new_beacon.txt", "7", at=1000)
    (dumps / "c%20d_beacon.txt").unlink()
    second = ingest_changes(spark, str(dumps), table, "run 2")
    assert rows(second) == rows(ingest(spark, str(dumps), str(tmp_path / "full"), "2"))
    parsed = spark.read.parquet(f"{table}/records").where("run_id = 'run 2'").select("source_file").distinct()
    assert sorted(r.source_file.rpartition("/")[2] for r in parsed.collect()) == ["a_beacon.txt", "new_beacon.txt"]
    third = ingest_changes(spark, str(dumps), table, "run 3")
    assert rows(third) == rows(second)
    assert spark.read.parquet(f"{table}/records/run_id=run%203").count() == 0
    # A dump that comes back as it was is parsed anew.
    land(dumps, "c%20d_beacon.txt", "5", at=1000)
    assert rows(ingest_changes(spark, str(dumps), table, "run 4")) == rows(
        ingest(spark, str(dumps), str(tmp_path / "full"), "4")
    )


def test_size_tells_a_change_when_the_time_does_not(spark, tmp_path, dumps):
    table = str(tmp_path / "harvest")
    ingest_changes(spark, str(dumps), table, "1")
    land(dumps, "a_beacon.txt", "#NAME: a", "9", at=1000)
    got = ingest_changes(spark, str(dumps), table, "2").where("NAME = 'a'").collect()
    assert [r.col1 for r in got] == ["9"]


def test_a_run_that_failed_before_its_list_is_made_good(spark, tmp_path, dumps):
    table = str(tmp_path / "harvest")
    kept = rows(ingest_changes(spark, str(dumps), table, "1"))
    stray = spark.read.parquet(f"{table}/records").drop("run_id")
    write_records(stray, f"{table}/records", "2")
    assert rows(current_records(spark, table)) == kept
    assert rows(ingest_changes(spark, str(dumps), table, "2")) == kept
    with pytest.raises(ValueError, match="does not follow"):
        ingest_changes(spark, str(dumps), table, "2")


def test_an_empty_folder_and_all_dumps_gone(spark, tmp_path, dumps):
    empty = tmp_path / "empty"
    empty.mkdir()
    assert ingest_changes(spark, str(empty), str(tmp_path / "none"), "1").count() == 0
    table = str(tmp_path / "harvest")
    ingest_changes(spark, str(dumps), table, "1")
    for path in dumps.iterdir():
        path.unlink()
    assert ingest_changes(spark, str(dumps), table, "2").count() == 0


def test_aggregation_of_changed_dumps_equals_a_full_one(spark, tmp_path, dumps):
    metadata = tmp_path / "m.jsonl"
    metadata.write_text("")
    out = str(tmp_path / "out")
    aggregate(spark, str(dumps), str(metadata), out, "1", changed_only=True)
    land(dumps, "a_beacon.txt", "#NAME: a", "9|y", at=2000)
    some = aggregate(spark, str(dumps), str(metadata), out, "2", changed_only=True)
    full = aggregate(spark, str(dumps), str(metadata), str(tmp_path / "full"), "2")
    assert some.records == full.records == 4
    assert rows(spark.read.parquet(some.merged_path)) == rows(spark.read.parquet(full.merged_path))


def test_the_newest_run_is_found_by_the_names_of_folders(spark, tmp_path):
    path = str(tmp_path / "records")
    schema = normalize_schema(spark.range(0)).schema
    assert latest_stored_run(spark, path) is None
    assert read_latest_run(spark, path, schema).count() == 0
    for run in ("2024 [a]", "2025 [b]"):
        write_records(normalize_schema(spark.range(2)), path, run)
    assert latest_stored_run(spark, path) == "2025 [b]"
    newest = read_latest_run(spark, path, schema)
    assert {r.run_id for r in newest.collect()} == {"2025 [b]"} and newest.count() == 2
    assert all("2025" in name for name in newest.inputFiles())
