"""Lines that are no entries: told apart, counted in passing, kept beside what was read."""

from __future__ import annotations

import json

import pytest

from linkloom import schemas
from linkloom.operators.counts import PassCounts
from linkloom.operators.rejects import accepted, json_elements, json_entries, rejected
from linkloom.sources import authority_dump_entries, harvest_metadata_entries, split_rejects, with_times

GOOD = ['{"id":"a","type":["x"]}', '  {"id":"b","type":null}\r', '{"id":5,"extra":{"a":1}}', "{}", "\ufeff{\"id\":\"c\"}"]
BAD = {
    "[1]": "no object",
    "null": "no object",
    "nope": "no object",
    '[{"id":"d"}]': "no object",
    '{"id":"e"': "malformed",
    '{"id":"f","type":["x"}': "malformed",
    '{"id":"g","type":"x"}': "wrong type",
    '{"id":"h","oldAuthorityNumber":{"a":1}}': "wrong type",
}
LINES = [*GOOD, *BAD, "", " \t"]


def entries_of(spark, lines):
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    return json_entries(df, schemas.AUTHORITY_DUMP)


def test_lines_are_told_apart(spark):
    entries = entries_of(spark, LINES)
    assert {r.line: r.reason for r in rejected(entries).collect()} == BAD
    good = accepted(entries)
    assert [f.name for f in good.schema.fields] == [f.name for f in schemas.AUTHORITY_DUMP.fields]
    assert sorted(str(r.id) for r in good.collect()) == ["5", "None", "a", "b", "c"]


def test_no_line_is_lost_or_doubled(spark):
    entries = entries_of(spark, LINES * 3)
    assert accepted(entries).count() + rejected(entries).count() == 3 * (len(GOOD) + len(BAD))
    assert entries_of(spark, []).count() == 0 and entries_of(spark, [None, ""]).count() == 0


def test_elements_of_arrays(spark):
    documents = [("f", '[{"url":"u","size_bytes":"x"}, {"url":"v"}, 5, null]'), ("g", '[{"url":'), ("h", " [] "), ("i", '{"url":"k"}')]
    rows = json_elements(spark.createDataFrame(documents, "file string, value string"))
    entries = json_entries(rows, schemas.HARVEST_METADATA)
    assert sorted(r.url for r in accepted(entries).collect()) == ["k", "v"]
    bad = {(r.file, r.list_index): r.reason for r in rejected(entries).collect()}
    assert bad == {("f", 0): "wrong type", ("f", 2): "no object", ("f", 3): "no object", ("g", None): "no object"}


def test_split_reads_the_lines_once(spark, tmp_path):
    path = tmp_path / "dump.jsonl"
    path.write_text("\n".join(LINES), encoding="utf-8")
    entries = authority_dump_entries(spark, str(path))
    good, count = split_rejects(entries, str(tmp_path / "rejects"), str(tmp_path / "area"))
    assert (good.count(), count) == (len(GOOD), len(BAD))
    kept = spark.read.json(str(tmp_path / "rejects")).collect()
    assert {(r.line, r.reason) for r in kept} == set(BAD.items())
    assert all(r.source_file.endswith("dump.jsonl") for r in kept)


@pytest.mark.parametrize("name", ["meta.json", "meta.jsonl"])
def test_metadata_files(spark, tmp_path, name):
    good = {"url": "u", "path": "p", "download_time_utc": "2025-01-01T00:00:00+00:00"}
    bad = {"url": "v", "size_bytes": [1]}
    path = tmp_path / name
    path.write_text("\n".join(map(json.dumps, (good, bad))) if name.endswith("l") else json.dumps([good, bad]))
    entries = harvest_metadata_entries(spark, str(path))
    (row,) = with_times(accepted(entries)).collect()
    assert (row.url, row.download_time_utc.year, row.download_time_text[:4]) == ("u", 2025, "2025")
    assert [r.reason for r in rejected(entries).collect()] == ["wrong type"]


def test_missing_files_are_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere"):
        authority_dump_entries(spark, str(tmp_path / "nowhere"))


def test_counts_are_taken_in_passing(spark):
    passing = PassCounts()
    rows = passing.watch(spark.range(10), "before")
    rows = passing.watch(rows.where("id > 6"), "after")
    rows.write.format("noop").mode("overwrite").save()
    assert (passing["before"]["rows"], passing["after"]["rows"]) == (10, 3)
    passing.watch(spark.range(0), "none").write.format("noop").mode("overwrite").save()
    assert passing["none"]["rows"] == 0
