"""Readers, sinks and staging."""

from __future__ import annotations

import datetime
import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from linkloom.operators.counts import latest_run
from linkloom.operators.slices import split_slices
from linkloom.schemas import RECORDS
from linkloom.sources import (
    broadcast_if_small,
    read_authority_dump,
    read_harvest_metadata,
    read_source_list,
    read_tables,
    samples_path,
    stage,
    staged_bytes,
    staging_area,
    staging_dir,
    write_records,
    write_report,
    write_samples,
    write_slices,
    write_table,
)


def test_source_list_keeps_positions_and_extra_fields(spark, tmp_path):
    entries = [{"beacon_url": f"http://x/{i}", "n": i, "tags": ["a"]} for i in range(50)]
    entries[3] = {"name": "no url"}
    path = tmp_path / "list.json"
    path.write_text("\ufeff" + json.dumps(entries, indent=2), encoding="utf-8")
    rows = read_source_list(spark, str(path)).orderBy("list_index").collect()
    assert [r.list_index for r in rows] == list(range(50))
    assert [r.beacon_url for r in rows] == [e.get("beacon_url") for e in entries]
    assert rows[3].name == "no url"
    assert rows[4].tags == ["a"]


def test_source_list_may_be_a_single_object(spark, tmp_path):
    path = tmp_path / "list.json"
    path.write_text(json.dumps({"source": "local-file", "items": [1, 2, 3]}))
    (row,) = read_source_list(spark, str(path)).collect()
    assert (row.list_index, row.source, row["items"]) == (0, "local-file", [1, 2, 3])


@pytest.mark.parametrize("reader", [read_source_list, read_harvest_metadata, read_authority_dump])
def test_missing_file(spark, tmp_path, reader):
    with pytest.raises(FileNotFoundError):
        reader(spark, str(tmp_path / "does-not-exist.json"))


def test_harvest_metadata(spark, tmp_path):
    path = tmp_path / "meta.json"
    item = {
        "url": "u",
        "filename": "f",
        "path": "d/f",
        "size_bytes": 12,
        "download_time_utc": "2025-03-01T10:20:30.123456+00:00",
        "status": "downloaded",
    }
    path.write_text(json.dumps([item, {**item, "download_time_utc": "soon"}], indent=2))
    rows = read_harvest_metadata(spark, str(path)).collect()
    assert rows[0].size_bytes == 12
    seconds = read_harvest_metadata(spark, str(path)).select(
        F.unix_micros("download_time_utc").alias("t")
    )
    when = datetime.datetime(2025, 3, 1, 10, 20, 30, 123456, datetime.UTC)
    assert [r.t for r in seconds.collect()] == [round(when.timestamp() * 1e6), None]
    text = read_harvest_metadata(spark, str(path), parse_time=False).head()
    assert text.download_time_utc == item["download_time_utc"]


def test_malformed_json_is_an_error(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text('[{"beacon_url": "a"}, {"beacon_')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_source_list(spark, str(path)).collect()
    path.write_text('[{"url": "a"}, {"ur')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_harvest_metadata(spark, str(path)).collect()
    for line in ('{"id": "a", "ty', '{"id": "a", "type": "Person"}'):
        path.write_text('{"id": "ok"}\n' + line)
        with pytest.raises(Exception, match="(?i)malformed"):
            read_authority_dump(spark, str(path)).collect()


def test_harvest_metadata_by_line(spark, tmp_path):
    path = tmp_path / "meta.jsonl"
    path.write_text("\n".join(json.dumps({"url": u, "download_time_utc": "soon"}) for u in "abc"))
    rows = read_harvest_metadata(spark, str(path)).collect()
    assert [r.url for r in rows] == ["a", "b", "c"]
    assert {(r.download_time_utc, r.download_time_text) for r in rows} == {(None, "soon")}


def test_without_a_shared_folder_staging_says_so(spark, settings):
    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda name, default=None: default)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_dir(Session)


@pytest.mark.parametrize("packed", [False, True])
def test_authority_dump_keeps_four_keys(spark, tmp_path, packed):
    entries = [
        {"id": "a", "gndIdentifier": "1", "type": ["Person"], "preferredName": "x", "z": {"q": 1}},
        {"id": "b", "oldAuthorityNumber": ["(DE-588)2"], "type": None},
    ]
    text = "\n".join(json.dumps(e) for e in entries).encode()
    path = tmp_path / ("dump.jsonl.gz" if packed else "dump.jsonl")
    path.write_bytes(gzip.compress(text) if packed else text)
    assert [tuple(r) for r in read_authority_dump(spark, str(path)).collect()] == [
        ("a", "1", ["Person"], None),
        ("b", None, None, ["(DE-588)2"]),
    ]


def records(spark, *targets):
    return spark.createDataFrame(
        [("f", t, None, None, None, "1", "2", None, None, None) for t in targets], RECORDS
    )


def test_records_of_a_run_are_replaced_and_no_others(spark, tmp_path):
    path = str(tmp_path / "records")
    write_records(records(spark, "a", "b"), path, "r1")
    write_records(records(spark, "c"), path, "r2")
    write_records(records(spark, "d"), path, "r1")
    write_records(records(spark), path, "r0")
    table = spark.read.parquet(path)
    assert {(r.run_id, r.TARGET) for r in table.collect()} == {("r1", "d"), ("r2", "c")}
    assert [r.TARGET for r in latest_run(table).collect()] == ["c"]


@pytest.mark.parametrize("rebalance", [False, True])
def test_slices_are_rewritten_whole(spark, tmp_path, rebalance):
    path = str(tmp_path / "slices")
    write_slices(split_slices(records(spark, "a", None)), path, rebalance)
    assert {p.name for p in (tmp_path / "slices").glob("slice=*")} == {
        "slice=target-null_col1-2",
        "slice=target-notnull_col1-2",
    }
    write_slices(split_slices(records(spark, None)), path, rebalance)
    assert {p.name for p in (tmp_path / "slices").glob("slice=*")} == {"slice=target-null_col1-2"}


def test_tables_are_compressed_and_read_together(spark, tmp_path):
    write_table(spark.range(3), str(tmp_path / "a"))
    write_table(spark.range(2), str(tmp_path / "b"))
    assert all(".zstd." in p.name for p in (tmp_path / "a").glob("*.parquet"))
    assert read_tables(spark, str(tmp_path / "a"), str(tmp_path / "b")).count() == 5
    assert read_tables(spark, str(tmp_path / "[ab]")).count() == 5


def test_reports_keep_nulls_and_write_iso_times(spark, tmp_path):
    path = tmp_path / "report"
    df = spark.sql("SELECT 'é' AS a, CAST(NULL AS string) AS b, timestamp'2025-01-02 03:04:05Z' AS t")
    write_report(df, str(path))
    (line,) = [x for p in path.glob("part-*") for x in p.read_text(encoding="utf-8").splitlines()]
    assert line == '{"a":"é","b":null,"t":"2025-01-02T03:04:05.000Z"}'


def test_sample_names(spark, tmp_path):
    assert samples_path("x/y/t_resolved.parquet") == "x/y/t_resolved_samples.json"
    assert samples_path("t.parquet") == "t_samples.json"
    assert samples_path("x/t.parquet", "out/") == "out/t_samples.json"
    with pytest.raises(ValueError, match=".parquet"):
        samples_path("t.json")
    written = write_samples(spark.range(2), str(tmp_path / "t.parquet"))
    assert spark.read.json(written).count() == 2


def test_staged_tables_go_to_the_shared_folder_and_have_a_size(spark, tmp_path):
    folder = staging_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    df = spark.range(1000).withColumn("s", F.lit("x"))
    staged = stage(df, "thing")
    assert staged.schema.names == df.schema.names
    assert all(f.startswith(f"file://{folder}/thing-") for f in staged.inputFiles())
    assert staged.count() == 1000


def test_the_size_of_a_plainly_staged_table_decides_about_a_broadcast(spark, settings, plan):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    same = spark.range(20_000).select("id", F.lit("the same text over and over").alias("s"))
    plain = stage(same, "plain", plain=True)
    assert staged_bytes(plain) > 20_000 * 27
    assert staged_bytes(stage(same, "packed")) < 20_000 * 9
    assert staged_bytes(stage(same.limit(0), "none", plain=True)) < 2000
    other = spark.range(10)
    assert "BroadcastHashJoin" in plan(other.join(broadcast_if_small(plain), "id"))
    assert "SortMergeJoin" in plan(other.join(broadcast_if_small(plain, limit=1000), "id"))


def test_a_staging_area_goes_with_its_job(spark):
    with staging_area(spark) as area:
        assert stage(spark.range(3), "numbers", area=area).count() == 3
        assert Path(area).parent == Path(staging_dir(spark))
        assert Path(area).exists()
    assert not Path(area).exists()
    with pytest.raises(RuntimeError), staging_area(spark) as area:
        stage(spark.range(3), "numbers", area=area)
        raise RuntimeError
    assert Path(area).exists()
