"""Whole jobs over files, from dumps to the enriched table."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from linkloom.fixed_values import RESOLVABLE_SLICES
from linkloom.plans import aggregate, enrich, ingest

DUMPS = {
    "0000_http_a_example_a.txt": "\ufeff#FORMAT: BEACON\n#TARGET: http://a.example/{ID}\n#NAME: A\n\n1\n2|5\n3|label|x9\n",
    "0001_http_b_example_b.txt": "#NAME: B\r\n#FEED: http://b.example/f\r\n(DE-588)1|http://b.example/p/q\r\n4||http://b.example/r/\r\n5\r\n",
    "0002_http_c_example_c.txt": "#TARGET: http://c.example\n\n# nothing here\n",
    "0003_http_d_example_d.txt": "7|http://d.example/7\n#late: x\n",
}
URLS = [
    "http://a.example",
    "http://b.example",
    "http://c.example",
    "http://d.example",
    None,
    "http://e.example",
]


@pytest.fixture(scope="module")
def workspace(tmp_path_factory):
    root = tmp_path_factory.mktemp("job")
    folder = root / "dumps"
    folder.mkdir()
    metadata = []
    for name, url in zip(DUMPS, URLS, strict=False):
        (folder / name).write_bytes(DUMPS[name].encode())
        metadata.append(
            {"url": url, "filename": name, "path": f"{folder}/{name}", "size_bytes": 1,
             "download_time_utc": "2025-01-01T00:00:00+00:00", "status": "downloaded"}
        )
    (folder / "harvest.json").write_text(json.dumps(metadata[:3]))
    (root / "list.json").write_text(json.dumps([{"beacon_url": u, "title": "t"} for u in URLS]))
    dump = [
        {"id": "https://d-nb.info/gnd/1", "type": ["Work", "Person"], "oldAuthorityNumber": ["(DE-588)7"]},
        {"id": "https://d-nb.info/gnd/4", "type": ["Family"]},
    ]
    (root / "dump.jsonl").write_text("\n".join(json.dumps(d) for d in dump))
    return root


@pytest.fixture(scope="module")
def aggregation(spark, workspace):
    return aggregate(
        spark,
        f"{workspace}/dumps",
        f"{workspace}/dumps/harvest.json",
        f"{workspace}/out",
        "20250101",
        f"{workspace}/list.json",
    )


def test_records(spark, workspace, aggregation):
    rows = spark.read.parquet(aggregation.records_path).collect()
    got = sorted((r.source_file.rsplit("/", 1)[1][:4], r.NAME, r.col1, r.col2, r.col3) for r in rows)
    assert got == [
        ("0000", "A", "1", None, None),
        ("0000", "A", "2", "5", None),
        ("0000", "A", "3", "label", "x9"),
        ("0001", "B", "(DE-588)1", "http://b.example/p/q", None),
        ("0001", "B", "4", "", "http://b.example/r/"),
        ("0001", "B", "5", None, None),
        ("0003", None, "#late: x", None, None),
        ("0003", None, "7", "http://d.example/7", None),
    ]


def test_merged(spark, aggregation):
    merged = spark.read.parquet(aggregation.merged_path)
    got = sorted(
        (r.authority_id, r.target_uri, r.target_id, r.beacon_uri, r.slice) for r in merged.collect()
    )
    a, b = "http://a.example", "http://b.example"
    assert got == sorted(
        [
            ("1", f"{a}/1", "1", a, "target-notnull_col1-only"),
            ("2", f"{a}/2", "2", a, "target-notnull_col1-2"),
            ("3", f"{a}/3", "x9", a, "target-notnull_col1-2-3"),
            ("(DE-588)1", f"{b}/p/q", "q", b, "target-null_col1-2"),
            ("4", f"{b}/r/", "", b, "target-null_col1-2-3"),
            ("7", "http://d.example/7", "7", None, "target-null_col1-2"),
        ],
        key=lambda r: r[0],
    )
    assert merged.where("beacon_uri IS NOT NULL AND beacon_harvest_timestamp IS NULL").count() == 0


def test_samples_and_matches(spark, aggregation):
    assert list(aggregation.samples_paths) == list(RESOLVABLE_SLICES)
    counts = {}
    for name, path in aggregation.samples_paths.items():
        assert path.endswith(f"20250101_{name}_samples.json")
        rows = spark.read.schema("slice string").json(path).collect()
        assert {r.slice for r in rows} <= {name}
        counts[name] = len(rows)
    assert sum(counts.values()) == 6 and counts["target-null_col1-2"] == 2
    rows = spark.read.json(aggregation.matches_path).orderBy("list_index").collect()
    assert [r.matched_parquets for r in rows] == [
        ["target-notnull_col1-only", "target-notnull_col1-2", "target-notnull_col1-2-3"],
        ["target-null_col1-2", "target-null_col1-2-3"],
        [],
        ["target-null_col1-2"],
        [],
        [],
    ]
    assert rows[0].title == "t"


@pytest.mark.parametrize("symmetric", [False, True])
def test_enrichment(spark, workspace, aggregation, symmetric):
    out = f"{workspace}/enriched_{symmetric}"
    result = enrich(spark, aggregation.merged_path, f"{workspace}/dump.jsonl", out, symmetric)
    assert len(result.enriched.columns) == 17
    types = {r.authority_id: (r.gnd_type, r.gnd_type_list) for r in result.enriched.collect()}
    person = ("Person", ["Person", "Work"])
    assert types == {
        "1": person,
        "(DE-588)1": person,
        "7": person,
        "4": ("Family", ["Family"]),
        "2": (None, []),
        "3": (None, []),
    }
    assert result.coverage.head() == (6, 4, 2)
    assert [r.beacon_uri for r in result.examples_with_type.collect()] == [
        None,
        "http://a.example",
        "http://b.example",
    ]
    assert [r.authority_id for r in result.examples_without_type.collect()] == ["2"]


def test_metadata_that_lists_a_path_twice_can_be_refused(spark, workspace, tmp_path):
    twice = json.loads((workspace / "dumps" / "harvest.json").read_text())[:1] * 2
    path = tmp_path / "harvest.json"
    path.write_text(json.dumps(twice))
    job = (spark, f"{workspace}/dumps", str(path), str(tmp_path / "out"), "r")
    with pytest.raises(ValueError, match="more than once"):
        aggregate(*job, check_metadata=True)
    doubled = spark.read.parquet(aggregate(*job).merged_path)
    assert doubled.count() == 6 + 3


def test_dumps_landed_elsewhere_than_metadata_says(spark, workspace, tmp_path):
    entries = [
        {"url": url, "filename": name, "path": f"data/beacons/{name}", "size_bytes": 1,
         "download_time_utc": "2025-01-01T00:00:00+00:00", "status": "downloaded"}
        for name, url in zip(DUMPS, URLS, strict=False)
    ]
    path = tmp_path / "harvest.jsonl"
    path.write_text("\n".join(map(json.dumps, entries)))
    job = (spark, f"{workspace}/dumps", str(path))
    lost = aggregate(*job, str(tmp_path / "lost"), "r")
    assert lost.without_metadata == 8
    found = aggregate(*job, str(tmp_path / "found"), "r", source_dir="data/beacons/", check_counts=True)
    assert found.without_metadata == 0
    assert spark.read.parquet(found.merged_path).where("beacon_uri IS NULL").count() == 0


def test_a_join_that_doubles_records_can_be_refused(spark, workspace, tmp_path):
    twice = json.loads((workspace / "dumps" / "harvest.json").read_text())[:1] * 2
    path = tmp_path / "harvest.json"
    path.write_text(json.dumps(twice))
    with pytest.raises(Exception, match="Row count mismatch"):
        aggregate(spark, f"{workspace}/dumps", str(path), str(tmp_path / "out"), "r", check_counts=True)


def test_ingest_again_without_data_empties_the_run(spark, tmp_path):
    folder = tmp_path / "dumps"
    folder.mkdir()
    (folder / "a.txt").write_text("1\n2\n")
    target = str(tmp_path / "records")
    assert ingest(spark, str(folder), target, "r1").count() == 2
    (folder / "a.txt").write_text("#NAME: only a header\n")
    assert ingest(spark, str(folder), target, "r1").count() == 0
    assert spark.read.parquet(target).count() == 0


def test_a_folder_without_data_adds_no_run(spark, tmp_path):
    folder = tmp_path / "dumps"
    folder.mkdir()
    (folder / "a.txt").write_text("#NAME: a\n")
    assert ingest(spark, str(folder), str(tmp_path / "records"), "r1").count() == 0


def test_ingest_again_replaces_the_run(spark, tmp_path):
    folder = tmp_path / "dumps"
    folder.mkdir()
    (folder / "a.txt").write_text("1\n2\n")
    target = str(tmp_path / "records")
    assert ingest(spark, str(folder), target, "r1").count() == 2
    (folder / "a.txt").write_text("1\n")
    assert ingest(spark, str(folder), target, "r1").count() == 1
    assert ingest(spark, str(folder), target, "r2").count() == 1
    assert spark.read.parquet(target).count() == 2


def test_bad_lines_are_kept_aside_and_the_others_used(spark, workspace, tmp_path):
    metadata = json.loads((workspace / "dumps" / "harvest.json").read_text())
    listed = tmp_path / "harvest.json"
    listed.write_text(json.dumps([*metadata, {"url": "x", "size_bytes": "many"}, 5]))
    run = aggregate(spark, f"{workspace}/dumps", str(listed), str(tmp_path / "out"), "r",
                    check_metadata=True, check_counts=True, rejects_path=str(tmp_path / "bad-metadata"))
    assert (run.rejected_metadata, run.records, run.without_metadata) == (2, 8, 2)
    with pytest.raises(Exception, match="size_bytes|MALFORMED|malformed"):
        aggregate(spark, f"{workspace}/dumps", str(listed), str(tmp_path / "strict"), "r")

    dump = tmp_path / "dump.jsonl"
    dump.write_text((workspace / "dump.jsonl").read_text() + '\n{"id": "cut\n{"id": "t", "type": "Person"}\n')
    result = enrich(spark, run.merged_path, str(dump), str(tmp_path / "typed"), rejects_path=str(tmp_path / "bad-lines"))
    assert result.rejected == 2
    reasons = {r.reason for r in spark.read.json(str(tmp_path / "bad-lines")).collect()}
    assert reasons == {"malformed", "wrong type"}
    typed = {(r.authority_id, r.gnd_type) for r in result.enriched.collect() if r.gnd_type}
    plain = enrich(spark, run.merged_path, f"{workspace}/dump.jsonl", str(tmp_path / "plain"))
    assert typed == {(r.authority_id, r.gnd_type) for r in plain.enriched.collect() if r.gnd_type} != set()


def test_counting_while_records_pass_reads_them_once(spark, plan):
    """The join is watched where it is: the plan of what is written has one scan of the records."""
    from linkloom.operators.counts import PassCounts
    from linkloom.operators.metadata import attach_metadata
    from linkloom.operators.parsing import normalize_schema
    from linkloom.operators.resolution import resolve_links

    rows = [("f", "T", "1", None, None), ("g", None, "2", "http://a/b", None)]
    schema = "source_file string, TARGET string, col1 string, col2 string, col3 string"
    records = normalize_schema(spark.createDataFrame(rows * 5, schema))
    metadata = spark.createDataFrame([("f", "u", "t"), ("f", "v", "t")], "path string, url string, download_time_utc string")
    passing = PassCounts()
    joined = passing.watch(attach_metadata(passing.watch(records, "records"), metadata, flag="listed"), "joined", listed=F.count_if("listed"))
    result = resolve_links(joined.drop("listed"))
    tree = plan(result).split("\n\n")[0]
    assert tree.count("CollectMetrics") == 2 and tree.count("Scan ExistingRDD") == 2
    result.write.format("noop").mode("overwrite").save()
    assert passing["records"]["rows"] == 10
    assert passing["joined"] == {"rows": 15, "listed": 10}
