from __future__ import annotations

import os
import re
from urllib.parse import unquote, urlparse

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkloom import functions as fn


def apply(spark, expression, values):
    """Values through a column expression, in order."""
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, "i int, v string")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def expected_prefix(url, max_len=80):
    """The naming rule, by hand."""
    words = re.findall("[A-Za-z0-9]+", url)
    if not words:
        return ""
    return "_".join(words)[:max_len].rstrip("_") + "_"


def expected_name(url):
    """The naming rule on top of the standard URL parser."""
    path = urlparse(url).path
    name = unquote(os.path.basename(path.rstrip("/")))
    name = name or "beacon.txt"
    name = name if "." in name else name + ".txt"
    name = name.replace("/", "_")
    if path.lower().endswith(".gz") and name.lower().endswith(".gz"):
        name = name[:-3] or "beacon.txt"
    return name


URLS = [
    "http://x.example/dumps/gnd.txt",
    "https://x.example/a/b/",
    "https://x.example",
    "https://x.example/",
    "https://x.example/list?format=beacon&x=/y.txt",
    "https://x.example/list#top/z",
    "https://x.example/a%20b%2Fc",
    "https://x.example/a+b%2Bc.txt",
    "https://x.example/100%/50%zz",
    "https://x.example/a;v=1",
    "https://x.example/a;v=1/b;w=2;x",
    "https://x.example/dump.TXT.GZ",
    "https://x.example/dump.gz/",
    "https://x.example/.gz",
    "https://x.example/%C3%A9t%C3%A9",
    "ftp://x.example/pub/gnd",
    "x.example/dump",
    "/only/a/path",
    "//host/path/file",
    "?query",
    "https://x.example/a_/_b__c-d",
    "  https://x.example/led by blanks",
    "http://" + "long-" * 40 + ".example/x",
    "http://" + "a" * 72 + "---b.example",
]


def test_safe_prefix(spark):
    values = [*URLS, "", "://", "___", "ä", "a", "_a_"]
    assert apply(spark, fn.safe_prefix, values) == [expected_prefix(v) for v in values]
    assert apply(spark, fn.safe_prefix, [None]) == [None]


def test_landed_name(spark):
    assert apply(spark, fn.landed_name, URLS) == [expected_name(u) for u in URLS]


def test_landed_name_after_a_prefix(spark):
    got = apply(
        spark,
        lambda u: fn.landed_name(u, fn.indexed_prefix(F.lit(12345), u)),
        ["http://x.example/dump.gz", "http://x.example/"],
    )
    assert got == ["12345_http_x_example_dump_gz_dump", "12345_http_x_example_beacon.txt"]
    assert apply(spark, lambda u: fn.indexed_prefix(F.lit(7), u), ["a", ""]) == ["0007_a_", "0007_"]


@given(st.lists(st.text(max_size=8), min_size=20, max_size=60))
@settings(max_examples=8, deadline=None)
def test_strip_equals_python(spark, values):
    values = [v.encode("utf-8", "ignore").decode() for v in values]
    padded = [w + v + w for v, w in zip(values, "\t\x1c\x85\xa0\u2003\u3000 \u200b\r\n" * 9, strict=False)]
    assert apply(spark, fn.strip, padded) == [v.strip() for v in padded]


@pytest.mark.parametrize(
    ("target", "expected"),
    [
        ("http://x/{ID}?a={ID}", "http://x/7?a=7"),
        ("http://x", "http://x/7"),
        ("http://x/", "http://x/7"),
        ("http://x//", "http://x//7"),
        ("http://x/\n", "http://x/\n/7"),
        ("http://x/{id}", "http://x/{id}/7"),
    ],
)
def test_fill_template(spark, target, expected):
    assert apply(spark, lambda t: fn.fill_template(t, F.lit("7")), [target]) == [expected]


def test_last_segment(spark):
    values = ["http://l/a/b", "http://l/a/", "", "12", "a/b?c=d/e", None]
    assert apply(spark, fn.last_segment, values) == ["b", "", "", "12", "e", None]


def test_unescape_slashes(spark):
    assert apply(spark, fn.unescape_slashes, [r"data\/a\/b", "data/a", r"a\b"]) == [
        "data/a/b",
        "data/a",
        r"a\b",
    ]


def test_bare_id(spark):
    cases = {
        "118540238": "118540238",
        "https://d-nb.info/gnd/118540238": "118540238",
        "http://d-nb.info/gnd/118540238": "118540238",
        "(DE-588)118540238": "118540238",
        "(DE-588a)118540238": "118540238",
        "(de-588)(DE-588)1": "(DE-588)1",
        "https://d-nb.info/gnd/(DE-588)1": "1",
        "(DE-588)https://d-nb.info/gnd/1": "https://d-nb.info/gnd/1",
        "https://dXnb.info/gnd/1": "https://dXnb.info/gnd/1",
        "(DE-58)1": "(DE-58)1",
        " (DE-588)1": " (DE-588)1",
        "": "",
        None: None,
    }
    assert apply(spark, fn.bare_id, list(cases)) == list(cases.values())


def test_entity_type(spark):
    cases = [
        (["Person", "Work"], "Person"),
        (["Family", "Work", "CorporateBody"], "CorporateBody"),
        (["SubjectHeading", "Work"], "Work"),
        (["Family", "PlaceOrGeographicName"], "PlaceOrGeographicName"),
        (["Family", None], "Family"),
        (["AuthorityResource"], "Other"),
        ([None], "Other"),
        ([], "Other"),
        (None, "Other"),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t array<string>")
    got = df.select("i", fn.entity_type(F.col("t")).alias("e")).orderBy("i").collect()
    assert [r.e for r in got] == [c[1] for c in cases]
