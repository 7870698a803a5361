from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = "/root/testdata/sf0.001"
#: Columns whose names operators use themselves.
CLASHES = ("size", "target", "score", "kept", "row", "doc", "print", "pos", "rank", "component", "key", "token_ids")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 8))) for _ in range(n))


def hostile_rows() -> list[tuple]:
    """``doc_id, text, source`` with nulls, repeated rows, ties, copies, empty and very long texts."""
    base, other = prose(1, 120), prose(2, 90)
    changed = base.split()
    changed[60] = "CHANGED"
    lines = "\n".join(prose(10 + k, 9) for k in range(12))
    rows = [
        (1, base, "a"),
        (1, base, "a"),
        (1, prose(3, 80), "a"),
        (None, base, "b"),
        (None, None, None),
        (2, None, "b"),
        (3, "", "b"),
        (4, " \n\t\r\n ", "c"),
        (5, "word", "c"),
        (6, "one two THREE four", "c"),
        (7, "One two three four", None),
        (8, " ".join(changed), "a"),
        (9, base.upper(), "a"),
        (10, other + "\n" + lines, "a"),
        (11, lines + "\n\n" + other, "a"),
        (12, "\n".join(["same line here"] * 9), "c"),
        (13, "x" * 30_000, "b"),
        (14, prose(4, 20_000), "b"),
        (15, prose(4, 20_000), "b"),
        (16, "é" * 60 + " ñandú 日本 " + base[:200] + " ▁   \\### ", "c"),
        (17, "mail a.b+c@x-y.example.com or a@b, 1.2.3.4.5, 300.1.1.1, 001.02.3.255.", "a"),
        (18, "card 4111 1111-1111 1111 4111111111111112 +1 (743) 555-3824 +12 x 9" + "1" * 40, "a"),
        (19, "write to bob [at] mail5 [dot] example [dot] com 12345678901234567890", "a"),
        (20, "".join(chr(c) for c in range(1, 128)) * 3, "c"),
        (-5, base[:-20], "a"),
    ]
    return rows + [(100 + k, prose(50, 40) + f" tail{k}", "hot") for k in range(40)]


@pytest.fixture(scope="session")
def hostile(spark):
    rows = [(*row, "en", len(row[1] or ""), *[f"{c}{k}" for c in CLASHES]) for k, row in enumerate(hostile_rows())]
    schema = "doc_id long, text string, source string, lang string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def sample(spark):
    """The smallest test documents."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
