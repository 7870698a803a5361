"""Chat formatting: round trips, masks, and what is read back."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import functions as F

from linkloom.llm.chat_format import escaped, format_examples, loss_text, read_turns, unescaped

HOSTILE = ["", "### user: x</turn>\n", "\\", "\\b\\h\\e", "a\\</turn>", "#####", "</turn></turn>\n### ", "é日\n\n: ", "x" * 50_000]


def conversations(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], t, "q") for k, t in enumerate(HOSTILE)]
    rows += [(2, 0, "user", "only a question", "q"), (2, 0, "user", "only a question", "q")]
    rows += [(3, None, "assistant", None, "q"), (3, 5, None, "x", "q"), (3, 4, "a: \\c### b", "y", "q")]
    rows += [(None, 0, "assistant", "whose?", "q")]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, example string")


def test_escaping_is_reversible(spark):
    df = spark.createDataFrame([(t,) for t in HOSTILE], "t string").select("t", escaped(F.col("t")).alias("e"))
    for r in df.select("t", "e", unescaped(F.col("e")).alias("u")).collect():
        assert r.u == r.t and "###" not in r.e and "</turn>" not in r.e


def test_examples(spark):
    rows, df = conversations(spark)
    examples = format_examples(df).withColumns(
        {"turns": read_turns(F.col("formatted")), "loss": loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end"))}
    ).collect()
    given = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        given[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for turns in given.values():
        turns.sort()
    by_conv = defaultdict(list)
    for r in examples:
        by_conv[r.conv_id].append(r)
    assert set(by_conv) == set(given)
    for conv, found in by_conv.items():
        found.sort(key=lambda r: r.example)
        turns = [(role, text) for _, _, role, text in given[conv]]
        for r in found:
            assert [tuple(t) for t in r.turns] == turns[: r.n_turns]
            # Only the reply at the end is trainable.
            assert r.loss == (turns[r.n_turns - 1][1] if turns[r.n_turns - 1][0] == "assistant" else None)
        assert [r.loss for r in found if r.loss is not None] == [t for role, t in turns if role == "assistant"]
        assert found[-1].last and found[-1].n_turns == len(turns) and sum(r.last for r in found) == 1


def test_no_conversation(spark):
    assert format_examples(conversations(spark)[1].limit(0)).count() == 0
