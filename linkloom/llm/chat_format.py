"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only its
text is trainable. A conversation that does not end with an assistant turn gets one more example, of
all its turns and with nothing trainable, so that the last example of a conversation is the whole of it.

Template of a turn: ``### role: text</turn>`` and a line feed. Control strings inside texts are replaced by
codes that begin with a backslash, as is the backslash itself, so that after formatting a control
string is always control, and the codes can be read back in any text.

Cases: a null text or role is empty; turns are sorted by number, nulls first, ties by role and text, and
repeated rows are turns of their own; rows whose ``conv_id`` is null are one conversation; other
columns are ignored. Empty input gives no examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.tables import table

START, BETWEEN, END = "### ", ": ", "</turn>\n"
# Control string and code, in the order in which they are replaced; read back in reverse.
CODES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\e"))
ROLE_CODES = (*CODES, (":", "\\c"))
TRAINED = "assistant"


def _replaced(text: Column, pairs) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escaped(text: Column, codes=CODES) -> Column:
    """``text`` without control strings."""
    return _replaced(text, codes)


def unescaped(text: Column, codes=CODES) -> Column:
    """What :func:`escaped` was given."""
    return _replaced(text, [(new, old) for old, new in reversed(codes)])


def format_examples(conversations: DataFrame) -> DataFrame:
    """``conv_id, example, n_turns, formatted, loss_start, loss_end``, one row per example.

    ``formatted[loss_start:loss_end]``, in code points, is trainable; ``last`` marks the example that is
    the whole conversation. ``example`` counts from 0.
    """
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    parts = F.transform(
        "turns",
        lambda t: F.concat(
            F.lit(START), escaped(t["role"], ROLE_CODES), F.lit(BETWEEN), escaped(t["text"]), F.lit(END)
        ),
    )
    ends = F.filter(
        F.transform("turns", lambda t, i: F.when(t["role"] == TRAINED, i + 1)), lambda i: i.isNotNull()
    )
    parted = turns.select(
        "conv_id",
        parts.alias("parts"),
        F.array_union(ends, F.array(F.size("turns"))).alias("ends"),
        F.transform("turns", lambda t: t["role"] == TRAINED).alias("trained"),
    )
    each = parted.select("conv_id", "parts", "trained", F.size("ends").alias("n"), F.posexplode("ends").alias("example", "end"))
    before = F.length(F.array_join(F.slice("parts", 1, F.col("end") - 1), ""))
    trained = F.element_at("trained", F.col("end"))
    part = F.element_at("parts", F.col("end"))
    return each.select(
        "conv_id",
        "example",
        F.col("end").alias("n_turns"),
        F.array_join(F.slice("parts", 1, F.col("end")), "").alias("formatted"),
        F.when(trained, before + len(START) + len(TRAINED) + len(BETWEEN)).alias("loss_start"),
        F.when(trained, before + F.length(part) - len(END)).alias("loss_end"),
        (F.col("example") == F.col("n") - 1).alias("last"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, an array of ``role`` and ``text``."""
    pieces = F.filter(F.split(formatted, END), lambda p: p != "")

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(START) + 1))
        role = F.substring_index(body, BETWEEN, 1)
        return F.struct(
            unescaped(role, ROLE_CODES).alias("role"),
            unescaped(F.substr(body, F.length(role) + len(BETWEEN) + 1)).alias("text"),
        )

    return F.transform(pieces, turn)


def loss_text(formatted: Column, start: Column, end: Column) -> Column:
    """The trainable text of an example."""
    return unescaped(F.substr(formatted, start + 1, end - start))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the examples of each conversation say, read back from them."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(says).alias("text"),
    )
    examples = format_examples(given.unionByName(more))
    turns = read_turns(F.col("formatted"))
    lines = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = examples.select(
        "conv_id",
        F.when(F.col("last"), F.col("n_turns")).alias("n_turns"),
        F.when(F.col("last"), F.sha2(F.array_join(lines, ""), 256)).alias("turns_sha256"),
        F.struct("example", F.coalesce(loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end")), F.lit("")).alias("text")).alias("loss"),
        F.length("formatted").alias("size"),
    )
    digest = read.groupBy("conv_id").agg(
        F.max("n_turns").cast("long").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.array_join(F.transform(F.sort_array(F.collect_list("loss")), lambda x: x["text"]), "").alias("loss"),
        F.sum("size").cast("long").alias("formatted_chars"),
    )
    return digest.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP2_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, role = 'assistant' AS trained,
         length(replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\e'), ':', '\c'))
         + length(replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\e')) + 14 AS size,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM given),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY place) AS so_far FROM sized)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY place) FILTER (trained), ''))::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (trained), '')) AS loss_sha256,
       sum(so_far) FILTER (trained OR place = n)::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id
"""
