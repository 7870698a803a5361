"""Link-dump lines to records.

A dump starts with a header: its leading lines that begin with ``#`` or are blank. Everything
after the first other line is data, including later lines that begin with ``#``. Where the
header of a file ends is the one fact about a line that depends on other lines; it is found,
with the header values, by one partial aggregate over the lines, never by sorting or windowing them.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.fixed_values import (
    EXTRA_LINE_BREAKS,
    HEADER_KEYS,
    HEADER_MARK,
    RECORD_COLUMNS,
    RECORD_FIELDS,
)
from linkloom.functions import all_fields, fields, header_key, header_value, line_kind, strip
from linkloom.operators.joining import shuffled_anew


def normalize_schema(df: DataFrame) -> DataFrame:
    """The ten record columns in order, all strings: missing ones NULL, others dropped."""
    present = set(df.columns)
    return df.select(
        [
            (F.col(name) if name in present else F.lit(None)).cast("string").alias(name)
            for name in RECORD_COLUMNS
        ]
    )


def with_kind(lines: DataFrame) -> DataFrame:
    """Add what later passes need to know of a line: its kind, and the header entry it may be.

    ``kind`` is mark, blank or text; ``entry_key`` and ``entry_value`` are NULL unless the line
    would set a header value if it stood in a header.
    """
    kind = line_kind(F.col("line"))
    key, value = header_key(F.col("line")), header_value(F.col("line"))
    sets = (F.col("kind") == "mark") & key.isin(HEADER_KEYS) & value.isNotNull()
    return (
        lines.withColumn("kind", kind)
        .withColumn("entry_key", F.when(sets, key))
        .withColumn("entry_value", F.when(F.col("entry_key").isNotNull(), value))
    )


def header_state(lines: DataFrame) -> DataFrame:
    """What decides about headers, in one aggregate: source_file, block, key, value, ord.

    A row with NULL ``key`` is where the text lines of a file and block start; every other row is
    a line that would set a header value. The buffer is one number, so the lines are hashed and
    combined where they are read; what is left is a row per file and split, and the entries.
    ``lines`` come from :func:`with_kind`.
    """
    entry = F.col("entry_key").isNotNull()
    return (
        lines.where((F.col("kind") == "text") | entry)
        .groupBy(
            "source_file",
            "block",
            F.col("entry_key").alias("key"),
            F.col("entry_value").alias("value"),
            F.when(entry, F.col("ord")).alias("entry"),
        )
        .agg(F.min("ord").alias("ord"))
        .drop("entry")
    )


def file_headers(lines: DataFrame, kinds_known: bool = False) -> DataFrame:
    """One row per file that has data: where data starts, and its header values.

    ``kinds_known`` says that ``lines`` come from :func:`with_kind`.

    Columns: source_file, data_block, data_ord, TARGET, NAME, FEED, TIMESTAMP. The last
    non-empty value of a key wins. One row per file is small beside the lines of the files, but
    it is not assumed to be: stage it, and the join in :func:`parse_links` follows its size.

    Lines are read once, for :func:`header_state`. Which entries count depends on the first text
    line of the whole file, so its rows meet their own minimum; both sides read one exchange.
    """
    lines = _with_block(lines)
    state = header_state(lines if kinds_known else with_kind(lines))
    position = F.struct("block", "ord")
    starts = (
        state.groupBy("source_file")
        .agg(F.min(F.when(F.col("key").isNull(), position)).alias("first"))
        .where(F.col("first").isNotNull())
    )
    # One file may hold most of the entries. They are the side that Spark can split.
    in_header = position < F.col("first")
    return (
        state.join(shuffled_anew(starts), "source_file")
        .groupBy("source_file", "first")
        .agg(
            *[
                F.max_by("value", F.when(in_header & (F.col("key") == key), position)).alias(key)
                for key in HEADER_KEYS
            ]
        )
        .select(
            "source_file",
            F.col("first.block").alias("data_block"),
            F.col("first.ord").alias("data_ord"),
            *HEADER_KEYS,
        )
    )


def parse_links(
    lines: DataFrame,
    headers: DataFrame | None = None,
    count: int = RECORD_FIELDS,
    kinds_known: bool = False,
) -> DataFrame:
    """Records of all data lines: file, header values, and the first ``count`` fields.

    A field that is present but blank is ``''``; a field that is absent is NULL. ``headers`` is
    the result of :func:`file_headers`, staged when the input is large. ``count=9`` gives the
    widest form of a record; ``kinds_known`` is as in :func:`file_headers`.
    """
    lines = _with_block(lines)
    lines = lines if kinds_known else with_kind(lines)
    if headers is None:
        headers = shuffled_anew(file_headers(lines, kinds_known=True))
    parts = fields(F.col("line"), count)
    data = (
        lines.where(F.col("kind") != "blank")
        .join(headers, "source_file")
        .where((F.col("kind") == "text") | _after("data"))
        .withColumn("parts", parts)
    )
    return data.select(
        "source_file",
        *HEADER_KEYS,
        *[strip(F.get("parts", F.lit(i))).alias(f"col{i + 1}") for i in range(count)],
    )


def header_ends(lines: DataFrame) -> DataFrame:
    """Where the raw header of a file ends: source_file, end_block, end_ord.

    The raw header ends at the first line that does not begin with ``#``, be it blank. Files
    that are all header are absent.
    """
    return _first_position(_in_pieces(lines).where(F.col("first_other") > 0), "end")


def raw_parts(lines: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """Header lines as they are, and data lines with all their fields, unstripped and uncapped.

    Columns: source_file, block, ord, part_of_line, is_header, raw, parts (NULL for header
    lines). Every Unicode line boundary ends a line here. ``ends`` is the result of
    :func:`header_ends`, staged when the input is large.
    """
    if ends is None:
        ends = shuffled_anew(header_ends(lines))
    inside = F.col("part_of_line") < F.col("first_other") - 1
    at_end = (F.col("block") == F.col("end_block")) & (F.col("ord") == F.col("end_ord"))
    is_header = F.col("end_ord").isNull() | _before("end") | (at_end & inside)
    return (
        _in_pieces(lines)
        .join(ends, "source_file", "left")
        .select("*", F.posexplode("pieces").alias("part_of_line", "raw"))
        .select(
            "source_file", "block", "ord", "part_of_line", is_header.alias("is_header"), "raw"
        )
        .where(F.col("is_header") | (strip(F.col("raw")) != ""))
        .withColumn("parts", F.when(~F.col("is_header"), all_fields(F.col("raw"))))
    )


def _in_pieces(lines: DataFrame) -> DataFrame:
    """Lines cut at the remaining line boundaries; where the first piece without # is (0: none).

    Hardly any line has such a boundary, so the others are not taken apart.
    """
    line = F.col("line")
    cut = reduce(or_, [F.contains(line, F.lit(mark)) for mark in EXTRA_LINE_BREAKS])
    pieces = F.split(line, f"[{EXTRA_LINE_BREAKS}]", -1)
    marks = F.transform(pieces, lambda piece: piece.startswith(HEADER_MARK))
    first_other = (
        F.when(~line.startswith(HEADER_MARK), 1)
        .when(~cut, 0)
        .otherwise(F.array_position(marks, F.lit(False)))
    )
    return _with_block(lines).select(
        "source_file",
        "block",
        "ord",
        F.when(cut, pieces).otherwise(F.array(line)).alias("pieces"),
        first_other.alias("first_other"),
    )


def _with_block(lines: DataFrame) -> DataFrame:
    """Lines that come from a table rather than from file splits are all in block 0."""
    if "block" in lines.columns:
        return lines
    return lines.withColumn("block", F.lit(0).cast("bigint"))


def _first_position(lines: DataFrame, name: str) -> DataFrame:
    """First position per file. The big pass keeps two numbers per split, so it hashes."""
    per_block = lines.groupBy("source_file", "block").agg(F.min("ord").alias("ord"))
    first = per_block.groupBy("source_file").agg(F.min(F.struct("block", "ord")).alias("first"))
    return first.select(
        "source_file",
        F.col("first.block").alias(f"{name}_block"),
        F.col("first.ord").alias(f"{name}_ord"),
    )


def _before(name: str) -> Column:
    block, order = F.col(f"{name}_block"), F.col(f"{name}_ord")
    return (F.col("block") < block) | ((F.col("block") == block) & (F.col("ord") < order))


def _after(name: str) -> Column:
    block, order = F.col(f"{name}_block"), F.col(f"{name}_ord")
    return (F.col("block") > block) | ((F.col("block") == block) & (F.col("ord") > order))
