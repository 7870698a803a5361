"""Line dedup: repeated runs of lines are deleted but for their first copy.

A document is its sequence of lines that hold a word; lines are numbers (64-bit hashes). The suffix
array over all these sequences is built by prefix doubling: suffixes ranked by their first ``k`` lines
get as keys their own rank and that of the suffix ``k`` lines on, and the sorted distinct keys, numbered
in order, are their ranks by ``2 k`` lines. A suffix whose key is unique has its final place and
leaves; the suffixes that share a key are an interval of the suffix array whose longest common prefix
is at least ``2 k``. The interval's first member (smallest ``doc_id``, then position) is the first
copy, the others begin later copies of a run of that length. Doubling ends when all places are
final. The runs of ``min_lines`` lines and more that intervals reveal are deleted except in the first
copy; overlapping runs of a document merge into maximal ones. With ``min_words`` a single line of that many
words is a run as well, whatever stands around it.

Keys are counted before they are joined back, so that a line that is found everywhere is one row of the
small side; Spark splits the other.

Cases: null and empty texts have no lines and stay as they are, blank lines stay and belong to no
run; a null ``doc_id`` sorts last; rows with the same id and text are one document, so that they
stay or lose lines together, and rows with the same id and different texts are documents sorted by
the hash of the text. Columns are kept, whatever their names. Empty input gives empty output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm.tables import durable, table

MIN_LINES = 2
#: Words of a line that is a run by itself where :func:`dedup_lines` is asked for such.
LONG_LINE = 50
LAST = 2**63 - 1
BLANK = " \t\x0b\x0c\r"


def _document() -> list[Column]:
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
        F.xxhash64("text").alias("print"),
    ]


def _is_filled(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(BLANK))) > 0


def _is_long(line: Column, min_words: int | None) -> Column:
    if min_words is None:
        return F.lit(False)
    return F.size(F.filter(F.split(line, r"[\x20\t\x0b\x0c\r]+"), lambda w: w != "")) >= min_words


def line_suffixes(docs: DataFrame, min_words: int | None = None) -> DataFrame:
    """``doc, print, pos, rank, long``: the suffixes whose first line occurs elsewhere, ranked by it."""
    lines = F.transform(
        F.filter(F.split("text", "\n"), _is_filled),
        lambda x: F.struct(F.xxhash64(x).alias("rank"), _is_long(x, min_words).alias("long")),
    )
    suffixes = (
        docs.select("doc_id", "text")
        .select(*_document(), F.posexplode(lines).alias("pos", "line"))
        .select("doc", "print", "pos", "line.rank", "line.long")
        .dropDuplicates(["doc", "print", "pos"])
    )
    suffixes = durable(suffixes)
    repeated = durable(suffixes.groupBy("rank").agg(F.count("*").alias("n")).where("n > 1").select("rank"))
    return durable(suffixes.join(repeated, "rank", "left_semi"))


def doubled(suffixes: DataFrame, lines: int) -> DataFrame:
    """Suffixes ranked by twice as many lines, if they share them with another; ``later`` unless first.

    ``rank`` of the input is by ``lines`` lines. Keys are sorted by range and numbered in order.
    """
    ahead = suffixes.select("doc", "print", (F.col("pos") - lines).alias("pos"), F.col("rank").alias("next"))
    keyed = durable(suffixes.select("doc", "print", "pos", "rank").join(ahead, ["doc", "print", "pos"]))
    ranks = durable(
        keyed.groupBy("rank", "next")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .orderBy("rank", "next")
        .select("rank", "next", F.monotonically_increasing_id().alias("new"))
    )
    return durable(
        keyed.join(ranks, ["rank", "next"]).select("doc", "print", "pos", F.col("new").alias("rank"))
    )


def _later(suffixes: DataFrame, lines: int) -> DataFrame:
    """``doc, print, pos, lines`` of all members of the intervals but the first of each."""
    first = suffixes.groupBy("rank").agg(F.min(F.struct("doc", "print", "pos")).alias("first"))
    return (
        suffixes.join(durable(first), "rank")
        .where(F.struct("doc", "print", "pos") != F.col("first"))
        .select("doc", "print", "pos", F.lit(lines).alias("lines"))
    )


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """``doc, print, pos, lines``: runs of lines that begin at ``pos`` and are later copies.

    ``min_lines`` is a power of two. Single lines of ``min_words`` words are runs too, if it is given.
    """
    if min_lines < 2 or min_lines & (min_lines - 1):
        raise ValueError("min_lines must be 2, 4, 8, ...")
    suffixes, lines = line_suffixes(docs, min_words), 1
    runs = None if min_words is None else _later(suffixes.where("long"), 1)
    while True:
        suffixes, lines = doubled(suffixes, lines), 2 * lines
        if suffixes.isEmpty():
            break
        if lines >= min_lines:
            found = _later(suffixes, lines)
            runs = found if runs is None else runs.union(found)
    if runs is None:
        return suffixes.select("doc", "print", "pos", F.lit(0).alias("lines"))
    return runs


def removed_runs(runs: DataFrame) -> DataFrame:
    """``doc, print, removed``: maximal runs ``low, high`` of lines to delete, by document.

    Runs that overlap or touch are merged by the furthest end before each; a run is a row however long it is.
    """
    place = Window.partitionBy("doc", "print").orderBy("pos")
    before = place.rowsBetween(Window.unboundedPreceding, -1)
    so_far = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        runs.groupBy("doc", "print", "pos")
        .agg((F.col("pos") + F.max("lines")).alias("end"))
        .withColumn("starts", F.coalesce(F.col("pos") > F.max("end").over(before), F.lit(True)))
        .withColumn("island", F.count_if("starts").over(so_far))
        .groupBy("doc", "print", "island")
        .agg(F.struct(F.min("pos").alias("low"), (F.max("end") - 1).alias("high")).alias("run"))
        .groupBy("doc", "print")
        .agg(F.sort_array(F.collect_list("run")).alias("removed"))
    )


def _without(lines: Column, removed: Column) -> Column:
    """The text of ``lines`` without the runs of ``removed``, which count filled lines only."""
    filled = F.filter(
        F.transform(lines, lambda x, i: F.when(_is_filled(x), i)), lambda i: i.isNotNull()
    )
    # Arrays of one element hold values that lambdas would compute again for every line.
    placed = F.transform(
        F.array(F.struct(lines.alias("lines"), filled.alias("filled"), removed.alias("removed"))),
        lambda s: F.struct(
            s["lines"].alias("lines"),
            F.transform(
                s["removed"],
                lambda r: F.struct(
                    F.element_at(s["filled"], r["low"] + 1).alias("low"),
                    F.element_at(s["filled"], r["high"] + 1).alias("high"),
                ),
            ).alias("removed"),
        ),
    )
    kept = F.transform(
        placed,
        lambda s: F.filter(
            s["lines"],
            lambda x, i: ~_is_filled(x)
            | ~F.exists(s["removed"], lambda r: (i >= r["low"]) & (i <= r["high"])),
        ),
    )
    return F.array_join(kept[0], "\n")


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """All rows and columns of ``docs`` as ``row``, later copies of runs deleted from its text.

    Beside it ``n_lines``, the lines with a word before, and ``n_removed`` of them.
    """
    removed = removed_runs(repeated_runs(docs, min_lines, min_words))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    out = docs.select(*_document(), row.alias("row")).join(durable(removed), ["doc", "print"], "left")
    lines = F.split("row.text", "\n")
    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(_without(lines, F.col("removed")))
    size = F.aggregate("removed", F.lit(0), lambda a, r: a + r["high"] - r["low"] + 1)
    return out.select(
        F.struct(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]).alias("row"),
        F.coalesce(F.size(F.filter(lines, _is_filled)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(size, F.lit(0)).cast("long").alias("n_removed"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, deleted lines and the remaining text of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("row.doc_id", "n_lines", "n_removed", "row.text")


OP7_SQL = """
WITH lines AS (
  SELECT doc_id, ord, line, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> '' AS filled
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               unnest(range(len(string_split(text, chr(10))))) AS ord
        FROM documents WHERE text IS NOT NULL)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) - 1 AS pos FROM lines WHERE filled),
pairs AS (
  SELECT a.doc_id, a.pos, row_number() OVER (PARTITION BY a.line, b.line ORDER BY a.doc_id, a.pos) > 1 AS later
  FROM placed a JOIN placed b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1),
removed AS (
  SELECT doc_id, pos FROM pairs WHERE later UNION SELECT doc_id, pos + 1 FROM pairs WHERE later),
flagged AS (
  SELECT l.doc_id, l.ord, l.line, l.filled, r.doc_id IS NOT NULL AS gone
  FROM lines l LEFT JOIN placed p ON p.doc_id = l.doc_id AND p.ord = l.ord
  LEFT JOIN removed r ON r.doc_id = p.doc_id AND r.pos = p.pos),
rebuilt AS (
  SELECT doc_id, count(*) FILTER (filled) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY ord) FILTER (NOT gone), '') AS text
  FROM flagged GROUP BY doc_id)
SELECT d.doc_id, coalesce(r.n_lines, 0) AS n_lines, coalesce(r.n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE r.text END AS text
FROM documents d LEFT JOIN rebuilt r ON r.doc_id = d.doc_id
"""
