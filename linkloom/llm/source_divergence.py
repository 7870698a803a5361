"""Source divergence audit: how far the sources of a language differ in the terms they use.

A term is a run of letters A to Z (lower-cased) and of characters beyond ASCII. A language keeps the terms that
occur in at least ``min_docs`` of its documents. A group is a language and a source; a group and a language give
every kept term ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))`` (``N`` the sum of its counts, ``V`` the number of
kept terms), and two of them differ at a term by ``f = floor((p - q)^2 / (p + q))``. All of it is whole numbers.

* Tasks count the terms of a few megabytes of text before anything is shuffled: per group, term occurrences and
  documents. Sums of groups then meet by language and term, so that no group is gathered anywhere.
* Kept terms are dealt into blocks of about ``block`` terms by a hash and numbered within their block. A group's
  counts in a block are a pair of arrays, term ids in order and counts: bounded, whatever the size of the group.
* Pairs are tasks: for every unordered pair of groups and every block, the two groups' arrays are co-grouped. A
  galloping intersection walks the shorter array through the longer one. It prices the overlap; terms of one side
  are priced against the other's ``p`` of an absent term; blocks are summed. Terms that both lack all have one
  price, taken once for the pair. ``f`` is symmetric, so a pair is computed once and reported both ways.
* Terms in which a group exceeds its language are compared with the language's counts beside them, and
  ranked: each task hands on its first ``top`` per group only.

There is a result for every ordered pair of sources, so that pairs are what is asked for; their number is that
of the output.

Cases: null text, language or source is ``''``; a group without terms takes part with counts of 0; without kept
terms every pair has the value 0 and there are no terms. Repeated rows count as often as they stand. A language
with one source has no pairs. Equal values are ranked by the UTF-8 of the item. Other columns are
ignored; empty input gives empty output. ``N + 2 V`` has to stay below ``9 * 10^15``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm.tables import durable, table
from linkloom.llm.text_blocks import LOWER, blocks

SCALE_STEPS = 3  # p is scaled by 1000 this many times
TOP = 10
MIN_DOCS = 10
BLOCK = 1 << 16
COUNTED = "lang string, source string, term string, n long, docs long"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """All terms of a block of texts in order, and how many each text has."""
    inside = _LETTER[data]
    edges = offsets[:-1][np.diff(offsets) > 0]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[edges] = inside[edges]
    last[edges[1:] - 1] = inside[edges[1:] - 1]
    starts = np.flatnonzero(first)
    ends = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - starts)])
    counts = np.diff(np.searchsorted(starts, offsets))
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(LOWER[data[inside]]))
    return terms, counts


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs."""
    ordered = np.sort(keys)
    edges = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], len(ordered) > 0))
    return ordered[edges], np.diff(edges, prepend=-1)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of the terms of every group in a block; a null term for the group itself."""
    for block in blocks(batches, limit=8 << 20):
        terms, counts = _terms(block.data, block.offsets)
        langs, sources = block.rows.column(0), block.rows.column(1)
        seen: dict = {}
        pairs = zip(langs.to_pylist(), sources.to_pylist(), strict=True)
        group = np.array([seen.setdefault(pair, len(seen)) for pair in pairs], np.int64)
        known = terms.dictionary_encode()
        names, code = known.dictionary, known.indices.to_numpy().astype(np.int64)
        wide = max(len(names), 1)
        text = np.repeat(np.arange(len(counts)), counts)
        by, n = _runs(group[text] * wide + code)
        # Every term of a text once: the same groups and terms, so the same keys.
        held, _ = _runs(text * wide + code)
        _, docs = _runs(group[held // wide] * wide + held % wide)
        of = pa.array(np.concatenate([by // wide, np.arange(len(seen))]))
        none = np.zeros(len(seen), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array([key[k] for key in seen], pa.string()).take(of) for k in (0, 1)),
                pa.concat_arrays([names.take(pa.array(by % wide)).cast(pa.string()), pa.nulls(len(seen), pa.string())]),
                pa.array(np.concatenate([n, none])),
                pa.array(np.concatenate([docs, none])),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )


def group_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, term, n, lang_n`` of kept terms in groups that hold them; null ``term``: the group itself."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = rows.mapInArrow(_count_terms, COUNTED)
    # Summed per group first, in every task and then over all: a term that stands in every text is as many
    # rows as it has groups when groups meet.
    summed = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    every = Window.partitionBy("lang", "term")
    return (
        summed.withColumns({"lang_n": F.sum("n").over(every), "held": F.sum("docs").over(every)})
        .where(F.col("term").isNull() | (F.col("held") >= min_docs))
        .select("lang", "source", "term", "n", "lang_n")
    )


def scaled(count: np.ndarray, total: int) -> np.ndarray:
    """``1 + floor(10^9 (count + 2) / total)`` by long division, without overflow."""
    rest, out = np.asarray(count, np.int64) + 2, np.int64(0)
    for _ in range(SCALE_STEPS + 1):
        step, rest = np.divmod(rest, np.int64(total))
        out = out * 1000 + step
        rest = rest * 1000
    return out + 1


def scaled_column(count: Column, total: Column) -> Column:
    """:func:`scaled` in Spark."""
    rest, out = count + 2, F.lit(0).cast("long")
    for _ in range(SCALE_STEPS + 1):
        out = out * 1000 + F.call_function("div", rest, total)
        rest = (rest % total) * 1000
    return out + 1


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q)^2 / (p + q))``."""
    return (p - q) ** 2 // (p + q)


def gallop(short: np.ndarray, long: np.ndarray, run: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common values of two ascending arrays of distinct values.

    The first value of every ``run`` of the shorter array is looked for from where the last one was found, in
    steps that double; the run is then looked up in the stretch between two such places.
    """
    found_short, found_long, low = [], [], 0
    for start in range(0, len(short), run):
        part = short[start : start + run]
        low = _first_from(long, low, part[0])
        high = min(_first_from(long, low, part[-1]) + 1, len(long))
        stretch = long[low:high]
        at = np.searchsorted(stretch, part)
        same = np.flatnonzero(stretch[np.minimum(at, len(stretch) - 1)] == part) if len(stretch) else at[:0]
        found_short.append(start + same)
        found_long.append(low + at[same])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(found_short or none), np.concatenate(found_long or none)


def _first_from(values: np.ndarray, low: int, wanted: int) -> int:
    """The first place from ``low`` on whose value is not below ``wanted``."""
    step, last = 1, low
    while last < len(values) and values[last] < wanted:
        low, last, step = last + 1, last + step, step * 2
    return low + int(np.searchsorted(values[low : min(last, len(values))], wanted))


def _price(left: pa.Table, right: pa.Table) -> pa.Table:
    """What a pair's terms of one block add: their sum, and how many terms that are."""
    sides = [
        [side.column(c).combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("ids", "counts")]
        for side in (left, right)
    ]
    some = (left if left.num_rows else right).drop_columns(["ids", "counts"]).to_pylist()[0]
    totals = some["a_total"], some["b_total"]
    (ids_a, n_a), (ids_b, n_b) = sides
    at_a, at_b = gallop(ids_a, ids_b) if len(ids_a) <= len(ids_b) else gallop(ids_b, ids_a)[::-1]
    p, q = scaled(n_a, totals[0]), scaled(n_b, totals[1])
    p_absent, q_absent = (scaled(np.zeros(1, np.int64), t)[0] for t in totals)
    only_a, only_b = np.ones(len(p), bool), np.ones(len(q), bool)
    only_a[at_a] = only_b[at_b] = False
    value = (
        difference(p[at_a], q[at_b]).sum()
        + difference(p[only_a], q_absent).sum()
        + difference(p_absent, q[only_b]).sum()
    )
    return pa.table(
        {
            "lang": [some["lang"]],
            "a": [some["a"]],
            "b": [some["b"]],
            "value": pa.array([int(value)], pa.int64()),
            "terms": pa.array([len(p) + len(q) - len(at_a)], pa.int64()),
        }
    )


def _pairs(counts: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """``lang, a, b, value``: all unordered pairs of groups of a language, ``a`` before ``b``."""
    terms = counts.where("term is not null")
    dealt = terms.join(groups, ["lang", "source"]).withColumn(
        "block", F.pmod(F.xxhash64("term"), F.greatest(F.lit(1).cast("long"), F.ceil(F.col("v") / block)))
    )
    number = F.dense_rank().over(Window.partitionBy("lang", "block").orderBy("term"))
    held = F.sort_array(F.collect_list(F.struct(F.col("id"), F.col("n"))))
    arrays = (
        dealt.withColumn("id", number)
        .groupBy("lang", "source", "block")
        .agg(held.alias("held"))
        .select("lang", "source", "block", F.col("held.id").alias("ids"), F.col("held.n").alias("counts"))
    )
    arrays = durable(arrays)
    left, right = (
        groups.select("lang", F.col("source").alias(s), F.col("total").alias(f"{s}_total"), "v") for s in ("a", "b")
    )
    pairs = left.join(right.drop("v"), "lang").where("a < b")
    columns = ("lang", "a", "b", "block", "a_total", "b_total", "ids", "counts")
    # Both sides come from one table; aliases tell their columns apart.
    sides = [
        arrays.withColumnRenamed("source", s).join(pairs, ["lang", s]).select([F.col(c).alias(c) for c in columns])
        for s in ("a", "b")
    ]
    keys = ["lang", "a", "b", "block"]
    priced = (
        sides[0].groupBy(*keys).cogroup(sides[1].groupBy(*keys))
        .applyInArrow(_price, "lang string, a string, b string, value long, terms long")
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))
    )
    p, q = (scaled_column(F.lit(0).cast("long"), F.col(f"{s}_total")) for s in ("a", "b"))
    absent = F.call_function("div", (p - q) * (p - q), p + q) * (F.col("v") - F.coalesce("terms", F.lit(0)))
    value = F.when(F.col("v") == 0, F.lit(0).cast("long")).otherwise(F.coalesce("value", F.lit(0)) + absent)
    return pairs.join(priced, ["lang", "a", "b"], "left").select("lang", "a", "b", value.alias("value"))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group: its ``pair`` items and its first ``term`` items."""
    counts = durable(group_counts(docs, min_docs))
    langs = (
        counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_sum"))
    )
    groups = durable(
        counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
        .join(langs, "lang", "left")
        .select(
            "lang", "source", F.coalesce("v", F.lit(0)).alias("v"),
            # Without kept terms there is nothing to divide; 1 keeps the division defined.
            F.greatest(F.col("n") + 2 * F.coalesce("v", F.lit(0)), F.lit(1)).alias("total"),
            F.greatest(F.coalesce("lang_sum", F.lit(0)) + 2 * F.coalesce("v", F.lit(0)), F.lit(1)).alias("lang_total"),
        )
    )
    pair = _pairs(counts, groups, block)
    ends = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pair = pair.select("lang", "value", F.explode(ends).alias("end")).select("lang", "end.source", F.lit("pair").alias("part"), "end.item", "value")
    term = (
        counts.where("n > 0").join(groups, ["lang", "source"])
        .withColumns({"p": scaled_column(F.col("n"), F.col("total")), "q": scaled_column(F.col("lang_n"), F.col("lang_total"))})
        .where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("p") + F.col("q")).alias("value"))
    )
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    term = term.withColumn("rank", ranked).where(F.col("rank") <= top)
    return pair.withColumn("rank", ranked).unionByName(term)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source against every other of its language, and the terms that mark it."""
    return source_divergence(table(spark, sf_dir, "documents"))


OP11_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents),
tokens AS (SELECT doc, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT doc) >= {MIN_DOCS}),
grp AS (SELECT DISTINCT lang, source FROM docs),
v AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM tokens JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counted GROUP BY ALL),
priced AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (coalesce(s.total, 0) + 2 * v.v) AS p
  FROM grp g JOIN kept k USING (lang) JOIN v USING (lang)
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source),
whole AS (
  SELECT lang, term, 1 + (1000000000 * (sum(n)::HUGEINT + 2)) // (sum(sum(n)::HUGEINT) OVER (PARTITION BY lang)::HUGEINT + 2 * any_value(v)) AS q
  FROM counted JOIN v USING (lang) GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
every_pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
marks AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, (((p.p - w.q) * (p.p - w.q)) // (p.p + w.q))::BIGINT AS value
  FROM priced p JOIN whole w ON w.lang = p.lang AND w.term = p.term WHERE p.n > 0 AND p.p > w.q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM every_pair UNION ALL SELECT * FROM marks))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
