"""Mixing of sources to target weights, with sizes counted in words.

Documents get hash-random keys and are sorted by key within their source. The sort is by range: a key
is a digest in hex, so that its first digits name one of 4096 equal ranges, and a source of any size is
dealt over all of them. Sums per range, added up along the ranges of each source, give every
document the words before it; a document is taken if its middle comes before its source's budget.
Where the budget is larger than the source, all documents are taken for every full epoch before.

Targets: sources share the words of all documents by weight. Where that is more than ``epochs`` times
what a source has, it gets that much, and the excess is shared by the others in the same way: the level
at which sources are cut off is found from sums over sources sorted by size per weight. Sources are the
only rows that meet in one task.

Cases: a null text has size 0, and documents without words are never taken; null is a source of its
own, last in the order; a null ``doc_id`` has a key like any other; repeated rows are taken one by one.
Columns of the input are kept; those with the names of results are replaced in :func:`mix_sizes` and
kept in :func:`mixed_documents`. Empty input gives empty output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm.tables import durable, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
EPOCHS = 3
SEED = 42


def word_count(text: Column) -> Column:
    """How many words a text has; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(
        row.alias("row"),
        word_count(F.col("text")).alias("size"),
        F.struct(F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name")).alias("of"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))).alias("key"),
    )
    return keyed.withColumn("range", F.substring("key", 1, 3))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``of, source_size, target`` of the sources in ``of, source_size``."""
    by_name = Window.orderBy("of")
    by_ratio = Window.orderBy("ratio", "of")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("double"))
    level = (
        weighed.withColumn("ratio", epochs * F.col("source_size") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(every) - epochs * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("shares", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("shares"))
    )
    cut = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "of", "level"))).over(every)
    return level.withColumn("cut", cut).select(
        "of",
        "source_size",
        F.when(
            F.struct("ratio", "of") < F.struct("cut.ratio", "cut.of"), (epochs * F.col("source_size")).cast("double")
        ).otherwise(F.col("cut.level") * F.col("weight")).alias("target"),
    )


def _mixed(keyed: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    ranges = durable(keyed.groupBy("of", "range").agg(F.sum("size").alias("range_size")))
    targets = source_targets(ranges.groupBy("of").agg(F.sum("range_size").alias("source_size")), weights, epochs)
    along = Window.partitionBy("of").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = durable(
        ranges.withColumn("offset", F.coalesce(F.sum("range_size").over(along), F.lit(0)))
        .join(targets, "of")
        .select("of", "range", "offset", "source_size", "target")
    )
    inside = Window.partitionBy("of", "range").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    middle = F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.col("size") / 2
    return (
        keyed.join(offsets, ["of", "range"])
        .withColumn("full", full)
        .withColumn("copies", F.col("full") + (middle < F.col("target") - F.col("full") * F.col("source_size")).cast("int"))
        .withColumn("copies", F.when(F.col("size") > 0, F.col("copies")).otherwise(F.lit(0)).cast("long"))
    )


def mix_sizes(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """Documents without their texts, with ``size, source_size, target, taken``."""
    slim = docs.drop("text", "size", "source_size", "target", "taken").columns
    keyed = durable(_keyed(docs, seed).withColumn("row", F.struct(*[F.col(f"row.`{c}`") for c in slim])))
    return _mixed(keyed, weights, epochs).select(
        "row.*", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their columns."""
    taken = _mixed(_keyed(docs, seed), weights, epochs).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).select("row.*")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes, targets and what the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_sizes(docs).drop("source")


OP6_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([1.0::DOUBLE, 2.0, 3.0])[((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source),
ratios AS (
  SELECT *, {EPOCHS} * source_size / weight AS ratio,
         row_number() OVER (ORDER BY {EPOCHS} * source_size / weight, source NULLS LAST) AS place FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () - {EPOCHS} * coalesce(sum(source_size) OVER w, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM ratios WINDOW w AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cut AS (SELECT min(place) AS place, arg_min(level, place) AS level FROM levels WHERE level <= ratio),
targets AS (
  SELECT l.source, l.source_size,
         CASE WHEN l.place < cut.place THEN ({EPOCHS} * l.source_size)::DOUBLE ELSE cut.level * l.weight END AS target
  FROM levels l, cut),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS whole
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN size > 0 THEN size * (whole + CASE WHEN before + size / 2 < target - whole * source_size THEN 1 ELSE 0 END)
             ELSE 0 END)::BIGINT AS taken
FROM placed
"""
