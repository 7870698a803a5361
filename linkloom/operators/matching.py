"""Which slices hold records of which entry of the source list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.fixed_values import RESOLVABLE_SLICES, SAFE_PREFIX_LENGTH
from linkloom.functions import safe_prefix
from linkloom.operators.joining import shuffled_anew


def match_sources(source_list: DataFrame, sliced: DataFrame) -> DataFrame:
    """Add safe_prefix and matched_parquets: the slices in which some source_file contains it.

    Every safe prefix is a run of letters, digits and single underscores that starts with a
    letter or digit, ends in an underscore and has at most 81 characters. So the substrings of
    a file name that can equal one are few, and an equality join on them finds exactly the
    names that contain a prefix: its work grows with names plus entries, not with their
    product. Names are made distinct first, which frees a source with most of the rows of its
    weight. Entries without a prefix, or without a match, get an empty list.
    """
    entries = source_list.withColumn("safe_prefix", safe_prefix(F.col("beacon_url")))
    wanted = entries.select("safe_prefix").where(F.col("safe_prefix") != "").distinct()
    names = sliced.select("slice", "source_file").where(F.col("source_file").isNotNull()).distinct()
    found = (
        names.select("slice", F.explode(_prefix_candidates(F.col("source_file"))).alias("safe_prefix"))
        .join(shuffled_anew(wanted), "safe_prefix")
        .distinct()
    )
    place = F.array_position(F.lit(RESOLVABLE_SLICES), F.col("slice"))
    lists = found.groupBy("safe_prefix").agg(
        F.array_sort(F.collect_set(F.struct(place.alias("place"), "slice"))).alias("places")
    )
    return (
        entries.join(shuffled_anew(lists), "safe_prefix", "left")
        .withColumn(
            "matched_parquets",
            F.coalesce(F.col("places.slice"), F.array().cast("array<string>")),
        )
        .select(*source_list.columns, "safe_prefix", "matched_parquets")
    )


def _prefix_candidates(name: Column) -> Column:
    """Distinct substrings of a name that have the form of a safe prefix."""
    runs = F.regexp_extract_all(name, F.lit("[A-Za-z0-9]+(?:_[A-Za-z0-9]+)*_"), F.lit(0))

    def ending_at(run: Column, end: Column) -> Column:
        starts = F.sequence(F.greatest(F.lit(1), end - SAFE_PREFIX_LENGTH), end - 1)
        return F.transform(starts, lambda start: F.substring(run, start, end - start + 1))

    def of_run(run: Column) -> Column:
        ends = F.filter(
            F.sequence(F.lit(2), F.length(run)), lambda i: F.substring(run, i, F.lit(1)) == "_"
        )
        return F.flatten(F.transform(ends, lambda end: ending_at(run, end)))

    candidates = F.flatten(F.transform(runs, of_run))
    return F.array_distinct(F.filter(candidates, lambda c: ~c.startswith("_")))
