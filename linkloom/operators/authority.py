"""Entity types from an authority dump."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.fixed_values import EXAMPLE_ROWS
from linkloom.functions import bare_id, entity_type
from linkloom.operators.hot_keys import HOT_SHARE, dealt, hot_keys, repeated
from linkloom.operators.joining import shuffled_anew


def candidate_ids(records: DataFrame, normalize: bool = False) -> DataFrame:
    """Distinct authority ids in use, as they stand in the records or in bare form."""
    gnd = bare_id(F.col("authority_id")) if normalize else F.col("authority_id")
    return records.select(gnd.alias("gnd")).where(F.col("gnd").isNotNull()).distinct()


def dump_ids(dump: DataFrame) -> DataFrame:
    """Every current and every old id of every entry: gnd, rank (0 current, 1 old), id, types.

    Both kinds come out of one scan of the dump.
    """
    current = F.array(F.struct(F.lit(0).alias("rank"), F.col("id").alias("raw_id")))
    old = F.transform(
        F.coalesce("oldAuthorityNumber", F.array().cast("array<string>")),
        lambda number: F.struct(F.lit(1).alias("rank"), number.alias("raw_id")),
    )
    return dump.select("id", F.col("type").alias("types"), F.inline(F.concat(current, old))).select(
        bare_id(F.col("raw_id")).alias("gnd"), "rank", "id", "types"
    )


def authority_types(dump: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """One type and one sorted type list per bare id: gnd, gnd_type, gnd_type_list.

    Where several entries carry the same id, a current id goes before an old one, then the
    smaller entry id; the list is that of the first entry that has one. ``candidates`` limits
    the result to ids in use. Ids are grouped before they meet the candidates: both sides then
    lie partitioned by id with one row each, so the join moves nothing and has no hot key.
    """
    entry = F.struct("rank", "id", "types")
    best = (
        dump_ids(dump)
        .where(F.col("gnd").isNotNull())
        .groupBy("gnd")
        .agg(
            F.min(entry).alias("first"),
            F.min(F.when(F.col("types").isNotNull(), entry)).alias("listed"),
        )
    )
    if candidates is not None:
        best = best.join(candidates.select("gnd").distinct(), "gnd")
    return best.select(
        "gnd",
        entity_type(F.col("first.types")).alias("gnd_type"),
        F.array_sort("listed.types").alias("gnd_type_list"),
    )


def attach_types(records: DataFrame, types: DataFrame, hot: Sequence[str] = ()) -> DataFrame:
    """Left join of records to types on the bare id; no match gives NULL and an empty list.

    ``types`` has one row per id, so the number of rows stays. The strategy is left to Spark:
    a small type table is broadcast, otherwise both sides are shuffled on the bare id and
    the ids that hold most of the records are split over several tasks. For the split
    ``types`` must be a stored table or ``shuffled_anew``. Ids in ``hot`` (see ``hot_keys``), and records
    without an id, are dealt over tasks in any case, with adaptive execution or without it.
    """
    keyed = records.withColumn("bare_authority_id", bare_id(F.col("authority_id")))
    types = types.select(F.col("gnd"), "gnd_type", "gnd_type_list")
    on = keyed["bare_authority_id"] == types["gnd"]
    if hot:
        keyed = dealt(keyed, F.col("bare_authority_id"), hot)
        types = repeated(types, F.col("gnd"), hot)
        on = (keyed["bare_authority_id"] == types["gnd"]) & (keyed["way"] == types["way"])
    joined = keyed.join(types, on, "left").withColumn(
        "gnd_type_list", F.coalesce("gnd_type_list", F.array().cast("array<string>"))
    )
    if hot:
        joined = joined.drop(keyed["way"], types["way"])
    return joined.drop("bare_authority_id", "gnd")


def hot_ids(records: DataFrame, share: float = HOT_SHARE) -> list[str]:
    """Bare authority ids that hold at least ``share`` of the records with an id."""
    return hot_keys(records, bare_id(F.col("authority_id")), share)


def enrich_types(
    records: DataFrame, dump: DataFrame, normalize_candidates: bool = False
) -> DataFrame:
    """Records with gnd_type and gnd_type_list.

    By default an id that records carry only in URI or ``(DE-588)`` form finds no type: ids in
    use are compared with the dump as they stand. ``normalize_candidates`` compares bare forms
    on both sides, and limits the dump to those in use.
    """
    candidates = candidate_ids(records, normalize_candidates)
    return attach_types(records, shuffled_anew(authority_types(dump, candidates)))


def match_coverage(enriched: DataFrame) -> DataFrame:
    """One row: records, records with a type, records without."""
    counts = enriched.agg(
        F.count(F.lit(1)).alias("total"), F.count("gnd_type").alias("matched")
    )
    return counts.withColumn("unmatched", F.col("total") - F.col("matched"))


def examples_per_source(enriched: DataFrame, matched: bool, n: int = EXAMPLE_ROWS) -> DataFrame:
    """One example row per source, with or without a type, for the first ``n`` sources.

    The example is the smallest row. The minimum combines before the shuffle, where a row number
    would bring all records of a source to one task; sources are limited after it, so that an
    enriched table that is not stored is computed once.
    """
    state = F.col("gnd_type").isNotNull() if matched else F.col("gnd_type").isNull()
    return (
        enriched.where(state)
        .groupBy("beacon_uri")
        .agg(F.min(F.struct("authority_id", "gnd_type", "gnd_type_list")).alias("example"))
        .select("example.*", "beacon_uri")
        .orderBy(F.asc_nulls_first("beacon_uri"))
        .limit(n)
    )
