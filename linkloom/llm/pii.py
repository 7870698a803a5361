"""Personal data: e-mail addresses, IP addresses, card and phone numbers.

Base patterns find the plain forms. Generators with high recall then propose spans that overlap
freely: addresses with spelt-out or spaced signs, dotted numbers, runs of digits under any grouping
(once as a card, once as a phone number). Features of format (digits, groups, brackets, check digit,
octets) and of context (neighbouring characters, words before) describe a proposal; boosted trees
estimate how likely it is what it is taken for. They learn from proposals of the corpus itself: one that
meets a base span of its kind is positive. Negative are only those that are surely none: a span of another
kind, a wrong check digit, octets above 255, too few or too many digits or parts, digits inside identifiers.
All others, missed forms among them, are neither and train nothing. No feature tells the signs that base patterns
demand (at and plus signs, country codes, the signs between parts), so that forms the base patterns do not
know can look like those they do. A fifth of the documents is held out, and all its labelled proposals
set the threshold of each kind, the lowest at which ``precision`` of those above it are positive. Proposals
without a label that reach the threshold and overlap no base span are added, the likeliest first where they
overlap each other.

Trees are fitted on at most ``fit_rows`` proposals, the smallest by a hash; everything else covers all
of them. The text is read once; spans, proposals and features of a document are kept in its row.

Cases: a null text is empty and has no spans; a null ``doc_id`` and repeated ids are rows like others;
without positive or without negative proposals nothing is added. Positions count code points, ends are
exclusive. Other columns are ignored, and empty input gives empty output.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.tables import durable, table

KINDS = ("email", "ip", "card", "phone")
# Base patterns. Quantifiers are possessive where nothing after them could make them give back, so
# that matching does not recurse on long texts.
BASE = {
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be tried.
HINTS = {"email": "@", "ip": "[0-9][.][0-9]", "card": "[0-9]", "phone": "[+][0-9]"}
PROPOSED = {
    "email": r"[A-Za-z0-9._%+-]++\x20?(?:@|[\[(](?:at|AT)[\])])\x20?[A-Za-z0-9-]++"
    r"(?:\x20?(?:\.|[\[(](?:dot|DOT)[\])])\x20?[A-Za-z0-9-]++)*+",
    "ip": r"[0-9]++(?:\.[0-9]++){2,}+",
    "number": r"[+(]{0,2}[0-9](?:[\x20().-]{0,2}[0-9]){6,}+",
}
PROPOSED_HINTS = {"email": r"@|[\[(](?:at|AT)[\])]", "ip": "[0-9][.][0-9]", "number": "[0-9]"}
AROUND = 24
AT, DOT = r"(?:@|[\[(](?:at|AT)[\])])", r"\.|[\[(](?:dot|DOT)[\])]"
COUNTRY = r"^[(]*\+[0-9]{1,3}[)]?[\x20.-]*(?=[\x20(.-])|^[(]*\+[0-9]{1,3}[\x20.-]+"
IDENTIFIER = r"(?i)[#/_=]$|\b(?:order|invoice|item|serial|isbn|id|no|ref)\b[\x20.:#]*$"
FEATURES = (
    "is_email", "is_ip", "is_card", "is_phone", "digits", "groups", "longest", "brackets", "parts", "check_digit", "octets", "word_before", "word_after",
    "space_before", "stop_after", "named",
)
BINS = 1000


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes_luhn(text: Column) -> Column:
    """Whether the digits of a text, 12 to 19 of them, have a valid check digit."""
    digits = F.reverse(_digits(text))
    doubled = F.transform(
        F.sequence(F.lit(1), F.least(F.length(digits), F.lit(19))),
        lambda i: F.when(i % 2 == 1, F.substr(digits, i, F.lit(1)).cast("int")).otherwise(
            F.substr(digits, i, F.lit(1)).cast("int") * 2
            - F.when(F.substr(digits, i, F.lit(1)).cast("int") > 4, 9).otherwise(0)
        ),
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + x)
    return F.when(F.length(digits).between(12, 19), total % 10 == 0).otherwise(False)


def has_octets(text: Column) -> Column:
    """Whether the numbers between dots are at most 255."""
    return F.forall(
        F.split(text, "[.]"),
        lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
        & (F.coalesce(F.substr(F.ltrim(p, F.lit("0")), F.lit(1), F.lit(3)).try_cast("int"), F.lit(0)) <= 255),
    )


def _matches(text: Column, pattern: str, hint: str) -> Column:
    """Leftmost matches that do not overlap: ``start, end, text`` of each."""
    # \G ties a match to the end of the one before; else the rest of a text after its last match
    # would be searched again from every position.
    with_gap = rf"(?s)\G(.*?)({pattern})"
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(with_gap), F.lit(1)).alias("gap"),
        F.regexp_extract_all(text, F.lit(with_gap), F.lit(2)).alias("hit"),
    )
    empty = F.array().cast("array<struct<start:int,end:int,text:string>>")
    placed = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["gap"]) + F.length(p["hit"])).alias("at"),
            F.concat(
                a["out"],
                F.array(
                    F.struct(
                        (a["at"] + F.length(p["gap"])).alias("start"),
                        (a["at"] + F.length(p["gap"]) + F.length(p["hit"])).alias("end"),
                        p["hit"].alias("text"),
                    )
                ),
            ).alias("out"),
        ),
        lambda a: a["out"],
    )
    return F.when(F.rlike(text, F.lit(hint)), placed).otherwise(empty)


def _base(text: Column) -> Column:
    """Base spans ``start, rank, end``, sorted; ``rank`` is the place of the kind in :data:`KINDS`."""
    valid = {
        "email": lambda m: F.lit(True),
        "ip": lambda m: has_octets(m["text"]),
        "card": lambda m: passes_luhn(m["text"]),
        "phone": lambda m: F.length(_digits(m["text"])).between(9, 15),
    }

    def spans(rank: int, kind: str) -> Column:
        return F.transform(
            F.filter(_matches(text, BASE[kind], HINTS[kind]), valid[kind]),
            lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end")),
        )

    return F.sort_array(F.concat(*[spans(rank, kind) for rank, kind in enumerate(KINDS)]))


def _around(text: Column, m: Column) -> tuple[Column, Column]:
    before = F.substr(text, F.greatest(m["start"] - AROUND, F.lit(0)) + 1, F.least(m["start"], F.lit(AROUND)))
    return before, F.substr(text, m["end"] + 1, F.lit(1))


def _parts(hit: Column) -> Column:
    """Dots after the at sign of an address, spelt out or not."""
    return F.regexp_count(F.regexp_extract(hit, f"{AT}(.*)$", 1), F.lit(DOT))


def _surely_none(text: Column, m: Column, rank: int) -> Column:
    """Whether a proposal cannot be of its kind."""
    hit, (before, after) = m["text"], _around(text, m)
    digits = F.length(_digits(hit))
    inside = F.rlike(before, F.lit(r"[A-Za-z0-9]$")) | F.rlike(after, F.lit("[A-Za-z0-9_]")) | F.rlike(before, F.lit(IDENTIFIER))
    return {
        "email": _parts(hit) == 0,
        "ip": inside | ~has_octets(hit) | (F.size(F.split(hit, "[.]")) != 4),
        "card": inside | ~passes_luhn(hit),
        "phone": inside | ~digits.between(9, 15),
    }[KINDS[rank]]


def _features(text: Column, m: Column, rank: int) -> Column:
    hit, (before, after) = m["text"], _around(text, m)
    if KINDS[rank] == "phone":
        hit = F.regexp_replace(hit, COUNTRY, "")
    groups = F.filter(F.split(hit, "[^0-9]+"), lambda g: g != "")
    flags = [F.lit(rank == k) for k in range(len(KINDS))]
    values = [
        *flags,
        F.length(_digits(hit)),
        F.size(groups),
        F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        F.lit(False) if rank == 0 else F.rlike(hit, F.lit(r"[()\[]")),
        _parts(hit) if rank == 0 else F.lit(0),
        passes_luhn(hit),
        F.lit(False) if rank != 1 else has_octets(hit),
        F.rlike(before, F.lit("[A-Za-z0-9]$")),
        F.rlike(after, F.lit("[A-Za-z0-9]")),
        F.rlike(before, F.lit(r"[\x20\n]$")),
        F.rlike(after, F.lit(r"[\x20\n.,;]")),
        F.rlike(before, F.lit(r"(?i)\b(?:card|visa|account|tel|phone|call|fax|ip|host|server|mail|contact)\b")),
    ]
    return F.array(*[v.cast("double") for v in values])


def _proposals(text: Column) -> Column:
    """Proposed spans ``start, end, rank, none, features``; a run of digits is proposed as two kinds."""

    def spans(source: str, kind: str) -> Column:
        rank = KINDS.index(kind)
        return F.transform(
            _matches(text, PROPOSED[source], PROPOSED_HINTS[source]),
            lambda m: F.struct(
                m["start"].alias("start"),
                m["end"].alias("end"),
                F.lit(rank).alias("rank"),
                _surely_none(text, m, rank).alias("none"),
                _features(text, m, rank).alias("features"),
            ),
        )

    return F.concat(
        spans("email", "email"), spans("ip", "ip"), spans("number", "card"), spans("number", "phone")
    )


def found_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, id, base, proposals`` of every document; ``id`` tells rows apart."""
    # Only texts that hold a digit or an at sign can have a span.
    text = F.coalesce(F.col("text"), F.lit(""))
    text = F.when(F.rlike(text, F.lit(r"[0-9@]|[\[(](?:at|AT)[\])]")), text).otherwise(F.lit(""))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return durable(
        given.select(
            "doc_id",
            F.monotonically_increasing_id().alias("id"),
            _base(F.col("text")).alias("base"),
            _proposals(F.col("text")).alias("proposals"),
        )
    )


def labelled_proposals(found: DataFrame) -> DataFrame:
    """A row per proposal with its features; label 1 if it meets a base span of its kind, 0 if surely none."""
    meets = F.exists(
        "base", lambda b: (b["rank"] == F.col("p.rank")) & (b["start"] < F.col("p.end")) & (F.col("p.start") < b["end"])
    )
    taken = F.exists("base", lambda b: (b["start"] < F.col("p.end")) & (F.col("p.start") < b["end"]))
    return found.select("id", "doc_id", "base", F.explode("proposals").alias("p")).select(
        "id",
        (F.pmod(F.xxhash64(F.lit("held out"), "doc_id"), F.lit(5)) == 0).alias("held_out"),
        F.col("p.start").alias("start"),
        F.col("p.end").alias("end"),
        F.col("p.rank").alias("rank"),
        F.when(meets, 1.0).when(taken | F.col("p.none"), 0.0).alias("label"),
        *[F.col("p.features")[k].alias(name) for k, name in enumerate(FEATURES)],
    )


def fit_trees(proposals: DataFrame, fit_rows: int = 20_000, rounds: int = 12, depth: int = 4) -> GBTClassificationModel | None:
    """Boosted trees on at most ``fit_rows`` labelled proposals of documents that are not held out."""
    sample = durable(
        proposals.where("not held_out and label is not null").orderBy(F.xxhash64("id", "start", "end", "rank"), "id", "start", "end", "rank").limit(fit_rows)
    )
    if len(sample.select("label").distinct().take(2)) < 2:
        return None
    trees = GBTClassifier(labelCol="label", featuresCol="vector", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=1)
    return trees.fit(VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(sample))


def scored(proposals: DataFrame, model: GBTClassificationModel) -> DataFrame:
    """Proposals with their ``score`` between 0 and 1."""
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(proposals)
    return model.transform(vectors).select(
        "id", "held_out", "start", "end", "rank", "label", vector_to_array("probability")[1].alias("score")
    )


def thresholds(scores: DataFrame, precision: float = 0.99) -> list[float]:
    """By kind, the lowest score above which labelled held-out proposals are positive with ``precision``."""
    bins = (
        scores.where("held_out and label is not null")
        .groupBy("rank", F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).alias("bin"))
        .agg(F.sum("label").alias("good"), F.count("*").alias("n"))
        .collect()
    )
    limits = []
    for rank in range(len(KINDS)):
        good = n = 0
        limit = float("inf")
        for row in sorted((r for r in bins if r["rank"] == rank), key=lambda r: -r["bin"]):
            good, n = good + row["good"], n + row["n"]
            if good >= precision * n:
                limit = row["bin"] / BINS
        limits.append(limit)
    return limits


def _chosen(added: Column) -> Column:
    """Of proposals sorted by falling score those that overlap none before."""
    empty = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    return F.aggregate(
        added,
        empty,
        lambda kept, x: F.when(
            F.exists(kept, lambda k: (k["start"] < x["end"]) & (x["start"] < k["end"])), kept
        ).otherwise(F.concat(kept, F.array(F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"))))),
    )


def pii_spans(docs: DataFrame, fit_rows: int = 20_000, precision: float = 0.99) -> DataFrame:
    """``doc_id, base, spans`` of every document: arrays of ``start, rank, end``, sorted."""
    found = found_spans(docs)
    proposals = durable(labelled_proposals(found))
    model = fit_trees(proposals, fit_rows)
    if model is None:
        return found.select("doc_id", "base", F.col("base").alias("spans"))
    scores = durable(scored(proposals, model))
    limits = F.array(*[F.lit(x) for x in thresholds(scores, precision)])
    added = (
        scores.where(F.col("label").isNull() & (F.col("score") >= F.element_at(limits, F.col("rank") + 1)))
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("order"), "start", "end", "rank"))).alias("added"))
    )
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(
        F.sort_array(F.concat("base", _chosen(F.col("added"))))
    )
    return found.join(durable(added), "id", "left").select("doc_id", "base", spans.alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in angle brackets; overlaps are one span."""
    names = F.array(*map(F.lit, KINDS))
    out = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    a["out"],
                    F.substr(text, a["at"] + 1, s["start"] - a["at"]),
                    F.lit("<"),
                    F.element_at(names, s["rank"] + 1),
                    F.lit(">"),
                ).alias("out"),
            )
        ),
    )
    return F.concat(out["out"], F.substr(text, out["at"] + 1))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document: numbers of base spans by kind, their digest, and all spans."""
    spans = pii_spans(table(spark, sf_dir, "documents"))

    def count(rank: int) -> Column:
        return F.size(F.filter("base", lambda b: b["rank"] == rank)).cast("long")

    return spans.select(
        "doc_id", *[count(rank).alias(f"n_{kind}") for rank, kind in enumerate(KINDS)], F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans")
    )
