"""Quality rules: an isolation forest over rule statistics of documents.

Every text gets counts (words, symbols, repeated lines and windows, ...). Ratios of these counts are
isolated by random splits: trees are grown on small random samples of labelled documents, and a
document that few splits separate from the rest is anomalous. Bad rows are rare among those the trees
are grown on, whatever their share of the labels: many of a kind would hide each other. The threshold
comes from the scores of all labelled rows of both classes: of those that reject at most
``max_good_rejected`` of the good ones, the one with the least sum of the shares of good rows rejected and
bad rows kept.

Cases: a null or empty text has no words and fails the base rule; a null ``doc_id`` gets a row like any
other but never has a label; rows with the same id are judged one by one; labels that are null or
belong to no document are ignored, several labels of a document all count. Without good or without bad
labels nothing is rejected beyond the base rule. Empty input gives empty output. Extra columns are
kept by :func:`filter_documents` whatever their names, and ignored by :func:`quality_rules`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.tables import durable, table
from linkloom.llm.text_blocks import (
    WHITE,
    Block,
    blocks,
    find_words,
    hash_spans,
    hash_windows,
    mix,
    window_starts,
)

SYMBOLS = b"#*$%&|<>"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks",
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
BINS = 10_000
#: Bad rows for each good one that trees are grown on.
BAD_SHARE = 0.02

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_MARK = np.zeros(256, bool)
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True
_MARK &= ~_SYMBOL
_CHAR = np.ones(256, bool)
_CHAR[0x80:0xC0] = False
_CHAR &= ~WHITE


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every key, whether it is found elsewhere and whether it is found before."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return twice, later


def block_counts(block: Block) -> dict[str, np.ndarray]:
    """:data:`COUNTS` of the texts of a block."""
    data, offsets = block.data, block.offsets
    texts = np.arange(len(offsets) - 1)
    words = find_words(data, offsets)
    hashes = hash_spans(data, words.starts, words.ends)
    word_text = np.repeat(texts, words.counts)
    salt = mix(word_text.astype(np.uint64))

    starts, counts = window_starts(words.of, 3)
    keys = mix(hash_windows(hashes, 3)[starts] ^ salt[starts]) if len(starts) else hashes[:0]
    twice, _ = _repeats(keys)
    repeated = np.zeros(len(hashes), bool)
    for k in range(3):
        repeated[starts[twice] + k] = True

    # Lines start at the start of a text and after every line feed; empty ones hold no word.
    edges = np.union1d(offsets[:-1], np.flatnonzero(data == 10) + 1)
    edges = edges[edges < len(data)]
    line_text = np.searchsorted(offsets, edges, "right") - 1
    ends = np.append(edges[1:], len(data))[: len(edges)]
    ends = ends - (data[ends - 1] == 10)
    held = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, edges)
    line_text = line_text[held]
    lines = mix(hash_spans(data, edges[held], ends[held]) ^ mix(line_text.astype(np.uint64)))
    _, later = _repeats(lines)

    return {
        "n_words": words.counts,
        "word_chars": _per_text(_CHAR[data], offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(line_text[later], minlength=len(texts)),
        "n_repeat_words": _per_text(repeated, words.of),
        "n_upper": _per_text(_UPPER[data], offsets),
        "n_marks": _per_text(_MARK[data], offsets),
    }


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Logarithms of ratios of rule statistics, a row per document.

    A split between nothing and little is then as likely as one between little and much.

    Length and repetition are left to the base rule: short and repetitive good texts are rare,
    so that a forest would take them for junk.
    """
    c = {k: v.astype(np.float64) for k, v in counts.items()}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    return np.log1p(
        1000
        * np.column_stack(
            [c["word_chars"] / words, c["n_symbols"] / words, c["n_upper"] / chars, c["n_marks"] / words]
        )
    )


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Too few words, or too many of them in repeated windows."""
    return (counts["n_words"] < MIN_WORDS) | (
        100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]
    )


def _usual_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, np.float64)
    safe = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees in heap order: feature (-1 at leaves), threshold and path length of every node."""

    feature: np.ndarray
    threshold: np.ndarray
    path: np.ndarray
    usual: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the larger the more anomalous."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, threshold, path in zip(self.feature, self.threshold, self.path, strict=True):
            node = np.zeros(len(x), np.int64)
            while True:
                f = feature[node]
                open_ = f >= 0
                if not open_.any():
                    break
                right = x[rows, np.maximum(f, 0)] >= threshold[node]
                node = np.where(open_, 2 * node + 1 + right, node)
            total += path[node]
        return np.exp2(-total / (len(self.feature) * self.usual))


def grow_forest(x: np.ndarray, trees: int = 100, sample: int = 256, seed: int = 7) -> Forest:
    """Random trees, each on ``sample`` rows of ``x``."""
    random = np.random.default_rng(seed)
    sample = min(sample, len(x))
    depth = max(1, int(np.ceil(np.log2(max(sample, 2)))))
    size = 2 ** (depth + 1) - 1
    feature = np.full((trees, size), -1)
    threshold, path = np.zeros((trees, size)), np.zeros((trees, size))
    for t in range(trees):
        todo = [(0, 0, random.choice(len(x), sample, replace=False))]
        while todo:
            node, level, rows = todo.pop()
            low, high = x[rows].min(0), x[rows].max(0)
            open_ = np.flatnonzero(high > low)
            if level == depth or len(rows) < 2 or not len(open_):
                path[t, node] = level + float(_usual_path(len(rows)))
                continue
            f = random.choice(open_)
            cut = random.uniform(low[f], high[f])
            cut = cut if cut > low[f] else high[f]
            feature[t, node], threshold[t, node] = f, cut
            right = x[rows, f] >= cut
            todo += [(2 * node + 1, level + 1, rows[~right]), (2 * node + 2, level + 1, rows[right])]
    return Forest(feature, threshold, path, float(_usual_path(sample)))


def document_counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and :data:`COUNTS` of every document, from one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            counts = block_counts(block)
            yield pa.RecordBatch.from_arrays(
                [block.rows.column("doc_id"), *(pa.array(counts[c].astype(np.int64)) for c in COUNTS)],
                names=["doc_id", *COUNTS],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    )


def _counts_of(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {c: batch.column(c).to_numpy(zero_copy_only=False) for c in COUNTS}


def _scored(counts: DataFrame, forest: Forest | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _counts_of(batch)
            score = forest.score(features(values)) if forest else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(base_failed(values)), pa.array(score)],
                names=[*batch.schema.names, "base_failed", "score"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counts.schema.fields)
    return counts.mapInArrow(run, f"{fields}, base_failed boolean, score double")


@dataclass
class Verdict:
    """A fitted forest and its threshold: documents that score above it are rejected."""

    forest: Forest | None
    threshold: float


def fit(
    counts: DataFrame,
    labels: DataFrame,
    fit_rows: int = 4096,
    max_good_rejected: float = 0.005,
    trees: int = 100,
    sample: int = 256,
    seed: int = 7,
) -> Verdict:
    """The forest, grown on at most ``fit_rows`` labelled rows, and the threshold.

    ``fit_rows`` bounds what reaches the driver; trees look at ``sample`` rows each. The threshold
    is read off a histogram of the scores of all labelled rows.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").select(
        F.col("doc_id").cast("long").alias("doc_id"), "quality"
    )
    labelled = durable(
        counts.where(f"n_words >= {MIN_WORDS} and 100 * n_repeat_words <= {MAX_REPEAT_PERCENT} * n_words")
        .join(known, "doc_id")
        .select("doc_id", "quality", *COUNTS)
    )
    rows = (
        labelled.orderBy(F.xxhash64(F.lit(seed), "doc_id"), *COUNTS)
        .limit(fit_rows)
        .select("quality", *COUNTS)
        .toPandas()
    )
    if len(rows) < 2:
        return Verdict(None, np.inf)
    is_good = rows.quality == 1
    if is_good.any():
        rare = max(1, round(BAD_SHARE * is_good.sum()))
        rows = rows[is_good | ((~is_good).cumsum() <= rare)]
    forest = grow_forest(features({c: rows[c].to_numpy() for c in COUNTS}), trees, sample, seed)
    histogram = (
        _scored(labelled, forest)
        .groupBy(F.floor(F.col("score") * BINS).alias("bin"), "quality")
        .count()
        .toPandas()
    )
    good, bad = np.zeros(BINS + 2), np.zeros(BINS + 2)
    for counted, quality in ((good, 1), (bad, 0)):
        rows = histogram[histogram.quality == quality]
        np.add.at(counted, rows.bin.to_numpy(np.int64), rows["count"])
    if not good.any() or not bad.any():
        return Verdict(forest, np.inf)
    rejected, kept = 1 - np.cumsum(good) / good.sum(), np.cumsum(bad) / bad.sum()
    error = np.where(good.sum() - np.cumsum(good) <= max_good_rejected * good.sum(), rejected + kept, np.inf)
    best = np.flatnonzero(error <= error.min() + 1e-12)
    return Verdict(forest, float(best[len(best) // 2] + 1) / BINS)


def quality_rules(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Every document's counts, ``base_failed``, anomaly ``score`` and whether it is ``kept``."""
    counts = durable(document_counts(docs))
    verdict = fit(counts, labels, **settings)
    return _scored(counts, verdict.forest).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") <= F.lit(verdict.threshold))
    )


def filter_documents(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The documents that :func:`quality_rules` keeps, with all their columns.

    Texts are read a second time instead of being shuffled to meet their verdicts.
    """
    verdict = fit(durable(document_counts(docs)), labels, **settings)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, place):
            counts = block_counts(block)
            keep = ~base_failed(counts)
            if verdict.forest:
                keep &= verdict.forest.score(features(counts)) <= verdict.threshold
            yield block.rows.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score",
    )
