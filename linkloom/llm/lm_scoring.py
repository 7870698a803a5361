"""LM scoring: the difference of cross-entropies under a target and a background n-gram model.

Both models are interpolated bigram models over one vocabulary: every word that occurs at least
``min_count`` times in all documents, one symbol for all rarer words and one for the start of a text.
The background model counts all documents, the target model those labelled good. A document's score
is the mean over its words of loss under the target model less loss under the background model, in
nats: the lower, the more it resembles the target.

Words and pairs of both models are tables dealt over buckets by hash; neither is ever in one place.
Texts are cut into blocks of tokens, kept by block. A block asks each bucket for the words, then for the
pairs, that it holds, each once with its own counts; the bucket sums what all blocks sent and answers
every block in the order of its question. The driver sees the seven totals of the vocabulary only.

Cases: null, empty and wordless texts have ``n_words`` 0 and null losses; a null ``doc_id`` is scored
and never a target; documents of one id are scored one by one and are all targets if one label of
that id is 1; without targets the target model is uniform. Empty input gives empty output; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.tables import durable, partitions, table
from linkloom.llm.text_blocks import LOWER, blocks, find_words, hash_spans, mix

#: A word that occurs less often in all documents is scored as the one unknown word.
MIN_COUNT = 2
BLOCK_BYTES = 8 << 20
WEIGHT, ADDED = 0.7, 0.5
#: Symbols beside the hashes of words.
START, UNKNOWN = np.uint64(0), np.uint64(1)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)

TOKENS = "block long, ids binary, known binary, sizes binary, words binary, codes binary"
ASKED = "bucket int, block long, keys binary, counts binary"
NEWS = "block long, kind int, place long, body binary"
TARGET, WORDS, PAIRS, TABLE = range(4)


def _packed(values: np.ndarray) -> bytes:
    """Compressed by planes: first bytes of all numbers, then second ones, so that equal upper bytes lie together."""
    values = np.ascontiguousarray(values).ravel()
    body = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def _unpacked(body: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(body[:8], "little")
    planes = np.frombuffer(pa.decompress(body[8:], size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _packed_sorted(keys: np.ndarray) -> bytes:
    """Sorted hashes as differences, whose upper bytes are zero."""
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_sorted(body: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(body, np.uint64), dtype=np.uint64)


def _arrow(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[name for name, _ in fields]
    )


def token_blocks(docs: DataFrame) -> DataFrame:
    """:data:`TOKENS` of ``doc_id, text``, dealt by block: words as places in the block's own sorted list."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block_id = TaskContext.get().partitionId() << 32
        for block in blocks(batches, limit=BLOCK_BYTES):
            data = LOWER[block.data]
            found = find_words(data, block.offsets)
            words, codes = np.unique(hash_spans(data, found.starts, found.ends), return_inverse=True)
            ids = block.rows.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            ids, known, sizes = map(_packed, (ids.astype(np.int64), known, found.counts.astype(np.int64)))
            yield _arrow(TOKENS, [(block_id, ids, known, sizes, _packed_sorted(words), _packed(codes.astype(np.int32)))])
            block_id += 1

    conf = docs.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled")
    # Adaptive plans do not say how a checkpoint is dealt; blocks would be shuffled again at every use.
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return durable(docs.mapInArrow(cut, TOKENS).repartition(partitions(docs.sparkSession), "block"))
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def target_places(tokens: DataFrame, targets: DataFrame) -> DataFrame:
    """:data:`NEWS` of the documents that are targets: their places in their blocks."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, known in zip(*(batch.column(c).to_pylist() for c in ("block", "ids", "known")), strict=True):
                known = np.flatnonzero(_unpacked(known, bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(known), block)), pa.array(known), pa.array(_unpacked(ids, np.int64)[known])],
                    names=["block", "place", "doc_id"],
                )

    places = tokens.select("block", "ids", "known").mapInArrow(listed, "block long, place long, doc_id long")
    # By a shuffle at every size: the targets grow with the documents.
    return durable(
        places.join(targets.hint("shuffle_merge"), "doc_id", "left_semi").select(
            "block", F.lit(TARGET).alias("kind"), "place", F.lit(None).cast("binary").alias("body")
        )
    )


def _order(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ``keys`` in the order in which buckets are asked for them, and where each bucket starts."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _asked(block: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> list[tuple]:
    """Rows of :data:`ASKED`; the bucket is the remainder of its keys, of which the quotients travel."""
    order, edges = _order(keys, buckets)
    keys, counts = keys[order] // np.uint64(buckets), counts[:, order]
    return [
        (int(b), block, _packed_sorted(keys[edges[b] : edges[b + 1]]), _packed(counts[:, edges[b] : edges[b + 1]]))
        for b in np.flatnonzero(np.diff(edges))
    ]


def _answered(keys: np.ndarray, news: list[tuple[int, bytes]], columns: int, buckets: int) -> np.ndarray:
    """The totals of ``keys``, a row per column, out of the answers of the buckets."""
    out = np.zeros((columns, len(keys)), np.int64)
    order, edges = _order(keys, buckets)
    for b, body in news:
        out[:, order[edges[b] : edges[b + 1]]] = _unpacked(body, np.int64).reshape(columns, -1)
    return out


def answers(asked: DataFrame, kind: int, columns: int, buckets: int) -> DataFrame:
    """:data:`NEWS` with the totals that each block asked for; of words also each bucket's table."""

    def add(group: pa.Table) -> pa.Table:
        bucket, blocks_ = group.column("bucket")[0].as_py(), group.column("block").to_pylist()
        parts = [_unpacked_sorted(x.as_py()) * np.uint64(buckets) + np.uint64(bucket) for x in group.column("keys")]
        counts = np.concatenate(
            [_unpacked(x.as_py(), np.int64).reshape(columns, -1) for x in group.column("counts")], axis=1
        )
        keys, of = np.unique(np.concatenate(parts), return_inverse=True)
        totals = np.stack([np.bincount(of, c, len(keys)).astype(np.int64) for c in counts])
        ends = np.cumsum([len(x) for x in parts])
        rows = [
            (block, kind, bucket, _packed(totals[:, of[end - len(x) : end]]))
            for block, x, end in zip(blocks_, parts, ends, strict=True)
        ]
        if kind == WORDS:
            rows.append((-1, TABLE, bucket, _packed(np.concatenate([keys.view(np.int64), totals.ravel()]))))
        return pa.Table.from_batches([_arrow(NEWS, rows)])

    return asked.groupBy("bucket").applyInArrow(add, NEWS)


@dataclass
class Vocabulary:
    """The rule for words, and totals: distinct words, then occurrences and contexts of unknown ones
    and occurrences of all, in all documents and in targets."""

    least: int
    last: int
    size: int = 0
    unknown: tuple = (0, 0, 0, 0)
    total: tuple = (0, 0)

    def holds(self, keys: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (keys == START) | (n > self.least) | ((n == self.least) & (keys.view(np.int64) <= self.last))


def vocabulary(words: DataFrame, min_count: int, size: int | None) -> Vocabulary:
    """The words that occur ``min_count`` times, or else the ``size`` most frequent; ties go to the smaller."""

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for body in batch.column("body").to_pylist():
                values = _unpacked(body, np.int64).reshape(5, -1)
                yield values[0], values[1:]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in bodies(batches):
            real = keys.view(np.uint64) != START
            yield pa.RecordBatch.from_arrays([pa.array(keys[real]), pa.array(counts[0][real])], names=["word", "n"])

    tables = words.where(F.col("kind") == TABLE).select("body")
    out = Vocabulary(min_count, 2**63 - 1)
    if size is not None:
        top = tables.mapInArrow(listed, "word long, n long").orderBy(F.desc("n"), "word").limit(size)
        last = top.orderBy("n", F.desc("word")).first()
        out = Vocabulary(last.n, last.word) if last else out
    names = ("size", "n", "n_good", "context", "context_good", "total", "total_good")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in bodies(batches):
            keys = keys.view(np.uint64)
            held = out.holds(keys, counts[0])
            values = [(held & (keys != START)).sum(), *counts[:, ~held].sum(1), *counts[:2].sum(1)]
            yield pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in values], names=list(names))

    sums = tables.mapInArrow(counted, ", ".join(f"{x} long" for x in names)).agg(
        *[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in names]
    )
    got = list(sums.first())
    return Vocabulary(out.least, out.last, got[0], tuple(got[1:5]), tuple(got[5:]))


class _Texts:
    """A block's tokens, with what it was told."""

    def __init__(self, tokens: pa.Table, news: pa.Table, buckets: int):
        kinds = {"ids": np.int64, "known": bool, "sizes": np.int64, "codes": np.int32}
        for name, kind in kinds.items():
            setattr(self, name, _unpacked(tokens.column(name)[0].as_py(), kind))
        self.words = _unpacked_sorted(tokens.column("words")[0].as_py())
        self.block, self.buckets = tokens.column("block")[0].as_py(), buckets
        self.news = {kind: [] for kind in (TARGET, WORDS, PAIRS)}
        for kind, place, body in zip(*(news.column(c).to_pylist() for c in ("kind", "place", "body")), strict=True):
            self.news[kind].append((place, body))
        # The start is one more word, which precedes the first word of every text.
        self.words = np.append(self.words, START)
        self.of = np.concatenate([[0], np.cumsum(self.sizes)])
        self.first = self.of[:-1][self.sizes > 0]
        self.before = np.empty_like(self.codes)
        self.before[1:] = self.codes[:-1]
        self.before[self.first] = len(self.words) - 1
        chosen = np.zeros(len(self.sizes), bool)
        chosen[[place for place, _ in self.news[TARGET]]] = True
        self.good = np.repeat(chosen, self.sizes)

    def asked_words(self) -> list[tuple]:
        n = len(self.words)
        counts = [np.bincount(x[y], minlength=n) for x in (self.codes, self.before) for y in (slice(None), self.good)]
        order = np.argsort(self.words)
        return _asked(self.block, self.words[order], np.stack(counts)[:, order].astype(np.int64), self.buckets)

    def pairs(self, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
        """Sorted pairs and the pair of every token; ``counts`` of words are set, unknown ones alike."""
        order = np.argsort(self.words)
        self.counts = np.empty((4, len(order)), np.int64)
        self.counts[:, order] = _answered(self.words[order], self.news[WORDS], 4, self.buckets)
        held = vocab.holds(self.words, self.counts[0])
        self.counts[:, ~held] = np.array(vocab.unknown)[:, None]
        symbols = np.where(held, self.words, UNKNOWN)
        keys = mix(symbols[self.before] * _A + mix(symbols[self.codes] + _B))
        return np.unique(keys, return_inverse=True)

    def asked_pairs(self, vocab: Vocabulary) -> list[tuple]:
        keys, of = self.pairs(vocab)
        counts = np.stack([np.bincount(of, minlength=len(keys)), np.bincount(of[self.good], minlength=len(keys))])
        return _asked(self.block, keys, counts.astype(np.int64), self.buckets)

    def scores(self, vocab: Vocabulary) -> pa.Table:
        keys, of = self.pairs(vocab)
        counts = _answered(keys, self.news[PAIRS], 2, self.buckets)
        means = []
        for kind in (1, 0):
            words, contexts = self.counts[kind], self.counts[2 + kind]
            alone = (words + ADDED) / (vocab.total[kind] + ADDED * (vocab.size + 1))
            before = contexts[self.before]
            share = np.where(before > 0, WEIGHT, 0.0)
            loss = -np.log(share * counts[kind][of] / np.maximum(before, 1) + (1 - share) * alone[self.codes])
            total = np.concatenate([[0.0], np.cumsum(loss)])
            means.append((total[self.of[1:]] - total[self.of[:-1]]) / np.maximum(self.sizes, 1))
        none = self.sizes == 0
        values = [pa.array(x, mask=none) for x in (*means, means[0] - means[1])]
        return pa.Table.from_arrays(
            [pa.array(self.ids, mask=~self.known), pa.array(self.sizes), *values],
            names=["doc_id", "n_words", "loss_target", "loss_background", "difference"],
        )


def lm_scores(docs: DataFrame, targets: DataFrame, size: int | None = None, min_count: int = MIN_COUNT) -> DataFrame:
    """``doc_id, n_words, loss_target, loss_background, difference`` of every document.

    ``targets`` has the ids of the target documents in ``doc_id``. The vocabulary is every word that
    occurs ``min_count`` times; a ``size`` takes that many of the most frequent words instead.
    """
    buckets = partitions(docs.sparkSession)
    targets = durable(targets.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct())
    tokens = token_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    news = target_places(tokens, targets)

    def told(news: DataFrame, f, schema: str) -> DataFrame:
        def run(tokens: pa.Table, news: pa.Table) -> pa.Table:
            return f(_Texts(tokens, news, buckets))

        return tokens.groupBy("block").cogroup(news.groupBy("block")).applyInArrow(run, schema)

    def table_of(rows: list[tuple]) -> pa.Table:
        return pa.Table.from_batches([_arrow(ASKED, rows)])

    words = durable(answers(told(news, lambda x: table_of(x.asked_words()), ASKED), WORDS, 4, buckets))
    vocab = vocabulary(words, min_count, size)
    news = news.union(words.where(F.col("kind") == WORDS))
    pairs = answers(told(news, lambda x: table_of(x.asked_pairs(vocab)), ASKED), PAIRS, 2, buckets)
    return told(
        news.union(pairs),
        lambda x: x.scores(vocab),
        "doc_id long, n_words long, loss_target double, loss_background double, difference double",
    )


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents against those labelled good."""
    targets = table(spark, sf_dir, "labels").where("quality = 1")
    return lm_scores(table(spark, sf_dir, "documents"), targets)
