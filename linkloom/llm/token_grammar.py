"""Token files: ids of documents in ascending order of their id, compressed by a Re-Pair grammar.

Texts are dealt by ranges of ``doc_id`` and sorted within them. A task encodes its texts, ends each document with an
end id, and closes a shard whenever one holds ``shard_ids`` ids or more. In a shard pairs of ids that are frequent
are replaced by nonterminals, again and again (Re-Pair): every round counts all neighbouring pairs anew, takes
those at least a quarter as frequent as the first, and replaces their occurrences; where two chosen pairs
overlap the more frequent one wins, and the other waits for the next round. Rounds end when no pair is worth a
rule, or when one has replaced fewer than one symbol in ``SMALL_GAIN``.

A shard file holds the rules, the length of every nonterminal's expansion, the documents and where each starts, the symbols that are
left, and the number of ids before every ``MARK``-th symbol. Any stretch of ids is therefore read without the rest: the mark before it is
looked up, and only nonterminals that reach into the stretch are expanded (:class:`Shard`). Layout, little-endian::

    RPG1  documents u4  rules u4  symbols u8  ids u8  first nonterminal u4  width of symbols u4
    doc ids i8  doc is null u1  doc starts u8  rule left  rule right  rule lengths u8  marks u8  symbols

Shard files are rows of a Parquet table, so that Spark commits or discards them with the task that wrote them; a
lost executor leaves no part of a file. How many ids lie before a shard is the sum over earlier ranges, of which there are
at most ``MOST_RANGES``, plus what the shard records itself.

Encoding is that of the tokenizers library. A tokenizer that drops white space and cuts texts into words and runs of signs
has no token that spans a cut; every distinct piece is then encoded once, and ids of texts are put together by
position. Other tokenizers get whole texts.

Cases: a null text is empty and has the end id alone; a null ``doc_id`` comes first; rows with one id follow each
other, ordered by a hash of their text, each with a row of its own in the result. A text is never split between
shards, however long. Other columns are ignored; an empty table gives files without rows and an empty result.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm.tables import shared_folder, table
from linkloom.llm.text_blocks import LOWER, WHITE, Block, blocks

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
END_ID = 2
SHARD_IDS = 1 << 20
RANGE_BYTES = 32 << 20
MOST_RANGES = 1 << 16
LEAST = 8  # a rule takes as much room as eight replacements save
SMALL_GAIN = 250  # rounds end when one replaces fewer than one of so many symbols
MARK = 1024
KNOWN = 500_000  # pieces that a task remembers
MAGIC = b"RPG1"
HEADER = "<4sIIQQII"
WRITTEN = "part int, shard int, before long, documents long, ids long, content binary"


# ---- grammar -----------------------------------------------------------------------------------------


def _chosen(keys: np.ndarray, room: int, least: int) -> np.ndarray:
    """The pairs of this round, the most frequent first."""
    ordered = np.sort(keys)
    edges = np.append(np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, len(ordered))
    counts = np.diff(edges, prepend=0)
    most = int(counts.max())
    if most < least:
        return keys[:0]
    some = np.flatnonzero(counts >= max(least, most // 4))
    some = some[np.argsort(-counts[some], kind="stable")][:room]
    return ordered[edges[some] - 1]


def _places(keys: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of chosen pairs, no two of which overlap, and which pair stands at each."""
    bits = max(12, int(len(chosen) - 1).bit_length() + 4)
    width = 8 * keys.itemsize
    odd, shift = keys.dtype.type(0x9E3779B97F4A7C15 >> (64 - width) | 1), keys.dtype.type(width - bits)
    slots = np.zeros(1 << bits, np.int32)
    # Of two pairs in one slot the more frequent one, written last, stays; the other waits for a round.
    slots[(chosen[::-1] * odd) >> shift] = np.arange(len(chosen) - 1, -1, -1, dtype=np.int32)
    rank = slots[(keys * odd) >> shift]
    at = np.flatnonzero(chosen[rank] == keys)
    rank = rank[at]
    touch = at[1:] == at[:-1] + 1
    # Equal pairs side by side are overlapping copies (a a a): every second one counts.
    same = touch & (rank[1:] == rank[:-1])
    if same.any():
        start = np.flatnonzero(np.append(True, ~same))
        offset = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
        even = offset % 2 == 0
        at, rank = at[even], rank[even]
        touch = at[1:] == at[:-1] + 1
    wins = np.ones(len(at), bool)
    wins[1:] &= ~(touch & (rank[:-1] < rank[1:]))
    wins[:-1] &= ~(touch & (rank[1:] < rank[:-1]))
    return at[wins], rank[wins]


def compress(ids: np.ndarray, base: int, room: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Symbols, and the two sides of every rule; rule ``k`` is symbol ``base + k``."""
    kind, shift = (np.uint32, 16) if base + room <= 1 << 16 else (np.uint64, 32)
    seq, shift = ids.astype(kind), kind(shift)
    rules: list[np.ndarray] = []
    while room > 0 and len(seq) > 1:
        keys = (seq[:-1] << shift) | seq[1:]
        chosen = _chosen(keys, room, least)
        if not len(chosen):
            break
        places, rank = _places(keys, chosen)
        # Occurrences lost to overlaps may leave a pair too rare for a rule.
        worth = np.bincount(rank, minlength=len(chosen)) >= least
        if not worth.any():
            # Only pairs that keep losing to each other are left: the first alone loses to none.
            chosen = chosen[:1]
            places, rank = _places(keys, chosen)
            worth = np.ones(1, bool)
            if len(places) < least:
                break
        number = (np.cumsum(worth) - 1 + base).astype(kind)
        mine = worth[rank]
        places, rank = places[mine], rank[mine]
        seq[places] = number[rank]
        stays = np.ones(len(seq), bool)
        stays[places + 1] = False
        seq = seq[stays]
        made = chosen[worth]
        rules.append(np.stack([made >> shift, made & kind((1 << int(shift)) - 1)], axis=1))
        base, room = base + len(made), room - len(made)
        if len(places) * SMALL_GAIN < len(seq):
            break
    sides = np.concatenate(rules) if rules else np.zeros((0, 2), kind)
    return seq, sides.astype(np.int64)


def rule_lengths(sides: np.ndarray, base: int) -> np.ndarray:
    """How many ids every rule stands for; the sides of a rule come before it."""
    lengths = np.zeros(len(sides), np.int64)
    todo = np.ones(len(sides), bool)
    while todo.any():
        at = np.flatnonzero(todo)
        parts = np.ones((len(at), 2), np.int64)
        inner = sides[at] >= base
        parts[inner] = lengths[sides[at][inner] - base]
        ready = (parts > 0).all(1)
        lengths[at[ready]] = parts[ready].sum(1)
        todo[at[ready]] = False
    return lengths


def pack(docs: list[int | None], starts: np.ndarray, ids: np.ndarray, base: int, room: int) -> bytes:
    """A shard file."""
    symbols, sides = compress(ids, base, room)
    lengths = rule_lengths(sides, base)
    width = 2 if base + len(sides) <= 1 << 16 else 4
    kind = f"<u{width}"
    before = np.cumsum(_sizes(symbols, lengths, base))
    marks = np.concatenate([[0], before[MARK - 1 :: MARK]])
    head = struct.pack(HEADER, MAGIC, len(docs), len(sides), len(symbols), len(ids), base, width)
    return head + b"".join(
        np.ascontiguousarray(a, t).tobytes()
        for a, t in (
            (np.array([d if d is not None else 0 for d in docs], np.int64), "<i8"),
            (np.array([d is None for d in docs], np.uint8), "u1"),
            (starts, "<u8"),
            (sides[:, 0], kind),
            (sides[:, 1], kind),
            (lengths, "<u8"),
            (marks, "<u8"),
            (symbols, kind),
        )
    )


def _sizes(symbols: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """How many ids each symbol stands for."""
    sizes = np.ones(len(symbols), np.int64)
    inner = symbols >= base
    sizes[inner] = lengths[symbols[inner] - base]
    return sizes


class Shard:
    """A shard file, read in place."""

    def __init__(self, content: bytes):
        magic, docs, rules, symbols, self.n_ids, self.base, width = struct.unpack_from(HEADER, content)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at, kind = struct.calcsize(HEADER), f"<u{width}"

        def take(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(content, dtype, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.no_id = take("<i8", docs), take("u1", docs).astype(bool)
        self.starts = take("<u8", docs).astype(np.int64)
        self.left, self.right = (take(kind, rules).astype(np.int64) for _ in range(2))
        self.lengths = take("<u8", rules).astype(np.int64)
        self.marks = take("<u8", symbols // MARK + 1).astype(np.int64)
        self.symbols = take(kind, symbols)
        self.ends = np.append(self.starts[1:], self.n_ids)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last - 1`` of the shard; nothing outside them is expanded."""
        out = np.zeros(max(last - first, 0), np.uint32)
        if first >= last:
            return out
        low = int(np.searchsorted(self.marks, first, "right")) - 1
        high = int(np.searchsorted(self.marks, last, "left"))
        symbols = self.symbols[low * MARK : high * MARK].astype(np.int64)
        sizes = _sizes(symbols, self.lengths, self.base)
        places = self.marks[low] + np.cumsum(sizes) - sizes
        while len(symbols):
            reach = (places < last) & (places + sizes > first)
            symbols, places = symbols[reach], places[reach]
            inner = symbols >= self.base
            out[places[~inner] - first] = symbols[~inner]
            rule, places = symbols[inner] - self.base, places[inner]
            left, right = self.left[rule], self.right[rule]
            symbols = np.concatenate([left, right])
            sizes = _sizes(symbols, self.lengths, self.base)
            places = np.concatenate([places, places + sizes[: len(left)]])
        return out


# ---- encoding ----------------------------------------------------------------------------------------


# Kinds of bytes: white space, letters, digits, other ASCII, and parts of characters beyond ASCII.
_SPACE, _LETTER, _DIGIT, _SIGN, _FAR = range(5)
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[WHITE] = _SPACE
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[128:] = _FAR
# Whether a piece ends between two bytes, by their kinds: at white space, between ASCII characters of
# different kinds, and between digits.
_CUT = np.array([[a != b and (_FAR not in (a, b) or _SPACE in (a, b)) or a == b == _DIGIT for b in range(5)] for a in range(5)])
_APOSTROPHE = 39


def inner_cuts(data: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each byte, as told by the byte before it."""
    kind = _KIND[data]
    cut = np.ones(len(data), bool)
    cut[1:] = _CUT.ravel()[kind[:-1] * np.uint8(5) + kind[1:]]
    # An apostrophe may take the letters after it with it, or be the end of a run of signs.
    cut[1:] &= ~((data[:-1] == _APOSTROPHE) & (kind[1:] == _LETTER))
    return cut


class Encoder:
    """Ids of blocks of texts."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer, pre_tokenizers

        config = json.loads(tokenizer)
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.by_piece = works_by_piece(config)
        self.added = [t["content"].encode() for t in config.get("added_tokens", [])]
        if self.by_piece:
            # Pieces come once each; a cache of words would only cost.
            self.tokenizer.model = _without_cache(config["model"])
            # Letters a to z pass the normaliser and the cutting into words as they are.
            self.plain = Tokenizer(_without_cache(config["model"]))
            self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            suffix = config["model"]["end_of_word_suffix"]
            self.last = np.zeros(self.vocabulary, bool)
            self.last[[k for name, k in config["model"]["vocab"].items() if name.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        """Start with no piece known but the end of a document, which is piece 0."""
        self.known = pa.array([""], pa.large_string())
        self.tokens = np.array([END_ID], np.uint32)
        self.first, self.size = np.zeros(1, np.int64), np.ones(1, np.int64)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _encode_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`_encode`, for words of a to z: many are one text, and end where a token of a word's end is."""
        texts = [" ".join(words[k : k + 256]) for k in range(0, len(words), 256)]
        found = self.plain.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in found] or [self.tokens[:0]])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):
            raise ValueError("words and their last tokens differ in number")
        return ids, np.diff(ends, prepend=0)

    def _look_up(self, names: pa.LargeStringArray) -> np.ndarray:
        """The number of every piece; unknown ones are encoded."""
        if len(self.known) > KNOWN:
            self.forget()
        found = pc.index_in(names, value_set=self.known)
        number = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
        for plain in (True, False):
            mine = pc.and_(found.is_null(), pc.equal(pc.ascii_is_alpha(names), plain))
            new = names.filter(mine)
            tokens, sizes = (self._encode_plain if plain else self._encode)(new.to_pylist())
            number[mine.to_numpy(zero_copy_only=False)] = np.arange(len(self.size), len(self.size) + len(new))
            self.known = pa.concat_arrays([self.known, new])
            self.first = np.concatenate([self.first, len(self.tokens) + np.cumsum(sizes) - sizes])
            self.size = np.concatenate([self.size, sizes])
            self.tokens = np.concatenate([self.tokens, tokens])
        return number

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block, each with the end id, and how many each has."""
        n = len(block.offsets) - 1
        if not self.by_piece:
            data, o = block.data.tobytes(), block.offsets
            ids, sizes = self._encode([data[a:b].decode() for a, b in zip(o[:-1], o[1:], strict=True)])
            return np.insert(ids, np.cumsum(sizes), END_ID), sizes + 1
        cut = inner_cuts(block.data)
        cut[block.offsets[:-1][np.diff(block.offsets) > 0]] = True
        whole = block.data.tobytes()
        for content in self.added:
            at = whole.find(content)
            while at >= 0:
                cut[at + 1 : at + len(content)] = False
                at = whole.find(content, at + len(content))
        inside = ~WHITE[block.data]
        starts = np.flatnonzero(cut & inside)
        body = LOWER[block.data[inside]]
        # Bytes before each piece that are no white space: where it starts in the joined pieces.
        gaps = np.flatnonzero(~inside)
        ends = np.append(starts - np.searchsorted(gaps, starts), len(body))
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(body)).dictionary_encode()
        pieces = self._look_up(words.dictionary)[words.indices.to_numpy()]
        # Piece 0 after the pieces of every text.
        held = np.searchsorted(starts, block.offsets)
        pieces = np.insert(pieces, held[1:], 0)
        sizes = self.size[pieces]
        ends = np.cumsum(sizes)
        place = np.repeat(self.first[pieces] - ends + sizes, sizes) + np.arange(int(sizes.sum()))
        total = np.concatenate([[0], ends])[np.concatenate([[0], held[1:] + np.arange(1, n + 1)])]
        return self.tokens[place], np.diff(total)


def _without_cache(model: dict):
    from tokenizers import models

    merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
    return models.BPE(
        model["vocab"],
        merges,
        cache_capacity=0,
        **{k: model[k] for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model[k] is not None},
        **{k: bool(model.get(k)) for k in ("fuse_unk", "byte_fallback", "ignore_merges")},
    )


def works_by_piece(config: dict) -> bool:
    """Whether texts can be cut where :func:`inner_cuts` cuts them, and a to z lower-cased, without changing an id.

    True for a tokenizer that lower-cases, drops white space, and cuts texts into contractions, runs of
    letters, single digits and runs of other signs, each a word to itself. Added tokens are found before
    all that; they must be told from their lower-cased pieces by a cut inside, and hold or strip no spaces.
    """
    steps = config.get("normalizer") or {"type": "none"}
    steps = steps["normalizers"] if steps["type"] == "Sequence" else [steps]
    plain = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and (
        steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
    )
    cuts = config.get("pre_tokenizer") or {"type": "none"}
    cuts = cuts["pretokenizers"] if cuts["type"] == "Sequence" else [cuts]
    words = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"]
    split = (
        [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and (cuts[0]["behavior"], cuts[0]["invert"], cuts[0]["pattern"]) == ("Removed", True, {"Regex": "|".join(words)})
        and not (cuts[1]["use_regex"] or cuts[1]["add_prefix_space"])
    )
    added = all(
        not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or any(c.isspace() for c in t["content"]))
        and t["content"].isascii()
        and inner_cuts(np.frombuffer(t["content"].encode(), np.uint8))[1:].any()
        for t in config.get("added_tokens", [])
    )
    model = config["model"]
    bpe = model["type"] == "BPE" and not model.get("dropout") and bool(model.get("end_of_word_suffix"))
    return plain and split and added and bpe and set("abcdefghijklmnopqrstuvwxyz") <= set(model["vocab"])


@lru_cache(maxsize=2)
def encoder(tokenizer: str) -> Encoder:
    """An encoder, built once per Python worker."""
    return Encoder(tokenizer)


# ---- files -------------------------------------------------------------------------------------------


def _write_shards(tokenizer: str, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = encoder(tokenizer)
        mine.forget()
        base = mine.vocabulary
        room = max((1 << 16) - base, 0) or 1 << 16
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        docs: list[int | None] = []
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        n = 0

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(held)
            counts = np.concatenate(sizes)
            content = pack(docs, np.cumsum(counts) - counts, ids, base, room)
            row = (part, shard, before, len(docs), len(ids), content)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ["part", "shard", "before", "documents", "ids", "content"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=names)

        for block in blocks(batches, limit=2 << 20):
            ids, counts = mine.encode(block)
            names = block.rows.column(0).to_pylist()
            ends = np.cumsum(counts)
            first = 0
            while first < len(names):
                # Up to and with the document that fills the shard.
                done = ends[first - 1] if first else 0
                last = min(int(np.searchsorted(ends, done + shard_ids - n)) + 1, len(names))
                docs += names[first:last]
                held.append(ids[done : ends[last - 1]])
                sizes.append(counts[first:last])
                n += int(ends[last - 1] - done)
                first = last
                if n >= shard_ids:
                    yield closed()
                    shard, before = shard + 1, before + n
                    docs, held, sizes, n = [], [], [], 0
        if docs:
            yield closed()

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str = TOKENIZER,
    shard_ids: int = SHARD_IDS,
    range_bytes: int = RANGE_BYTES,
) -> None:
    """Encode the texts of ``docs`` and write their ids to token files under ``path``."""
    with open(tokenizer, encoding="utf-8") as file:
        config = file.read()
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes")).first().bytes or 0
    key = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranges = min(int(size // range_bytes) + 1, MOST_RANGES)
    ordered = rows.repartitionByRange(ranges, *key).sortWithinPartitions(*key)
    shards = ordered.mapInArrow(_write_shards(config, shard_ids), WRITTEN)
    shards.write.mode("errorifexists").option("compression", "zstd").parquet(path)


def shard_table(spark: SparkSession, path: str) -> DataFrame:
    """The shard files under ``path`` with ``start``, the number of ids before each."""
    files = spark.read.schema(WRITTEN).parquet(path)
    sums = files.groupBy("part").agg(F.sum("ids").alias("part_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("part_ids").over(earlier), F.lit(0)).alias("offset"))
    # At most MOST_RANGES rows of two numbers.
    return files.join(F.broadcast(offsets), "part").withColumn("start", F.col("offset") + F.col("before"))


def _documents(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard = Shard(content.as_buffer())
                ids = shard.ids(0, shard.n_ids).astype("<u4")
                bounds = list(zip(shard.starts.tolist(), shard.ends.tolist(), strict=True))
                columns = [
                    pa.array(shard.doc_ids, mask=shard.no_id),
                    pa.array(start + shard.starts),
                    pa.array(shard.ends - shard.starts),
                    pa.array([zlib.crc32(ids[a:b]) for a, b in bounds], pa.int64()),
                ]
                if with_ids:
                    offsets = np.append(shard.starts, shard.n_ids)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32))))
                names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and ``ids`` of every document in the token files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return shard_table(spark, path).select("start", "content").mapInArrow(_documents(with_ids), schema)


def read_stretches(stretches: DataFrame, path: str) -> DataFrame:
    """``first, last, shard_first, ids`` for every stretch ``first <= place < last`` of the whole sequence of ids.

    A stretch that runs over several shards gives a row for each, in order of ``shard_first``. Only what lies in
    a stretch is expanded.
    """
    spark = stretches.sparkSession
    wanted = stretches.select(F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"))
    shards = shard_table(spark, path).select("start", (F.col("start") + F.col("ids")).alias("stop"), "content")
    index = shards.select("start", "stop")
    # Shards are about equally long: a stretch looks only into the bins of places that it touches.
    bins = F.sequence(F.floor(F.col("start") / SHARD_IDS), F.floor((F.col("stop") - 1) / SHARD_IDS))
    index = index.select("*", F.explode(bins).alias("bin"))
    touched = F.sequence(F.floor(F.col("first") / SHARD_IDS), F.floor((F.col("last") - 1) / SHARD_IDS))
    hits = (
        wanted.where("last > first")
        .select("*", F.explode(touched).alias("bin"))
        .join(index, "bin")
        .where("first < stop and last > start")
        .select("first", "last", "start")
        .distinct()
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, start, content in zip(*[batch.column(k) for k in range(4)], strict=True):
                shard, a, b = Shard(content.as_buffer()), first.as_py(), last.as_py()
                low = max(a - start.as_py(), 0)
                found = shard.ids(low, min(b - start.as_py(), shard.n_ids)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a]), pa.array([b]), pa.array([start.as_py() + low]), pa.array([found.tolist()], pa.list_(pa.int32()))],
                    names=["first", "last", "shard_first", "ids"],
                )

    found = hits.join(shards.drop("stop"), "start").select("first", "last", "start", "content")
    return found.mapInArrow(run, "first long, last long, shard_first long, ids array<int>")


def op13_token_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and checksum of every document's ids, read back from token files."""
    path = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path, with_ids=False)
