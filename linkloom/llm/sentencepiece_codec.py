"""SentencePiece encoding and decoding with the tokenizers library.

The model file is parsed here (it is a protobuf message) and rebuilt: normaliser, marker of spaces,
scores of a unigram model or merges of a BPE model, byte fallback, decoder. In a vocabulary in which no piece
has a space marker after another character, no token crosses from a word into the space after it. Texts
are then cut before every run of spaces, every distinct cut of a block is encoded once, in batches on
several threads, and tokens of texts are put together by position. Other models encode whole texts.
Each task compares its first cuts with the sentencepiece library and fails if one differs.

Cases: null and empty texts have no tokens and decode to an empty text; all else is encoded whole,
however long. Rows are independent: a null ``doc_id``, repeated rows and further columns change
nothing; columns are kept, but for those with the name of a result. Bytes that are not
UTF-8 after decoding arbitrary ids become U+FFFD.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.tables import table
from linkloom.llm.text_blocks import Block, blocks, hash_spans

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# Fixed values of the format: types of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class Model:
    """What a model file says."""

    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protobuf message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        wire = key & 7
        if wire == 0:
            value, at = _varint(data, at)
        else:
            if wire == 2:
                size, at = _varint(data, at)
            elif wire in (1, 5):
                size = 8 if wire == 1 else 4
            else:
                raise ValueError(f"wire type {wire} in a model file")
            value, at = data[at : at + size], at + size
            if len(value) < size:
                raise ValueError("a model file that is cut off")
        yield key >> 3, value


def parse_model(data: bytes) -> Model:
    """The parts of a model file that encoding and decoding need."""
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    (score,) = struct.unpack("<f", v)
                elif n == 3:
                    kind = v
            model.pieces.append(piece), model.scores.append(score), model.types.append(kind)
        elif number == 2:
            spec = dict(_fields(value))
            model.kind, model.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
        elif number == 3:
            spec = dict(_fields(value))
            model.charsmap = spec.get(2, b"")
            model.add_dummy_prefix = bool(spec.get(3, 1))
            model.remove_extra_whitespaces = bool(spec.get(4, 1))
            model.escape_whitespaces = bool(spec.get(5, 1))
    return model


def bpe_merges(model: Model) -> list[tuple[str, str]]:
    """Merges of a BPE model: every way to put a piece together, better pieces first."""
    usable = {p: s for p, s, t in zip(model.pieces, model.scores, model.types, strict=True) if t == NORMAL}
    ids = {p: i for i, p in enumerate(model.pieces)}
    found = []
    for piece, score in usable.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in usable and right in usable:
                found.append((-score, ids[left], ids[right], left, right))
    found.sort()
    return [(left, right) for *_, left, right in found]


def build_tokenizer(model: Model, whole: bool = True):
    """A tokenizer; ``whole=False`` for cuts of texts in which spaces are already marked."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    unknown = model.types.index(UNKNOWN)
    if model.kind == UNIGRAM:
        pieces = list(zip(model.pieces, model.scores, strict=True))
        core = models.Unigram(pieces, unk_id=unknown, byte_fallback=model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE(
            {p: i for i, p in enumerate(model.pieces)},
            bpe_merges(model),
            unk_token=model.pieces[unknown],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
            cache_capacity=0,
        )
    else:
        raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
    tokenizer = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if whole:
        if model.add_dummy_prefix:
            steps.append(normalizers.Prepend(" "))
        if model.escape_whitespaces:
            steps.append(normalizers.Replace(" ", MARK))
        tokenizer.normalizer = normalizers.Sequence(steps)
    tokenizer.decoder = decoders.Sequence(
        [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        + ([decoders.Strip(" ", 1, 0)] if model.add_dummy_prefix else [])
    )
    return tokenizer


class Codec:
    """Encodes blocks of texts and decodes ids."""

    def __init__(self, data: bytes, verify: int = 1000):
        self.data, self.model = data, parse_model(data)
        model = self.model
        inner = any(
            a != MARK and b == MARK
            for p, t in zip(model.pieces, model.types, strict=True)
            if t in (NORMAL, USER_DEFINED)
            for a, b in zip(p, p[1:])
        )
        self.by_cut = (
            not inner
            and not model.charsmap
            and not model.remove_extra_whitespaces
            and model.escape_whitespaces
            and model.add_dummy_prefix
            and USER_DEFINED not in model.types
        )
        self.tokenizer = build_tokenizer(model, whole=not self.by_cut)
        self.verify = verify
        self.forget()

    def forget(self) -> None:
        """Start with no cut known."""
        self.known = np.zeros(0, np.uint64)
        self.tokens = np.zeros(0, np.int32)
        self.first = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    @property
    def reference(self):
        """The sentencepiece library's own processor."""
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.data)

    def _encode_new(self, texts: list[str]) -> list[list[int]]:
        """Token ids of cuts, each of which starts with a space."""
        marked = [x.replace(" ", MARK) for x in texts]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(marked, add_special_tokens=False)]
        if self.verify > 0:
            some = min(self.verify, len(texts))
            expected = self.reference.encode([x[1:] for x in texts[:some]], num_threads=1)
            for text, mine, its in zip(texts, ids, expected):
                # An empty text has no tokens in the library; a single space is a cut of its own.
                if mine != its and text != " ":
                    raise ValueError(f"tokens of {text!r} are {its}, not {mine}")
            self.verify -= some
        return ids

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block, joined, and where each text starts."""
        if not self.by_cut:
            data = block.data.tobytes()
            o = block.offsets
            texts = [data[a:b].decode() for a, b in zip(o[:-1], o[1:], strict=True)]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            sizes = np.array([len(x) for x in ids], np.int64)
            return np.concatenate([np.array(x, np.int32) for x in ids] or [np.zeros(0, np.int32)]), _offsets(sizes)
        # Every text that is not empty gets a space in front.
        filled = np.flatnonzero(np.diff(block.offsets) > 0)
        data = np.insert(block.data, block.offsets[filled], 32)
        starts = block.offsets[filled] + np.arange(len(filled))
        space = data == 32
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        # A marker in the text itself joins the spaces after it.
        cut[3:] &= ~((data[:-3] == 0xE2) & (data[1:-2] == 0x96) & (data[2:-1] == 0x81))
        cut[starts] = True
        cuts = np.flatnonzero(cut)
        ends = np.append(cuts[1:], len(data))[: len(cuts)]
        hashes = hash_spans(data, cuts, ends)
        distinct, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = self._look_up(distinct, data, cuts[where], ends[where])
        at = at[inverse]
        sizes = self.size[at]
        total = _offsets(sizes)
        place = np.repeat(self.first[at] - total[:-1], sizes) + np.arange(total[-1])
        text_first = np.searchsorted(cuts, starts)
        counts = np.zeros(len(block.offsets) - 1, np.int64)
        counts[filled] = np.diff(np.append(total[text_first], total[-1]))
        return self.tokens[place], _offsets(counts)

    def _look_up(self, hashes, data, starts, ends) -> np.ndarray:
        if len(self.known) > 1_000_000:
            self.forget()
        found = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        if len(self.known):
            new = self.known[np.minimum(found, len(self.known) - 1)] != hashes
        if new.any():
            body = data.tobytes()
            texts = [body[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
            ids = self._encode_new(texts)
            sizes = np.array([len(x) for x in ids], np.int64)
            flat = np.fromiter((i for x in ids for i in x), np.int32, int(sizes.sum()))
            firsts = len(self.tokens) + _offsets(sizes)[:-1]
            self.tokens = np.concatenate([self.tokens, flat])
            known = np.concatenate([self.known, hashes[new]])
            order = np.argsort(known, kind="stable")
            self.known = known[order]
            self.first = np.concatenate([self.first, firsts])[order]
            self.size = np.concatenate([self.size, sizes])[order]
        return np.searchsorted(self.known, hashes)

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of lists of ids."""
        return self.tokenizer.decode_batch(ids, skip_special_tokens=True)


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


@lru_cache(maxsize=2)
def codec(data: bytes) -> Codec:
    """A codec, built once per Python worker."""
    return Codec(data)


def read_model(path: str = MODEL) -> bytes:
    """The bytes of a model file that the driver can open; they go to the tasks with the code."""
    with open(path, "rb") as file:
        return file.read()


TOKENS = T.ArrayType(T.IntegerType())


def encode_documents(
    docs: DataFrame, model: bytes, column: str = "token_ids", check: bool = False
) -> DataFrame:
    """All columns and rows of ``docs``, with the token ids of ``text``.

    ``check`` adds ``decoded_sha256``, the digest of the text that the ids decode to. Columns of the
    input that have these names are replaced.
    """
    docs = docs.drop(column, *["decoded_sha256"] * check)
    place = docs.columns.index("text")
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(column, TOKENS)]
        + [T.StructField("decoded_sha256", T.StringType())] * check
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = codec(model)
        mine.forget()
        for block in blocks(batches, place):
            tokens, of = mine.encode(block)
            ids = pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.array(tokens, pa.int32()))
            more = []
            if check:
                lists = [tokens[a:b].tolist() for a, b in zip(of[:-1], of[1:], strict=True)]
                more = [pa.array([hashlib.sha256(x.encode()).hexdigest() for x in mine.decode(lists)], pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*block.rows.columns, ids, *more], names=[f.name for f in schema.fields]
            )

    return docs.mapInArrow(run, schema)


def decode_documents(rows: DataFrame, model: bytes, column: str = "token_ids") -> DataFrame:
    """All columns of ``rows`` and ``text``, decoded from the ids in ``column``; null is no ids.

    A column ``text`` of the input is replaced.
    """
    rows = rows.drop("text")
    place = rows.columns.index(column)
    schema = T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = codec(model)
        for batch in batches:
            texts = mine.decode([x or [] for x in batch.column(place).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[f.name for f in schema.fields]
            )

    return rows.mapInArrow(run, schema)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number, and the digest of what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_documents(docs, read_model(), check=True)
    return encoded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "decoded_sha256")
