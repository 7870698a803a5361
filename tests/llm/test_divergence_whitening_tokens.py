"""Source divergence, embedding whitening and token files against plain Python, numpy and the library."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linkloom.llm import catalog, token_grammar
from linkloom.llm.embedding_whitening import bidiagonalise, whitened
from linkloom.llm.source_divergence import gallop, scaled, source_divergence

DATA = "/root/testdata/sf0.001"

# ---- source divergence -------------------------------------------------------------------------------


def divergence_by_hand(rows, min_docs, top=10):
    """``lang, source, part, item, value, rank`` from rows of ``text, lang, source``."""
    fold = {k: k + 32 for k in range(65, 91)}
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(fold))) for text, lang, source in rows]
    held = Counter((lang, t) for lang, _, terms in docs for t in set(terms))
    groups = defaultdict(Counter)
    for lang, source, terms in docs:
        groups[lang, source].update(t for t in terms if held[lang, t] >= min_docs)
    out = []
    for (lang, source), mine in groups.items():
        kept = [t for (name, t), n in held.items() if name == lang and n >= min_docs]
        whole = Counter()
        for (name, _), counts in groups.items():
            if name == lang:
                whole.update(counts)

        def price(counts):
            total = sum(counts.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // total for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        p, every = price(mine), price(whole)
        pairs = [(-sum(f(p[t], q[t]) for t in kept), s.encode(), s) for (name, s), c in groups.items() if (name, s) != (lang, source) and name == lang for q in [price(c)]]
        terms = [(-f(p[t], every[t]), t.encode(), t) for t in kept if mine[t] and p[t] > every[t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, item, -value, k + 1) for k, (value, _, item) in enumerate(items)]
    return sorted(out)


def divergence_rows(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("block", [7, 1 << 16])
def test_divergence_of_hostile_rows(hostile, block):
    mixed = hostile.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "de").when(F.col("doc_id") > 50, "en"))
    rows = [(r.text, r.lang, r.source) for r in mixed.collect()]
    for min_docs in (1, 3, 1000):
        assert divergence_rows(source_divergence(mixed, min_docs, block=block)) == divergence_by_hand(rows, min_docs)


def test_divergence_of_nothing(hostile):
    assert source_divergence(hostile.where("false")).collect() == []


def test_divergence_reads_terms_across_blocks_of_text(spark):
    rows = [("É-a\u0080b Ab", "x", "s"), ("abé", "x", "t"), (None, "x", "u"), ("", None, None)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert divergence_rows(source_divergence(df, 1)) == divergence_by_hand(rows, 1)


def test_gallop_finds_common_values():
    random = np.random.default_rng(1)
    for n, m in ((0, 5), (1, 1), (3, 4000), (500, 5000), (700, 700)):
        a, b = (np.sort(random.choice(6000, k, replace=False)) for k in (n, m))
        at_a, at_b = gallop(a, b)
        assert a[at_a].tolist() == sorted(set(a.tolist()) & set(b.tolist())) == b[at_b].tolist()


def test_scaled_is_exact_beyond_long_products():
    counts = np.array([0, 1, 7 * 10**12, 8_999_999_999_999_990], np.int64)
    total = 8_999_999_999_999_995
    assert scaled(counts, total).tolist() == [1 + 10**9 * (c + 2) // total for c in counts.tolist()]


# ---- embedding whitening -----------------------------------------------------------------------------


def whole(x):
    return np.floor(64 * np.asarray(x, np.float64)).astype(np.int64) + 1_000_000


def check_whitened(result, ids, x, components):
    """Results against the covariance's own eigenvectors."""
    n, sums = len(x), x.sum(0)
    y = x - sums / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    got = defaultdict(list)
    for r in result.collect():
        got[r.vec_id, r.component].append(r)
    z = np.array([[got[i, k + 1][0].whitened for k in range(components)] for i in ids])
    expected = y @ vectors / np.sqrt(values)
    assert np.abs(np.abs((z * expected).sum(0)) / n - 1).max() < 1e-9
    assert np.abs(z * np.sign((z * expected).sum(0)) - expected).max() < 1e-6
    exact = [int(((n * row.astype(object) - sums.astype(object)) ** 2).sum()) for row in x]
    for i, deviation in zip(ids, exact, strict=True):
        for k in range(components):
            (r,) = got[i, k + 1]
            assert (int(r.deviation), r.n) == (deviation, n)
            assert abs(r.explained / (values[k] / np.trace(y.T @ y / n)) - 1) < 1e-9
            assert r.identity_error < 1e-9
    assert len(got) == len(ids) * components


def test_whitening_of_the_test_data(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    result = catalog.QUERIES["op12_embedding_whitening"](spark, DATA)
    check_whitened(result, [r.vec_id for r in rows], whole([r.embedding for r in rows]), 32)


def test_whitening_leaves_out_what_is_no_vector(spark):
    random = np.random.default_rng(4)
    good = [(k, random.standard_normal(5).tolist(), "a") for k in range(60)]
    bad = [(100, None, "a"), (101, [1.0, None, 2.0, 3.0, 4.0], "b"), (102, [float("nan")] * 5, "b"), (103, [], "c"),
           (104, [float("inf"), 0.0, 0.0, 0.0, 0.0], "c"), (105, [1.0, 2.0], "c"), (106, [1e300] * 5, "c")]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>, component string")
    check_whitened(whitened(df), [k for k, _, _ in good], whole([x for _, x, _ in good]), 5)


def test_whitening_of_equal_deviations_and_flat_directions(spark):
    """Pairs of equal eigenvalues, which one chain cannot see, and directions on which nothing varies."""
    corners = [[a, b, c, 1.0, a + b] for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-2.0, 2.0)]
    df = spark.createDataFrame([(None if k == 3 else k // 2, x) for k, x in enumerate(corners * 3)], "vec_id long, embedding array<double>")
    rows = whitened(df).collect()
    assert {r.component for r in rows} == {1, 2, 3} and len(rows) == 3 * 24
    assert max(r.identity_error for r in rows) < 1e-9
    shares = sorted({(r.component, round(r.explained, 9)) for r in rows})
    assert shares == [(1, round(4 / 8, 9)), (2, round(3 / 8, 9)), (3, round(1 / 8, 9))]


def test_whitening_of_nothing_and_of_one_row(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitened(spark.createDataFrame([], schema)).collect() == []
    assert whitened(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).collect() == []


class Local:
    """A matrix with the products of the distributed one."""

    def __init__(self, x):
        self.x, self.d = x, x.shape[1]
        self.passes = 0

    def products(self, c, earlier):
        self.passes += 1
        u = self.x @ c
        return self.x.T @ u, (self.x @ earlier).T @ u, float(u @ u)


def test_bidiagonalisation_settles_before_all_dimensions():
    random = np.random.default_rng(7)
    basis, _ = np.linalg.qr(random.standard_normal((300, 300)))
    x = random.standard_normal((900, 300)) * (0.9 ** np.arange(300)) @ basis
    matrix = Local(x - x.mean(0))
    values, directions = bidiagonalise(matrix, 8)
    expected = np.linalg.svd(matrix.x, compute_uv=False)[:8]
    assert matrix.passes < 150
    assert np.abs(values[:8] / expected - 1).max() < 1e-10
    assert np.abs(np.linalg.norm(matrix.x @ directions[:, :8], axis=0) / expected - 1).max() < 1e-10


def test_bidiagonalisation_finds_equal_values():
    random = np.random.default_rng(8)
    left, _ = np.linalg.qr(random.standard_normal((200, 40)))
    right, _ = np.linalg.qr(random.standard_normal((40, 40)))
    wanted = np.repeat([9.0, 7.0, 5.0, 3.0, 1e-3], 8)
    values, directions = bidiagonalise(Local((left * wanted) @ right.T), 32)
    assert np.abs(values[:32] - wanted[:32]).max() < 1e-9
    assert np.abs(directions.T @ directions - np.eye(directions.shape[1])).max() < 1e-12


# ---- token files -------------------------------------------------------------------------------------


def expected_tokens(rows, tokenizer):
    """``doc_id, start, n_tokens, crc`` with whole texts given to the library."""
    out, start = [], 0
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [token_grammar.END_ID]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_token_query_equals_the_library(spark, sample):
    rows = catalog.QUERIES["op13_token_grammar"](spark, DATA).collect()
    expected = expected_tokens(by_id(sample), Tokenizer.from_file(token_grammar.TOKENIZER))
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == sorted(r[:4] for r in expected)


@pytest.mark.parametrize(("shard_ids", "range_bytes"), [(1, 1 << 30), (700, 20_000), (1 << 20, 1 << 30)])
def test_token_files_of_hostile_rows(hostile, tmp_path, shard_ids, range_bytes):
    more = [(200, "x<|endoftext|>y <|ENDOFTEXT|> <|startoftext|>"), (201, "é a b c ́d don't'll ẞ İ DOGS' 's #'s '5's 12a3-'re.'t \x01a\x7fb≮a=É́.x“.y”z'É KK"), (202, "ab " * 5000)]
    spark = hostile.sparkSession
    docs = hostile.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    path = str(tmp_path / "tokens")
    token_grammar.write_tokens(docs, path, shard_ids=shard_ids, range_bytes=range_bytes)
    rows = sorted(token_grammar.read_tokens(spark, path).collect(), key=lambda r: r.start)
    tokenizer = Tokenizer.from_file(token_grammar.TOKENIZER)
    got = [(r.doc_id, r.n_tokens, r.ids_crc32, list(r.ids)) for r in rows]
    expected = expected_tokens([(r.doc_id, r.text) for r in docs.collect()], tokenizer)
    assert sorted(map(repr, got)) == sorted(repr((d, n, crc, ids)) for d, _, n, crc, ids in expected)
    assert [r.doc_id for r in rows] == [d for d, *_ in by_id(got)]
    ends = np.cumsum([r.n_tokens for r in rows])
    assert [r.start for r in rows] == [0, *ends[:-1].tolist()]
    whole_ids = [i for r in rows for i in r.ids]
    stretches = [(0, 5), (3, 3), (len(whole_ids) - 4, len(whole_ids)), (100, len(whole_ids) // 2)]
    found = token_grammar.read_stretches(spark.createDataFrame(stretches, "first int, last int"), path).collect()
    for first, last in stretches:
        parts = sorted((r.shard_first, r.ids) for r in found if (r["first"], r["last"]) == (first, last))
        assert [i for _, ids in parts for i in ids] == whole_ids[first:last]


def test_token_files_of_nothing(hostile, tmp_path):
    token_grammar.write_tokens(hostile.where("false"), str(tmp_path / "tokens"))
    assert token_grammar.read_tokens(hostile.sparkSession, str(tmp_path / "tokens")).collect() == []


@pytest.mark.parametrize("base", [300, 70_000])
def test_grammar_round_trip_and_random_access(base):
    random = np.random.default_rng(base)
    passage = random.integers(0, base, 400)
    parts = [random.zipf(1.3, 20_000) % base, np.full(5001, 7), *[passage] * 40, np.tile([1, 2], 3000), random.integers(0, base, 3)]
    ids = np.concatenate(parts).astype(np.uint32)
    room = (1 << 16) - base if base < 1 << 16 else 1 << 16
    content = token_grammar.pack([1, None], np.array([0, 10]), ids, base, room)
    shard = token_grammar.Shard(content)
    assert (shard.ids(0, shard.n_ids) == ids).all() and len(content) < 2 * len(ids)
    assert shard.doc_ids.tolist() == [1, 0] and shard.no_id.tolist() == [False, True] and shard.ends.tolist() == [10, len(ids)]
    for first, last in [(0, 0), (0, 1), (len(ids) - 1, len(ids)), *np.sort(random.integers(0, len(ids), (50, 2)), axis=1).tolist()]:
        assert (shard.ids(first, last) == ids[first:last]).all()
    # A passage that repeats ends as few symbols, and no rule is used less often than it takes to pay.
    symbols, sides = token_grammar.compress(ids, base, room)
    assert len(symbols) < len(ids) / 2
    for n in range(4):
        few = ids[:n]
        assert (token_grammar.Shard(token_grammar.pack([], np.zeros(0, int), few, base, room)).ids(0, n) == few).all()


def test_files_of_another_kind_are_refused():
    with pytest.raises(ValueError, match="not a token file"):
        token_grammar.Shard(b"0" * 100)


def test_other_tokenizers_get_whole_texts():
    import json

    with open("/opt/tokenizers/byte_bpe_50k.json", encoding="utf-8") as file:
        config = file.read()
    assert not token_grammar.works_by_piece(json.loads(config))
    encoder = token_grammar.Encoder(config)
    import pyarrow as pa

    from linkloom.llm.text_blocks import blocks

    texts = ["two  words", "", None, " a\n b"]
    (block,) = blocks([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])
    ids, sizes = encoder.encode(block)
    library = Tokenizer.from_str(config)
    wanted = [library.encode(t or "", add_special_tokens=False).ids + [token_grammar.END_ID] for t in texts]
    assert sizes.tolist() == [len(w) for w in wanted] and ids.tolist() == [i for w in wanted for i in w]
