"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Every vector becomes whole numbers, ``x = floor(64 c) + 1000000``; the number of vectors ``n`` and the sums ``S`` are
exact. The rows ``x - S / n`` are the matrix ``X``, which stays distributed. From a start direction ``v`` the
method alternates products: ``u = X v`` less its parts along earlier ``u`` (``U`` orthonormal), and ``w = X' u``
less its parts along earlier ``v``. ``X`` then is ``U B V'`` on the directions seen, ``B`` upper bidiagonal and small, and the
singular value decomposition of ``B`` gives components (``V`` times its right vectors) and deviations (its values over ``sqrt(n)``).

* A step is one pass over the rows, two where rounding calls for it. A ``u`` is never stored: it is ``X c`` for a ``c`` of the length of a vector,
  so tasks get the ``c`` of all steps (dimensions times steps), and hand back sums of ``X' u``, ``U' u`` and ``u' u``. Sums of tasks are
  added by Spark; the driver gets one row per direction and no row of the table.
* Both sides are reorthogonalised in full: ``v`` on the driver, twice; ``u`` by the sums ``U' u``, and once more by a second
  pass if the part taken off was large.
* A direction on which all rows vanish, or an exhausted start, ends a chain: the next ``v`` is a new direction
  orthogonal to all before. Steps end after as many as there are dimensions, or when the wanted components
  have been settled, to ``TOLERANCE`` of the largest, over ``PATIENCE`` further steps after a new chain was begun to look for equal ones.

The covariance of the whitened rows is summed in a pass of its own and held against the identity.

Cases: rows whose vector is null, empty, or holds null or non-finite entries take no part, nor do entries beyond ``2^52 / 64`` (no exact
whole number) and vectors of another length than the most frequent. Rows with null or repeated ids are vectors of their own.
Components without variance (equal rows, fewer rows than components) have no direction and give no rows;
empty input gives empty output. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.tables import durable, table

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**52 / SCALE
TOLERANCE = 1e-13
PATIENCE = 8
BLOCK = 4096
RESULT = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
)


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, x`` (array of long) of the vectors that take part, computed once and kept."""
    fine = F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) <= LARGEST))
    clean = durable(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("c"))
        .where(F.coalesce(fine, F.lit(False)) & (F.size("c") > 0))
        .select("vec_id", F.transform("c", lambda v: F.floor(v * SCALE).cast("long") + SHIFT).alias("x"))
    )
    usual = clean.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return clean.where(F.size("x") == (usual.d if usual else 0))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and vectors, as matrices of at most ``BLOCK`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            values = part.column(1).flatten().to_numpy(zero_copy_only=False)
            yield part.column(0), values.reshape(part.num_rows, -1)


def exact_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of rows and the sum of every dimension, without rounding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * d
        for _, x in _matrices(batches):
            n += len(x)
            # A block of 4096 entries below 2^53 may pass 2^63: its halves are added apart.
            high, low = (x >> 26).sum(0).tolist(), (x & ((1 << 26) - 1)).sum(0).tolist()
            sums = [s + (h << 26) + lo for s, h, lo in zip(sums, high, low, strict=True)]
        values = pa.array([Decimal(v) for v in [n, *sums]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), values], names=["k", "value"])

    total = rows.mapInArrow(run, "k int, value decimal(38,0)").groupBy("k").agg(F.sum("value").alias("value"))
    found = {r.k: int(r.value) for r in total.collect()}
    return found.get(-1, 0), [found.get(k, 0) for k in range(d)]


def centring(n: int, sums: list[int]):
    """A function that takes the mean off a block of rows."""
    # A mean is split into whole and rest, so that x - whole is exact before the rest is taken off.
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return lambda x: (x - whole).astype(np.float64) - rest


class Centred:
    """The centred rows as a matrix that only sums come out of."""

    def __init__(self, rows: DataFrame, n: int, sums: list[int]):
        self.rows, self.n, self.d = rows, n, len(sums)
        self.centre = centring(n, sums)

    def _sums(self, of_block, size: int) -> np.ndarray:
        """The sum over all rows of what ``of_block`` makes of a block of centred rows."""
        centre = self.centre

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for _, x in _matrices(batches):
                total += of_block(centre(x))
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], names=["k", "value"])

        added = self.rows.mapInArrow(run, "k int, value double").groupBy("k").agg(F.sum("value").alias("value"))
        out = np.zeros(size)
        for r in added.collect():
            out[r.k] = r.value
        return out

    def products(self, c: np.ndarray, earlier: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """For ``u = X c``: ``X' u``, ``U' u`` where ``U = X earlier``, and ``u' u``."""
        d, k = self.d, earlier.shape[1]

        def of_block(x):
            u = x @ c
            return np.concatenate([x.T @ u, (x @ earlier).T @ u, [u @ u]])

        sums = self._sums(of_block, d + k + 1)
        return sums[:d], sums[d : d + k], float(sums[-1])

    def covariance(self, directions: np.ndarray) -> np.ndarray:
        """The covariance, divisor ``n``, of the rows' projections on ``directions``."""
        k = directions.shape[1]

        def of_block(x):
            z = x @ directions
            return np.concatenate([z.sum(0), (z.T @ z).ravel()])

        sums = self._sums(of_block, k + k * k) / self.n
        return sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k])


def _orthogonal(w: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``w`` less its parts along the columns of ``basis``; twice is enough."""
    for _ in range(2):
        w = w - basis @ (basis.T @ w)
    return w


def _start(d: int, basis: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """A unit direction orthogonal to ``basis``."""
    w = _orthogonal(random.standard_normal(d), basis)
    return w / np.linalg.norm(w)


def bidiagonalise(x: Centred, wanted: int, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Singular values (falling) of the centred rows and their right vectors as columns; ``wanted`` of them settled."""
    random = np.random.default_rng(seed)
    d = x.d
    v_all, c_all, w_all = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))
    b = np.zeros((d, d))
    v, beta, quiet = _start(d, v_all, random), 0.0, 0
    scale = 0.0
    for step in range(d):
        v_all = np.column_stack([v_all, v])
        # u = X v less its parts along earlier u; X' u follows from the same sums.
        c = v.copy()
        w, along, square = x.products(c, c_all)
        before = square
        c, w, square = c - c_all @ along, w - w_all @ along, square - along @ along
        b[:step, step] = along
        if square < 0.5 * before:
            # What was taken off was large beside what is left: a pass over the rest gives exact sums.
            w, again, square = x.products(c, c_all)
            c, w, square = c - c_all @ again, w - w_all @ again, square - again @ again
            b[:step, step] += again
        alpha = np.sqrt(max(square, 0.0))
        scale = max(scale, alpha)
        if alpha <= 1e-10 * scale or alpha == 0.0:
            alpha, c, w = 0.0, np.zeros(d), np.zeros(d)
        else:
            c, w = c / alpha, w / alpha
        b[step, step] = alpha
        c_all, w_all = np.column_stack([c_all, c]), np.column_stack([w_all, w])
        if step + 1 == d:
            break
        v = _orthogonal(w, v_all)
        beta = float(np.linalg.norm(v))
        left, values, _ = np.linalg.svd(b[: step + 1, : step + 1])
        top = slice(0, min(wanted, step + 1))
        settled = step + 1 >= wanted and np.all(beta * np.abs(left[-1, top]) <= TOLERANCE * values[0])
        if beta <= 1e-10 * scale or (settled and not quiet):
            # The chain is exhausted, or all that is wanted is settled: look for what it cannot see.
            v, quiet = _start(d, v_all, random), quiet + bool(settled)
        else:
            v = v / beta
            quiet = quiet + 1 if settled and quiet else 0
        if quiet > PATIENCE:
            break
    k = v_all.shape[1]
    _, values, right = np.linalg.svd(b[:k, :k])
    return values, v_all @ right.T


def _exact_squares(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """``sum((n x - S)^2)`` of every row, in whole numbers of any size."""
    low, high = x.min(0).tolist(), x.max(0).tolist()
    most = max(max(abs(n * lo - s), abs(n * hi - s)) for lo, hi, s in zip(low, high, sums, strict=True))
    if most < 2**62 and most * most * x.shape[1] < 2**63 and n < 2**62 and max(map(abs, sums)) < 2**62:
        y = n * x - np.array(sums, np.int64)
        return (y * y).sum(1).tolist()
    y = x.astype(object) * n - np.array(sums, object)
    return (y * y).sum(1).tolist()


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every vector and component."""
    spark = vectors.sparkSession
    rows = whole_vectors(vectors)
    first = rows.first()
    if first is None:
        return spark.createDataFrame([], RESULT)
    d = len(first.x)
    n, sums = exact_sums(rows, d)
    x = Centred(rows, n, sums)
    values, directions = bidiagonalise(x, min(components, d))
    kept = int(np.sum(values[:components] > 1e-9 * max(values[0], 1e-300)))
    directions, e = directions[:, :kept], values[:kept] ** 2 / n
    projection = directions / np.sqrt(e)
    error = float(np.abs(x.covariance(projection) - np.eye(kept)).max()) if kept else 0.0
    trace = float(x._sums(lambda y: np.array([(y * y).sum()]), 1)[0]) / n
    shares = (e / trace).tolist()
    centre = x.centre

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in _matrices(batches):
            z = centre(block) @ projection
            m = len(block)
            spread = [Decimal(v) for v in _exact_squares(block, n, sums)]
            each = np.repeat(np.arange(m), kept)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * kept, n, np.int64)),
                    pa.array(spread, pa.decimal128(38, 0)).take(pa.array(each)),
                    pa.array(z.ravel()),
                    pa.array(np.tile(shares, m)),
                    pa.array(np.full(m * kept, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, RESULT)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their first 32 components."""
    rows = whitened(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))
