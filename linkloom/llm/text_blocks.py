"""Texts of Arrow batches as byte arrays, cut into words, hashed without Python loops over words.

Everything here works on a block of a few megabytes of text at a time, whatever the size of a batch.
A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and return.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_C = np.uint64(0x94D049BB133111EB)
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


@dataclass
class Block:
    """Rows of a batch with their texts joined: text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    rows: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, joined, and where each text starts; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    n, first = len(column), column.offset
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, body = column.buffers()
    offsets = np.frombuffer(where, np.int64)[first : first + n + 1]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = 4 << 20
) -> Iterator[Block]:
    """The rows of batches, as blocks of at most ``limit`` bytes of text or a single row."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield Block(
                batch.slice(first, last - first),
                data[offsets[first] : offsets[last]],
                offsets[first : last + 1] - offsets[first],
            )
            first = last


@dataclass
class Words:
    """Words of a block: byte positions, and ``of[i]`` to ``of[i + 1]`` the words of text ``i``."""

    starts: np.ndarray
    ends: np.ndarray
    of: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.of)


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Where the words of a block start and end."""
    inside = ~WHITE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    before[edges] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    if len(edges):
        after[edges[1:] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; loops over eights of bytes, not over spans."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    left = (ends - starts).astype(np.int64)
    out = mix(left.astype(np.uint64) + _A)
    active, at = np.arange(len(starts)), starts.astype(np.int64)
    while len(active):
        size = left[active]
        chunk = eights[at[active]] & _MASKS[np.minimum(size, 8)]
        out[active] = mix(out[active] * _A + chunk)
        active = active[size > 8]
        left[active] -= 8
        at[active] += 8
    return out


def hash_windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of every ``n`` neighbours in ``hashes``; shorter by ``n - 1``."""
    count = max(0, len(hashes) - n + 1)
    out = mix(hashes[:count] + np.uint64(n))
    for k in range(1, n):
        out = mix(out * _A + hashes[k : k + count])
    return out


def window_starts(of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a window of ``n`` words of one text starts, and counts per text."""
    counts = np.maximum(np.diff(of) - n + 1, 0)
    first = np.repeat(of[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    return first + np.arange(len(first)), counts


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's long."""
    return x.view(np.int64)
