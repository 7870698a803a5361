"""Suffix-array dedup: bytes inside a 50-byte string that an earlier document also holds are removed.

Suffixes are cut into independent parts first, so that none is sorted that cannot matter. Every window of
``LENGTH`` bytes has an anchor, the 24-byte string in it with the smallest hash (the leftmost of equal ones):
equal windows have equal anchors at equal places. Windows with one anchor lie side by side, and the
bytes they cover are the anchor's context. An anchor that only one text holds is dropped with its windows.

The contexts of the others are dealt by anchor: a packet goes from every slot of texts to every bucket of anchors.
In each bucket the distinct contexts are cut into shards of a fixed size, whatever packets they come from;
the shard's suffixes are sorted and give its Burrows-Wheeler transform. The transforms of all shards
are merged by iterative interleave refinement: a vector says which shard the next row comes from; reading the
transforms in that order and dealing the vector stably by the symbols read gives the order by two
more symbols. A round reads only the suffixes that the windows have come to, counted back from their ends:
as many rows in every round as there are windows. Rows of a shard never change places, and no two suffixes are
compared. After ``LENGTH`` symbols neighbours are compared once, which gives the intervals of rows with a common
prefix of ``LENGTH`` bytes; the smallest document of an interval keeps its bytes, the others lose them.

Texts that are equal are one text with several ids: the smallest takes part, the others lose everything.
Every task sends a text once, whatever the number of its copies there.

Cases: a null text is empty; texts under ``LENGTH`` bytes lose nothing; a null ``doc_id`` counts as larger
than all others; rows with the same id take nothing from each other, and each gets a result. Other
columns are ignored; empty input gives empty output.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import jaccard_join
from linkloom.llm.jaccard_join import _SHARED, _parts
from linkloom.llm.tables import partitions, table
from linkloom.llm.text_blocks import blocks, hash_spans

LENGTH = 50
GRAM = 24
SPAN = LENGTH - GRAM + 1
LAST = 2**63 - 1
END = 0xFF
FLUSH = 24 << 20
CHUNK = 1 << 15  # windows whose anchors are looked for at once: their hashes stay in a core's cache
SHARD = 1 << 16  # rows of a shard at most: three ranks and a row are one 64-bit number
MERGED = 1 << 20  # bytes of contexts that are merged at once, about: rows of a round stay in the cache

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def text_print(text: bytes) -> int:
    """A 64-bit digest of a text."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash of each anchor, the first of its windows, how many it has, and the text it is in."""
    empty = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return empty.astype(np.uint64), empty, empty, empty
    # Runs of windows with one place; some of the windows lie in two texts.
    runs = [_runs(data[at : at + CHUNK + LENGTH - 1], at) for at in range(0, len(data) - LENGTH + 1, CHUNK)]
    hashes, place, begin = (np.concatenate(x) for x in zip(*runs, strict=True))
    new = np.append(True, place[1:] != place[:-1])
    hashes, begin = hashes[new], begin[new]
    # A run also ends where the windows of its text begin or end.
    ends = np.maximum(offsets[1:] - LENGTH + 1, offsets[:-1])
    edge = np.sort(np.concatenate([begin, offsets[:-1], ends]), kind="stable")
    edge = edge[np.append(True, edge[1:] != edge[:-1]) & (edge <= len(data) - LENGTH + 1)]
    start, counts = edge[:-1], np.diff(edge)
    text = np.searchsorted(offsets, start, "right") - 1
    inside = start < ends[text]
    start, counts, text = start[inside], counts[inside], text[inside]
    return hashes[np.searchsorted(begin, start, "right") - 1], start, counts, text


def _runs(data: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows of ``data``, whose first byte is byte ``at``: hash and place of each run's anchor, and the run's first window."""
    n = len(data) - GRAM + 1
    eights = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), 0, (1,))
    h = eights[:n] * _A
    for k in (8, 16):
        h ^= h >> np.uint64(29)
        h += eights[k : k + n]
        h *= _B
    h ^= h >> np.uint64(32)
    h *= _C
    # The upper half of the hash, then the place: the smallest is the leftmost smallest hash.
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    rest = SPAN - width
    key = np.minimum(key[:-rest], key[rest:]) if rest else key
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    place = (key[begin] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return h[place], place + at, begin + at


def _travelled(h: np.ndarray, buckets: int) -> np.ndarray:
    """Hashes as they come out of a bucket: 32 bits and the bucket."""
    b = np.uint64(buckets)
    return ((h // b) & np.uint64(0xFFFFFFFF)) * b + h % b


def _pack_anchors(buckets: int):
    """Anchors of distinct texts, by bucket: the texts, how many each has there, and 32 bits of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed():
            points = np.fromiter(sets, np.uint64, len(sets))
            every = np.concatenate([np.zeros(0, np.uint64), *sets.values()])
            owner = np.repeat(np.arange(len(points), dtype=np.int32), [len(x) for x in sets.values()])
            bucket = every % np.uint64(buckets)
            order = np.argsort(bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64), kind="stable")
            owner, low = owner[order], (every // np.uint64(buckets)).astype("<u4")[order]
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            rows = []
            for b in np.flatnonzero(np.diff(edges)).tolist():
                who = owner[edges[b] : edges[b + 1]]
                edge = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
                counts = np.diff(np.append(edge, len(who))).astype("<u4")
                body = points[who[edge]].tobytes() + counts.tobytes() + low[edges[b] : edges[b + 1]].tobytes()
                rows.append((b, len(edge), body))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.binary()))],
                names=["bucket", "points", "body"],
            )

        sets, held = {}, 0
        for block in blocks(batches):
            hashes, _, _, text = anchors(block.data, block.offsets)
            edges = np.searchsorted(text, np.arange(len(block.offsets))).tolist()
            ends, body = block.offsets.tolist(), block.data.tobytes()
            for i in range(len(edges) - 1):
                if edges[i] == edges[i + 1]:
                    continue
                point = text_print(body[ends[i] : ends[i + 1]])
                if point not in sets:
                    found = np.sort(hashes[edges[i] : edges[i + 1]])
                    sets[point] = found[np.append(True, found[1:] != found[:-1])]
                    held += len(sets[point])
            if held > 4_000_000:
                yield flushed()
                sets, held = {}, 0
        yield flushed()

    return run


PACKET = "slot int, kind int, body binary"


def _packet_rows(rows: list[tuple[int, int, bytes]]) -> dict:
    return {
        "slot": pa.array([r[0] for r in rows], pa.int32()),
        "kind": pa.array([r[1] for r in rows], pa.int32()),
        "body": pa.array([r[2] for r in rows], pa.binary()),
    }


_COMPRESSOR = zstandard.ZstdCompressor(level=1)


def _joined(*arrays: np.ndarray) -> bytes:
    """Arrays with their lengths, compressed."""
    head = np.array([a.nbytes for a in arrays], np.int64)
    return _COMPRESSOR.compress(
        b"".join([np.int64(len(arrays)).tobytes(), head.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])
    )


def _split(body: bytes, *types: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, n, 8)
    out, at = [], 8 + 8 * n
    for size, kind in zip(sizes.tolist(), types, strict=True):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def _pack_texts(slots: int):
    """Distinct texts with the ids of their documents, by slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed():
            by_slot: dict[int, list[int]] = {}
            for point in texts:
                by_slot.setdefault(point % slots, []).append(point)
            rows = []
            for slot, points in by_slot.items():
                ids = [np.array(texts[p][1], np.int64) for p in points]
                rows.append(
                    (
                        slot,
                        0,
                        _joined(
                            np.array(points, np.uint64),
                            np.array([len(texts[p][0]) for p in points], np.int64),
                            np.array([len(x) for x in ids], np.int64),
                            np.concatenate(ids),
                            np.frombuffer(b"".join(texts[p][0] for p in points), np.uint8),
                        ),
                    )
                )
            return pa.RecordBatch.from_pydict(_packet_rows(rows))

        texts: dict[int, tuple[bytes, list[int]]] = {}
        held = 0
        for block in blocks(batches):
            ids = block.rows.column("doc_id").fill_null(LAST).to_pylist()
            body = block.data.tobytes()
            for doc, a, b in zip(ids, block.offsets[:-1].tolist(), block.offsets[1:].tolist(), strict=True):
                text = body[a:b]
                point = text_print(text)
                if point in texts:
                    texts[point][1].append(doc)
                else:
                    texts[point] = (text, [doc])
                    held += len(text)
            if held > FLUSH:
                yield flushed()
                texts, held = {}, 0
        yield flushed()

    return run


def _texts(bodies: list[bytes]) -> dict[int, tuple[bytes, np.ndarray]]:
    """Texts of a slot with all their ids."""
    out: dict[int, tuple[bytes, list]] = {}
    for body in bodies:
        points, sizes, counts, ids, data = _split(body, "<u8", "<i8", "<i8", "<i8", "u1")
        raw = data.tobytes()
        ends, id_ends = np.cumsum(sizes), np.cumsum(counts)
        for p, e, s, ie, c in zip(points.tolist(), ends.tolist(), sizes.tolist(), id_ends.tolist(), counts.tolist(), strict=True):
            if p in out:
                out[p][1].append(ids[ie - c : ie])
            else:
                out[p] = (raw[e - s : e], [ids[ie - c : ie]])
    return {p: (text, np.sort(np.concatenate(ids))) for p, (text, ids) in out.items()}


def _contexts(buckets: int):
    """Of a slot's texts the contexts of shared anchors, by bucket."""

    def run(texts: pa.Table, shared: pa.Table) -> pa.Table:
        rows = []
        if shared.num_rows:
            shared = np.concatenate([np.frombuffer(b, _SHARED) for b in shared.column("body").to_pylist()])
            shared = shared[np.lexsort((shared["shingle"], shared["point"]))]
            points, first = np.unique(shared["point"], return_index=True)
            last = np.append(first[1:], len(shared))
            chosen = list(zip(points.tolist(), first.tolist(), last.tolist(), strict=True))
            rows = _contexts_of(_texts(texts.column("body").to_pylist()), shared["shingle"], chosen, buckets)
        return pa.table(_packet_rows(rows))

    return run


def _contexts_of(texts, shingles, chosen, buckets) -> list[tuple[int, int, bytes]]:
    data = np.frombuffer(b"".join(texts[p][0] for p, _, _ in chosen), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(texts[p][0]) for p, _, _ in chosen])])
    points = np.array([p for p, _, _ in chosen], np.uint64)
    docs = np.array([texts[p][1][0] for p, _, _ in chosen], np.int64)
    hashes, start, windows, text = anchors(data, offsets)
    known = _travelled(hashes, buckets)
    keep = np.zeros(len(known), bool)
    edges = np.searchsorted(text, np.arange(len(chosen) + 1)).tolist()
    for i, (_, a, b) in enumerate(chosen):
        part = slice(edges[i], edges[i + 1])
        mine = shingles[a:b]
        keep[part] = mine[np.minimum(np.searchsorted(mine, known[part]), len(mine) - 1)] == known[part]
    hashes, start, windows, text = hashes[keep], start[keep], windows[keep], text[keep]
    ends = start + windows + LENGTH - 1
    prints = hash_spans(data, start, ends)
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    # A bucket may be merged in parts; contexts of one anchor are in one part.
    deal = (hashes // np.uint64(buckets)).astype(np.uint8)
    order = np.lexsort((prints, bucket << 8 | deal))
    parts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(parts)):
        here = order[parts[b] : parts[b + 1]]
        # Equal contexts are one context with several occurrences.
        new = np.append(True, (prints[here][1:] != prints[here][:-1]) | (deal[here][1:] != deal[here][:-1]))
        context = np.cumsum(new) - 1
        rep = here[new]
        sizes = ends[rep] - start[rep]
        total = np.concatenate([[0], np.cumsum(sizes)])
        where = np.repeat(start[rep] - total[:-1], sizes) + np.arange(total[-1])
        rows.append(
            (
                int(b),
                2,
                _joined(
                    deal[rep],
                    sizes.astype(np.int32),
                    context.astype(np.int32),
                    points[text[here]],
                    docs[text[here]],
                    (start[here] - offsets[text[here]]).astype(np.int64),
                    data[where],
                ),
            )
        )
    return rows


class Shard:
    """Contexts with the order of their suffixes, each context followed by ``END``."""

    def __init__(self, sizes: np.ndarray, data: np.ndarray):
        self.sizes = sizes.astype(np.int64)
        n = len(sizes)
        ends = np.cumsum(self.sizes)
        self.text = np.full(len(data) + n, END, np.uint8)
        self.last = ends + np.arange(n)
        self.first = self.last - self.sizes
        real = np.ones(len(self.text), bool)
        real[self.last] = False
        self.text[real] = data
        self.owner = np.repeat(np.arange(n), self.sizes + 1)
        self.inside = (np.arange(len(self.text)) - self.first[self.owner]).astype(np.uint8)
        self.windows = (self.sizes - LENGTH + 1).astype(np.uint8)[self.owner]
        self.rows = self._sorted_suffixes()

    def _sorted_suffixes(self) -> np.ndarray:
        """Suffixes by ``LENGTH`` symbols and more. What follows ``END`` decides between suffixes no window reaches beyond."""
        n = len(self.text)
        # Key and row are one number: sorting numbers is faster than sorting rows by them.
        bits = np.uint64(max(1, (n - 1).bit_length()))
        row = np.arange(n, dtype=np.uint64)
        depth = min(8, (64 - int(bits)) // 8)
        padded = np.append(self.text, np.zeros(8, np.uint8))
        key = np.ndarray((n,), ">u8", padded, 0, (1,)).astype(np.uint64) >> np.uint64(64 - 8 * depth)
        while True:
            # Suffixes with equal keys may stand in any order: they have one prefix.
            ordered = np.sort(key << bits | row)
            order = (ordered & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            if depth >= LENGTH:
                return order
            ordered >>= bits
            rank = np.zeros(n, np.uint64)
            rank[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1]))
            # A key is the rank here, and those of as many suffixes further on as there is room for.
            taken = 64 // int(bits) - 1
            key = rank.copy()
            for k in range(1, taken):
                key <<= bits
                key[: max(0, n - k * depth)] |= rank[k * depth :]
            depth *= taken

    def transform(self) -> np.ndarray:
        """The two symbols before each suffix, in sorted order."""
        before = np.append(np.zeros(2, np.uint16), self.text[:-1])
        return (before[:-1] << np.uint16(8) | before[1:])[self.rows]


def interleaved(transforms: list[np.ndarray], inside: np.ndarray | None = None, windows: np.ndarray | None = None) -> np.ndarray:
    """From which shard the next row of the merged order comes, by the first ``LENGTH`` symbols.

    With the place of every row inside its context and the number of the context's windows, the rows are those
    that start a window: every round reads only the suffixes that windows have come to (``LENGTH`` is even).
    """
    kind = np.uint8 if len(transforms) <= 256 else np.uint16 if len(transforms) <= 65536 else np.int64
    sizes = [len(t) for t in transforms]
    source = np.repeat(np.arange(len(transforms)), sizes).astype(kind)
    symbols = np.concatenate(transforms)
    if inside is not None:
        source = source[inside < windows]
    for depth in range(0, LENGTH, 2):
        now = symbols if inside is None else symbols[inside - np.uint8(LENGTH - depth) < windows]
        read = np.empty_like(now)
        read[np.argsort(source, kind="stable")] = now
        after = source[np.argsort(read, kind="stable")]
        if inside is None and np.array_equal(after, source):
            break
        source = after
    return source


_CUT = np.dtype([("point", "<u8"), ("start", "<i8"), ("end", "<i8")])


def _parted(bodies: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """The contexts of a bucket's packets and their occurrences, in parts of about ``MERGED`` bytes."""
    packets = [_split(body, "u1", "<i4", "<i4", "<u8", "<i8", "<i8", "u1") for body in bodies]
    shift = np.cumsum([0, *(len(p[1]) for p in packets[:-1])])
    deal, sizes, context, *rows, data = (np.concatenate(x) for x in zip(*packets, strict=True))
    context = context + np.repeat(shift, [len(p[2]) for p in packets])
    del packets
    parts = min(256, -(-len(data) // MERGED))
    order = np.argsort(deal, kind="stable")
    edges = np.searchsorted(deal[order], [-(-256 * k // parts) for k in range(parts + 1)])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    context = place[context]
    by_context = np.argsort(context)
    found = np.searchsorted(context[by_context], edges)
    begin = np.cumsum(sizes, dtype=np.int64) - sizes
    for k in np.flatnonzero(np.diff(edges)):
        mine, here = order[edges[k] : edges[k + 1]], by_context[found[k] : found[k + 1]]
        total = np.concatenate([[0], np.cumsum(sizes[mine], dtype=np.int64)])
        where = np.repeat(begin[mine] - total[:-1], sizes[mine]) + np.arange(total[-1])
        yield sizes[mine], context[here] - edges[k], *(x[here] for x in rows), data[where]


def _shards(sizes: np.ndarray, context: np.ndarray, data: np.ndarray) -> tuple[list[Shard], np.ndarray]:
    """Shards of the distinct contexts, and the number of the context of every occurrence."""
    ends = np.cumsum(sizes, dtype=np.int64)
    _, first, number = np.unique(hash_spans(data, ends - sizes, ends), return_index=True, return_inverse=True)
    fresh = np.zeros(len(sizes), bool)
    fresh[first] = True
    place = (np.cumsum(fresh) - 1)[first]
    data, sizes = data[np.repeat(fresh, sizes)], sizes[fresh]
    begin = np.cumsum(sizes + 1, dtype=np.int64) - sizes - 1
    edges = np.flatnonzero(np.diff(begin // (SHARD - LENGTH - SPAN), prepend=-1)).tolist()
    ends = np.cumsum(sizes, dtype=np.int64)
    shards = [
        Shard(sizes[a:b], data[ends[a] - sizes[a] : ends[b - 1]]) for a, b in zip(edges, [*edges[1:], len(sizes)], strict=True)
    ]
    return shards, place[number[context]]


def _lost(part: tuple[np.ndarray, ...]) -> np.ndarray:
    """Spans that texts lose, from the contexts of a part."""
    sizes, context, points, docs, places, data = part
    shards, context = _shards(sizes, context, data)
    inside = np.concatenate([s.inside[s.rows] for s in shards])
    windows = np.concatenate([s.windows[s.rows] for s in shards])
    source = interleaved([s.transform() for s in shards], inside, windows)
    # Rows of the merged order as positions in the texts of all shards.
    shift = np.concatenate([[0], np.cumsum([len(s.text) for s in shards])])
    rows = np.empty(len(source), np.int64)
    rows[np.argsort(source, kind="stable")] = np.concatenate([s.rows + k for s, k in zip(shards, shift, strict=False)])[inside < windows]
    text = np.concatenate([s.text for s in shards])
    before = np.concatenate([[0], np.cumsum([len(s.sizes) for s in shards])])
    owner = np.concatenate([s.owner + k for s, k in zip(shards, before, strict=False)])
    first = np.concatenate([s.first + k for s, k in zip(shards, shift, strict=False)])
    sizes = np.concatenate([s.sizes for s in shards])
    # Occurrences of contexts: the smallest document of each, then of each interval.
    least = np.full(len(sizes), LAST)
    np.minimum.at(least, context, docs)
    # Neighbours with a common prefix of LENGTH bytes are in one interval.
    eights = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for at in [*range(0, LENGTH - 7, 8), LENGTH - 8]:
        prefix = eights[rows + at]
        new[1:] |= prefix[1:] != prefix[:-1]
    edge = np.flatnonzero(new)
    smallest = np.repeat(np.minimum.reduceat(least[owner[rows]], edge), np.diff(np.append(edge, len(rows))))
    keeper = np.full(len(text), LAST)
    keeper[rows] = smallest
    windows = (sizes - LENGTH + 1)[context]
    total = np.concatenate([[0], np.cumsum(windows)])
    inside = np.arange(total[-1]) - np.repeat(total[:-1], windows)
    lost = keeper[np.repeat(first[context], windows) + inside] < np.repeat(docs, windows)
    # Windows that are lost one after the other are one span.
    begins, stops = lost.copy(), lost.copy()
    begins[1:] &= ~lost[:-1] | (inside[1:] == 0)
    stops[:-1] &= ~lost[1:] | (inside[1:] == 0)
    who = np.repeat(np.arange(len(windows)), windows)[begins]
    cuts = np.empty(len(who), _CUT)
    cuts["point"] = points[who]
    cuts["start"] = places[who] + inside[begins]
    cuts["end"] = places[who] + inside[stops] + LENGTH
    return cuts


def _merged(slots: int):
    """Spans that texts lose, from the contexts of a bucket, by slot."""

    def run(group: pa.Table) -> pa.Table:
        cuts = [_lost(part) for part in _parted(group.column("body").to_pylist())]
        return pa.table(_dealt(3, np.concatenate(cuts), slots))

    return run


def _dealt(kind: int, rows: np.ndarray, slots: int) -> dict:
    """Rows with a point, as a packet for each slot."""
    slot = (rows["point"] % np.uint64(slots)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    rows, edges = rows[order], np.searchsorted(slot[order], np.arange(slots + 1))
    return _packet_rows([(int(s), kind, rows[edges[s] : edges[s + 1]].tobytes()) for s in np.flatnonzero(np.diff(edges))])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _results(keep_text: bool):
    """Every document of a slot without the spans it loses."""

    def run(texts: pa.Table, cuts: pa.Table) -> pa.Table:
        texts = _texts(texts.column("body").to_pylist())
        cuts = np.concatenate([np.empty(0, _CUT), *(np.frombuffer(b, _CUT) for b in cuts.column("body").to_pylist())])
        cuts = cuts[np.lexsort((cuts["start"], cuts["point"]))]
        points, first = np.unique(cuts["point"], return_index=True)
        last = np.append(first[1:], len(cuts))[: len(first)]
        where = {p: (a, b) for p, a, b in zip(points.tolist(), first.tolist(), last.tolist(), strict=True)}
        out: dict[str, list] = {name: [] for name in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept")}

        def digest(text: bytes) -> bytes:
            return text if keep_text else hashlib.sha256(text).digest()

        nothing = digest(b"")
        for point, (text, ids) in texts.items():
            size = len(text)
            pieces, removed, spans, done = [], 0, 0, 0
            if point in where:
                a, b = where[point]
                low, high = cuts["start"][a:b], np.maximum.accumulate(cuts["end"][a:b])
                new = np.append(True, low[1:] > high[:-1])
                lows, highs = low[new], high[np.append(np.flatnonzero(new)[1:] - 1, len(low) - 1)]
                for low, high in zip(lows.tolist(), highs.tolist(), strict=True):
                    pieces.append(text[done:low])
                    removed, spans, done = removed + high - low, spans + 1, high
            pieces.append(text[done:])
            kept = digest(b"".join(pieces))
            for doc in ids.tolist():
                copy = doc > ids[0] and size >= LENGTH
                out["doc_id"].append(None if doc == LAST else doc)
                out["n_bytes"].append(size)
                out["n_removed"].append(size if copy else removed)
                out["n_spans"].append(1 if copy else spans)
                out["kept"].append(nothing if copy else kept)
        return pa.table(
            {k: pa.array(v, pa.binary() if k == "kept" else pa.int64()) for k, v in out.items()}
        )

    return run


def suffix_dedup(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every document.

    ``kept`` is the remaining bytes (which need not be UTF-8 text), or their SHA-256 digest.
    """
    spark = docs.sparkSession
    slots = max(8, partitions(spark))
    buckets = _buckets(slots)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = (
        given.select("text")
        .mapInArrow(_pack_anchors(buckets), "bucket int, points int, body binary")
        .groupBy("bucket")
        .applyInArrow(_shared_by_text(buckets, slots), PACKET)
    )
    # Both times the texts are the same exchange, which is written once.
    texts = given.mapInArrow(_pack_texts(slots), PACKET).groupBy("slot")
    contexts = texts.cogroup(shared.groupBy("slot")).applyInArrow(_contexts(buckets), PACKET)
    cuts = contexts.groupBy("slot").applyInArrow(_merged(slots), PACKET)
    return texts.cogroup(cuts.groupBy("slot")).applyInArrow(_results(keep_text), RESULT)


def _buckets(slots: int) -> int:
    """A packet goes from every slot to every bucket: many slots deal to fewer buckets, which are merged in parts."""
    return min(2 * slots, max(96, slots // 4))


def _shared_by_text(buckets: int, slots: int):
    """Anchors that several texts hold, by the slot of the text; a part of a bucket after the other.

    A bucket stays packed; of its anchors one part after the other is unpacked and sorted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packets, points, first, bucket = [], [], 0, 0
        for batch in batches:
            for bucket, n, body in zip(*(batch.column(c).to_pylist() for c in ("bucket", "points", "body")), strict=True):
                points.append(np.frombuffer(body, "<u8", n))
                packets.append((first, n, body))
                first += n
        points = np.concatenate([np.zeros(0, np.uint64), *points])
        ready, held = [], 0
        parts = _parts(sum(len(body) for _, _, body in packets))
        for part in range(parts if packets else 0):
            ready.append(_repeated(packets, points, part, parts, bucket, buckets))
            held += ready[-1].nbytes
            if held > jaccard_join.PART or part == parts - 1:
                yield pa.RecordBatch.from_pydict(_dealt(1, np.concatenate(ready), slots))
                ready, held = [], 0

    return run


def _repeated(packets: list[tuple[int, int, bytes]], points: np.ndarray, part: int, parts: int, bucket: int, buckets: int) -> np.ndarray:
    """Of a part of a bucket's anchors the rows of those found in several texts."""
    found = []
    for first, n, body in packets:
        owner = np.repeat(np.arange(first, first + n, dtype=np.uint64), np.frombuffer(body, "<u4", n, 8 * n))
        low = np.frombuffer(body, "<u4", offset=12 * n)
        if parts > 1:
            here = low % np.uint32(parts) == part
            owner, low = owner[here], low[here]
        found.append(low.astype(np.uint64) << np.uint64(32) | owner)
    found = np.sort(np.concatenate(found))
    low = found >> np.uint64(32)
    same = low[1:] == low[:-1]
    several = np.append(same, False) | np.append(False, same)
    low, owner = low[several[: len(low)]], points[(found[several[: len(low)]] & np.uint64(0xFFFFFFFF)).astype(np.int64)]
    # One text may come from several tasks: it counts once.
    order = np.lexsort((owner, low))
    low, owner = low[order], owner[order]
    new = np.append(True, (low[1:] != low[:-1]) | (owner[1:] != owner[:-1]))[: len(low)]
    low, owner = low[new], owner[new]
    edge = np.flatnonzero(np.append(True, low[1:] != low[:-1])[: len(low)])
    runs = np.diff(np.append(edge, len(low)))
    row = np.zeros(len(low), _SHARED)
    row["point"], row["found"] = owner, np.repeat(runs, runs)
    row["shingle"] = low * np.uint64(buckets) + np.uint64(bucket)
    return row[row["found"] > 1]


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed bytes and spans of every document, and the digest of what is kept."""
    found = suffix_dedup(table(spark, sf_dir, "documents"), keep_text=False)
    return found.withColumn("kept_sha256", F.lower(F.hex("kept"))).drop("kept")
