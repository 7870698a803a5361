"""N-gram Jaccard join: documents whose sets of word shingles overlap by 80 percent or more.

Jaccard distance is a metric, and the join is a metric-space join by pivots:

1. Equal sets are one point. Points are fingerprinted in one pass over the texts.
2. The first pivots are the sets of a single shingle, ordered from rare to frequent. A point is at
   distance less than 1 only of its own shingles, and its home is the first of them. Points within
   ``1 - threshold`` of each other differ in so few shingles that one of the first
   ``n - ceil(threshold * n) + 1`` of either lies in both: a point is replicated to that window of
   regions, and a point whose window holds only shingles of its own has no link.
3. Within every region documents become pivots: first one that lies in the middle of its copies,
   then, in every round more, members that are not yet connected with the rest. Members within
   ``1 - threshold`` of a pivot are linked, by exact distances. What cannot be linked is not
   compared: a member and a pivot whose distances from the region's first pivot differ by more than
   a link is long (the triangle inequality), or whose parts inside and outside that pivot are too
   small for the overlap. A large region without a large component is cut into Voronoi cells: a
   member goes to the cell of its nearest pivot, and to every other cell ``i`` with
   ``d(y, i) <= d(y, nearest) + 2 * (1 - threshold)``; members far from every pivot form a cell
   that others enter only if they are nearly as far. Cells are the regions of the next round.
   A region whose members are all connected is finished; one whose cells would overlap too much
   stays whole, without its pivots, which are done with everyone.

Rounds end when no region is left; nothing is dropped or capped. Once all regions together hold no more
than ``FEW`` pairs for each member of the first round, one round with all members as pivots is the last:
many rounds over a few rows cost the driver plans, threads and broadcasts, not the tasks work. Shingles are compared by 64-bit
hashes, of which 40 bits travel beside the number of their bucket. No region is gathered in one
task: its members are rows that are dealt by document.

Shingles found in more than one document are found by a shuffle of packed hashes, a bucket of hashes
per group. Shingles in over 1/32 of all documents (there are at most 32 times the mean set size of
them) are known from the first pass, are last in the order, and travel by document instead of by
bucket, so that no bucket grows by them.

Cases: null and empty texts, and texts without words, have an empty set, are linked with nothing and
form components of their own; fewer words than a shingle form one shingle. A null ``doc_id`` takes
part, but a component is named by the smallest id that is not null, if there is one. Repeated
rows are equal sets. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm.components import components
from linkloom.llm.tables import durable, partitions, stored, table
from linkloom.llm.text_blocks import (
    LOWER,
    Block,
    blocks,
    find_words,
    hash_spans,
    hash_windows,
    mix,
    signed,
)

WORDS = 5
LAST = 2**63 - 1
HOT = 32
FLUSH = 1_000_000
WIDTH = 5
PART = 4 << 20  # packed shingles, or rows of shared ones, that a task unpacks at once
CELL_BYTES = 8 << 20  # sets of either side of the pairs that are compared in one group, about
FEW = 4  # pairs for each member of the first round that one round compares, whatever the pivots


def block_shingles(block: Block, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text of a block."""
    data = LOWER[block.data]
    found = find_words(data, block.offsets)
    hashes = hash_spans(data, found.starts, found.ends)
    windows = hash_windows(hashes, words)
    out = []
    for first, last in zip(found.of[:-1].tolist(), found.of[1:].tolist(), strict=True):
        if last - first >= words:
            shingles = np.sort(windows[first : last - words + 1])
            out.append(shingles[np.append(True, shingles[1:] != shingles[:-1])])
        elif last > first:
            out.append(hash_windows(hashes[first:last], last - first))
        else:
            out.append(hashes[:0])
    return out


def set_print(shingles: np.ndarray) -> np.uint64:
    """A fingerprint of a set."""
    return mix(mix(shingles).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(shingles)))[0]


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and rows without one for shingles that are frequent in this task."""
    for block in blocks(batches, limit=8 << 20):
        sets = block_shingles(block)
        prints = np.array([set_print(x) for x in sets], np.uint64)
        sizes = np.array([len(x) for x in sets], np.int64)
        yield _rows(block.rows.column("doc_id"), block.rows.column("print"), sizes, prints, np.zeros(len(sets), bool))
        _, first = np.unique(prints, return_index=True)
        if first.size:
            every = np.concatenate([sets[i] for i in first])
            found, counts = np.unique(every, return_counts=True)
            often = counts * 2 * HOT >= max(len(first), 4 * HOT)
            nobody = pa.nulls(int(often.sum()), pa.int64())
            yield _rows(nobody, nobody, counts[often], found[often], np.ones(int(often.sum()), bool))


def _rows(ids: pa.Array, texts: pa.Array, sizes: np.ndarray, prints: np.ndarray, shingle: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, texts, pa.array(sizes), pa.array(signed(prints)), pa.array(shingle)],
        names=["doc_id", "print", "n_shingles", "point", "shingle"],
    )


def _packed(low: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH])


def _unpacked(body: np.ndarray) -> np.ndarray:
    out = np.zeros((len(body) // WIDTH, 8), np.uint8)
    out[:, :WIDTH] = body.reshape(-1, WIDTH)
    return out.view("<u8").ravel()


_POINT = np.dtype([("point", "<u8"), ("size", "<u4"), ("here", "<u4")])


def _packets(sets: dict[int, np.ndarray], hot: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Shingles of points by bucket: a table of points with counts, then the low bits."""
    points = np.fromiter(sets, np.uint64, len(sets))
    sizes = np.array([len(x) for x in sets.values()], np.uint32)
    every = np.concatenate(list(sets.values()))
    owner = np.repeat(np.arange(len(points)), sizes)
    if len(hot):
        is_hot = hot[np.minimum(np.searchsorted(hot, every), len(hot) - 1)] == every
        for kind, keep in ((1, is_hot), (0, ~is_hot)):
            yield from _dealt(kind, points, sizes, owner[keep], every[keep], buckets)
    else:
        yield from _dealt(0, points, sizes, owner, every, buckets)


def _dealt(kind, points, sizes, owner, shingles, buckets) -> Iterator[tuple]:
    key = points[owner] if kind else shingles
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((owner, bucket)) if len(owner) else owner
    bucket, owner, shingles = bucket[order], owner[order], shingles[order]
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        part = slice(edges[b], edges[b + 1])
        who, counts = np.unique(owner[part], return_counts=True)
        head = np.empty(len(who), _POINT)
        head["point"], head["size"], head["here"] = points[who], sizes[who], counts
        low = shingles[part] if kind else shingles[part] // np.uint64(buckets)
        body = low.astype("<u8").tobytes() if kind else _packed(low).tobytes()
        yield int(b), kind, len(who), head.tobytes() + body


def _read(body: bytes, points: int, kind: int) -> tuple[np.ndarray, np.ndarray]:
    head = np.frombuffer(body, _POINT, points)
    rest = np.frombuffer(body, np.uint8, offset=points * _POINT.itemsize)
    return head, rest.view("<u8") if kind else _unpacked(rest)


_SHARED = np.dtype([("point", "<u8"), ("shingle", "<u8"), ("size", "<u4"), ("found", "<u4")])


def _parts(size: int) -> int:
    return max(1, -(-size // PART))


def _by_slot(rows: list[np.ndarray], slots: int) -> pa.RecordBatch:
    """Rows dealt by point: a body per slot."""
    rows = np.concatenate(rows)
    slot = (mix(rows["point"]) % np.uint64(slots)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    slot, rows = slot[order], rows[order]
    edges = np.searchsorted(slot, np.arange(slots + 1))
    used = np.flatnonzero(np.diff(edges))
    bodies = pa.array([rows[edges[s] : edges[s + 1]].tobytes() for s in used], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), bodies], names=["slot", "body"])


def _repeated(packets: list[tuple[int, bytes]], part: int, parts: int, bucket: int, buckets: int) -> np.ndarray:
    """Of a part of a bucket's shingles the rows of those found in several points."""
    points, shingles, sizes = [], [], []
    for n, body in packets:
        head, low = _read(body, n, 0)
        owner = np.repeat(np.arange(n, dtype=np.uint32), head["here"])
        if parts > 1:
            here = low % np.uint64(parts) == part
            owner, low = owner[here], low[here]
        points.append(head["point"][owner]), shingles.append(low), sizes.append(head["size"][owner])
    points, shingles, sizes = map(np.concatenate, (points, shingles, sizes))
    order = np.argsort(shingles, kind="stable")
    shingles = shingles[order]
    edge = np.flatnonzero(np.append(True, shingles[1:] != shingles[:-1])[: len(shingles)])
    runs = np.diff(np.append(edge, len(shingles)))
    keep = np.repeat(runs > 1, runs)
    order, shingles = order[keep], shingles[keep]
    points, sizes = points[order], sizes[order]
    # One point may come from several tasks: it counts once.
    order = np.lexsort((points, shingles))
    shingles, points, sizes = shingles[order], points[order], sizes[order]
    new = np.append(True, (shingles[1:] != shingles[:-1]) | (points[1:] != points[:-1]))[: len(points)]
    shingles, points, sizes = shingles[new], points[new], sizes[new]
    edge = np.flatnonzero(np.append(True, shingles[1:] != shingles[:-1])[: len(points)])
    runs = np.diff(np.append(edge, len(shingles)))
    found = np.repeat(runs, runs)
    row = np.empty(len(points), _SHARED)
    row["point"], row["size"], row["found"] = points, sizes, found
    row["shingle"] = shingles * np.uint64(buckets) + np.uint64(bucket)
    return row[found > 1]


def _shared(buckets: int, slots: int):
    """Of a bucket's shingles those found in several points, packed by point.

    A bucket stays packed; of its shingles one part after the other is unpacked and sorted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packets, bucket = [], 0
        ready, held = [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("bucket", "kind", "points", "body"))
            for bucket, kind, n, body in zip(*columns, strict=True):
                if not kind:
                    packets.append((n, body))
                    continue
                head, low = _read(body, n, kind)
                row = np.zeros(len(low), _SHARED)
                row["point"], row["size"] = np.repeat(head["point"], head["here"]), np.repeat(head["size"], head["here"])
                row["shingle"] = low
                ready.append(row)
                held += row.nbytes
                if held > PART:
                    yield _by_slot(ready, slots)
                    ready, held = [], 0
        if ready:
            yield _by_slot(ready, slots)
        parts = _parts(sum(len(body) for _, body in packets))
        for part in range(parts if packets else 0):
            yield _by_slot([_repeated(packets, part, parts, bucket, buckets)], slots)

    return run


def _windows(percent: int, slots: int):
    """Points with their shared shingles and the window of regions they are replicated to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bodies = [body for batch in batches for body in batch.column("body").to_pylist()]
        parts = _parts(sum(map(len, bodies)))
        for part in range(parts):
            rows = [np.frombuffer(x, _SHARED) for x in bodies]
            if parts > 1:
                rows = [x[mix(x["point"]) // np.uint64(slots) % np.uint64(parts) == part] for x in rows]
            yield _placed(np.concatenate(rows), percent)

    return run


def _placed(rows: np.ndarray, percent: int) -> pa.RecordBatch:
    # Rare shingles first, those in a large part of all documents last.
    rank = np.where(rows["found"] == 0, np.iinfo(np.uint32).max, rows["found"])
    order = np.lexsort((rows["shingle"], rank, rows["point"]))
    rows = rows[order]
    new = np.append(True, (rows["point"][1:] != rows["point"][:-1]) | (rows["shingle"][1:] != rows["shingle"][:-1]))
    rows = rows[new[: len(rows)]]
    edge = np.flatnonzero(np.append(True, rows["point"][1:] != rows["point"][:-1])[: len(rows)])
    out = {"point": [], "size": [], "shared": [], "regions": []}
    for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(rows)][: len(edge)], strict=True):
        n, own = int(rows["size"][a]), int(rows["size"][a]) - (b - a)
        window = n - -(-percent * n // 100) + 1
        if window > own:
            shared = rows["shingle"][a:b]
            out["point"].append(rows["point"][a : a + 1].view(np.int64)[0])
            out["size"].append(n)
            out["shared"].append(_packed(np.sort(mix(shared) >> np.uint64(64 - 8 * WIDTH))).tobytes())
            out["regions"].append(shared[: window - own].view(np.int64))
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out.values(), kinds, strict=True)], names=list(out))


def _pack(hot: np.ndarray, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed():
            got = list(_packets(sets, hot, buckets))
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*got), (pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
                names=["bucket", "kind", "points", "body"],
            )

        sets: dict[int, np.ndarray] = {}
        held = 0
        for block in blocks(batches):
            for shingles in block_shingles(block):
                point = int(set_print(shingles))
                if len(shingles) and point not in sets:
                    sets[point] = shingles
                    held += len(shingles)
            if held > FLUSH:
                yield flushed()
                sets, held = {}, 0
        if sets:
            yield flushed()

    return run


def _overlaps(sets: pa.Table, pairs: pa.Table) -> pa.Table:
    """``a, b, common, total`` of the pairs of a cell, pivot by pivot."""
    point, size = sets.column("point").to_numpy(), sets.column("size").to_numpy()
    order = np.argsort(point)
    a, b, pivot = (pairs.column(c).to_numpy() for c in ("a", "b", "pivot"))
    by_pivot = np.argsort(pivot, kind="stable")
    a, b, pivot = a[by_pivot], b[by_pivot], pivot[by_pivot]
    at_a, at_b, at_pivot = (order[np.searchsorted(point, x, sorter=order)] for x in (a, b, pivot))
    member = np.where(at_a == at_pivot, at_b, at_a)
    bodies = [_unpacked(np.frombuffer(x, np.uint8)) for x in sets.column("shared").to_pylist()]
    lengths = np.array([len(x) for x in bodies], np.int64)
    # Pairs of one pivot, of so many shingles at once.
    done = np.cumsum(lengths[member]) // FLUSH
    new = np.append(True, (at_pivot[1:] != at_pivot[:-1]) | (done[1:] != done[:-1]))[: len(a)]
    edge = np.flatnonzero(new).tolist()
    common = np.zeros(len(a), np.int64)
    for first, last in zip(edge, [*edge[1:], len(a)][: len(edge)], strict=True):
        mine, theirs = np.concatenate([bodies[i] for i in member[first:last]]), bodies[at_pivot[first]]
        if len(theirs) and len(mine):
            found = theirs[np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)] == mine
            ends = np.cumsum(lengths[member[first:last]])
            sums = np.append(0, np.cumsum(found))
            common[first:last] = np.diff(np.append(0, sums[ends]))
    total = size[at_a] + size[at_b] - common
    return pa.table({"a": a, "b": b, "common": common, "total": total})


def _apart(rows: DataFrame) -> DataFrame:
    """Rows for a join by point or pair, which is dealt evenly: small ones too come by shuffle, none through the driver."""
    return rows.hint("merge")


def _distances(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """``a, b, common, total`` (sizes of intersection and union) of pairs of points, one of which is the ``pivot``.

    Pairs are dealt over cells: groups of members by groups of pivots. A set goes once to every cell in which
    it has a pair, not with each pair, and none goes through the driver. There are as many groups as sets of
    about ``CELL_BYTES`` need on either side; members have more of them, for the sake of small tasks, as long
    as pivots' sets, repeated in them, take no more than twice the bytes of all sets.
    """
    pairs = pairs.withColumn("member", F.when(F.col("a") == F.col("pivot"), F.col("b")).otherwise(F.col("a")))
    ends = F.array(
        F.struct(F.col("member").alias("point"), F.lit(0).alias("asked")),
        F.struct(F.col("pivot").alias("point"), F.lit(1).alias("asked")),
    )
    used = pairs.select(F.inline(ends)).groupBy("point").agg(F.count("*").alias("times"), F.sum("asked").alias("asked"))
    sets = durable(points.select("point", "size", "shared").join(_apart(used), "point"))
    weight = F.length("shared") + 64
    ways = [2**k for k in range(partitions(pairs.sparkSession).bit_length())]
    moved = sets.agg(
        F.sum(weight).alias("all"),
        F.sum(F.when(F.col("times") > F.col("asked"), weight)).alias("members"),
        F.sum(F.when(F.col("asked") > 0, weight)).alias("pivots"),
        *[F.sum(F.least("asked", F.lit(n)) * weight).alias(f"by_{n}") for n in ways],
    ).first()
    rows = max(-(-(moved.members or 0) // CELL_BYTES), *[n for n in ways if (moved[f"by_{n}"] or 0) <= 2 * (moved.all or 0)])
    columns = max(1, -(-(moved.pivots or 0) // CELL_BYTES))
    cell = F.pmod(F.xxhash64("member"), F.lit(rows)) * columns + F.pmod(F.xxhash64("pivot"), F.lit(columns))
    placed = pairs.withColumn("cell", cell)
    goes = placed.select(F.col("cell").alias("to"), F.explode(F.array("member", "pivot")).alias("point")).distinct()
    sent = goes.join(_apart(sets.select("point", "size", "shared")), "point").select("to", "point", "size", "shared")
    met = sent.groupBy("to").cogroup(placed.select("cell", "a", "b", "pivot").groupBy("cell"))
    return met.applyInArrow(_overlaps, "a long, b long, common long, total long")


SLACK = 1e-9


def point_links(
    points: DataFrame, percent: int = 80, pivots: int = 1, growth: int = 4, far: float = 0.5
) -> tuple[DataFrame | None, DataFrame | None]:
    """Links ``a, b`` between points that connect whatever any link connects, and ``point, component``.

    ``points`` has ``point, size, shared, regions`` as made by :func:`shared_shingles`. The first round
    compares the members of each region with ``pivots`` of them, every next one with ``growth`` times
    as many. Both results are None if no two points meet in a region.
    """
    reach = 1 - percent / 100
    own = F.col("size") - F.length("shared") / WIDTH
    placed = points.select(F.explode("regions").alias("region"), "point", "size", own.alias("own"))
    counts = placed.groupBy("region").agg(F.count("*").alias("n")).where("n > 1")
    here = counts.agg(F.sum("n").alias("members"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs")).first()
    if here.members is None:
        return None, None
    budget = FEW * here.members
    links = named = None
    if pivots == 1 and here.pairs > FEW * points.count():
        members, links, named = _around_pivots(placed, points, percent)
        pivots *= growth
    else:
        nothing = [F.lit(None).cast(kind).alias(c) for c, kind in (("ref", "double"), ("met", "long"))]
        members = durable(placed.select("*", F.col("point").alias("component"), *nothing))
    while True:
        # A region is done when it has one member or when all its members are connected.
        weighed = members.groupBy("region", "component").agg(F.count("*").alias("weight"))
        state = (
            weighed.groupBy("region")
            .agg(F.sum("weight").alias("members"), F.max(F.struct("weight", "component")).alias("top"), F.count("*").alias("parts"))
            .where("parts > 1")
            .select("region", "members", F.col("top.weight").alias("largest"), F.col("top.component").alias("core"))
        )
        open_ = durable(members.join(_apart(state), "region"))
        # A member and a pivot need no comparing if they are connected or cannot be linked: for
        # their sizes and the shingles of their own, or for their places around the region's first
        # pivot: what both have in common lies in the pivot, where neither has more than it
        # shares with the pivot, or outside, where shingles of a member's own do not count; and
        # their distances from the pivot differ by no more than a link's length.
        shared = F.coalesce(
            F.least("met", "k.met")
            + F.least(F.col("size") - F.col("own") - F.col("met"), F.col("k.size") - F.col("k.own") - F.col("k.met")),
            F.least(F.col("size") - F.col("own"), F.col("k.size") - F.col("k.own")),
        )
        needed = (
            (F.col("component") != F.col("k.component"))
            & _within(F.col("size"), F.col("k.size"), shared, percent)
            & F.coalesce(F.abs(F.col("ref") - F.col("k.ref")) <= reach + SLACK, F.lit(True))
        )
        # Of two members that are not connected one at least is not in the largest component.
        member = F.struct("own", "point", "component", "size", "ref", "met").alias("k")
        loose = open_.where("component <> core").select("region", member)
        met = open_.join(_apart(loose), "region").where(((F.col("component") == F.col("core")) | (F.col("point") > F.col("k.point"))) & needed)
        left = met.count()
        if not left:
            break
        last = left <= budget
        if last:
            pairs = durable(_once(met))
        else:
            # A member leaves a region in which none can be like it for the shingles of its own.
            extremes = open_.groupBy("region").agg(
                F.min("size").alias("smallest"), F.max(F.col("size") - F.col("own")).alias("most")
            )
            common = F.least(F.col("size") - F.col("own"), F.col("most"))
            # The best partner has just what can be in common, or is the smallest member.
            open_ = open_.join(extremes, "region").where(
                _within(F.col("size"), F.greatest("smallest", common), common, percent)
            )
            # Regions of many members without a large component are split into cells.
            split = (F.lit(pivots > 1)) & (F.col("members") > 4 * pivots + 16) & (2 * F.col("largest") < F.col("members"))
            open_ = durable(
                open_.drop("smallest", "most").join(weighed, ["region", "component"]).withColumn("split", split)
            )
            # Pivots: members of the smallest components, so that what is not yet connected with the
            # rest is compared first; among them those with the fewest shingles of their own, which
            # lie in the middle of their copies.
            order = F.struct("weight", "own", F.xxhash64("point").alias("mixed"), "point", "component", "size", "ref", "met")
            chosen = durable(_smallest(open_.select("region", order.alias("k")), pivots))
            pairs = durable(_once(open_.join(chosen, "region").where((F.col("point") != F.col("k.point")) & (F.col("split") | needed))))
        known = stored(_distances(pairs, points))
        new = _linked(known, percent)
        links = new if links is None else links.union(new)
        named = _renamed(named, new)
        if last:
            break
        rest = durable(
            open_.select("region", "point", "size", "own", "ref", "met", "split").join(
                _apart(chosen.select("region", F.col("k.point").alias("point"))), ["region", "point"], "left_anti"
            )
        )
        cells = _cells(rest.where("split"), chosen, known, reach, far)
        members = stored(
            _with_component(rest.where("not split").select("region", "point", "size", "own", "ref", "met").union(cells), named)
        )
        pivots *= growth
    return links, named


def _around_pivots(placed: DataFrame, points: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every region's members compared with its one pivot: members of the next round, links, ``point, component``.

    The pivot is the member with the fewest shingles of its own, which lies in the middle of its copies. Copies
    meet in as many regions as they share rare shingles, mostly around the same pivot: regions of one pivot
    become one, which holds each member once, with its distance from the pivot as ``ref`` and what it shares
    with it as ``met``. Members that met in a region still meet.
    """
    order = F.struct("own", (-F.col("size")).alias("small"), F.xxhash64("point").alias("mixed"), "point")
    middle = placed.groupBy("region").agg(F.min(order).alias("k")).select("region", F.col("k.point").alias("pivot"))
    around = durable(
        placed.join(_apart(middle), "region")
        .where("point <> pivot")
        .select(F.col("pivot").alias("region"), "point", "size", "own")
        .distinct()
    )
    a, b = F.greatest("point", "region"), F.least("point", "region")
    pairs = durable(around.groupBy(a.alias("a"), b.alias("b")).agg(F.min("region").alias("pivot")))
    known = stored(_distances(pairs, points))
    links = _linked(known, percent)
    named = _renamed(None, links)
    places = known.select("a", "b", (1 - F.col("common") / F.col("total")).alias("ref"), F.col("common").alias("met"))
    members = around.withColumns({"a": a, "b": b}).join(_apart(places), ["a", "b"]).drop("a", "b")
    return stored(_with_component(members, named)), links, named


def _once(met: DataFrame) -> DataFrame:
    """``a, b, pivot`` of members that met a pivot ``k``, however many regions they met in."""
    return met.groupBy(F.greatest("point", "k.point").alias("a"), F.least("point", "k.point").alias("b")).agg(
        F.min("k.point").alias("pivot")
    )


def _linked(known: DataFrame, percent: int) -> DataFrame:
    return known.where(100 * F.col("common") >= percent * F.col("total")).select("a", "b")


def _with_component(members: DataFrame, named: DataFrame) -> DataFrame:
    """Members with the component of their point, which is the point itself if it has no link."""
    return members.join(_apart(named), "point", "left").select(
        "region", "point", "size", "own", F.coalesce("component", "point").alias("component"), "ref", "met"
    )


def _within(size: Column, other: Column, common: Column, percent: int) -> Column:
    """Whether sets of these sizes with so many common elements, or fewer, can be linked."""
    common = F.least(common, size, other)
    return (100 + percent) * common >= percent * (size + other)


def _renamed(named: DataFrame | None, links: DataFrame) -> DataFrame:
    """``point, component`` of linked points, after the links of one more round."""
    if named is None:
        return stored(components(links).withColumnRenamed("node", "point"))
    ends = links.select(F.explode(F.array("a", "b")).alias("point")).distinct()
    every = named.join(ends, "point", "full").select("point", F.coalesce("component", "point").alias("component"))
    joined = (
        links.join(every.withColumnsRenamed({"point": "a", "component": "ca"}), "a")
        .join(every.withColumnsRenamed({"point": "b", "component": "cb"}), "b")
        .where("ca <> cb")
        .select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    )
    moved = components(joined).select(F.col("node").alias("component"), F.col("component").alias("to"))
    return stored(every.join(moved, "component", "left").select("point", F.coalesce("to", "component").alias("component")))


def _smallest(ranked: DataFrame, n: int) -> DataFrame:
    """The ``n`` smallest ``k`` of every region; tasks keep ``n`` per region before a shuffle."""
    order = Window.partitionBy("region").orderBy("k")
    return ranked.withColumn("r", F.row_number().over(order)).where(F.col("r") <= n).select("region", "k")


def _cells(members: DataFrame, chosen: DataFrame, known: DataFrame, reach: float, far: float) -> DataFrame:
    """Regions of the next round: the cells of pivots, or the region itself if they overlap much."""
    distance = 1 - F.col("common") / F.col("total")
    pivots = chosen.select("region", F.col("k.point").alias("pivot"))
    each = (
        members.join(pivots, "region")
        .withColumn("a", F.greatest("point", "pivot"))
        .withColumn("b", F.least("point", "pivot"))
        .join(_apart(known), ["a", "b"])
        .select("region", "point", "size", "own", "ref", "met", F.struct(distance.alias("d"), "pivot").alias("k"))
    )
    seen = each.groupBy("region", "point", "size", "own", "ref", "met").agg(F.min("k").alias("home"), F.collect_list("k").alias("ks"))
    inside = F.filter(
        "ks", lambda k: (k["d"] <= F.least(F.lit(far + reach), F.col("home.d") + 2 * reach) + SLACK)
    )
    # Members farther than ``far`` from every pivot meet those that are at most a link nearer.
    cells = F.concat(
        F.transform(inside, lambda k: F.xxhash64("region", k["pivot"])),
        F.when(F.col("home.d") > far - reach - SLACK, F.array(F.xxhash64("region", F.lit("far")))).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    placed = durable(seen.select("region", "point", "size", "own", "ref", "met", cells.alias("cells")))
    crowd = placed.groupBy("region").agg((F.sum(F.size("cells")) > 1.5 * F.count("*")).alias("whole"))
    whole = F.array(F.xxhash64("region", F.lit("rest")))
    return placed.join(crowd, "region").select(
        F.explode(F.when(F.col("whole"), whole).otherwise(F.col("cells"))).alias("region"), "point", "size", "own", "ref", "met"
    )


def fingerprints(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """``doc_id, print, n_shingles, point`` of every document (``print`` is a hash of the text), and the shingles in over 1/32 of all points."""
    both = durable(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("print")).mapInArrow(
            _fingerprints, "doc_id long, print long, n_shingles long, point long, shingle boolean"
        )
    )
    prints = both.where("not shingle").drop("shingle")
    points = prints.where("n_shingles > 0").select("point").distinct().count()
    hot = (
        both.where("shingle")
        .groupBy("point")
        .agg(F.sum("n_shingles").alias("found"))
        .where(F.col("found") * 2 * HOT >= max(points, 4 * HOT))
        .select("point")
        .toPandas()
    )
    return prints, np.sort(hot["point"].to_numpy(np.int64).view(np.uint64))


def shared_shingles(docs: DataFrame, hot: np.ndarray, percent: int = 80) -> DataFrame:
    """Points that may have a link: ``point, size, shared`` (packed shingles), ``regions``."""
    buckets = slots = max(8, partitions(docs.sparkSession))
    packets = docs.select("text").mapInArrow(
        _pack(hot, buckets), "bucket int, kind int, points int, body binary"
    )
    shared = packets.groupBy("bucket").applyInArrow(_shared(buckets, slots), "slot int, body binary")
    return shared.groupBy("slot").applyInArrow(
        _windows(percent, slots), "point long, size long, shared binary, regions array<long>"
    )


def jaccard_join(docs: DataFrame, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Documents with their component, and the links between points.

    Documents have ``doc_id, print, n_shingles, point, component, component_id``. Equal sets are a
    point, linked points a component; ``component`` is null for empty sets. Links ``a, b`` connect all
    points of a component, not each with each.
    """
    prints, hot = fingerprints(docs)
    points = durable(shared_shingles(docs, hot, percent))
    links, named = point_links(points, percent)
    first = prints.where("n_shingles > 0").groupBy("point").agg(F.min("doc_id").alias("first"))
    if named is None:
        links = points.sparkSession.createDataFrame([], "a long, b long")
        first = first.select("point", F.col("point").alias("component"), F.col("first").alias("component_id"))
    else:
        first = durable(first.join(_apart(named), "point", "left").withColumn("component", F.coalesce("component", "point")))
        lowest = first.groupBy("component").agg(F.min("first").alias("component_id"))
        first = first.join(lowest, "component").select("point", "component", "component_id")
    members = prints.join(first, "point", "left").select(
        "doc_id", "print", "n_shingles", "point", "component", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    return members, links


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one row of every component, and all rows without a word.

    The row that stays has the smallest ``doc_id`` (null is last) and, among texts with the same
    id, the smallest hash of the text; of repeated rows one stays.
    """
    members, _ = jaccard_join(docs, percent)
    name = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    staying = (
        members.where("component is not null")
        .groupBy("component")
        .agg(F.min(F.struct(name.alias("doc"), "print")).alias("k"))
        .select("k.doc", "k.print", F.lit(True).alias("stays"))
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(name.alias("doc"), F.xxhash64("text").alias("print"), row.alias("row"))
    copies = Window.partitionBy("doc", "print").orderBy("stays")
    return (
        rows.join(durable(staying), ["doc", "print"], "left")
        .withColumn("copy", F.row_number().over(copies))
        .withColumn("empty", ~F.coalesce(F.rlike("row.text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False)))
        .where(F.col("empty") | (F.col("stays") & (F.col("copy") == 1)))
        .select("row.*")
    )


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    members, _ = jaccard_join(table(spark, sf_dir, "documents"))
    return members.select("doc_id", "n_shingles", "component_id")
