"""Exact join of documents by the Jaccard similarity of their word shingles, in the metric space of shingle sets.

One minus the similarity is a metric, so with radius R = 1 - threshold:

1. **Classes.** Documents with the same set are one point of the space.
2. **Which points can have a neighbour at all.** Shingles are ordered by hash. Two points within R share at least
   an eighth of the smaller one's shingles among the first R n + n / 8 of each (`reach`, `least_shared`), so a point
   too few of whose first shingles occur in any other point has none. Of those that are left, all shingles are looked
   at in the same way: threshold n of them must occur in others. The hashes are dealt out in packed pieces; a hash
   that many points share is sent once a batch.
3. **Shingle pivots.** For the rest, each shingle s is a pivot: {s} is nearer to the points that hold s than to all
   others. Pivots are ordered by the number of their points, rarest first, and a point is replicated into the cells of
   its first n - ceil(threshold n) + 1 pivots; two points within R meet in one of them at least, since a point that
   lacks all these pivots lacks more than R of the other's shingles. Passages that many documents share come last.
   The place of a pivot among a point's shingles bounds the size of a partner whose first common shingle it is (`most`):
   points that fit the size of no other point of a cell leave it, such as those that share a template and nothing else.
4. **Contraction.** In every cell the points are compared with one of them, several rounds with other choices; links
   found that way join components. A group of near copies falls together here, however large it is, and no pairs within
   it are listed. Cells whose points are all of one component are done.
5. **Regions.** Points that share unfinished cells form regions, which share no link. Each is split by point pivots,
   recursively: the pivot's ball (distance up to R) is one component; by the triangle inequality only points outside
   within 2 R of the pivot can be linked with points of the ball, and these only with points of the ball that are at
   least as far from the pivot as the nearest of them less R. That boundary is compared, the ball is closed, and the
   rest is a region of its own. This finds every component exactly. A region above a fixed size is taken apart into its
   cells, one for all cells of the same points: pairs of a small cell are listed and verified, a cell of medium size is
   a region by itself, and a larger one is salted into blocks, each pair of which is a group of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm import bitmaps, bytewise
from parcelwise.llm.components import components, stored

SHINGLE = 5
#: Similarity of at least THRESHOLD[0] / THRESHOLD[1].
THRESHOLD = (3, 4)
#: Packed hashes of one piece; sets the number of pieces, hence a task's memory.
PIECE_HASHES = 1_500_000
#: Hashes that a task packs together, and rows it hands over together.
PACK_HASHES, OUT_ROWS = 1_000_000, 50_000
ROUNDS = 2
#: Points and shingles of a region or block that one task solves, and points of a cell whose pairs are listed.
REGION_POINTS, REGION_HASHES, PAIR_POINTS = 2_000, 4_000_000, 16


def least_common(n):
    """Shingles a set of n has in common with any set within the radius, at least."""
    return -(-THRESHOLD[0] * n // THRESHOLD[1])


def reach(n):
    """How many first shingles take part in step 2."""
    return np.minimum(n, n - least_common(n) + -(-n // 8))


def least_shared(n):
    """How many of them occur in another set, at least, if that is within the radius: an eighth of the smaller set."""
    return -(-least_common(n) // 8)


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, hashes, where each row's begin): the ascending distinct shingle hashes of runs of rows.

    Words are runs of non-blank characters with A-Z lower-cased. Fewer words than a shingle are one shingle.
    """
    for low, high, data, offsets in bytewise.slices(column):
        n = high - low
        data = bytewise.LOWER[data]
        starts, ends, rows = bytewise.spans(bytewise.NOT_SPACE[data], offsets)
        words = bytewise.span_hashes(data, starts, ends)
        own = np.flatnonzero(bytewise.within_row(rows, SHINGLE))
        hashes, owner = bytewise.window_hashes(words, SHINGLE)[own], rows[own]
        counts = np.bincount(rows, minlength=n)
        first = np.cumsum(counts) - counts
        for row in np.flatnonzero((counts > 0) & (counts < SHINGLE)).tolist():
            whole = bytewise.window_hashes(words[first[row] : first[row] + counts[row]], int(counts[row]))
            hashes, owner = np.append(hashes, whole), np.append(owner, row)
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        if len(hashes):
            keep = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))
            hashes, owner = hashes[keep], owner[keep]
        yield low, high, hashes, np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n))))


def signature(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _points(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, signature (null for an empty set) and its first 64 bits, owner, of each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names = [], []
            for low, high, hashes, at in shingle_sets(batch.column("text")):
                sizes += np.diff(at).tolist()
                names += [signature(hashes[at[k] : at[k + 1]]) if at[k] < at[k + 1] else None for k in range(high - low)]
            owners = [_short(n) if n else None for n in names]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(owners, pa.int64())],
                ["doc_id", "n_shingles", "signature", "owner"],
            )

    return docs.select("doc_id", "text").mapInArrow(bytewise.lean(run), f"doc_id {kind}, n_shingles long, signature binary, owner long")


def _short(name: bytes) -> int:
    return int.from_bytes(name[:8], "little", signed=True)


def _first_shingles(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(first bits of the signature, first shingles) of each document of a batch."""
    for _, _, hashes, at in shingle_sets(batch.column("text")):
        for k in np.flatnonzero(np.diff(at)).tolist():
            own = hashes[at[k] : at[k + 1]]
            yield _short(signature(own)), own[: reach(len(own))]


def _all_shingles(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(first bits of the signature, shingles) of each set of a batch."""
    for name, own in zip(batch.column("signature"), batch.column("set")):
        yield _short(name.as_py()), np.frombuffer(own.as_py(), np.uint64)


def _shared_counts(
    rows: DataFrame, shingles: Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray]]], total: int
) -> DataFrame:
    """owner (the first 64 bits of a signature), n: how many of its shingles occur in other sets, at least.

    `total` is about the number of shingles; it sets the number of pieces.
    """
    pieces = max(1, round(total / PIECE_HASHES))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owners, seen, held = [], [], set(), 0
            for name, own in shingles(batch):
                if name not in seen:  # a copy within the batch adds nothing
                    seen.add(name)
                    keys.append(own)
                    owners.append(np.full(len(own), name))
                    held += len(own)
                if held >= PACK_HASHES:
                    yield packed_rows(np.concatenate(keys), np.concatenate(owners))
                    keys, owners, held = [], [], 0
            if held:
                yield packed_rows(np.concatenate(keys), np.concatenate(owners))

    def packed_rows(key: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
        by_key = np.argsort(key, kind="stable")
        ordered = key[by_key]
        same = ordered[1:] == ordered[:-1]
        again, shared = np.append(False, same), np.zeros(len(key), bool)
        shared[by_key] = np.append(same, False) | again
        dropped = np.zeros(len(key), bool)
        dropped[by_key] = again  # of a hash that several sets here share, one is sent on, as shared
        piece = ((key >> np.uint64(32)) % np.uint64(pieces)).astype(np.int32)
        left = np.flatnonzero(~dropped)
        left = left[np.argsort(piece[left], kind="stable")]
        ends = np.searchsorted(piece[left], np.arange(pieces), "right")
        rows = []
        for k in range(pieces):
            at = left[ends[k - 1] if k else 0 : ends[k]]
            if len(at):
                rows.append((k, key[at].astype(np.uint32).tobytes(), owner[at].tobytes(), np.packbits(shared[at]).tobytes()))
        names, times = np.unique(owner[shared], return_counts=True)
        if len(names):  # counted here already
            rows.append((int(names[0]) % pieces, None, names.tobytes(), times.astype(np.int64).tobytes()))
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["piece", "hashes", "owners", "more"])

    def match(rows: pa.Table) -> pa.Table:
        keys, owners, shared = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        names, times = [], []
        for hashes, own, more in zip(rows["hashes"], rows["owners"], rows["more"]):
            own = np.frombuffer(own.as_py(), np.int64)
            if hashes.as_py() is None:
                names.append(own)
                times.append(np.frombuffer(more.as_py(), np.int64))
                continue
            keys.append(np.frombuffer(hashes.as_py(), np.uint32))
            owners.append(own)
            shared.append(np.unpackbits(np.frombuffer(more.as_py(), np.uint8), count=len(own)).astype(bool))
        key, owner, flag = np.concatenate(keys), np.concatenate(owners), np.concatenate(shared)
        order = np.argsort(key, kind="stable")
        key, owner, flag = key[order], owner[order], flag[order]
        if len(key):
            begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            several = np.minimum.reduceat(owner, begin) != np.maximum.reduceat(owner, begin)
            several |= np.logical_or.reduceat(flag, begin)
            hit = np.repeat(several, np.diff(begin, append=len(key))) & ~flag
            found, n = np.unique(owner[hit], return_counts=True)
            names.append(found)
            times.append(n)
        owner, n = added(names, times)
        part = (owner.view(np.uint64) % np.uint64(pieces)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        ends = np.searchsorted(part[order], np.arange(pieces), "right")
        cut = [order[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        found = [(k, owner[at].tobytes(), n[at].tobytes()) for k, at in enumerate(cut) if len(at)]
        keys, owners, shared, names, times = [], [], [], [], []
        bytewise.release()
        kinds = {"part": pa.int32(), "owners": pa.binary(), "counts": pa.binary()}
        return pa.table({c: pa.array([row[k] for row in found], kind) for k, (c, kind) in enumerate(kinds.items())})

    def added(names: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Each owner once, with the sum of its counts."""
        name, n = np.concatenate([np.zeros(0, np.int64), *names]), np.concatenate([np.zeros(0, np.int64), *times])
        owner, which = np.unique(name, return_inverse=True)
        return owner, np.bincount(which, weights=n, minlength=len(owner)).astype(np.int64)

    def add(rows: pa.Table) -> pa.Table:
        numbers = lambda column: [np.frombuffer(v.as_py(), np.int64) for v in rows[column]]
        owner, n = added(numbers("owners"), numbers("counts"))
        return pa.table({"owner": owner, "n": n})

    packed = rows.mapInArrow(bytewise.lean(pack), "piece int, hashes binary, owners binary, more binary")
    counts = packed.repartition(pieces, "piece").groupBy("piece").applyInArrow(match, "part int, owners binary, counts binary")
    return counts.repartition(pieces, "part").groupBy("part").applyInArrow(add, "owner long, n long")


def _sets(docs: DataFrame, points: DataFrame) -> DataFrame:
    """signature, doc_id, set (binary) of the given points (signature, doc_id), each once."""
    bit = bitmaps.place(F.col("doc_id"))
    wanted = bitmaps.build(points.select(bit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.filter(pa.array(bitmaps.marked(wanted.value, batch.column("bit").to_numpy())))
            names, sets = [], []
            for low, high, hashes, at in shingle_sets(kept.column("text")):
                for k in range(high - low):
                    own = hashes[at[k] : at[k + 1]]
                    names.append(signature(own))
                    sets.append(own.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), kept.column("doc_id"), pa.array(sets, pa.binary())],
                ["signature", "doc_id", "set"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.where("doc_id is not null").select("doc_id", "text", bit.alias("bit"))
    found = found.mapInArrow(bytewise.lean(run), f"signature binary, doc_id {kind}, set binary")
    return found.join(points, ["signature", "doc_id"], "left_semi").dropDuplicates(["signature", "doc_id"])


def _cells(sets: DataFrame) -> DataFrame:
    """pivot (a shingle), signature, size, most: the cells each point is replicated into; pivots of one point are left
    out. `most` is the largest size of a partner for which the pivot can be the first shingle in common: the overlap is
    at most what stands from the pivot on, and at least t / (t + w) of both sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(s.as_py(), np.int64) for s in batch.column("set")]
            sizes = np.array([len(s) for s in own])
            ends = np.cumsum(sizes)
            low = 0
            while low < len(own):  # some thousand shingles at a time, one set at least
                high = max(low + 1, int(np.searchsorted(ends, ends[low] - sizes[low] + OUT_ROWS, "right")))
                index = np.repeat(np.arange(low, high), sizes[low:high])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(own[low:high])),
                        batch.column("signature").take(pa.array(index)),
                        pa.array(sizes[index].astype(np.int32)),
                    ],
                    ["pivot", "signature", "size"],
                )
                low = high

    each = sets.select("signature", "set").mapInArrow(bytewise.lean(run), "pivot long, signature binary, size int")
    often = each.groupBy("pivot").agg(F.count("*").alias("points")).where("points > 1")
    shared = each.join(often, "pivot").groupBy("signature", "size").agg(
        F.sort_array(F.collect_list(F.struct("points", "pivot"))).alias("pivots")  # of one document
    )
    alone = F.col("size") - F.size("pivots")
    first = F.col("size") - F.ceil(F.col("size") * THRESHOLD[0] / THRESHOLD[1]) + 1 - alone
    chosen = shared.withColumn("first", first.cast("int")).where("first > 0")
    placed = chosen.select("signature", "size", alone.alias("alone"), F.posexplode(F.slice("pivots", F.lit(1), F.col("first"))).alias("at", "p"))
    left = F.col("size") - F.col("alone") - F.col("at")
    most = F.floor(left * sum(THRESHOLD) / THRESHOLD[0]).cast("int") - F.col("size")
    return placed.select(F.col("p.pivot").alias("pivot"), "signature", "size", most.alias("most"))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two ascending sets are within the radius."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return THRESHOLD[1] * common >= THRESHOLD[0] * (len(a) + len(b) - common)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) of signatures that are within the radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                linked(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64))
                for a, b in zip(batch.column("a"), batch.column("b"))
            ]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("signature").alias("u"), F.col("set").alias("a"))
    right = sets.select(F.col("signature").alias("v"), F.col("set").alias("b"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(bytewise.lean(run), "u binary, v binary")


class _Region:
    """Finds the components of the points of one region."""

    def __init__(self, sets: list[np.ndarray], labels: list) -> None:
        self.sizes = np.array([len(s) for s in sets])
        _, codes = np.unique(np.concatenate(sets), return_inverse=True)
        self.codes, self.ends = codes, np.cumsum(self.sizes)
        self.mark = np.zeros(codes.max() + 1, np.int64)
        first: dict = {}
        self.parent = [first.setdefault(label, k) for k, label in enumerate(labels)]

    def root(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = k = self.parent[self.parent[k]]
        return k

    def own(self, k: int) -> np.ndarray:
        return self.codes[self.ends[k] - self.sizes[k] : self.ends[k]]

    def common(self, pivot: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of the intersections and unions of the pivot with others (not empty)."""
        own, sizes = self.own(pivot), self.sizes[others]
        self.mark[own] = 1
        ends = np.cumsum(sizes)
        at = np.repeat(self.ends[others] - ends, sizes) + np.arange(ends[-1])
        both = np.add.reduceat(self.mark[self.codes[at]], ends - sizes)
        self.mark[own] = 0
        return both, len(own) + sizes - both

    def solve(self) -> None:
        t, w = THRESHOLD
        rest = np.arange(len(self.sizes))
        while len(rest) > 1:
            pivot, rest = int(rest[0]), rest[1:]
            both, union = self.common(pivot, rest)
            ball = w * both >= t * union
            for k in rest[ball].tolist():
                self.parent[self.root(k)] = self.root(pivot)
            far = 1 - both / union
            radius = (w - t) / w + 1e-9
            edge = rest[~ball & (far <= 2 * radius)]
            if ball.any() and len(edge):
                inner = rest[ball & (far >= far[~ball].min() - radius)]
                for k in edge.tolist():
                    if len(inner) and self.root(k) != self.root(pivot):
                        both, union = self.common(k, inner)
                        if (w * both >= t * union).any():
                            self.parent[self.root(k)] = self.root(pivot)
            rest = rest[~ball]

    def across(self, sides: np.ndarray) -> None:
        """Compares the points of side 0 with those of side 1."""
        t, w = THRESHOLD
        others = np.flatnonzero(sides == 1)
        for k in np.flatnonzero(sides == 0).tolist():
            both, union = self.common(k, others)
            for j in others[w * both >= t * union].tolist():
                self.parent[self.root(j)] = self.root(k)


def _solve(rows: pa.Table) -> pa.Table:
    names = rows["signature"].to_pylist()
    region = _Region([np.frombuffer(s.as_py(), np.uint64) for s in rows["set"]], rows["label"].to_pylist())
    sides = rows["side"].to_numpy()
    if sides.min() < sides.max():
        region.across(sides)
    else:
        region.solve()
    roots = [region.root(k) for k in range(len(names))]
    found = [(names[k], names[r]) for k, r in enumerate(roots) if k != r]
    return pa.table({"u": pa.array([a for a, _ in found], pa.binary()), "v": pa.array([b for _, b in found], pa.binary())})


def _solved(regions: DataFrame, cells: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (u, v) that join the components of each region (node, root), from its unfinished cells (pivot, signature,
    label, size, most)."""
    placed = cells.join(regions.withColumnRenamed("node", "signature"), "signature")
    points = placed.select("root", "signature", "label", "size").distinct()
    weight = points.groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("hashes"))
    weight = stored(weight.where((F.col("n") > REGION_POINTS) | (F.col("hashes") > REGION_HASHES)).select("root"), "large")
    none = F.lit(0)
    small = points.join(weight, "root", "left_anti").select("root", none.alias("a"), none.alias("b"), none.alias("side"), "signature", "label")
    if weight.isEmpty():
        return _grouped(small, sets)
    parts = stored(placed.join(weight, "root", "left_semi").drop("root"), "large-cells")
    held = parts.groupBy("pivot").agg(
        F.count("*").alias("n"),
        F.sum("size").alias("hashes"),
        F.bit_xor(F.xxhash64("signature")).alias("h"),
        F.bit_xor(F.xxhash64("signature", F.lit(1))).alias("i"),
    )
    held = stored(held, "held-cells")
    listed = parts.join(held.where(F.col("n") <= PAIR_POINTS).select("pivot"), "pivot")
    x, y = listed.alias("x"), listed.alias("y")
    pairs = x.join(y, "pivot").where(
        "x.signature < y.signature and x.label <> y.label and x.size <= y.most and y.size <= x.most"
    )
    pairs = pairs.select(F.col("x.signature").alias("u"), F.col("y.signature").alias("v")).distinct()
    # two blocks together are what one task solves
    blocks = F.greatest(F.ceil(2 * F.col("n") / REGION_POINTS), F.ceil(2 * F.col("hashes") / REGION_HASHES))
    whole = (F.col("n") <= REGION_POINTS) & (F.col("hashes") <= REGION_HASHES)
    # cells of the same points are one; `most` is no longer used
    once = held.where(F.col("n") > PAIR_POINTS).groupBy("n", "hashes", "h", "i").agg(F.min("pivot").alias("pivot"))
    dealt = once.select("pivot", F.when(whole, 1).otherwise(blocks).cast("long").alias("blocks"))
    salted = parts.join(dealt, "pivot").withColumn("own", F.pmod(F.xxhash64("signature", F.lit("block")), "blocks"))
    salted = salted.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    blocked = salted.select(
        F.col("pivot").alias("root"),
        F.least("own", "other").alias("a"),
        F.greatest("own", "other").alias("b"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "signature",
        "label",
    )
    # a root is a signature, a pivot a number
    found = _grouped(small, sets).union(_grouped(blocked, sets))
    return found.union(_verified(pairs, sets))


def _grouped(points: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of groups (root, a, b) of points (side, signature, label); a group is a task's work."""
    whole = points.join(sets, "signature").select("root", "a", "b", "side", "signature", "set", "label")
    return whole.groupBy("root", "a", "b").applyInArrow(_solve, "u binary, v binary")


def join(docs: DataFrame) -> DataFrame:
    """One row per row of documents (doc_id, text): doc_id, n_shingles, class_id (least doc_id of the same set),
    component_id (least doc_id reachable by links).

    Null and empty texts have no shingles and are linked with nothing: their ids are their own. A row with a null
    doc_id gets its n_shingles and, if rows with an id have its set, their ids. Rows with the same doc_id are points of
    their own sets and give each row that set's ids. Other columns are ignored.
    """
    points = stored(_points(docs), "points")
    classes = (
        points.where("signature is not null and doc_id is not null")
        .groupBy("signature")
        .agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"), F.max("owner").alias("owner"))
    )
    total = points.agg(F.sum("n_shingles")).first()[0] or 0
    shared = _shared_counts(docs.select("text"), _first_shingles, total * 3 // 8)
    n = F.col("n_shingles")
    common = F.ceil(n * THRESHOLD[0] / THRESHOLD[1])
    near = stored(
        classes.join(shared, "owner")
        .where(F.col("n") >= F.ceil(common / 8))
        .select("signature", "doc_id", "n_shingles", "owner"),
        "near",
    )
    sets = stored(_sets(docs, near.select("signature", "doc_id")), "sets")
    # and of all their shingles as many as two points within the radius share
    total = near.agg(F.sum("n_shingles")).first()[0] or 0
    shared = _shared_counts(sets.select("signature", "set"), _all_shingles, total)
    near = near.join(shared, "owner")
    sets = stored(sets.join(near.where(F.col("n") >= common).select("signature"), "signature", "left_semi"), "near-sets")
    cells = stored(_cells(sets), "cells")
    links = stored(sets.select(F.col("signature").alias("u"), F.col("signature").alias("v")).limit(0), "links")
    parts = components(links)
    tagged = cells.withColumn("label", F.col("signature"))
    for k in range(ROUNDS + 1):
        rank = F.struct(F.xxhash64("signature", F.lit(k)).alias("h"), "signature", "label")
        centre = tagged.groupBy("pivot").agg(
            F.min(rank).alias("c"),
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.min("size").alias("least"),
            F.max("most").alias("top"),
        )
        unfinished = tagged.join(centre.where("low < high").select("pivot", "c", "least", "top"), "pivot")
        unfinished = unfinished.where("most >= least and size <= top")
        unfinished = stored(unfinished.select("pivot", "signature", "label", "size", "most", "c"), "unfinished")
        if unfinished.isEmpty():
            break
        both = unfinished.select(F.col("signature").alias("u"), F.col("c.signature").alias("v"), "label", "c")
        if k < ROUNDS:
            found = _verified(both.where("label <> c.label").select("u", "v").distinct(), sets)
        else:
            found = _solved(components(both.select("u", "v")), unfinished.drop("c"), sets)
        links = stored(links.union(found), "links")
        parts = components(links)
        tagged = unfinished.join(parts, F.col("signature") == F.col("node"), "left").select(
            "pivot", "signature", "size", "most", F.coalesce("root", "signature").alias("label")
        )
    joined = classes.join(parts, F.col("signature") == F.col("node"), "left").withColumn("root", F.coalesce("root", "signature"))
    lowest = joined.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    ids = joined.join(lowest, "root").select("signature", F.col("doc_id").alias("class_id"), "component_id")
    alone = F.concat(F.lit("none "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")  # no hot null key
    named = points.withColumn("signature", F.coalesce("signature", alone))
    return named.join(ids, "signature", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
