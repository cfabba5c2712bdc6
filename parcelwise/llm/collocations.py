"""Collocations of 2 to 4 words per language, counted by direct-address tiling.

Items (words, then frequent phrases) are ranked by frequency within their language and get an address: a band of the
ranking, which holds about BAND_MASS occurrences, and a place in it. A pair of neighbouring items thus lies in a tile (band,
band) at a cell (place, place). Tasks count the pairs of a chunk of text tile by tile: a tile that is small against
its pairs as a dense array by numpy's bincount, a sparse one as sorted coordinates. Tiles are summed over the chunks in
rounds of FAN_IN. A band of more than one item has less than 2 * BAND_MASS occurrences, so a tile has no more pairs
than that, however large the input; rounds only keep the tile of two very frequent items from gathering a row a chunk.

Pairs that occur MIN_COUNT times get addresses by their own frequencies and take the words' place, so that the
same count finds phrases of three words as overlapping pairs of phrases of two, and so on: every part of a frequent
phrase is as frequent. Chunks learn the addresses of their own pairs by a join with the frequent ones, tile by tile.
Only packed tiles and word numbers are shuffled, never texts. Within a chunk, 64-bit hashes stand for words; between
chunks the words themselves do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm import bytewise
from parcelwise.llm.ordering import placed
from parcelwise.llm.packed import pack, unpack
from parcelwise.llm.scratch import Scratch

MIN_COUNT = 30
LONGEST = 4
#: Occurrences in a band of the frequency ranking; bounds the pairs of a tile.
BAND_MASS = 1 << 22
#: Words of a chunk, and chunks that are summed in one group.
CHUNK_WORDS = 1 << 20
FAN_IN = 4096
NO_LANGUAGE = "und"

_PLACE = np.int64((1 << 32) - 1)
_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_BREAKS
_WORD[[0x20, 0x09]] = False


def _cut(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, row starts) of about a megabyte each; a longer text is cut at ends of pieces, where no phrase goes across."""
    for _, _, data, offsets in bytewise.slices(column):
        if len(offsets) > 2 or len(data) <= 2 * bytewise.SLICE_BYTES:
            yield data, offsets
            continue
        ends = np.append(np.flatnonzero(_BREAKS[data]) + 1, len(data))
        low = 0
        while low < len(data):
            high = int(ends[max(np.searchsorted(ends, low + bytewise.SLICE_BYTES, "right") - 1, np.searchsorted(ends, low, "right"))])
            yield data[low:high], np.array([0, high - low])
            low = high


class _Chunk:
    """Words of one language, gathered until there are CHUNK_WORDS."""

    def __init__(self) -> None:
        self.data, self.starts, self.ends, self.hashes, self.last, self.size, self.words = [], [], [], [], [], 0, 0

    def add(self, data: np.ndarray, offsets: np.ndarray) -> None:
        lower = bytewise.LOWER[data]
        starts, ends, rows = bytewise.spans(_WORD[lower], offsets)
        if not len(starts):
            return
        broken = np.append(0, np.cumsum(_BREAKS[lower]))
        last = np.ones(len(starts), bool)  # of its piece
        last[:-1] = (rows[1:] != rows[:-1]) | (broken[starts[1:]] != broken[ends[:-1]])
        self.hashes.append(bytewise.span_hashes(lower, starts, ends))
        for held, new in ((self.data, lower), (self.starts, starts + self.size), (self.ends, ends + self.size), (self.last, last)):
            held.append(new)
        self.size += len(lower)
        self.words += len(starts)

    def row(self, lang: str, chunk: int) -> pa.RecordBatch:
        starts, ends, last = (np.concatenate(x) for x in (self.starts, self.ends, self.last))
        _, first, number, counts = np.unique(np.concatenate(self.hashes), return_index=True, return_inverse=True, return_counts=True)
        raw = np.concatenate(self.data).tobytes()
        words = pa.array([raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())], pa.binary()).cast(pa.string())
        items = np.insert(number.astype("<i4"), np.flatnonzero(last) + 1, -1)
        columns = [
            pa.array([lang]),
            pa.array([chunk], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
            pa.array([counts], pa.list_(pa.int64())),
            pa.array([items.tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, list(_CHUNK))


_CHUNK = {"lang": "string", "chunk": "long", "words": "array<string>", "counts": "array<long>", "items": "binary"}
_TILE = {"lang": "string", "chunk": "long", "bx": "long", "by": "long", "cells": "binary", "counts": "binary"}


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{n} {k}" for n, k in columns.items())


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, made, open_chunks = TaskContext.get().partitionId(), 0, {}
    for batch in batches:
        langs = batch.column("lang")
        for lang in langs.unique():
            own = open_chunks.setdefault(lang.as_py(), _Chunk())
            for data, offsets in _cut(pc.filter(batch.column("text"), pc.equal(langs, lang))):
                own.add(data, offsets)
                if own.words >= CHUNK_WORDS:
                    yield own.row(lang.as_py(), task << 32 | made)
                    made, own = made + 1, _Chunk()
            open_chunks[lang.as_py()] = own
    for lang, own in open_chunks.items():
        if own.words:
            yield own.row(lang, task << 32 | made)
            made += 1


def _addressed(rows: DataFrame, keys: list[str], scratch: Scratch, label: str) -> DataFrame:
    """Rows (lang, keys, f) with the address z of their place in the language's frequency ranking."""
    order = [F.col("lang"), F.col("f").desc(), *map(F.col, keys)]
    table = placed(rows, order, scratch, f"{label}-sorted")
    earlier = (Window.unboundedPreceding, -1)
    own = Window.partitionBy("lang", "part").orderBy("at").rowsBetween(*earlier)
    parts = table.groupBy("lang", "part").agg(F.sum("f").alias("mass"))  # a row for each language and written task
    base = F.sum("mass").over(Window.partitionBy("lang").orderBy("part").rowsBetween(*earlier))
    parts = parts.select("lang", "part", F.coalesce(base, F.lit(0)).alias("base"))
    before = F.coalesce(F.sum("f").over(own), F.lit(0)) + F.col("base")
    banded = table.join(parts, ["lang", "part"]).withColumn("before", before)
    banded = banded.withColumn("band", F.expr(f"before div {BAND_MASS}"))
    place = F.row_number().over(Window.partitionBy("lang", "band").orderBy("at")) - 1
    z = F.shiftleft("band", 32) + place
    return scratch.stored(banded.select("lang", *keys, "f", z.alias("z")), label)


def _squeezed(items: np.ndarray) -> np.ndarray:
    """Without items that have no neighbour; runs stay apart by one -1."""
    inside = np.zeros(len(items) + 2, bool)
    inside[1:-1] = items >= 0
    kept = inside[1:-1] & (inside[:-2] | inside[2:])
    closing = ~inside[1:-1]
    closing[1:] &= kept[:-1]
    closing[:1] = False
    return items[kept | closing]


def _pairs(items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whether both are items, first, second) of all neighbours."""
    x, y = items[:-1], items[1:]
    return (x >= 0) & (y >= 0), x, y


def _sum_cells(cells: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells in ascending order and their counts (None: one each)."""
    x, y = cells >> 32, cells & _PLACE
    width = int(y.max()) + 1
    if (int(x.max()) + 1) * width <= 4 * len(cells):  # dense: direct addresses
        total = np.bincount(x * width + y, weights=counts)
        found = np.flatnonzero(total)
        return found // width << 32 | found % width, total[found].astype(np.int64)
    if counts is None:  # sparse: sorted coordinates
        return np.unique(cells, return_counts=True)
    order = np.argsort(cells, kind="stable")
    cells = cells[order]
    first = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
    return cells[first], np.add.reduceat(counts[order], first)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each chunk, counted tile by tile."""
    for batch in batches:
        for lang, chunk, items in zip(batch.column("lang"), batch.column("chunk"), batch.column("items")):
            both, x, y = _pairs(unpack(items.as_py()))
            x, y = x[both], y[both]
            if not len(x):
                continue
            tile = (x >> 32) << 31 | y >> 32
            order = np.argsort(tile, kind="stable")
            tile, cells = tile[order], ((x & _PLACE) << 32 | y & _PLACE)[order]
            first = np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))
            found = [_sum_cells(cells[a:b], None) for a, b in zip(first, np.append(first[1:], len(cells)))]
            n = len(first)
            columns = [
                pa.array([lang.as_py()] * n, pa.string()),
                pa.array([chunk.as_py()] * n, pa.int64()),
                pa.array(tile[first] >> 31),
                pa.array(tile[first] & ((1 << 31) - 1)),
                pa.array([pack(c, ascending=True) for c, _ in found], pa.binary()),
                pa.array([pack(c) for _, c in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, list(_TILE))


def _numbers(column: pa.ChunkedArray, ascending: bool = False) -> np.ndarray:
    return np.concatenate([np.zeros(0, "<i8"), *(unpack(v.as_py(), ascending) for v in column)])


def _summed(least: int):
    def run(tiles: pa.Table) -> pa.Table:
        cells, counts = _sum_cells(_numbers(tiles.column("cells"), True), _numbers(tiles.column("counts")))
        kept = counts >= least
        key = [tiles.column(c)[:1] for c in ("lang", "chunk", "bx", "by")]
        packed = [pa.array([pack(cells[kept], True)], pa.binary()), pa.array([pack(counts[kept])], pa.binary())]
        return pa.Table.from_arrays([*key, *packed], list(_TILE)).slice(0, int(kept.any()))

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, bx, by, cells, counts in zip(*(batch.column(c) for c in ("lang", "bx", "by", "cells", "counts"))):
            cell, count = unpack(cells.as_py(), True), unpack(counts.as_py())
            x, y = bx.as_py() << 32 | cell >> 32, by.as_py() << 32 | cell & _PLACE
            names = pa.array([lang.as_py()] * len(cell), pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.array(x), pa.array(y), pa.array(count)], ["lang", "x", "y", "f"])


def _frequent(tiles: DataFrame, chunks: int, scratch: Scratch, label: str) -> DataFrame:
    """(lang, x, y, f) of the pairs that occur MIN_COUNT times, tiles summed in rounds of FAN_IN chunks."""
    parts = max(1, -(-chunks // FAN_IN))
    now = tiles.withColumn("chunk", F.pmod(F.xxhash64("chunk"), F.lit(parts)))
    while True:
        now = now.groupBy("lang", "bx", "by", "chunk").applyInArrow(_freed(_summed(MIN_COUNT if parts == 1 else 1)), _ddl(_TILE))
        if parts == 1:
            return now.mapInArrow(bytewise.lean(_unpacked), "lang string, x long, y long, f long")
        parts = -(-parts // FAN_IN)
        now = scratch.stored(now, f"{label}-summed").withColumn("chunk", F.pmod("chunk", F.lit(parts)))


def _labels(pairs: pa.Table) -> pa.Table:
    """The frequent pairs of a tile, packed: cells and addresses in order of the cells."""
    x, y, z = (pairs.column(c).to_numpy() for c in ("x", "y", "z"))
    cells = (x & _PLACE) << 32 | y & _PLACE
    order = np.argsort(cells)
    packed = [pa.array([pack(cells[order], True)], pa.binary()), pa.array([pack(z[order])], pa.binary())]
    return pa.Table.from_arrays([*(pairs.column(c)[:1] for c in ("lang", "bx", "by")), *packed], ["lang", "bx", "by", "known", "z"])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Addresses of a chunk's own frequent pairs."""
    for batch in batches:
        out = []
        for chunk, bx, by, *packed in zip(*(batch.column(c) for c in ("chunk", "bx", "by", "cells", "known", "z"))):
            cells, known, z = (unpack(v.as_py(), k < 2) for k, v in enumerate(packed))
            at = np.minimum(np.searchsorted(known, cells), len(known) - 1)
            hit = known[at] == cells
            x, y = bx.as_py() << 32 | cells[hit] >> 32, by.as_py() << 32 | cells[hit] & _PLACE
            out.append((chunk.as_py(), *map(pack, (x, y, z[at[hit]]))))
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["own_chunk", "x", "y", "z"])


def _freed(run):
    """The function over a group's table, with freed memory handed back after a large one."""

    def wrapped(table: pa.Table) -> pa.Table:
        out = run(table)
        if table.nbytes > _LARGE_BYTES:
            bytewise.release()
        return out

    return wrapped


def _both_freed(run):
    """The same for a function over two tables."""

    def wrapped(left: pa.Table, right: pa.Table) -> pa.Table:
        out = run(left, right)
        if left.nbytes + right.nbytes > _LARGE_BYTES:
            bytewise.release()
        return out

    return wrapped


_LARGE_BYTES = 1 << 20


def _row(chunk: pa.Table, items: np.ndarray) -> pa.Table:
    packed = pa.array([pack(items)], pa.binary())
    return pa.Table.from_arrays([chunk.column("lang"), chunk.column("chunk"), packed], ["lang", "chunk", "items"]).slice(
        0, int(len(items) > 0)
    )


_ITEMS = "lang string, chunk long, items binary"
_NONE = pa.table({"lang": pa.array([], pa.string()), "chunk": pa.array([], pa.int64()), "items": pa.array([], pa.binary())})


def _words_to_items(chunk: pa.Table, found: pa.Table) -> pa.Table:
    if not chunk.num_rows:
        return _NONE
    numbers = np.frombuffer(chunk.column("items")[0].as_py(), "<i4")
    address = np.full(int(numbers.max()) + 2, -1, np.int64)  # the last one stands for -1
    address[found.column("pos").to_numpy()] = found.column("z").to_numpy()
    return _row(chunk, _squeezed(address[numbers]))


def _pairs_to_items(chunk: pa.Table, found: pa.Table) -> pa.Table:
    if not chunk.num_rows or not found.num_rows:
        return _NONE
    both, x, y = _pairs(unpack(chunk.column("items")[0].as_py()))
    known_x, known_y, z = (_numbers(found.column(c)) for c in ("x", "y", "z"))
    names = np.unique(np.concatenate((known_x, known_y)))
    keys = np.searchsorted(names, known_x) * len(names) + np.searchsorted(names, known_y)
    order = np.argsort(keys)
    keys, z = keys[order], z[order]
    at_x, at_y = (np.minimum(np.searchsorted(names, v), len(names) - 1) for v in (x, y))
    own = np.where(both & (names[at_x] == x) & (names[at_y] == y), at_x * len(names) + at_y, -1)
    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
    return _row(chunk, _squeezed(np.where(keys[at] == own, z[at], -1)))


def _described(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Phrases of overlapping parts, with the counts of what they begin (`heads`) and end with (`tails`)."""
    a, b = parts.alias("a"), parts.alias("b")
    joined = pairs.alias("p").join(a, F.expr("p.lang = a.lang and p.x = a.z")).join(b, F.expr("p.lang = b.lang and p.y = b.z"))
    return joined.select(
        "p.lang",
        "p.x",
        "p.y",
        "p.z",
        "p.f",
        F.concat_ws(" ", "a.phrase", "b.last").alias("phrase"),
        "b.last",
        F.concat("a.heads", F.array("p.f")).alias("heads"),
        F.concat("b.tails", F.array("p.f")).alias("tails"),
    )


def _scored(phrases: DataFrame, longer: DataFrame | None, size: int) -> DataFrame:
    """lang, phrase, a, l, r, score of the phrases that no longer candidate covers."""

    def cut(k: int) -> Column:
        l, r = F.col("heads")[k - 1], F.col("tails")[size - k - 1]
        exact = F.expr(f"cast(2000000 as decimal(20, 0)) * f div (cast(heads[{k - 1}] as decimal(20, 0)) + tails[{size - k - 1}])")
        return F.struct(exact.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))

    if longer is not None:
        # a phrase two words longer is no more frequent than the one between, so the next size tells it all
        sides = longer.select("lang", F.col("x").alias("z"), "f").union(longer.select("lang", "y", "f"))
        most = sides.groupBy("lang", "z").agg(F.max("f").alias("most"))
        covered = F.expr("cast(100 as decimal(20, 0)) * most >= cast(80 as decimal(20, 0)) * f")
        phrases = phrases.join(most, ["lang", "z"], "left").where(F.col("most").isNull() | ~covered)
    best = phrases.withColumn("best", F.array_min(F.array(*[cut(k) for k in range(1, size)])))
    return best.select("lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", "best.score")


def mine(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """lang, phrase, a, l, r, n, score of all candidates that are not covered by a longer one.

    docs: text and lang; other columns are ignored. A null text has no words, a null language is `und`, repeated rows
    count again, an empty table gives no row. One word, however long, is one item. A text is cut at ends of pieces only, so
    one piece of many megabytes is looked at as a whole. Scratch must live until the result has been read.
    """
    named = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text")
    chunks = scratch.stored(named.mapInArrow(bytewise.lean(_chunks), _ddl(_CHUNK)), "chunks")
    numbered = chunks.select("lang", "chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "own"))
    words = numbered.groupBy("lang", F.col("own.words").alias("phrase")).agg(F.sum("own.counts").alias("f"))
    sums = F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)
    totals = chunks.groupBy("lang").agg(F.sum(sums).alias("n"), F.count(F.lit(1)).alias("chunks"))
    totals = scratch.stored(totals, "totals")
    most_chunks = totals.agg(F.coalesce(F.max("chunks"), F.lit(0))).head()[0]

    known = _addressed(words.where(F.col("f") >= MIN_COUNT), ["phrase"], scratch, "words")
    found = numbered.select("lang", "chunk", "pos", F.col("own.words").alias("phrase")).join(known, ["lang", "phrase"])
    texts = chunks.select("lang", "chunk", "items").groupBy("chunk")
    found = found.select(F.col("chunk").alias("own_chunk"), "pos", "z").groupBy("own_chunk")
    items = scratch.stored(texts.cogroup(found).applyInArrow(_both_freed(_words_to_items), _ITEMS), "items-1")

    one = F.array("f")
    parts = known.select("lang", "z", "phrase", F.col("phrase").alias("last"), one.alias("heads"), one.alias("tails"))
    levels = []
    for size in range(2, LONGEST + 1):
        tiles = scratch.stored(items.mapInArrow(bytewise.lean(_tiles), _ddl(_TILE)), f"tiles-{size}")
        pairs = _addressed(_frequent(tiles, most_chunks, scratch, f"tiles-{size}"), ["x", "y"], scratch, f"pairs-{size}")
        levels.append(scratch.stored(_described(pairs, parts), f"phrases-{size}"))
        parts = levels[-1].drop("x", "y")
        if size < LONGEST:
            tile = [F.shiftright("x", 32).alias("bx"), F.shiftright("y", 32).alias("by")]
            labels = pairs.select("lang", *tile, "x", "y", "z").groupBy("lang", "bx", "by")
            labels = labels.applyInArrow(_freed(_labels), "lang string, bx long, by long, known binary, z binary")
            # stored first: both sides of the join are then plain shuffles, whose large partitions Spark can split
            labels = scratch.stored(labels, f"labels-{size}")
            hits = tiles.drop("counts").join(labels, ["lang", "bx", "by"]).drop("lang")
            hits = hits.mapInArrow(bytewise.lean(_found), "own_chunk long, x binary, y binary, z binary").groupBy("own_chunk")
            items = scratch.stored(items.groupBy("chunk").cogroup(hits).applyInArrow(_both_freed(_pairs_to_items), _ITEMS), f"items-{size}")

    scored = [_scored(x, longer, k + 2) for k, (x, longer) in enumerate(zip(levels, [*levels[1:], None]))]
    found = scored[0].union(scored[1]).union(scored[2])
    return found.join(totals.select("lang", "n"), "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def first(found: DataFrame, most: int) -> DataFrame:
    """The best phrases of each language with their rank: by score, then count, both descending, then the phrase's bytes."""
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
