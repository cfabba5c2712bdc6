"""Token ids in binary blocks, entropy-coded by a static range asymmetric numeral system (rANS).

Texts are tokenised once: the ids are stored in the scratch folder together with each task's histogram, and it is ids,
not texts, that are dealt out by ranges of doc_id.

One frequency table, of the ids of all documents, is shared by all blocks. A block holds the ids of whole documents, or
of pieces of documents longer than a block, in ascending order and is decoded by itself: id k is coded in lane k modulo
the number of lanes, each lane with its own 64-bit state, so numpy codes one id of every lane at a time. Every so many
steps a checkpoint keeps the states and the place in the payload, from which decoding may start; a CRC-32 covers the
rest of the block.

Files are Parquet tables, so that Spark's committer writes them once whatever executors are lost, with the columns
shard (ascending ranges of documents), block, first (ids of the shard before it), n_tokens, divided (whether it holds
pieces) and data:

    magic "RANS", lanes, step between checkpoints, checkpoints, documents, words (u32 each), ids (u64)
    documents or pieces: doc_id (i64), null flag (u8), ids (u64) and the document's ids before them (u64), by columns
    final states (u64 per lane), then for each checkpoint step (u64), word (u64) and states (u64 per lane)
    words (u32), CRC-32 of all before it (u32)
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.llm import bpe, bytewise
from parcelwise.llm.scratch import Scratch
from parcelwise.llm.sent import send

SCALE = 20
_LOW = np.uint64(1 << 31)
_MASK = np.uint64((1 << SCALE) - 1)
BLOCK_TOKENS, LANES, CHECKPOINT_STEPS = 1 << 19, 2048, 128
BROADCAST_SHARDS = 100_000


class Table:
    """Frequencies of ids scaled to a sum of 2**SCALE; each id that occurs keeps at least one."""

    def __init__(self, counts: np.ndarray) -> None:
        used = np.flatnonzero(counts)
        if len(used) > 1 << SCALE - 1:
            raise ValueError("too many different ids for the scale")
        share = counts[used].astype(np.float64) / max(1, counts.sum())
        scaled = np.floor(share * ((1 << SCALE) - len(used))).astype(np.int64) + 1
        if len(used):
            scaled[np.argmax(scaled)] += (1 << SCALE) - scaled.sum()
        self.freq = np.zeros(len(counts), np.uint64)
        self.freq[used] = scaled
        self.cum = (np.cumsum(self.freq) - self.freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(counts), dtype=np.uint32), self.freq.astype(np.int64))


def encode_ids(ids: np.ndarray, table: Table, lanes: int, every: int) -> tuple[np.ndarray, list, np.ndarray]:
    """(final states, checkpoints (step, word, states), words)."""
    freq, cum = table.freq[ids], table.cum[ids]
    if not freq.all():
        raise ValueError("an id is not in the frequency table")
    x, words, marks, written = np.full(lanes, _LOW), [], [], 0
    for step in range(-(-len(ids) // lanes) - 1, -1, -1):
        a, b = step * lanes, min(len(ids), (step + 1) * lanes)
        f, own = freq[a:b], x[: b - a]
        over = own >= f << np.uint64(63 - SCALE)
        words.append((own[over] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        written += len(words[-1])
        own = np.where(over, own >> np.uint64(32), own)
        times = own // f
        x[: b - a] = (times << np.uint64(SCALE)) + (own - times * f) + cum[a:b]
        if step and step % every == 0:
            marks.append((step, written, x.copy()))
    stream = np.concatenate([np.zeros(0, np.uint32), *words[::-1]])
    return x, [(s, len(stream) - w, states) for s, w, states in marks[::-1]], stream


def decode_ids(n: int, table: Table, states: np.ndarray, words: np.ndarray, first: int = 0, at: int = 0) -> np.ndarray:
    """Ids from step `first` on, given the states and the place in the words there."""
    x, lanes = states.copy(), len(states)
    out = np.empty(max(0, n - first * lanes), np.uint32)
    wide = words.astype(np.uint64)
    for a in range(0, len(out), lanes):
        own = x[: len(out) - a]
        slot = own & _MASK
        ids = table.symbol[slot]
        out[a : a + lanes] = ids
        own = table.freq[ids] * (own >> np.uint64(SCALE)) + slot - table.cum[ids]
        under = np.flatnonzero(own < _LOW)
        own[under] = (own[under] << np.uint64(32)) | wide[at : at + len(under)]
        at += len(under)
        x[: len(own)] = own
    return out


def write_block(names: list, counts: list, before: list, ids: np.ndarray, table: Table) -> bytes:
    lanes = 1
    while lanes < LANES and lanes * 64 < len(ids):
        lanes *= 2
    states, marks, words = encode_ids(ids, table, lanes, CHECKPOINT_STEPS)
    parts = [
        b"RANS",
        np.array([lanes, CHECKPOINT_STEPS, len(marks), len(names), len(words)], "<u4").tobytes(),
        np.array([len(ids)], "<u8").tobytes(),
        np.array([n or 0 for n in names], "<i8").tobytes(),
        np.array([n is None for n in names], "u1").tobytes(),
        np.array(counts, "<u8").tobytes(),
        np.array(before, "<u8").tobytes(),
        states.astype("<u8").tobytes(),
        *(np.array([s, w, *st], "<u8").tobytes() for s, w, st in marks),
        words.astype("<u4").tobytes(),
    ]
    data = b"".join(parts)
    return data + np.array([zlib.crc32(data)], "<u4").tobytes()


def read_block(data: bytes, table: Table, checkpoint: int | None = None) -> tuple[list, list, list, np.ndarray]:
    """(doc_ids, numbers of ids, ids of the documents before them, ids); with a checkpoint's number the ids from there
    on only. Raises if damaged."""
    if data[:4] != b"RANS" or zlib.crc32(memoryview(data)[:-4]) != int.from_bytes(data[-4:], "little"):
        raise ValueError("damaged block")
    at = 4

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        at += (size := np.dtype(kind).itemsize * n)
        return np.frombuffer(data, kind, n, at - size)

    lanes, _, n_marks, documents, n_words = take("<u4", 5).tolist()
    n = int(take("<u8", 1)[0])
    names, null, counts = take("<i8", documents), take("u1", documents), take("<u8", documents)
    before = take("<u8", documents)
    states = take("<u8", lanes)
    marks = [take("<u8", lanes + 2) for _ in range(n_marks)]
    words = take("<u4", n_words)
    first = place = 0
    if checkpoint is not None:
        first, place, states = int(marks[checkpoint][0]), int(marks[checkpoint][1]), marks[checkpoint][2:]
    ids = decode_ids(n, table, states, words, first, place)
    return [None if z else d for d, z in zip(names.tolist(), null)], counts.tolist(), before.tolist(), ids


def write(docs: DataFrame, path: str, tokenizer: str, *, end_id: int = 0) -> None:
    """Encodes documents (doc_id long, text), each followed by the end id, in ascending order of doc_id, into `path`.

    A null or empty text is the end id alone; a null doc_id comes first, repeated doc_ids stand side by side (by a hash
    of the text); other columns are ignored. An empty table gives a readable, empty set of files. A document of more
    than BLOCK_TOKENS ids is divided between blocks, so none grows with the longest document.
    """
    spark, size = docs.sparkSession, _vocabulary(tokenizer, end_id)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    with Scratch(spark) as scratch:
        tokens = scratch.stored(_tokens(docs, tokenizer, end_id, size, kind), "ids")
        bars = tokens.where("used is not null").select(F.explode(F.arrays_zip("used", "times")).alias("bar"))
        counts = bars.groupBy(F.col("bar.used").alias("id")).agg(F.sum("bar.times").alias("n"))
        counts.write.parquet(f"{path}/frequencies")
        table = spark.sparkContext.broadcast(_table(spark, path, size))  # one entry per id of the vocabulary
        order = ["doc_id", "tie", "row", "before"]
        ranged = tokens.where("used is null").drop("used", "times").repartitionByRange(*order).sortWithinPartitions(*order)
        fields = ", ".join(f"{n} {k}" for n, k in BLOCK.items())
        ranged.mapInArrow(bytewise.lean(_coder(table, kind)), fields).write.parquet(f"{path}/blocks")
        table.destroy()


def _tokens(docs: DataFrame, tokenizer: str, end_id: int, size: int, kind: str) -> DataFrame:
    """Documents as ids, in pieces of BLOCK_TOKENS, and one more row a task: how often (`times`) it saw which ids (`used`)."""
    limit = BLOCK_TOKENS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, row = np.zeros(size, np.int64), TaskContext.get().partitionId() << 33
        for batch in batches:
            for low, high, found, at in bpe.encoder(tokenizer).encode(batch.column("text")):
                ids = np.insert(found, at[1:], end_id)
                seen += np.bincount(ids, minlength=size)
                total = np.diff(at) + 1
                pieces = -(-total // limit)
                of = np.repeat(np.arange(high - low), pieces)
                before = (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * limit
                ends = np.cumsum(np.minimum(total[of] - before, limit))
                offsets = np.concatenate(([0], ends * np.dtype(kind).itemsize)).astype(np.int32)
                cells = [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype(kind))]
                taken = pa.array(of + low)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(taken),
                        batch.column("tie").take(taken),
                        pa.array(row + low + of),
                        pa.array(before),
                        pa.array(total[of]),
                        pa.Array.from_buffers(pa.binary(), len(of), cells),
                        pa.nulls(len(of), pa.list_(pa.int32())),
                        pa.nulls(len(of), pa.list_(pa.int64())),
                    ],
                    list(TOKENS),
                )
            row += batch.num_rows
        used = np.flatnonzero(seen)
        last = [[None]] * 6 + [[used.tolist()], [seen[used].tolist()]]
        kinds = [pa.int64()] * 5 + [pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(last, kinds)], list(TOKENS))

    given = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    return given.mapInArrow(bytewise.lean(run), ", ".join(f"{n} {k}" for n, k in TOKENS.items()))


def _coder(table: Broadcast, kind: str):
    """Sorted pieces to blocks; a block holds whole documents or pieces of divided ones, never both."""
    limit = BLOCK_TOKENS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        names, counts, before, ids, held, divided = [], [], [], [], 0, False

        def flush():
            nonlocal block, first, names, counts, before, ids, held
            data = write_block(names, counts, before, np.concatenate(ids), table.value)
            row = [[shard], [block], [first], [held], [divided], [data]]
            block, first = block + 1, first + held
            names, counts, before, ids, held = [], [], [], [], 0
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], list(BLOCK))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "before", "total"))
            for name, at, total, cell in zip(*columns, batch.column("ids")):
                own = np.frombuffer(cell.as_buffer(), kind)
                if names and (divided != (total > limit) or held + len(own) > limit):
                    yield flush()
                divided = total > limit
                names.append(name)
                counts.append(len(own))
                before.append(at)
                ids.append(own)
                held += len(own)
        if names:
            yield flush()

    return run


TOKENS = {
    "doc_id": "long",
    "tie": "long",
    "row": "long",
    "before": "long",
    "total": "long",
    "ids": "binary",
    "used": "array<int>",
    "times": "array<long>",
}
BLOCK = {"shard": "int", "block": "int", "first": "long", "n_tokens": "long", "divided": "boolean", "data": "binary"}


def _vocabulary(tokenizer: str, end_id: int) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)


def _table(spark: SparkSession, path: str, size: int) -> Table:
    counts = np.zeros(size, np.int64)
    for row in spark.read.parquet(f"{path}/frequencies").collect():  # at most one per id of the vocabulary
        counts[row.id] = row.n
    return Table(counts)


def read(spark: SparkSession, path: str, tokenizer: str, *, end_id: int = 0) -> DataFrame:
    """Documents decoded from the files: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian
    unsigned 32-bit, the end id included)."""
    table = send(spark.sparkContext, _table(spark, path, _vocabulary(tokenizer, end_id)))
    blocks = spark.read.parquet(f"{path}/blocks")
    before, total = [], 0
    for row in blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect():  # one per written task
        before.append((row.shard, total))
        total += row.n
    bases = spark.createDataFrame(before, "shard int, base long")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, data in zip(batch.column("base").to_pylist(), batch.column("data")):
                names, counts, before, ids = read_block(data.as_py(), table.value)
                offsets = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
                cells = [None, pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()),
                        pa.array(base + offsets[:-1] - np.array(before, np.int64)),
                        pa.array(before, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.Array.from_buffers(pa.binary(), len(names), cells),
                    ],
                    ["doc_id", "start", "before", "n_tokens", "ids"],
                )

    few = len(before) <= BROADCAST_SHARDS
    placed = blocks.join(F.broadcast(bases) if few else bases, "shard").select((F.col("base") + F.col("first")).alias("base"), "divided", "data")
    fields = "doc_id long, start long, before long, n_tokens long, ids binary"

    def decoded(which: str) -> DataFrame:
        return placed.where(which).select("base", "data").mapInArrow(bytewise.lean(decode), fields)

    # a divided document's pieces meet by its start; its ids fill one cell, as its text did
    pieces = F.array_sort(F.collect_list(F.struct("before", "ids")))
    joined = decoded("divided").groupBy("doc_id", "start").agg(F.sum("n_tokens").alias("n_tokens"), pieces.alias("pieces"))
    ids = F.aggregate("pieces", F.lit(b""), lambda done, piece: F.concat(done, piece["ids"]))
    return decoded("not divided").drop("before").union(joined.select("doc_id", "start", "n_tokens", ids.alias("ids")))
