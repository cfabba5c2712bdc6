"""Quality by perplexity under an interpolated modified Kneser-Ney n-gram model of trusted text.

Texts are read byte by byte as 63 symbols (`SYMBOLS`: letters, capitals as one, digits as one, signs, parts of non-ASCII
characters) and the model has order 5. It holds every 5-gram of the trusted text with its count, up to 2**30 of them, in
`SHARDS` shards by the three symbols before the last one: a 5-gram, its context, the shorter n-grams that it falls back
to and their contexts share these, so a shard answers for its n-grams alone. Orders up to 3 are one table of 2**18 numbers.

* Training: tasks count 5-grams and send them, packed, to their shards, where they are added up.
* Scoring: documents are cut into batches of a few megabytes. A batch asks each shard for the costs of its distinct 5-grams,
  -log2 p in 1/1024 bit as unsigned 16-bit integers; the shards' model rows and the questions meet in one shuffle, the
  answers and the batch's compressed symbols in another. Sums of integers don't depend on the order of addition.
* No task holds more than one shard of the model, at most 2**20 n-grams, or one batch, and nothing but the table of 2**18
  numbers is sent to all tasks. Texts of more than a batch are cut into pieces that overlap by a context.

One trusted document in `HELD_OUT` takes no part in training; the held-out ones set the limits. A language's centre is the
median of their scores, a document's deviation its distance from the centre times the root of its bytes, since the
scores of short texts scatter more. The limits of a language are quantiles of deviations, `SPREAD` times as wide, above
and below: text can be too odd or too predictable. The lower quantile includes the documents trained on, which are more
predictable than others. A quantile that rests on fewer documents than it takes to have a value beyond it (`ENOUGH`) is
replaced by that of all languages together, and a language without held-out documents also takes their centre.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from parcelwise.llm import bitmaps, bytewise
from parcelwise.llm.components import stored
from parcelwise.llm.packed import pack, unpack
from parcelwise.llm.scratch import Scratch
from parcelwise.llm.sent import send

ORDER, BITS = 5, 6
LOW = 3  # orders up to this one are a dense table
LOW_CELLS = 1 << LOW * BITS
SHARDS = 1024
BATCH = 4 << 20  # bytes of text that are looked up together
UNIT = 1024  # costs are in 1/UNIT bit
HELD_OUT, QUANTILE, SPREAD = 5, 0.99, 2.5
ENOUGH = 100  # 1 / (1 - QUANTILE)
#: Deviations are counted in steps up to a widest one, so that a histogram has a known size.
STEP, WIDEST = 20, 100_000
UNKNOWN = "und"

SYMBOLS = np.full(256, 41, np.uint8)
SYMBOLS[:32] = 31
SYMBOLS[127] = 31
SYMBOLS[97:123] = np.arange(1, 27)
SYMBOLS[65:91] = 27
SYMBOLS[48:58] = 28
for _code, _signs in enumerate((" ", "\n", "\t\r", ".", ",", "'", '"', "-", ";:", "!", "?", "()"), 29):
    SYMBOLS[list(_signs.encode())] = _code
SYMBOLS[list(b"#*$%&|<>")] = 42
SYMBOLS[0x80:0xC0] = 46 + (np.arange(64) & 15)
SYMBOLS[0xC0:] = 44
SYMBOLS[0xC3] = 43


def grams(symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each symbol; before a text stand boundary symbols (0)."""
    key = symbols.astype(np.int32)  # 30 bits
    begin = offsets[:-1]
    for back in range(1, ORDER):
        shifted = np.zeros(len(symbols), np.int32)
        shifted[back:] = symbols[:-back] if back < len(symbols) else 0
        for k in range(back):
            at = begin + k
            shifted[at[at < len(symbols)]] = 0
        key |= shifted << (BITS * back)
    return key


def pieces(column: pa.Array, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """(first row, end row, symbols, starts, lead) of whole rows of about `limit` bytes together. A longer row comes in
    pieces; the first `lead` symbols of a piece repeat the end of the one before, as context."""
    for low, high, data, offsets in bytewise.slices(column, limit):
        symbols = SYMBOLS[data]
        if len(symbols) <= limit:
            yield low, high, symbols, offsets, 0
            continue
        for start in range(0, len(symbols), limit):
            lead = min(start, ORDER - 1)
            part = symbols[start - lead : start + limit]
            yield low, high, part, np.array([0, len(part)]), lead


def by_shard(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that puts n-grams by shard, and where each shard starts. A shard has 256 of the 2**18 possible contexts of
    three symbols, since multiplying by an odd number mixes them one to one."""
    context = (keys >> BITS).astype(np.int64) & (LOW_CELLS - 1)
    shard = ((context * 0x2545F) & (LOW_CELLS - 1)) // (LOW_CELLS // SHARDS)
    order = np.argsort(shard.astype(np.uint16), kind="stable")
    return order, np.searchsorted(shard[order], np.arange(SHARDS + 1))


def discounts(of: tuple[int, int, int, int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from the numbers of n-grams that occur 1, 2, 3 and 4 times."""
    n = np.array(of, np.float64)
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    d = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k / 2 for k in (1, 2, 3)]
    return np.array([0.0, *(min(max(x, 0.0), float(k)) for k, x in enumerate(d, 1))])


def interpolate(counts: np.ndarray, d: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probabilities of one order; `counts` has one row of 64 symbols per context, `lower` one value per entry."""
    kind = np.minimum(counts, 3)
    total = counts.sum(axis=1, keepdims=True)
    gamma = sum(d[k] * (kind == k).sum(axis=1, keepdims=True) for k in (1, 2, 3))
    seen = (np.maximum(counts - d[kind], 0) + gamma * lower) / np.maximum(total, 1)
    return np.where(total > 0, seen, lower)


def lower_orders(preceded: np.ndarray) -> np.ndarray:
    """3-gram probabilities (2**18) from the number of different symbols before each 3-gram."""
    tables = [preceded]
    while len(tables[0]) > 1 << BITS:
        tables.insert(0, (tables[0].reshape(64, -1) > 0).sum(axis=0))
    p = np.full(64, 1 / 63)
    p[0] = 0.0  # nothing is followed by the start of a text
    for counts in tables:
        rows = counts.reshape(-1, 64)
        d = discounts(tuple(int((counts == k).sum()) for k in (1, 2, 3, 4)))
        p = interpolate(rows, d, np.resize(p, counts.shape).reshape(-1, 64)).ravel()
    return p


def costs(p: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-np.log2(np.maximum(p, 1e-19)) * UNIT), 65535).astype("<u2")


def count(texts: DataFrame, limit: int) -> DataFrame:
    """(shard, keys, counts): packed 5-grams of the compressed texts, one row a shard and some megabytes of text."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
        unzip, held, size = zstandard.ZstdDecompressor(), [], 0
        for batch in batches:
            for text in batch.column(0):
                held.append(unzip.decompress(text.as_py()))
                size += len(held[-1])
                if size >= limit:
                    yield pa.array(held, pa.binary())
                    held, size = [], 0
        yield pa.array(held, pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            for _, _, symbols, offsets, lead in pieces(group, limit):
                keys, n = np.unique(grams(symbols, offsets)[lead:], return_counts=True)
                order, starts = by_shard(keys)
                keys, n = keys[order], n[order]
                some = np.flatnonzero(np.diff(starts))
                columns = (
                    pa.array(some, pa.int32()),
                    pa.array([pack(keys[starts[s] : starts[s + 1]], ascending=True) for s in some], pa.binary()),
                    pa.array([pack(n[starts[s] : starts[s + 1]]) for s in some], pa.binary()),
                )
                yield pa.RecordBatch.from_arrays(list(columns), ["shard", "keys", "counts"])

    return texts.mapInArrow(bytewise.lean(run), "shard int, keys binary, counts binary")


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Counts of equal n-grams added up."""
    found, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, which, np.concatenate(counts))
    return [found], [total]


def shorter(keys: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of one order less and how many different symbols precede each, from those of `order`."""
    return np.unique(keys & ((1 << BITS * (order - 1)) - 1), return_counts=True)


MERGED = "shard int, keys binary, counts binary, counted array<long>, ends array<int>, times array<int>"


def merged(parts: DataFrame) -> DataFrame:
    """One row a shard: its 5-grams and counts, how many n-grams of each order above `LOW` occur 1 to 4 times, and its
    3-grams with the number of different symbols before each. A task holds one shard at a time."""

    def row(shard: int, keys: np.ndarray, counts: np.ndarray) -> tuple:
        counted, own, n = [], keys, counts
        for order in range(ORDER, LOW, -1):
            counted += [int((n == k).sum()) for k in (1, 2, 3, 4)]
            own, n = shorter(own, order)
        return shard, pack(keys, ascending=True), pack(counts), counted, own, n

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, keys, counts, pending = None, [], [], 0
        for batch in batches:
            for shard, k, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "keys", "counts"))):
                if now is not None and shard != now:
                    yield row(now, *[x[0] for x in added(keys, counts)])
                    keys, counts, pending = [], [], 0
                now = shard
                keys.append(unpack(k, ascending=True))
                counts.append(unpack(n))
                pending += len(keys[-1])
                if pending > len(keys[0]) + (1 << 18):
                    keys, counts = added(keys, counts)
                    pending = 0
        if now is not None:
            yield row(now, *[x[0] for x in added(keys, counts)])

    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in rows(batches):
            columns = [pa.array([value], kind) for value, kind in zip(found, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "keys", "counts", "counted", "ends", "times"])

    return parts.repartition("shard").sortWithinPartitions("shard").mapInArrow(bytewise.lean(run), MERGED)


class Model(NamedTuple):
    shards: DataFrame  # as of `merged`, stored
    discounts: dict[int, np.ndarray]  # by order, above `LOW`
    low: Broadcast  # probabilities of all 3-grams


def train(texts: DataFrame, scratch: Scratch, limit: int = BATCH) -> Model:
    """The model of a table of compressed texts (first column). No text: uniform probabilities."""
    shards = scratch.stored(merged(count(texts, limit)), "ngrams")
    number = (ORDER - LOW) * 4
    sums = shards.agg(*[F.coalesce(F.sum(F.col("counted")[k]), F.lit(0)) for k in range(number)]).first()
    found = {ORDER - k: discounts(tuple(sums[4 * k : 4 * k + 4])) for k in range(ORDER - LOW)}
    ends = shards.select(F.explode(F.arrays_zip("ends", "times")).alias("x")).groupBy("x.ends").agg(F.sum("x.times").alias("n"))
    ends = ends.toArrow()  # 2**18 rows at most
    preceded = np.zeros(LOW_CELLS, np.int64)
    preceded[ends["ends"].to_numpy()] = ends["n"].to_numpy()
    return Model(shards, found, send(texts.sparkSession.sparkContext, lower_orders(preceded)))


class Shard:
    """The n-grams of one shard with what their probabilities take."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, d: dict[int, np.ndarray]) -> None:
        self.orders = []
        for order in range(ORDER, LOW, -1):
            kept = d[order][np.minimum(counts, 3)]
            contexts, starts = np.unique(keys >> BITS, return_index=True)
            total = np.add.reduceat(counts, starts) if len(keys) else counts
            gamma = np.add.reduceat(kept, starts) if len(keys) else kept
            self.orders.insert(0, (order, keys, np.maximum(counts - kept, 0), contexts, total, gamma))
            keys, counts = shorter(keys, order)

    def probabilities(self, asked: np.ndarray, low: np.ndarray) -> np.ndarray:
        p = low[asked & (LOW_CELLS - 1)]
        for order, keys, left, contexts, total, gamma in self.orders:
            if not len(keys):
                continue
            gram = asked & ((1 << BITS * order) - 1)
            at = np.minimum(np.searchsorted(contexts, gram >> BITS), len(contexts) - 1)
            place = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
            own = np.where(keys[place] == gram, left[place], 0.0)
            p = np.where(contexts[at] == gram >> BITS, (own + gamma[at] * p) / total[at], p)
        return p


BATCHED = "batch long, kind int, shard int, checked long, data binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = ("batch", "kind", "shard", "checked", "data"), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds)], list(names))


def _batches(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple]:
    """(batch, checksum, rows, symbols, starts, lead, part): numbered within the partition; part is null but for the pieces
    of a long text, which share the number of the first."""
    number, part = 0, None
    for rows in batches:
        if not rows.num_rows:
            continue
        partition = rows.column("partition")[0].as_py() << 32
        for low, high, symbols, offsets, lead in pieces(rows.column("text"), limit):
            batch = partition | number
            if high - low > 1 or len(symbols) < limit and not lead:
                part = None
            elif not lead:
                part = batch
            yield batch, zlib.crc32(symbols), rows.slice(low, high - low), symbols, offsets, lead, part
            number += 1


def questions(docs: DataFrame, limit: int) -> DataFrame:
    """The distinct 5-grams of each batch, one packed row a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, checked, _, symbols, offsets, lead, _ in _batches(batches, limit):
            keys = np.unique(grams(symbols, offsets)[lead:])
            order, starts = by_shard(keys)
            keys = keys[order]
            some = np.flatnonzero(np.diff(starts))
            yield _rows([(batch, 1, int(s), checked, pack(keys[starts[s] : starts[s + 1]], ascending=True)) for s in some])

    return docs.mapInArrow(bytewise.lean(run), BATCHED)


def answers(asked: DataFrame, model: Model) -> DataFrame:
    """The costs of the n-grams of each question, in their order. A shard's model comes first, then its questions one by
    one, so a task holds one shard and one question."""
    d, low = model.discounts, model.low

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        now, shard = None, Shard(none, none, d)
        for rows in batches:
            found = []
            for batch, kind, number, checked, data, counts in zip(*(column.to_pylist() for column in rows.columns)):
                if kind == 0:
                    now, shard = number, Shard(unpack(data, ascending=True), unpack(counts), d)
                    continue
                if number != now:
                    now, shard = number, Shard(none, none, d)
                cost = costs(shard.probabilities(unpack(data, ascending=True), low.value))
                found.append((batch, 0, number, checked, cost.tobytes()))
            yield _rows(found)

    null = F.lit(None)
    own = model.shards.select(
        null.cast("long").alias("batch"), F.lit(0).alias("kind"), "shard", null.cast("long").alias("checked"), F.col("keys").alias("data"), "counts"
    )
    both = own.unionByName(asked.withColumn("counts", null.cast("binary")))
    return both.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(bytewise.lean(run), BATCHED)


def texts_of_batches(docs: DataFrame, limit: int) -> DataFrame:
    """The compressed symbols of each batch, with what is kept of its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, checked, rows, symbols, offsets, lead, part in _batches(batches, limit):
            kept = rows.select(["doc_id", "lang", "tie"])
            buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(symbols)]
            texts = pa.Array.from_buffers(pa.large_binary(), rows.num_rows, buffers)
            parts = pa.array([part] * rows.num_rows, pa.int64())
            leads = pa.array(np.full(rows.num_rows, lead, np.int32))
            whole = pa.RecordBatch.from_arrays([*kept.columns, texts, parts, leads], [*kept.schema.names, "symbols", "part", "lead"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(whole)
            yield _rows([(batch, 1, 0, checked, sink.getvalue().to_pybytes())])

    return docs.mapInArrow(bytewise.lean(run), BATCHED)


def summed(both: DataFrame, kind: str) -> DataFrame:
    """doc_id, lang, tie, part, n_bytes, cost of every document, or piece of one, from answers and texts by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, given = None, []
        for rows in batches:
            for batch, is_text, _, checked, data in zip(*(column.to_pylist() for column in rows.columns)):
                if batch != now:
                    now, given = batch, []
                if not is_text:
                    given.append((checked, np.frombuffer(data, "<u2")))
                    continue
                with pa.ipc.open_stream(data) as stream:
                    whole = stream.read_next_batch()
                lead = whole.column("lead")[0].as_py()
                _, starts, content = whole.column("symbols").buffers()
                offsets = np.frombuffer(starts, np.int64)[: whole.num_rows + 1]
                symbols = np.frombuffer(content, np.uint8)[: offsets[-1]] if content else np.zeros(0, np.uint8)
                which, keys = pd.factorize(grams(symbols, offsets)[lead:])  # by hashing, much faster than sorting all
                place = np.argsort(keys)
                order = place[by_shard(keys[place])[0]]
                found = np.concatenate([np.zeros(0, "<u2"), *[cost for _, cost in given]])
                if len(found) != len(keys) or any(of != checked for of, _ in given):
                    raise RuntimeError("the documents differ from one reading to the next; store them first")
                cost = np.empty(len(keys), np.int64)
                cost[order] = found
                total = np.concatenate(([0], np.cumsum(cost[which])))
                ends = np.maximum(offsets - lead, 0)
                columns = [whole.column(c) for c in ("doc_id", "lang", "tie", "part")]
                columns += [pa.array(np.diff(ends)), pa.array(np.diff(total[ends]))]
                given = []
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "tie", "part", "n_bytes", "cost"])

    met = both.repartition("batch").sortWithinPartitions("batch", "kind", "shard")
    return met.mapInArrow(bytewise.lean(run), f"doc_id {kind}, lang string, tie long, part long, n_bytes long, cost long")


def score(docs: DataFrame, model: Model, scratch: Scratch, limit: int = BATCH) -> DataFrame:
    """doc_id, lang, tie (a hash of the text), n_bytes, cost (1/1024 bit) and score (1/1000 bit a byte, rounded; 0 for none),
    one row a document. The documents are read twice and must be the same both times, which checksums make sure of."""
    docs = docs.select("doc_id", "lang", "text", F.xxhash64("text").alias("tie"), F.spark_partition_id().alias("partition"))
    both = answers(questions(docs, limit), model).unionAll(texts_of_batches(docs, limit))
    found = scratch.stored(summed(both, docs.schema["doc_id"].dataType.simpleString()), "costs")
    long = found.where("part is not null").groupBy("part")
    long = long.agg(*[F.first(c).alias(c) for c in ("doc_id", "lang", "tie")], *[F.sum(c).alias(c) for c in ("n_bytes", "cost")])
    whole = found.where("part is null").drop("part").unionByName(long.drop("part"))
    return whole.withColumn("score", F.expr(f"(2000 * cost + {UNIT} * n_bytes) div greatest({2 * UNIT} * n_bytes, 1)"))


def trusted(labels: DataFrame) -> DataFrame:
    """doc_id of documents that labels (doc_id, quality, toxic) call good and not toxic; contradicting ones count as bad."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return labels.groupBy("doc_id").agg(F.min(F.coalesce(good, F.lit(False))).alias("good")).where("good").select("doc_id")


def trusted_texts(docs: DataFrame, names: DataFrame) -> DataFrame:
    """Compressed texts of the documents with the given doc_ids. A bitmap keeps most others out of the shuffle; the join,
    always a shuffle, keeps out the rest."""
    found = bitmaps.build(names.select(bitmaps.place(F.col("doc_id"))))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            live = bitmaps.marked(found.value, batch.column("bit").to_numpy())
            likely = batch.select(["doc_id", "text"]).filter(pa.array(live))
            squeeze = zstandard.ZstdCompressor()
            texts = [squeeze.compress((text.as_py() or "").encode()) for text in likely.column("text")]
            yield pa.RecordBatch.from_arrays([likely.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "text"])

    likely = docs.select("doc_id", "text", bitmaps.place(F.col("doc_id")).alias("bit"))
    likely = likely.mapInArrow(bytewise.lean(run), f"doc_id {kind}, text binary")
    return likely.join(names.hint("merge"), "doc_id", "left_semi").select("text")


def held_out(doc_id: Column) -> Column:
    """Whether a trusted document is kept from training."""
    return F.pmod(F.xxhash64(doc_id), F.lit(HELD_OUT)) == 0


def _by_language(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The rows with what a stored table holds about their language; broadcast up to a checked number of languages."""
    few = table.limit(10_001).count() <= 10_000
    return rows.join(F.broadcast(table) if few else table, "language", "left")


def _deviation(centre: Column) -> Column:
    return (F.col("score") - centre) * F.sqrt("n_bytes")


def limits(scored: DataFrame) -> tuple[DataFrame, Row | None]:
    """(language, centre, low, high) from trusted documents (language, held, n_bytes, score), and the row of all languages
    together, None without held-out documents. Both histograms have a known size, whatever the number of documents."""
    scored = stored(scored, "scores")
    centres = stored(scored.where("held").rollup("language").agg(F.percentile("score", F.lit(0.5)).alias("centre")), "centres")
    pooled = centres.where("language is null").first()
    if pooled is None:
        return centres.withColumns({"low": F.lit(0.0), "high": F.lit(0.0)}), None
    placed = _by_language(scored, centres.where("language is not null"))
    deviation = _deviation(F.coalesce("centre", F.lit(pooled.centre)))
    step = F.round(F.greatest(F.least(deviation, F.lit(float(WIDEST))), F.lit(-float(WIDEST))) / STEP) * STEP
    cuts = (
        placed.withColumn("step", step)
        .rollup("language")
        .agg(
            F.percentile(F.when(F.col("held"), F.col("step")), F.lit(QUANTILE)).alias("high"),
            F.percentile("step", F.lit(round(1 - QUANTILE, 6))).alias("low"),
            F.count(F.when(F.col("held"), 1)).alias("n"),
        )
    )
    cuts = stored(cuts.select("language", (F.col("low") * SPREAD).alias("low"), (F.col("high") * SPREAD).alias("high"), "n"), "cuts")
    every = cuts.where("language is null").first()
    own = F.col("n") >= ENOUGH
    found = cuts.where("language is not null").select(
        "language",
        F.when(own, F.col("low")).otherwise(every.low).alias("low"),
        F.when(own, F.col("high")).otherwise(every.high).alias("high"),
    )
    table = found.join(centres, "language", "left").withColumn("centre", F.coalesce("centre", F.lit(pooled.centre)))
    return stored(table, "limits"), Row(centre=pooled.centre, low=every.low, high=every.high)


def verdicts(docs: DataFrame, labels: DataFrame, limit: int = BATCH) -> DataFrame:
    """One row for each row of documents (doc_id, text, lang): doc_id, lang, tie (a hash of the text), n_bytes, cost, score,
    perplexity, deviation, low, high, kept. Texts are not returned.

    A document is rejected if its deviation is below `low` or above `high`. A null language is one of its own
    (`UNKNOWN`); a language without trusted documents is judged by those of all languages. Null and empty texts have
    score 0 and stay. Rows may repeat; each is judged. Labels of absent documents are ignored; without trusted text all
    costs are alike, and without held-out documents nothing is rejected and the limits are null. Other columns are left out.
    `limit` is the number of bytes of text that a task looks up together.
    """
    docs = docs.select("doc_id", "lang", "text")
    names = trusted(labels)
    with Scratch(docs.sparkSession) as scratch:
        model = train(trusted_texts(docs, names.where(~held_out(F.col("doc_id")))), scratch, limit)
        scored = stored(score(docs, model, scratch, limit), "scored")
    language = F.coalesce(F.col("lang"), F.lit(UNKNOWN))
    scores = scored.where("n_bytes > 0").join(names, "doc_id", "left_semi")
    scores = scores.select(language.alias("language"), held_out(F.col("doc_id")).alias("held"), "n_bytes", "score")
    table, pooled = limits(scores)
    judged = _by_language(scored.withColumn("language", language), table)
    centre, low, high = (F.coalesce(c, F.lit(pooled[c] if pooled else None).cast("double")) for c in ("centre", "low", "high"))
    deviation = _deviation(centre)
    inside = (F.col("n_bytes") == 0) | deviation.between(low, high)
    return judged.select(
        "doc_id",
        "lang",
        "tie",
        "n_bytes",
        "cost",
        "score",
        F.round(F.pow(F.lit(2.0), F.col("score") / 1000), 3).alias("perplexity"),
        F.round(deviation).cast("long").alias("deviation"),
        low.alias("low"),
        high.alias("high"),
        F.coalesce(inside, F.lit(True)).alias("kept"),
    )


RESULTS = ("n_bytes", "cost", "score", "perplexity", "deviation", "low", "high", "kept")


def _identity(docs: DataFrame, tie: Column) -> DataFrame:
    """The rows with what their verdict depends on; nulls in it are equal."""
    return docs.withColumn("_identity", F.struct("doc_id", "lang", tie.alias("tie")))


def classify(docs: DataFrame, labels: DataFrame, limit: int = BATCH) -> DataFrame:
    """All columns of documents and the results of :func:`verdicts`, which replace columns with their names."""
    found = _identity(verdicts(docs, labels, limit), F.col("tie")).select("_identity", *RESULTS).dropDuplicates(["_identity"])
    own = [c for c in docs.columns if c not in (*RESULTS, "_identity")]
    named = _identity(docs.select(*[F.col(f"`{c}`") for c in own]), F.xxhash64("text"))
    return named.join(found, "_identity", "left").drop("_identity")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all their columns, without the rejected ones."""
    found = _identity(verdicts(docs, labels).where("not kept"), F.col("tie")).select("_identity").distinct()
    return _identity(docs, F.xxhash64("text")).join(found, "_identity", "left_anti").drop("_identity")
