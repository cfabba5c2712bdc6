"""Benchmark decontamination by winnowing.

Every run of SPAN words holds SPAN - K + 1 hashes of K words; the least of each such run is kept as a fingerprint, on
both sides alike. Two texts that share SPAN words in a row therefore share a fingerprint: no such span is missed. A
benchmark item of fewer words is one window, its fingerprint the hash of all its words.

The benchmark's fingerprints and window hashes are marked in a bitmap of fixed size, made by Spark's bitmap aggregate
and sent to every task; it lets through what the benchmark may hold and costs nothing in correctness. A document's
fingerprints that pass are extended to their windows; the digests of these windows are joined with the benchmark's
windows, which decides. Documents are read once and their texts are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm import bitmaps, bytewise

SPAN, K = 10, 5


def words_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, lower-cased bytes, word starts, word ends, row and hash of each word)."""
    for low, high, data, offsets in bytewise.slices(column):
        data = bytewise.LOWER[data]
        starts, ends, rows = bytewise.spans(bytewise.ALNUM[data], offsets)
        yield low, high, data, starts, ends, rows, bytewise.span_hashes(data, starts, ends)


def digest(raw: memoryview, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """128 bits for a sequence of words; words hold no blank."""
    return hashlib.blake2b(b" ".join([raw[a:b] for a, b in zip(starts, ends)]), digest_size=16).digest()


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    """The fingerprint of each window of SPAN words, by its first word."""
    grams = bytewise.window_hashes(hashes, K)
    n = max(0, len(hashes) - SPAN + 1)
    least = grams[:n].copy()
    for k in range(1, SPAN - K + 1):
        np.minimum(least, grams[k : n + k], out=least)
    return least


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """item, size, digest, bits (of the bitmap) of every window of every item; a null item_id counts as ``null``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, out = batch.column("item").to_pylist(), []
            for low, high, data, starts, ends, rows, hashes in words_of(batch.column("text")):
                raw = memoryview(data.tobytes())
                counts = np.bincount(rows, minlength=high - low)
                at = np.cumsum(counts) - counts
                least = fingerprints(hashes)
                for k, (a, n) in enumerate(zip(at.tolist(), counts.tolist())):
                    size = min(SPAN, n)
                    for s in range(a, a + n - size + 1) if n else ():
                        whole = int(bytewise.window_hashes(hashes[s : s + size], size)[0])
                        print_ = int(least[s]) if size == SPAN else whole
                        bits = [whole >> (64 - bitmaps.BITS), print_ >> (64 - bitmaps.BITS)]
                        out.append((items[low + k], size, digest(raw, starts[s : s + size], ends[s : s + size]), bits))
            if out:
                kinds = (pa.string(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["item", "size", "digest", "bits"]
                )

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    return items.mapInArrow(bytewise.lean(run), "item string, size int, digest binary, bits array<long>")


def marked(found: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return bitmaps.marked(found, (hashes >> np.uint64(64 - bitmaps.BITS)).astype(np.int64))


def candidates(docs: DataFrame, found: Broadcast, short: list[int]) -> DataFrame:
    """doc_id, n_words and the windows that pass the bitmap: an array of (start, digest) in words of the document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    hit = pa.struct([("start", pa.int32()), ("size", pa.int32()), ("digest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = found.value
        for batch in batches:
            n_words, hits = [], [[] for _ in range(batch.num_rows)]
            for low, high, data, starts, ends, rows, hashes in words_of(batch.column("text")):
                counts = np.bincount(rows, minlength=high - low)
                n_words.append(counts)
                begin = np.cumsum(counts) - counts
                raw = None
                for size in (SPAN, *short):
                    inside = bytewise.within_row(rows, size)
                    if size == SPAN:
                        least = fingerprints(hashes)
                        changed = np.flatnonzero(np.diff(least, prepend=~least[:1]))  # one fingerprint stays for a while
                        live = np.repeat(marked(bits, least[changed]), np.diff(changed, append=len(least)))
                        at = np.flatnonzero(live & inside)
                        if not len(at):
                            continue
                        whole = bytewise.window_hashes(hashes, size)[at]
                    else:
                        at = np.flatnonzero(inside)
                        whole = bytewise.window_hashes(hashes, size)[at]
                    at = at[marked(bits, whole)]
                    if len(at) and raw is None:
                        raw = memoryview(data.tobytes())
                    for s, row in zip(at.tolist(), rows[at].tolist()):
                        d = digest(raw, starts[s : s + size], ends[s : s + size])
                        hits[low + row].append({"start": s - int(begin[row]), "size": size, "digest": d})
            total = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total.astype(np.int64)), pa.array(hits, pa.list_(hit))],
                ["doc_id", "n_words", "hits"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        bytewise.lean(run), f"doc_id {kind}, n_words long, hits array<struct<start int, size int, digest binary>>"
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of documents (doc_id, text): doc_id, n_words, n_hit (words inside any occurrence of a benchmark
    window), spans (start and size of each, in words), items (those with occurring windows, sorted as strings).

    Null and empty texts have no words and hits; items without words have no window. Repeated documents are judged
    each, repeated items count once. Other columns are ignored.
    """
    windows = benchmark_windows(benchmark)
    short = sorted(r.size for r in windows.where(F.col("size") < SPAN).select("size").distinct().collect())  # < SPAN rows
    found = candidates(docs, bitmaps.build(windows.select(F.explode("bits"))), short).withColumn("row", F.monotonically_increasing_id())
    by_digest = windows.groupBy("digest").agg(F.sort_array(F.collect_set("item")).alias("items"))
    hits = found.select("row", "doc_id", "n_words", F.explode_outer("hits").alias("hit")).withColumn(
        "digest", F.coalesce("hit.digest", F.col("row").cast("string").cast("binary"))  # no hot null key
    )
    joined = hits.join(by_digest, "digest", "left")
    span = F.when(F.col("items").isNotNull(), F.struct("hit.start", "hit.size"))
    per_row = joined.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.sort_array(F.collect_list(span)).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["start"] + s["size"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(a["end"], s["start"]))).alias("n"),
        ),
        lambda a: a["n"],
    )
    return per_row.select("doc_id", "n_words", covered.alias("n_hit"), "spans", "items")
