"""Byte-level BPE from a rank file: merges folded over distinct words by Spark's higher-order functions.

Texts are split by the public pattern, chunks of texts keep numbers of their distinct words, and the distinct words of
all chunks meet in buckets by their hash, where each is encoded once: a fold over a word's bytes merges, step by step, the
leftmost pair of the least rank, with a literal map of the vocabulary's ranks. The ids go back to the chunks, many words in
a row. Texts are never shuffled, only words and word numbers, both compressed. Texts are split twice, for the words and for
their numbers, so that neither need be stored besides. Bytes are held as characters U+0000 to U+00FF (ISO-8859-1), one a byte.

A fold is quadratic in a word's length. Words above FOLD_BYTES bytes are therefore merged by a heap in an Arrow function,
by the same rule.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm import bytewise

#: Longer words are merged by a heap; the ids are the same.
FOLD_BYTES = 1024
#: Bits of a place in a word; two places lie below a rank in one number.
_PLACE_BITS = FOLD_BYTES.bit_length()
#: Above every pair that has a rank.
_NO_RANK = 1 << 62
#: Pieces up to which the fold finds one by a filter.
_FEW_PIECES = 100
#: Words of a chunk; one longer text is a chunk of its own.
CHUNK_WORDS = 1 << 20
#: Buckets of words for each shuffle partition.
BUCKETS_PER_PARTITION = 8
#: Buckets of the literal rank map: Spark goes through a map's keys one by one.
BUCKETS = 1 << 14


@lru_cache
def ranks_of(path: str) -> dict[str, int]:
    """Rank of each token of a rank file, bytes as ISO-8859-1 characters."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token).decode("latin-1"): int(rank) for token, rank in map(bytes.split, lines)}


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once; an aggregate over nothing, which unlike a transform copies no result."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, use)


def rank_table(ranks: dict[str, int]) -> Column:
    """The literal map, in buckets by hash."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        buckets[xxhash.xxh64_intdigest(token.encode(), seed=42) % BUCKETS][token] = rank  # as Spark's xxhash64
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")  # the optimizer makes it a literal


def fold(word: Column, table: Column) -> Column:
    """Ids of a word of at most FOLD_BYTES ISO-8859-1 characters, by a :func:`rank_table`.

    The state holds a number for each piece: the rank of the pair that the piece opens, where the piece starts, where it
    ends. The least number is the leftmost pair of the least rank.
    """

    def rank(piece: Column) -> Column:
        return F.element_at(F.get(table, F.xxhash64(piece).bitwiseAND(BUCKETS - 1)), piece)

    def place(number: Column) -> Column:
        return number.bitwiseAND((1 << 2 * _PLACE_BITS) - 1)

    def start(number: Column) -> Column:
        return F.shiftright(place(number), _PLACE_BITS).cast("int")

    def end(number: Column) -> Column:
        return number.bitwiseAND((1 << _PLACE_BITS) - 1).cast("int")

    def run(w: Column) -> Column:
        size, rest = F.length(w), F.lit(FOLD_BYTES)

        def piece(first: Column, last: Column) -> Column:
            return F.substring(w, first + 1, last - first)

        def without_rank(first: Column, last: Column) -> Column:
            return F.lit(_NO_RANK).bitwiseOR(F.shiftleft(first, _PLACE_BITS)).bitwiseOR(last.cast("long"))

        def with_rank(first: Column, last: Column, following: Column) -> Column:  # following: the end of the next piece
            of_pair = F.shiftleft(rank(piece(first, following)).cast("long"), 2 * _PLACE_BITS)
            return F.coalesce(of_pair, F.lit(_NO_RANK)).bitwiseOR(F.shiftleft(first, _PLACE_BITS)).bitwiseOR(last.cast("long"))

        def step(state: Column, _: Column) -> Column:
            def merged(least: Column) -> Column:
                def replaced(i: Column) -> Column:  # the pieces i and i + 1, counted from 1
                    def with_end(last: Column) -> Column:
                        first, right = start(least), F.get(state, i + 1)
                        new = F.when(right.isNull(), without_rank(first, last)).otherwise(with_rank(first, last, end(right)))

                        def after_left(left: Column) -> Column:
                            return F.array(with_rank(start(left), end(left), last), new)

                        middle = F.when(i > 1, _let(F.get(state, i - 2), after_left)).otherwise(F.array(new))
                        return F.concat(F.slice(state, 1, F.greatest(i - 2, F.lit(0))), middle, F.slice(state, i + 2, rest))

                    return _let(end(F.get(state, i)), with_end)

                # array_position leaves its loop by an exception, which costs as much as a filter of some hundred numbers
                before = F.size(F.filter(state, lambda number: place(number) < place(least)))
                i = F.when(F.size(state) > _FEW_PIECES, F.array_position(state, least).cast("int")).otherwise(before + 1)
                return F.when(least < _NO_RANK, _let(i, replaced)).otherwise(state)

            return _let(F.array_min(state), merged)

        def opened(k: Column) -> Column:
            return F.when(k < size - 1, with_rank(k, k + 1, k + 2)).otherwise(without_rank(k, k + 1))

        steps = F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1)))
        pieces = F.aggregate(steps, F.transform(F.sequence(F.lit(0), size - 1), opened), step)
        return F.transform(pieces, lambda number: rank(piece(start(number), end(number))))

    return _let(word, lambda w: _let(rank(w), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(run(w))))


def merge_by_heap(word: str, ranks: dict[str, int]) -> list[int]:
    """Ids of a word given as ISO-8859-1 characters, in n log n steps."""
    n = len(word)
    ends, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    if word in ranks:
        return [ranks[word]]

    def pair(at: int) -> int | None:
        return ranks.get(word[at : ends[ends[at]]]) if ends[at] < n else None

    heap = [(r, at) for at in range(n) if (r := pair(at)) is not None]
    heapq.heapify(heap)
    while heap:
        r, at = heapq.heappop(heap)
        if not alive[at] or pair(at) != r:
            continue
        second = ends[at]
        alive[second], ends[at] = False, ends[second]
        if ends[at] < n:
            before[ends[at]] = at
        for changed in (before[at], at):
            if changed >= 0 and (r := pair(changed)) is not None:
                heapq.heappush(heap, (r, changed))
    out, at = [], 0
    while at < n:
        out.append(ranks[word[at : ends[at]]])
        at = ends[at]
    return out


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, compressed byte plane by byte plane, after their count."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(chunk, distinct words with the most frequent first, numbers of all words, ids and lengths of the texts)."""
    task, made = TaskContext.get().partitionId(), 0
    for batch in batches:
        lists = batch.column("words")
        ends = np.cumsum(np.append(0, lists.value_lengths().to_numpy(zero_copy_only=False)), dtype=np.int64)
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(ends, ends[low] + CHUNK_WORDS, "right")) - 1)
            words = lists.slice(low, high - low).flatten().dictionary_encode()
            numbers = words.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(-np.bincount(numbers, minlength=len(words.dictionary)), kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            distinct = words.dictionary.take(pa.array(order))
            yield task << 32 | made, distinct, place[numbers], batch.column("doc_id").slice(low, high - low), np.diff(ends[low : high + 1])
            made, low = made + 1, high


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, where each word starts, the end of the last one)"""
    data, starts = bytewise.text_buffer(words)
    return data[starts[0] : starts[-1]], starts - starts[0]


_REQUEST = {"bucket": "long", "chunk": "long", "crc": "long", "n": "long", "steps": "binary", "lengths": "binary", "size": "long", "words": "binary"}


def _requests(buckets: int):
    """A chunk's distinct words by bucket, with the steps between their places in the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, words, *_ in _chunks(batches):
            if not len(words):
                continue
            data, starts = _bytes_of(words)
            bucket = (bytewise.span_hashes(data, starts[:-1], starts[1:]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order))
            crc, rows = zlib.crc32(data), []
            for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
                own, at = _bytes_of(words.take(pa.array(order[a:b])))
                steps = np.diff(order[a:b], prepend=0)
                packed = pa.compress(own.tobytes(), "zstd", asbytes=True)
                rows.append((int(bucket[order[a]]), chunk, crc, b - a, _packed(steps), _packed(np.diff(at)), len(own), packed))
            yield _batch(rows, _REQUEST)

    return bytewise.lean(run)


_KINDS = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}


def _batch(rows: list[tuple], columns: dict[str, str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(zip(*rows), columns.values())], list(columns))


_BUCKET = {"chunks": "array<long>", "crcs": "array<long>", "steps": "array<binary>", "which": "array<binary>", "words": "array<string>"}


def _bucket(requests: pa.Table) -> pa.Table:
    """The distinct words of a bucket, and which of them each chunk asks for."""
    counts = requests.column("n").to_pylist()
    lengths = np.concatenate([_unpacked(v.as_py()) for v in requests.column("lengths")])
    parts = [pa.decompress(v.as_py(), n.as_py(), "zstd", asbytes=True) for v, n in zip(requests.column("words"), requests.column("size"))]
    starts = np.append(0, np.cumsum(lengths, dtype=np.int64))
    words = pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(starts), pa.py_buffer(b"".join(parts))]).dictionary_encode()
    number, ends = words.indices.to_numpy(zero_copy_only=False), np.cumsum([0, *counts])
    which = [_packed(number[a:b]) for a, b in zip(ends, ends[1:])]
    values = [requests.column(c).to_pylist() for c in ("chunk", "crc", "steps")]
    columns = [pa.array([v], _KINDS[k]) for v, k in zip((*values, which), _BUCKET.values())]
    distinct = pa.ListArray.from_arrays(pa.array([0, len(words.dictionary)], pa.int32()), words.dictionary.cast(pa.string()))
    return pa.Table.from_arrays([*columns, distinct], list(_BUCKET))


_ANSWER = {"own_chunk": "long", "crc": "long", "n": "long", "steps": "binary", "sizes": "binary", "n_ids": "long", "ids": "binary"}


def _answers(path: str):
    """Ids of each chunk's words of a bucket. A word that was too long to be folded, whose ids are null, is merged here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("ids")[row].values
                if ids.null_count:
                    words = batch.column("words")[row].values.to_pylist()
                    own = [i if i is not None else merge_by_heap(w.encode().decode("latin-1"), ranks_of(path)) for i, w in zip(ids.to_pylist(), words)]
                    ids = pa.array(own, pa.list_(pa.int32()))
                length = ids.value_lengths().to_numpy()
                flat = ids.flatten().to_numpy()
                start = np.cumsum(length) - length
                rows = []
                for chunk, crc, steps, which in zip(*(batch.column(c)[row].as_py() for c in ("chunks", "crcs", "steps", "which"))):
                    number = _unpacked(which)
                    found = _gathered(flat, start[number], length[number])
                    rows.append((chunk, crc, len(number), steps, _packed(length[number]), len(found), _packed(found)))
                yield _batch(rows, _ANSWER)

    return bytewise.lean(run)


def _gathered(values: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Runs of values, strung together."""
    ends = np.cumsum(count, dtype=np.int64)
    return values[np.repeat(start - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)]


_TEXTS = {"chunk": "long", "crc": "long", "doc_ids": "array<long>", "lengths": "array<long>", "numbers": "binary"}


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk, words, numbers, doc_ids, lengths in _chunks(batches):
        yield _batch([(chunk, zlib.crc32(_bytes_of(words)[0]), doc_ids.to_pylist(), lengths, _packed(numbers))], _TEXTS)


def _assembled(chunk: pa.Table, answers: pa.Table) -> pa.Table:
    """Ids of a chunk's texts, from the ids of its words."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    if chunk.num_rows != 1 or set(answers.column("crc").to_pylist()) - {chunk.column("crc")[0].as_py()}:
        raise ValueError("the documents were not the same when they were read again")
    nothing = np.zeros(0, np.int64)
    place = np.concatenate([nothing, *(np.cumsum(_unpacked(v.as_py()), dtype=np.int64) for v in answers.column("steps"))])
    sizes, flat = (np.concatenate([nothing, *(_unpacked(v.as_py()) for v in answers.column(c))]) for c in ("sizes", "ids"))
    length, start = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    length[place] = sizes
    start[place] = np.cumsum(sizes) - sizes
    numbers = _unpacked(chunk.column("numbers")[0].as_py())
    texts = np.append(0, np.cumsum(chunk.column("lengths")[0].as_py(), dtype=np.int64))
    ids = _gathered(flat.astype(np.int32), start[numbers], length[numbers])
    ends = np.append(0, np.cumsum(length[numbers]))[texts]
    out = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
    return pa.Table.from_arrays([pa.array(chunk.column("doc_ids")[0].as_py(), pa.int64()), out], schema=schema)


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{n} {k}" for n, k in columns.items())


def words_of(text: Column, pattern: str) -> Column:
    """The matches of the pattern, read with Unicode classes; none for a null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"(?U){pattern}"), F.lit(0)), F.array().cast("array<string>"))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id (long) and ids of every row of docs (doc_id, text) by the rank file at `path`.

    A null or empty text has no ids; null and repeated doc_ids stay as they are; other columns are ignored; an empty table
    gives no row. docs are read twice and must be the same both times, as a table is; else the job fails.
    """
    split = docs.select("doc_id", words_of(F.col("text"), pattern).alias("words"))
    buckets = BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    requests = split.mapInArrow(_requests(buckets), _ddl(_REQUEST))
    met = requests.groupBy("bucket").applyInArrow(_bucket, _ddl(_BUCKET))
    ranks = ranks_of(path)

    def folded(table: Column) -> Column:
        return F.transform("words", lambda w: F.when(F.octet_length(w) <= FOLD_BYTES, fold(_characters(w), table)))

    encoded = met.withColumn("ids", _let(rank_table(ranks), folded))
    answers = encoded.mapInArrow(_answers(path), _ddl(_ANSWER)).groupBy("own_chunk")
    texts = split.mapInArrow(bytewise.lean(_texts), _ddl(_TEXTS)).groupBy("chunk")
    return texts.cogroup(answers).applyInArrow(_assembled, "doc_id long, ids array<int>")


def _characters(word: Column) -> Column:
    return F.decode(word.cast("binary"), "ISO-8859-1")


def decode(ids: Column, path: str) -> Column:
    """The bytes of ids: the tokens' bytes, strung together."""
    ranks = ranks_of(path)
    tokens: list[str | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    literal = F.from_json(F.lit(json.dumps(tokens)), "array<string>")
    return _let(literal, lambda table: F.encode(F.array_join(F.transform(ids, lambda i: F.element_at(table, i + 1)), ""), "ISO-8859-1"))
