"""Quality rules as a short-circuit cascade.

Counts that the report needs are made for every document at once, with numpy. The rules then run one after another,
each on the documents that all earlier ones let pass. Their order comes from a sample: the rule with the most
rejections per second of work first. The order changes how much work is done, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm import bytewise

#: Documents the costs and selectivities are estimated on, at most; the sample decides the order of rules only.
SAMPLE_ROWS = 2_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass
class Document:
    """What a rule may look at."""

    data: np.ndarray = field(repr=False)  # UTF-8 bytes
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_lines: int  # lines with a word


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Document], bool]


def _upper_case(d: Document) -> bool:
    upper = np.count_nonzero((d.data >= 65) & (d.data <= 90))
    return upper > np.count_nonzero((d.data >= 97) & (d.data <= 122))


RULES = (
    Rule("upper_case", _upper_case),
    Rule("exclamations", lambda d: 2 * np.count_nonzero(d.data == 33) > d.n_words),
    Rule("word_length", lambda d: not 2 * d.n_words <= d.word_chars <= 15 * d.n_words),
    Rule("symbols", lambda d: 10 * d.n_symbols > d.n_words),
    Rule("repeated_lines", lambda d: 10 * d.n_dup_lines > 3 * d.n_lines),
)


def base_failed(d: Document) -> bool:
    return d.n_words < 10 or 100 * d.n_repeat_words > 20 * d.n_words


def documents(column: pa.Array) -> Iterator[Document]:
    """The documents of a text column with their counts, in order."""
    for low, high, data, offsets in bytewise.slices(column):
        n = high - low
        inside = bytewise.NOT_SPACE[data]
        starts, ends, rows = bytewise.spans(inside, offsets)
        n_words = np.bincount(rows, minlength=n)
        at = np.concatenate(([0], np.cumsum(inside & ((data & 0xC0) != 0x80))))
        word_chars = np.diff(at[offsets])
        at = np.concatenate(([0], np.cumsum(_SYMBOL[data])))
        n_symbols = np.diff(at[offsets])
        # lines
        a, b, line_rows = bytewise.spans(data != 10, offsets)
        at = np.concatenate(([0], np.cumsum(inside)))
        worded = at[b] > at[a]
        salt = bytewise.mix(np.arange(n, dtype=np.uint64))
        line = (bytewise.span_hashes(data, a, b) ^ salt[line_rows])[worded]
        line_rows = line_rows[worded]
        n_lines = np.bincount(line_rows, minlength=n)
        _, first = np.unique(line, return_index=True)
        n_dup_lines = n_lines - np.bincount(line_rows[first], minlength=n)
        # words in windows of five that occur twice in the document
        repeated = np.zeros(n, np.int64)
        if len(starts) >= 5:
            windows = bytewise.window_hashes(bytewise.span_hashes(data, starts, ends), 5)
            own = np.flatnonzero(bytewise.within_row(rows, 5))
            _, which, times = np.unique(windows[own] ^ salt[rows[own]], return_inverse=True, return_counts=True)
            twice = own[times[which] > 1]
            step = np.zeros(len(starts) + 1, np.int64)
            np.add.at(step, twice, 1)
            np.add.at(step, twice + 5, -1)
            covered = np.cumsum(step[:-1]) > 0
            repeated = np.bincount(rows[covered], minlength=n)
        counts = np.stack([n_words, word_chars, n_symbols, n_dup_lines, repeated, n_lines]).T.tolist()
        for k, own in enumerate(counts):
            yield Document(data[offsets[k] : offsets[k + 1]], *own)


def order(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """The rules by rejections per second on a sample, each tried on all documents of the sample that pass the base."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, rejected = np.zeros(len(rules)), np.zeros(len(rules), np.int64)
        for batch in batches:
            live = [d for d in documents(batch.column("text")) if not base_failed(d)]
            for k, rule in enumerate(rules):
                begin = time.perf_counter()
                rejected[k] += sum(map(rule.rejects, live))
                spent[k] += time.perf_counter() - begin
        yield pa.RecordBatch.from_arrays([pa.array(range(len(rules))), pa.array(spent), pa.array(rejected)], ["k", "s", "n"])

    sample = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(8)) == 0).limit(SAMPLE_ROWS)
    found = sample.mapInArrow(bytewise.lean(measure), "k long, s double, n long").groupBy("k").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    rate = {r.k: r.n / max(r.s, 1e-9) for r in found.collect()}  # one row per rule
    return tuple(rules[k] for k in sorted(range(len(rules)), key=lambda k: -rate.get(k, 0.0)))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of documents (doc_id, text): doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept.

    A null or empty text has no words and fails the base. Repeated rows are judged each; other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    ordered = order(docs, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, failed, kept = [], [], []
            for d in documents(batch.column("text")):
                counts.append([getattr(d, n) for n in names])
                failed.append(base_failed(d))
                kept.append(not failed[-1] and not any(rule.rejects(d) for rule in ordered))
            columns = np.array(counts, np.int64).reshape(-1, len(names)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, columns), pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_())],
                ["doc_id", *names, "base_failed", "kept"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        bytewise.lean(run), f"doc_id {kind}, {', '.join(f'{n} long' for n in names)}, base_failed boolean, kept boolean"
    )
