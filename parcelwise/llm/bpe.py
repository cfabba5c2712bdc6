"""Token ids of text columns by a public tokenizer file, each distinct chunk encoded once per worker.

Texts are cut where both supported pre-tokenizers cut in any case (before a run of white space, before the last
character of such a run, and between ASCII or Latin-1 letters, digits and signs, never next to an apostrophe or
another non-ASCII character), so the ids of the chunks, strung together, are the ids of the whole text. The
tokenizers library encodes the chunks; numpy looks up what a worker has encoded before. Strings of special tokens in
a text are ordinary text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from parcelwise.llm import bytewise

#: Entries a worker keeps; beyond, it starts anew. Affects speed and memory only.
MEMO_ENTRIES = 1_500_000

SPACE, BLANK, LETTER, DIGIT, SIGN, APOSTROPHE, OTHER = range(7)
_KINDS = np.full(256, OTHER, np.uint8)
_KINDS[:0x80] = SIGN
_KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
_KINDS[0x30:0x3A] = DIGIT
_KINDS[0x09:0x0E] = BLANK
_KINDS[0x20] = SPACE
_KINDS[0x27] = APOSTROPHE


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the texts may be cut, row starts included."""
    n = len(data)
    kind = _KINDS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = LETTER
    known, white = (kind >= LETTER) & (kind != OTHER), kind <= BLANK
    cut = np.zeros(n + 1, bool)
    p, c = slice(0, n - 1), slice(1, n)
    plain = known & (kind != APOSTROPHE)
    cut[1:n] = known[p] & white[c]
    cut[1 : n - 1] |= white[: n - 2] & white[1 : n - 1] & known[2:]
    cut[1:n] |= (kind[p] == BLANK) & known[c]
    cut[1:n] |= plain[p] & plain[c] & (kind[p] != kind[c])
    # the next row is no part of the run: what only its first byte allowed is undone
    ends = offsets[1:-1]
    last = ends[ends > 1] - 1
    undo = last[white[last] & white[last - 1]]
    cut[undo] = False
    cut[offsets] = True
    return np.flatnonzero(cut[:n])


class Encoder:
    """Encodes slices of text columns; `words` maps chunk hashes to runs of `ids`."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint16)

    def _learn(self, data: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw = data.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist())]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        count = np.fromiter(map(len, found), np.int32, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.int64, int(count.sum()))
        ids = flat.astype(np.uint16 if flat.max(initial=0) < 1 << 16 else np.uint32)
        begin = len(self.ids) + np.concatenate(([0], np.cumsum(count[:-1], dtype=np.int64)))[: len(count)]
        self.ids = np.concatenate((self.ids, ids))
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.begin = np.insert(self.begin, at, begin)
        self.count = np.insert(self.count, at, count)

    def lookup(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(entry of each distinct chunk, distinct number of each chunk, row of each chunk, times of each distinct one)."""
        starts = chunk_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        keys = bytewise.span_hashes(data, starts, ends)
        distinct, first, which, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        if len(self.keys) + len(distinct) > MEMO_ENTRIES:
            self.clear()
        at = np.searchsorted(self.keys, distinct)
        new = np.ones(len(distinct), bool)
        if len(self.keys):
            new = self.keys[np.minimum(at, len(self.keys) - 1)] != distinct
        if new.any():
            self._learn(data, distinct[new], starts[first[new]], ends[first[new]])
            at = np.searchsorted(self.keys, distinct)
        return at, which, np.searchsorted(offsets, starts, "right") - 1, times

    def encode(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids, where each row's ids start) for runs of whole rows."""
        for low, high, data, offsets in bytewise.slices(column):
            if not len(data):
                yield low, high, np.zeros(0, np.uint32), np.zeros(high - low + 1, np.int64)
                continue
            entry, which, rows, _ = self.lookup(data, offsets)
            begin, count = self.begin[entry][which], self.count[entry][which].astype(np.int64)
            ends = np.cumsum(count)
            ids = self.ids[np.repeat(begin - ends + count, count) + np.arange(ends[-1])]
            tokens = np.bincount(rows, weights=count, minlength=high - low).astype(np.int64)
            yield low, high, ids.astype(np.uint32), np.concatenate(([0], np.cumsum(tokens)))

    def histogram(self, column: pa.Array, size: int) -> np.ndarray:
        """How often each id below `size` occurs in a column."""
        total = np.zeros(size, np.int64)
        for _, _, data, offsets in bytewise.slices(column):
            if len(data):
                entry, _, _, times = self.lookup(data, offsets)
                count = self.count[entry].astype(np.int64)
                ends = np.cumsum(count)
                ids = self.ids[np.repeat(self.begin[entry] - ends + count, count) + np.arange(ends[-1])]
                total += np.bincount(ids, weights=np.repeat(times, count), minlength=size).astype(np.int64)
        return total


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
