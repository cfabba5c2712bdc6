"""Hierarchical packing of token ids into sequences of several context sizes.

Each document's ids are cut into whole windows of the longest tier and one remainder, which is routed to the shortest
tier that holds it. Each tier is packed longest remainder first, one remainder per window; the gap of a long window is
filled from the pools of shorter tiers, the largest piece that fits first, and at last with a cut piece. What finds no
filling is strung together and cut into windows of the longest tier; the tail of a task is cut into powers of two, so
that no sequence needs padding. Sequences of one tier form step groups with the same number of tokens.

Every task packs what it reads, so nothing is shuffled, no document is larger than a task's share, and a lost task is
packed anew in the same way; only the tail of each task is shorter than the shortest tier.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from parcelwise.llm import bpe, bytewise

TIERS = (256, 512, 1024, 2048)
#: Tokens in the pools before they are packed; bounds a task's memory.
POOL_TOKENS = 1 << 18
#: Tokens of a step group.
STEP_TOKENS = 1 << 16

PIECES = (
    "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
)


class Packer:
    """Packs documents as they come; `done` holds finished sequences, lists of pieces (document, start, ids)."""

    def __init__(self, tiers: tuple[int, ...] = TIERS) -> None:
        self.tiers = sorted(tiers)
        self.pools: dict[int, list] = {t: [] for t in self.tiers}  # (length, number, piece), sorted
        self.pending = self.number = 0
        self.done: list[list] = []

    def _put(self, piece: tuple) -> None:
        length = len(piece[2])
        tier = next(t for t in self.tiers if t >= length)
        self.number += 1
        insort(self.pools[tier], (length, self.number, piece))
        self.pending += length

    def _take(self, tier: int, at: int) -> tuple:
        length, _, piece = self.pools[tier].pop(at)
        self.pending -= length
        return piece

    def add(self, document: object, ids: np.ndarray) -> None:
        top, n = self.tiers[-1], len(ids)
        whole = n - n % top
        for start in range(0, whole, top):
            self.done.append([(document, start, ids[start : start + top])])
        if whole < n:
            self._put((document, whole, ids[whole:]))
        if self.pending >= POOL_TOKENS:
            self.pack()

    def _fill(self, window: list, gap: int, shorter: list[int]) -> int:
        for tier in reversed(shorter):
            pool = self.pools[tier]
            while gap and pool and (at := bisect_right(pool, gap, key=lambda x: x[0])):
                window.append(self._take(tier, at - 1))
                gap -= len(window[-1][2])
        for tier in shorter:
            if gap and self.pools[tier]:  # all that is left is longer than the gap
                document, start, ids = self._take(tier, 0)
                window.append((document, start, ids[:gap]))
                self._put((document, start + gap, ids[gap:]))
                return 0
        return gap

    def pack(self) -> None:
        """Empties the pools into whole windows; fewer tokens than one window of the longest tier stay."""
        rest: list[tuple] = []
        for k in range(len(self.tiers) - 1, 0, -1):
            tier = self.tiers[k]
            while self.pools[tier]:
                window = [self._take(tier, -1)]
                gap = self._fill(window, tier - len(window[0][2]), self.tiers[:k])
                if gap:
                    rest += window
                else:
                    self.done.append(window)
        rest += [self._take(self.tiers[0], 0) for _ in range(len(self.pools[self.tiers[0]]))]
        left = self._string(rest, self.tiers[-1])
        for piece in left:
            self._put(piece)

    def _string(self, pieces: list[tuple], size: int) -> list[tuple]:
        """Cuts the pieces, one after another, into windows of a size; returns those of the unfinished one."""
        window, gap = [], size
        for document, start, ids in pieces:
            while len(ids) >= gap:
                self.done.append([*window, (document, start, ids[:gap])])
                start, ids = start + gap, ids[gap:]
                window, gap = [], size
            if len(ids):
                window.append((document, start, ids))
                gap -= len(ids)
        return window

    def finish(self) -> None:
        self.pack()
        rest = [self._take(t, 0) for t in self.tiers for _ in range(len(self.pools[t]))]
        while left := sum(len(p[2]) for p in rest):
            size = 1 << left.bit_length() - 1
            before = len(self.done)
            rest = self._string(rest, size)
            assert len(self.done) == before + 1


def pack(docs: DataFrame, tokenizer: str, *, end_id: int = 1, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """Pieces of packed sequences of documents (doc_id, text): doc_id, start (ids of its document before it), length,
    ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset (in the sequence), tier, step_group.

    A null or empty text is the end id alone. Each row is a document, also if its doc_id is null or repeated; other
    columns are ignored. An empty table has no pieces. `tiers` are powers of two.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, schema, counts = Packer(tiers), None, {}
        first = TaskContext.get().partitionId() << 40
        made = 0

        def emit():
            nonlocal made
            out = []
            for sequence in packer.done:
                size = sum(len(p[2]) for p in sequence)
                tier = next((t for t in packer.tiers if t >= size), size)
                counts[tier] = counts.get(tier, -1) + 1
                step = first + (tier << 24) + counts[tier] // max(1, STEP_TOKENS // tier)
                offset = 0
                for (doc, tokens), start, ids in sequence:
                    out.append((doc, start, len(ids), ids.tobytes(), tokens, first + made, offset, tier, step))
                    offset += len(ids)
                made += 1
            packer.done = []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            schema = schema or pa.schema(
                [batch.schema.field("doc_id"), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
                + [(n, pa.int64()) for n in ("doc_tokens", "sequence_id", "offset")]
                + [("tier", pa.int32()), ("step_group", pa.int64())]
            )
            names = batch.column("doc_id").to_pylist()
            for low, high, ids, at in bpe.encoder(tokenizer).encode(batch.column("text")):
                for row in range(low, high):
                    own = ids[at[row - low] : at[row - low + 1]]
                    packer.add((names[row], len(own) + 1), np.append(own, np.uint32(end_id)).astype("<u4"))
                if packer.done:
                    yield emit()
        packer.finish()
        if packer.done:
            yield emit()

    return docs.select("doc_id", "text").mapInArrow(bytewise.lean(run), f"doc_id {kind}, {PIECES}")
