"""Sequence packing by minimum bin slack.

Each document's ids (with an end id) are cut into full windows and a
remainder.  Remainders wait in a bounded pool per task; each window starts
from the longest waiting remainder and a bitset subset-sum over the multiset
of waiting lengths finds the fill closest to capacity; backtracking gives how
many remainders of each length are used.  A slack that is left is filled by
cutting one more remainder, so every window of the pool is full.  What a task
has left at its end (less than a window) is cut into powers of two, which
need no padding.

Ids never leave the task that made them: there is no shuffle, a lost task
repeats its own documents, and a document's pieces lie in one task.

Nulls and empty texts give just the end id; repeated rows are packed once
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tillstar.llm.common import map_arrow
from tillstar.llm.tokens import encoder

WINDOW = 2048
POOL = 4096  # remainders a task keeps waiting; a memory bound, all of them get packed
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def best_fill(counts: dict[int, int], present: int, capacity: int, first: int) -> dict[int, int]:
    """Counts by length whose sum is closest to ``capacity`` from below, ``first`` used once.

    ``counts``: how many items wait by length (``first`` among them);
    ``present``: a bit for each length that waits.  Bit s of ``reach`` says
    that some sub-multiset sums to s; counts are taken in powers of two.
    """
    mask = (1 << (capacity + 1)) - 1
    reach, steps = 1 << first, []
    left = present & ((1 << (capacity - first + 1)) - 1)
    while left and not reach >> capacity & 1:
        size = left.bit_length() - 1
        left ^= 1 << size
        most = min(counts[size] - (size == first), (capacity - first) // size)
        take = 1
        while most > 0:
            take = min(take, most)
            steps.append((size, take, reach))
            reach |= (reach << (size * take)) & mask
            most -= take
            take *= 2
    at = reach.bit_length() - 1
    used: dict[int, int] = defaultdict(int)
    for size, take, before in reversed(steps):
        if not before >> at & 1:
            used[size] += take
            at -= size * take
    used[first] += 1
    return used


class Packer:
    """Takes documents' ids; yields pieces (doc, start, ids, total, sequence, offset)."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.pool: dict[int, list] = defaultdict(list)
        self.counts: dict[int, int] = defaultdict(int)
        self.present = self.waiting = self.tokens = 0
        self.out: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, ids, total, self.sequence, offset))
            offset += len(ids) // 4
        self.sequence += 1

    def _wait(self, doc, start: int, ids: bytes, total: int) -> None:
        if ids:
            size = len(ids) // 4
            self.pool[size].append((doc, start, ids, total))
            self.counts[size] += 1
            self.present |= 1 << size
            self.waiting += 1
            self.tokens += size

    def _take(self, size: int) -> tuple:
        piece = self.pool[size].pop()
        self.counts[size] -= 1
        if not self.counts[size]:
            self.present ^= 1 << size
        self.waiting -= 1
        self.tokens -= size
        return piece

    def _fill(self, capacity: int) -> None:
        """One full sequence; at least ``capacity`` tokens wait."""
        first = self.present.bit_length() - 1
        used = best_fill(self.counts, self.present, capacity, first) if first < capacity else {}
        pieces = [self._take(size) for size, n in used.items() for _ in range(n)]
        slack = capacity - sum(len(p[2]) // 4 for p in pieces)
        while slack:  # each waiting remainder is longer than the slack, or just fits
            size = self.present.bit_length() - 1
            doc, start, ids, total = self._take(size)
            cut = min(slack, size)
            pieces.append((doc, start, ids[: 4 * cut], total))
            self._wait(doc, start + cut, ids[4 * cut :], total)
            slack -= cut
        self._emit(pieces)

    def add(self, doc, ids: bytes) -> None:
        total, step = len(ids) // 4, 4 * self.window
        full = len(ids) // step
        for i in range(full):
            self._emit([(doc, i * self.window, ids[i * step : (i + 1) * step], total)])
        self._wait(doc, full * self.window, ids[full * step :], total)
        if self.waiting > POOL:
            while self.waiting > POOL // 2 and self.tokens >= self.window:
                self._fill(self.window)

    def finish(self) -> None:
        while self.tokens >= self.window:
            self._fill(self.window)
        while self.tokens:
            self._fill(1 << (self.tokens.bit_length() - 1))


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    end_id: int = 1,
    with_ids: bool = False,
    added: bool = False,
) -> DataFrame:
    """Pieces of ``docs (doc_id, text)`` in sequences of at most ``window`` ids.

    ``with_ids`` adds the piece's ids as array column ``token_ids``; with ``added``
    the vocabulary's added tokens in a text get their own ids.
    """
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        enc = encoder(tokenizer_path, added)
        packer = Packer(window, TaskContext.get().partitionId() << 33)

        def flush() -> dict:
            out, packer.out = packer.out, []
            cols = {
                "doc_id": [p[0] for p in out],
                "start": [p[1] for p in out],
                "length": [len(p[2]) // 4 for p in out],
                "ids_crc32": [zlib.crc32(p[2]) for p in out],
                "doc_tokens": [p[3] for p in out],
                "sequence_id": [p[4] for p in out],
                "offset": [p[5] for p in out],
            }
            if with_ids:
                import numpy as np

                cols["token_ids"] = [np.frombuffer(p[2], dtype="<u4").astype("int32") for p in out]
            return cols

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc, enc.ids(text.as_py() or "") + end)
                if len(packer.out) >= 8192:
                    yield flush()
        packer.finish()
        yield flush()

    schema = SCHEMA + (", token_ids array<int>" if with_ids else "")
    return map_arrow(docs.select("doc_id", "text"), run, schema)
