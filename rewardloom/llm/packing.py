"""Packing by minimum bin slack.

Every document becomes ids plus an end id.  Full windows of ``capacity`` ids are cut off as
sequences of their own; the remainders wait in a pool.  A window is filled from the pool by a
subset-sum search: bit ``s`` of an integer says that some of the waiting remainders sum to ``s``, one
shift per remainder (kept in powers of two of a length's count); the highest bit is the fullest
window, and walking back over the kept integers gives how many remainders of each length it takes.
The longest waiting remainder is always taken, so none waits forever.

Packing is local to an input partition: no row is shuffled, memory is one batch and the pool,
and a partition that runs again yields the same sequences (the reader deals files out the same way).
When a partition's rows end, the pool is packed until it is empty, slack is filled by cutting the next
remainder, and the last, short rest is cut at powers of two, which need no padding.

Defined cases: null text is the empty text (one piece, the end id); a null id is kept; repeated
rows are packed each on their own; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rewardloom.llm.tokens import encoded

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def fullest(lengths: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as near to ``capacity`` as it can be, not
    above.  ``lengths``: length -> how many there are."""
    steps, reach = [], 1
    limit = (1 << (capacity + 1)) - 1
    for length in sorted(lengths, reverse=True):
        left, take = min(lengths[length], capacity // length), 1
        while left > 0:
            take = min(take, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & limit
            left -= take
            take *= 2
        if reach >> capacity:
            break
    at, taken = reach.bit_length() - 1, defaultdict(int)
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            taken[length] += take
    return dict(taken)


class Packer:
    """Turns documents into rows of pieces; ``rows`` holds those not yet handed out."""

    def __init__(self, capacity: int, pool: int, first_sequence: int):
        self.capacity, self.most, self.sequence = capacity, pool, first_sequence
        self.waiting: dict[int, list] = defaultdict(list)      # length -> remainders (doc, start, ids, tokens)
        self.count, self.total, self.rows = 0, 0, []

    def _emit(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, tokens in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), tokens, self.sequence, offset))
            offset += n
        self.sequence += 1

    def add(self, doc, ids: bytes) -> None:
        tokens, width = len(ids) // 4, self.capacity * 4
        whole = len(ids) // width * width
        for i in range(0, whole, width):
            self._emit([(doc, i // 4, ids[i:i + width], tokens)])
        if whole < len(ids):
            self._wait((doc, whole // 4, ids[whole:], tokens))
        if self.count >= self.most:
            while self.count > self.most // 2:
                self._emit(self._window())

    def _wait(self, piece) -> None:
        self.waiting[len(piece[2]) // 4].append(piece)
        self.count += 1
        self.total += len(piece[2]) // 4

    def _take(self, length: int):
        piece = self.waiting[length].pop()
        if not self.waiting[length]:
            del self.waiting[length]
        self.count -= 1
        self.total -= length
        return piece

    def _window(self) -> list:
        longest = max(self.waiting)
        out = [self._take(longest)]
        for length, n in fullest({k: len(v) for k, v in self.waiting.items()}, self.capacity - longest).items():
            out += [self._take(length) for _ in range(n)]
        return out

    def finish(self) -> None:
        while self.total >= self.capacity:
            window = self._window()
            slack = self.capacity - sum(len(x[2]) // 4 for x in window)
            if slack:
                window.append(self._cut(slack))
            self._emit(window)
        while self.total:
            size, window = 1 << (self.total.bit_length() - 1), []
            while size:
                length = max(self.waiting)
                piece = self._take(length) if length <= size else self._cut(size)
                size -= len(piece[2]) // 4
                window.append(piece)
            self._emit(window)

    def _cut(self, size: int):
        """The first ``size`` ids of the longest remainder; the rest goes on waiting."""
        doc, start, ids, tokens = self._take(max(self.waiting))
        if len(ids) > 4 * size:
            self._wait((doc, start + size, ids[4 * size:], tokens))
        return doc, start, ids[:4 * size], tokens


def pack(docs: DataFrame, tokenizer: str, spaces: str, capacity: int = 4096, pool: int = 256, end: int = 2) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one per piece."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(batches):
        packer = Packer(capacity, pool, TaskContext.get().partitionId() << 33)
        for (doc,), ids in encoded(batches, tokenizer, spaces, end):
            packer.add(doc, ids)
            if len(packer.rows) >= 20_000:
                yield _batch(packer, schema)
        packer.finish()
        yield _batch(packer, schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def _batch(packer: Packer, schema) -> pa.RecordBatch:
    rows, packer.rows = packer.rows, []
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)
