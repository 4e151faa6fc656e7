"""Packing token sequences by minimum bin slack.

A document gives its whole windows at once; what remains of it waits in a buffer by length.  For each
window, a bitset subset-sum program over the waiting lengths picks the multiset that comes closest
to the capacity; the counts are read back through its layers and the pattern is used as often as
the buffer allows.  Where no multiset is exact, one more piece is cut to fill the rest; the last
ids of a task, fewer than a window, go into sequences whose lengths are powers of two.  Each task
packs its own documents, so nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from llm.common import only, texts, trimmed
from llm.tokens import DEFAULT_VOCABULARY, REMEMBERED, drop_encoders, encoder

CAPACITY = 1024
# Remainders that wait in a task's buffer before they are packed.
WAITING = 8192
# Sequences of one task are numbered from its partition times this.
SEQUENCES = 1 << 40


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length to take so that the sum comes closest to ``capacity``.

    The longest length is always taken once, as the hardest to place.
    """
    longest = max(counts)
    target = capacity - longest
    mask = (1 << (target + 1)) - 1
    reach, layers = 1, []
    for length in sorted(counts, reverse=True):
        have = min(counts[length] - (length == longest), target // length)
        step = 1
        while have > 0 and not reach >> target & 1:
            take = min(step, have)
            layers.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            have -= take
            step *= 2
        if reach >> target & 1:
            break
    left = reach.bit_length() - 1
    used = {longest: 1}
    for length, take, before in reversed(layers):
        if not before >> left & 1:
            used[length] = used.get(length, 0) + take
            left -= length * take
    return used


class Packer:
    """Packs the documents of one task; ``rows`` collects its pieces."""

    def __init__(self, capacity: int = CAPACITY, waiting: int = WAITING, first_sequence: int = 0, with_ids: bool = False) -> None:
        self.capacity, self.limit, self.next = capacity, waiting, first_sequence
        self.with_ids = with_ids
        self.bins: dict[int, deque] = {}
        self.waiting = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        whole = len(ids) - len(ids) % self.capacity
        for start in range(0, whole, self.capacity):
            self._sequence([(doc_id, start, ids[start : start + self.capacity], len(ids))])
        if whole < len(ids):
            self._wait((doc_id, whole, ids[whole:].copy(), len(ids)))
            if self.waiting >= self.limit:
                self.pack(keep=self.limit // 8)

    def _wait(self, piece: tuple) -> None:
        self.bins.setdefault(len(piece[2]), deque()).append(piece)
        self.waiting += 1

    def _take(self, length: int) -> tuple:
        queue = self.bins[length]
        piece = queue.popleft()
        if not queue:
            del self.bins[length]
        self.waiting -= 1
        return piece

    def pack(self, keep: int = 0) -> None:
        """Fill windows until at most ``keep`` pieces wait, or too few ids for a window."""
        while self.waiting > keep:
            counts = {length: len(queue) for length, queue in self.bins.items()}
            if sum(length * n for length, n in counts.items()) < self.capacity:
                break
            used = fill(counts, self.capacity)
            total = sum(length * n for length, n in used.items())
            if total == self.capacity:
                for _ in range(min(counts[length] // n for length, n in used.items())):
                    self._sequence([self._take(length) for length, n in used.items() for _ in range(n)])
                continue
            pieces = [self._take(length) for length, n in used.items() for _ in range(n)]
            gap = self.capacity - total
            doc_id, start, ids, doc_tokens = self._take(min(x for x in self.bins if x > gap))
            pieces.append((doc_id, start, ids[:gap], doc_tokens))
            self._wait((doc_id, start + gap, ids[gap:], doc_tokens))
            self._sequence(pieces)

    def finish(self) -> None:
        """Pack all; the ids left over go into sequences of 2 ** n."""
        self.pack()
        rest = sum(length * len(queue) for length, queue in self.bins.items())
        while rest:
            room = 1 << (rest.bit_length() - 1)
            rest -= room
            pieces = []
            while room:
                doc_id, start, ids, doc_tokens = self._take(max(self.bins))
                pieces.append((doc_id, start, ids[:room], doc_tokens))
                if len(ids) > room:
                    self._wait((doc_id, start + room, ids[room:], doc_tokens))
                room -= min(room, len(ids))
            self._sequence(pieces)

    def _sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            raw = ids.astype("<u4").tobytes()
            row = (doc_id, start, len(ids), zlib.crc32(raw), doc_tokens, self.next, offset)
            self.rows.append((*row, raw) if self.with_ids else row)
            offset += len(ids)
        self.next += 1


PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
])


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    vocabulary: str = DEFAULT_VOCABULARY,
    end_id: int | None = 0,
    waiting: int = WAITING,
    with_ids: bool = True,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """A row for each piece of ``docs(doc_id, text)``: where it lies in its document and sequence.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers (left out without
    ``with_ids``).  Null text is the empty text: a piece with the end id alone.  Rows with a null or
    repeated ``doc_id`` are packed like all others, other columns are ignored, and an empty table
    gives no rows.  ``remembered`` bounds the distinct words that a worker keeps encoded.
    """
    schema = PIECES if with_ids else pa.schema(list(PIECES)[:-1])
    ddl = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity, waiting, TaskContext.get().partitionId() * SEQUENCES, with_ids)
        enc = encoder(vocabulary, remembered)
        end = np.array([] if end_id is None else [end_id], dtype=np.uint32)

        def out() -> pa.RecordBatch:
            rows, packer.rows = packer.rows, []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(texts(batch, "text")), strict=True):
                ids = np.concatenate([ids, end])
                if len(ids):
                    packer.add(doc_id, ids)
            if packer.rows:
                yield out()
        packer.finish()
        if packer.rows:
            yield out()
        if remembered < REMEMBERED:
            del enc
            drop_encoders()

    return only(docs, doc_id="doc_id", text="text").mapInArrow(trimmed(run), ddl + (", ids binary" if with_ids else ""))
