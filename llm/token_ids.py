"""Token ids of a corpus in fixed-width bit-packed files.

A file holds blocks of ids, each id in the fewest bits that the vocabulary needs, then a footer
with the byte offset of every block and the documents' ids and token offsets.  A block unpacks
with one vectorised step, and any range of ids is read by seeking to its blocks.

File: magic, blocks, footer, footer length (8 bytes), magic.  All numbers are little-endian;
the bits of an id are stored from the lowest up.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import filesystem, new_dir, only, texts, write_once
from llm.tokens import DEFAULT_VOCABULARY, encoder

MAGIC = b"FWIDS001"
BLOCK_IDS = 1 << 14
READ_IDS = 1 << 20


def bits_for(vocabulary_size: int) -> int:
    """The fewest bits that hold every id below ``vocabulary_size``."""
    return max(1, int(vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each, padded to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of a packed block."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=count).astype(np.uint32)
    spread = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=count * bits, bitorder="little")
    weights = np.uint32(1) << np.arange(bits, dtype=np.uint32)
    return (spread.reshape(count, bits).astype(np.uint32) * weights).sum(axis=1, dtype=np.uint32)


class ShardWriter:
    """Streams documents into one file; holds a block and the index in memory."""

    def __init__(self, out, bits: int, block_ids: int = BLOCK_IDS) -> None:
        self.out, self.bits, self.block_ids = out, bits, block_ids
        self.pending: list[np.ndarray] = []
        self.pending_ids = self.tokens = 0
        self.position = len(MAGIC)
        self.blocks: list[int] = []
        self.doc_ids: list[int | None] = []
        self.ends: list[int] = []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.tokens += len(ids)
        self.ends.append(self.tokens)
        self.pending.append(ids)
        self.pending_ids += len(ids)
        if self.pending_ids >= self.block_ids:
            self._blocks(last=False)

    def _blocks(self, last: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.empty(0, np.uint32)
        stop = len(ids) if last else len(ids) - len(ids) % self.block_ids
        for i in range(0, stop, self.block_ids):
            data = pack(ids[i : i + self.block_ids], self.bits)
            self.blocks.append(self.position)
            self.out.write(data)
            self.position += len(data)
        self.pending = [ids[stop:].copy()]
        self.pending_ids = len(ids) - stop

    def close(self) -> None:
        self._blocks(last=True)
        known = np.array([d is not None for d in self.doc_ids], dtype=np.uint8)
        parts = [
            np.array(self.blocks, dtype="<u8").tobytes(),
            np.array([d or 0 for d in self.doc_ids], dtype="<i8").tobytes(),
            known.tobytes(),
            np.array(self.ends, dtype="<u8").tobytes(),
        ]
        head = {"bits": self.bits, "block_ids": self.block_ids, "blocks": len(self.blocks),
                "documents": len(self.doc_ids), "tokens": self.tokens, "end": self.position}
        line = json.dumps(head).encode() + b"\n"
        footer = line + b"".join(parts)
        self.out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)


class ShardReader:
    """Random access to a file: documents by position, ids by range."""

    def __init__(self, uri: str) -> None:
        store, path = filesystem(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{uri}: not a token file")
        length = int.from_bytes(tail[:8], "little")
        footer = self.file.read_at(length, size - 16 - length)
        line, _, rest = footer.partition(b"\n")
        head = json.loads(line)
        self.bits, self.block_ids, self.tokens = head["bits"], head["block_ids"], head["tokens"]
        self.documents, blocks, n = head["documents"], head["blocks"], head["documents"]
        at = np.cumsum([0, 8 * blocks, 8 * n, n, 8 * n])
        self.blocks = np.append(np.frombuffer(rest[at[0] : at[1]], "<u8"), np.uint64(head["end"])).astype(np.int64)
        self.ids = np.frombuffer(rest[at[1] : at[2]], "<i8")
        self.known = np.frombuffer(rest[at[2] : at[3]], np.uint8)
        self.ends = np.frombuffer(rest[at[3] : at[4]], "<u8").astype(np.int64)

    def doc_id(self, k: int) -> int | None:
        return int(self.ids[k]) if self.known[k] else None

    def start(self, k: int) -> int:
        return int(self.ends[k - 1]) if k else 0

    def range(self, first: int, stop: int) -> np.ndarray:
        """Ids ``first`` up to ``stop``, from the blocks that hold them."""
        if stop <= first:
            return np.empty(0, np.uint32)
        a, b = first // self.block_ids, (stop - 1) // self.block_ids + 1
        data = self.file.read_at(int(self.blocks[b] - self.blocks[a]), int(self.blocks[a]))
        if self.bits in (8, 16, 32) or self.block_ids * self.bits % 8 == 0:  # blocks join without gaps
            ids = unpack(data, self.bits, min(b * self.block_ids, self.tokens) - a * self.block_ids)
        else:
            cut = [data[self.blocks[i] - self.blocks[a] : self.blocks[i + 1] - self.blocks[a]] for i in range(a, b)]
            ids = np.concatenate([unpack(d, self.bits, min(self.block_ids, self.tokens - (a + i) * self.block_ids))
                                  for i, d in enumerate(cut)])
        return ids[first - a * self.block_ids : stop - a * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.range(self.start(k), int(self.ends[k]))

    def each(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """All documents in order, with the ids before them in this file; reads many at once."""
        k = 0
        while k < self.documents:
            first = self.start(k)
            stop = max(k + 1, int(np.searchsorted(self.ends, first + READ_IDS, side="right")))
            ids = self.range(first, int(self.ends[stop - 1]))
            for i in range(k, stop):
                a = self.start(i)
                yield self.doc_id(i), a, ids[a - first : int(self.ends[i]) - first]
            k = stop


def write_token_ids(
    docs: DataFrame, folder: str, vocabulary: str = DEFAULT_VOCABULARY, end_id: int | None = 2, block_ids: int = BLOCK_IDS
) -> list[dict]:
    """Encode ``docs(doc_id, text)`` and write one file for each range of ``doc_id``.

    Null text is the empty text (only the end id), a null ``doc_id`` sorts first, rows that
    share a ``doc_id`` stay apart in a fixed order, other columns are ignored, and an empty table
    writes no file.  Returns the manifest, a row for each file in ``doc_id`` order: its size
    follows the number of files, not of documents.
    """
    rows = only(docs, doc_id="doc_id", text="text").withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        enc = encoder(vocabulary)
        totals = {}

        def fill(out) -> None:
            shard = ShardWriter(out, bits_for(enc.vocabulary_size), block_ids)
            end = np.array([] if end_id is None else [end_id], dtype=np.uint32)

            def add(batch: pa.RecordBatch) -> None:
                encoded = enc.encode(texts(batch, "text"))
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                    shard.add(doc_id, np.concatenate([ids, end]))

            add(first)
            for batch in batches:
                add(batch)
            shard.close()
            totals.update(documents=len(shard.ends), tokens=shard.tokens)

        path = write_once(folder, f"ids-{part:06d}.fwids", fill)
        yield pa.RecordBatch.from_pylist([{"part": part, "path": path, **totals}], schema=MANIFEST)

    found = ordered.select("doc_id", "text").mapInArrow(write, "part long, path string, documents long, tokens long").collect()
    return [r.asDict() for r in sorted(found, key=lambda r: r.part)]


MANIFEST = pa.schema([("part", pa.int64()), ("path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())])
DIGESTS = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("shard", pa.int64())
])


def read_digests(spark: SparkSession, manifest: list[dict]) -> DataFrame:
    """A row for each document, read back from the files."""
    rows, before = [], 0
    for entry in manifest:
        rows.append((entry["part"], entry["path"], before))
        before += entry["tokens"]
    files = spark.createDataFrame(rows, "part long, path string, before long").repartition(max(1, len(rows)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry in batch.to_pylist():
                out = []
                for doc_id, start, ids in ShardReader(entry["path"]).each():
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    out.append((doc_id, entry["before"] + start, len(ids), crc, entry["part"]))
                    if len(out) == 10_000:
                        yield _batch(out)
                        out = []
                if out:
                    yield _batch(out)

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), DIGESTS, strict=True)], schema=DIGESTS)


def round_trip(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, end_id: int = 2) -> DataFrame:
    """Write the ids of ``docs`` and read them back: ``doc_id, start, n_tokens, ids_crc32, shard``."""
    spark = docs.sparkSession
    return read_digests(spark, write_token_ids(docs, new_dir(spark, "token-ids"), vocabulary, end_id))
