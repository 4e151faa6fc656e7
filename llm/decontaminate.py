"""Benchmark decontamination by a prefix-filtered join of word shingles.

An item's windows are its runs of 13 words (the whole item if it has fewer).  Each window must occur word by word, so any one of its
three-word shingles is necessary: the one that is rarest in all documents is its prefix (a containment of 1 has a prefix of one token).

1. Windows and their shingles are a table.  Documents count these shingles, and the counts are summed by shingle.
2. A window with a shingle that no document has can't occur and goes; each other one keeps its rarest shingle and the shingle's place in it.
3. Documents offer the places of the kept shingles with the words around them, and the two sides are joined on the shingle.  The window's place follows from the
   shingle's, its length bounds where it may lie, and the words there decide.
4. What was found is gathered by text and joined back.

So that documents offer only shingles that some window may want, they are looked up in a bitmap of fixed size first, which is all that is broadcast.  It lets
through every wanted shingle, and the join drops the others, so a benchmark of any size gives the same result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import free, only, raw_texts, staged, trimmed

WINDOW = 13
SHINGLE = 3
# Bits of the bitmap of wanted shingles: 2 MB.
BITS = 1 << 24
REMEMBERED = 200_000

# A-Z to a-z; all other ASCII but digits and letters to a space; bytes of other characters stay.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
ODD = np.uint64(0x9E3779B97F4A7C15)


def words(text) -> list[bytes]:
    """Lower-case words of UTF-8 bytes."""
    return bytes(text).translate(FOLD).split()


class _Hashes(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


def _forget() -> None:
    """Give up the words that this worker remembers."""
    _HASHES.clear()


def hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, found), dtype=np.uint64, count=len(found))


def shingles(own: np.ndarray, size: int) -> np.ndarray:
    """A signed hash for each run of ``size`` words."""
    n = len(own) - size + 1
    if n <= 0:
        return np.empty(0, np.int64)
    key = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        key = (key ^ own[k : k + n]) * ODD
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """A row ``item_id, window, size, keys`` for each distinct window of an item: its words, parted by spaces, and the hashes of its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, cut, size, keys = [], [], [], []
            for row, text in enumerate(raw_texts(batch, "text")):
                found = words(text)
                own = hashes(found)
                width = min(window, len(found))
                seen = set()
                for k in range(len(found) - width + 1 if found else 0):
                    one = b" ".join(found[k : k + width]).decode()
                    if one not in seen:
                        seen.add(one)
                        at.append(row)
                        cut.append(one)
                        size.append(width)
                        keys.append(shingles(own[k : k + width], min(SHINGLE, width)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(at, pa.int64())), pa.array(cut, pa.string()), pa.array(size, pa.int32()), pa.array(keys, pa.list_(pa.int64()))],
                names=["item_id", "window", "size", "keys"],
            )

    schema = T.StructType([items.schema["item_id"], *T.StructType.fromDDL("window string, size int, keys array<long>").fields])
    return items.select("item_id", "text").mapInArrow(run, schema)


class Wanted:
    """A bitmap that has the bit of every wanted shingle, and the sizes of wanted shingles."""

    def __init__(self, bitmap: np.ndarray, sizes: list[int]) -> None:
        self.bitmap, self.sizes, self.shift = bitmap, sizes, np.uint64(64 - (8 * len(bitmap) - 1).bit_length())

    @classmethod
    def of(cls, keys: DataFrame, bits: int = BITS) -> "Wanted":
        """From ``key, size``; each of at most eight tasks sends one compressed bitmap to the driver."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, sizes = cls(np.zeros(bits // 8, np.uint8), []), set()
            for batch in batches:
                slot = own._slots(batch.column("key").to_numpy().view(np.uint64))
                np.bitwise_or.at(own.bitmap, slot >> np.uint64(3), (1 << (slot & np.uint64(7))).astype(np.uint8))
                sizes.update(batch.column("size").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(own.bitmap.tobytes(), 1)], pa.binary()), pa.array([sorted(sizes)], pa.list_(pa.int32()))], names=["bitmap", "sizes"])

        found = keys.select("key", "size").repartition(8).mapInArrow(run, "bitmap binary, sizes array<int>").collect()
        whole = np.zeros(bits // 8, np.uint8)
        for r in found:
            whole |= np.frombuffer(zlib.decompress(r.bitmap), np.uint8)
        return cls(whole, sorted({s for r in found for s in r.sizes}))

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return keys >> self.shift

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slots(keys.view(np.uint64))
        return (self.bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def __reduce__(self):
        return _unpacked, (zlib.compress(self.bitmap.tobytes(), 1), self.sizes)


def _unpacked(bitmap: bytes, sizes: list[int]) -> Wanted:
    return Wanted(np.frombuffer(zlib.decompress(bitmap), np.uint8), sizes)


def shingle_counts(docs: DataFrame, wanted: Wanted) -> DataFrame:
    """``key, n``: how often the shingles that the bitmap lets through occur in all documents."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            met = []
            for text in raw_texts(batch, "text"):
                found = hashes(words(text))
                for size in own.sizes:
                    keys = shingles(found, size)
                    met.append(keys[own.has(keys)])
            keys, n = np.unique(np.concatenate(met) if met else np.empty(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], names=["key", "n"])
        _forget()

    return docs.select("text").mapInArrow(trimmed(count), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def prefixes(cut: DataFrame, docs: DataFrame, bits: int = BITS) -> DataFrame:
    """``key, place, window, size`` of the windows that may occur: their rarest shingle, the first of equals, and its place."""
    one = cut.select("window", "size", "keys").dropDuplicates(["window"])
    every = staged(one.select("window", "size", F.posexplode("keys").alias("place", "key")), "window-shingles")
    wide = every.select("key", F.least("size", F.lit(SHINGLE)).alias("size")).distinct()
    counts = staged(shingle_counts(docs, Wanted.of(wide, bits)), "shingle-counts")
    known = every.join(counts, "key", "left")
    least = known.groupBy("window", "size").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "key")).alias("one"))
    return least.filter("one.n > 0").select("one.key", "one.place", "window", "size")


def _offers(docs: DataFrame, wanted: Wanted, window: int) -> DataFrame:
    """``text1, text2, pos, key, around``: the wanted shingles of each text and the words from ``window - 1`` before to as many after their start."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)
    reach = window - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            out = []
            for t1, t2, text in zip(batch.column("text1").to_pylist(), batch.column("text2").to_pylist(), raw_texts(batch, "text"), strict=True):
                found = words(text)
                number = hashes(found)
                for size in own.sizes:
                    keys = shingles(number, size)
                    for p in np.flatnonzero(own.has(keys)).tolist():
                        before, after = found[max(0, p - reach) : p], found[p : p + window]
                        around = [b""] * (reach - len(before)) + before + after + [b""] * (window - len(after))
                        out.append((t1, t2, p, int(keys[p]), around))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary())]
                arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*arrays[:-1], arrays[-1].cast(pa.list_(pa.string()))], names=["text1", "text2", "pos", "key", "around"])
        _forget()

    return docs.select("text1", "text2", "text").mapInArrow(trimmed(run), "text1 long, text2 long, pos long, key long, around array<string>")


def occurrences(docs: DataFrame, chosen: DataFrame, window: int = WINDOW, bits: int = BITS) -> DataFrame:
    """``text1, text2, first, stop, window``: each place of a text where a window's words stand; ``docs(text1, text2, text)``."""
    wide = chosen.select("key", F.least("size", F.lit(SHINGLE)).alias("size")).distinct()
    # Copies of a text offer the same places.
    offered = _offers(docs, Wanted.of(wide, bits), window).dropDuplicates(["text1", "text2", "pos", "key"])
    met = offered.join(chosen, "key")
    there = F.array_join(F.slice("around", F.lit(window) - F.col("place"), F.col("size")), " ")
    first = F.col("pos") - F.col("place")
    return met.filter(there == F.col("window")).select("text1", "text2", first.alias("first"), (first + F.col("size")).alias("stop"), "window")


def _gathered(places: DataFrame, cut: DataFrame) -> DataFrame:
    """By text the maximal runs of words inside windows, and the items whose windows occur."""
    span = F.array_sort(F.collect_set(F.struct("first", "stop")))
    by_text = places.groupBy("text1", "text2").agg(span.alias("spans"))
    grow = lambda done, s: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["stop"] >= s["first"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["first"].alias("first"), F.greatest(F.element_at(done, -1)["stop"], s["stop"]).alias("stop")))),
    ).otherwise(F.concat(done, F.array(s)))
    none = F.array().cast("array<struct<first: long, stop: long>>")
    runs = by_text.select("text1", "text2", F.aggregate("spans", none, grow).alias("hit_spans"))
    owned = places.select("text1", "text2", "window").distinct().join(cut.select("window", "item_id").distinct(), "window")
    items = owned.groupBy(F.col("text1").alias("of1"), F.col("text2").alias("of2")).agg(F.array_sort(F.collect_set(F.struct("item_id"))).alias("items"))
    both = runs.join(items, (F.col("text1") == F.col("of1")) & (F.col("text2") == F.col("of2")))
    return both.select("text1", "text2", "hit_spans", F.col("items.item_id").alias("hit_items"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, bits: int = BITS) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (word ranges inside an occurring window) and ``hit_items``.

    ``docs`` needs ``text``, ``items`` needs ``item_id`` and ``text``; all columns of ``docs`` are kept, and one that is
    named like a result is replaced.  Null and empty texts have no words, hence no hits; an item without
    words has no window; of items with equal words each is reported, an id once; an empty benchmark hits nothing.
    ``bits`` is the size of the bitmap of wanted shingles; a small one costs time and changes nothing.
    """
    docs = docs.drop("n_words", "hit_spans", "hit_items")
    own = docs.select(F.xxhash64("text").alias("text1"), F.xxhash64("text", F.lit(1)).alias("text2"), "text")
    cut = staged(windows(only(items, item_id="item_id", text="text"), window), "windows")
    chosen = staged(prefixes(cut, own, bits), "window-prefixes")
    places = staged(occurrences(own, chosen, window, bits), "window-places")
    found = staged(_gathered(places, cut), "window-hits")

    text1, text2, of1, of2 = free(docs, "text1", "text2", "of1", "of2")
    keyed = docs.withColumns({text1: F.xxhash64("text"), text2: F.xxhash64("text", F.lit(1))})
    hits = found.withColumnsRenamed({"text1": of1, "text2": of2})
    joined = keyed.join(hits, (F.col(text1) == F.col(of1)) & (F.col(text2) == F.col(of2)), "left")

    @F.arrow_udf("long")
    def count(text: pa.Array) -> pa.Array:
        return pa.array([len(words((t or "").encode())) for t in text.to_pylist()], pa.int64())

    none = lambda c: F.coalesce(c, F.array().cast(found.schema[c].dataType))
    return joined.select(*docs.columns, count("text").alias("n_words"), none("hit_spans").alias("hit_spans"), none("hit_items").alias("hit_items"))


def n_hit() -> F.Column:
    """Words inside an occurring window."""
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["first"])


def contaminated(percent: int = 5) -> F.Column:
    """Whether any word is hit and hits are at least ``percent`` of all words."""
    return (n_hit() > 0) & (100 * n_hit() >= percent * F.col("n_words"))


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from ``contamination``."""
    listed = F.array_join(F.array_sort(F.transform(F.filter("hit_items", lambda i: i.isNotNull()), lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
