"""Removal of every byte that lies in a 400-byte string which also starts elsewhere.

A full suffix array of the corpus would move every suffix.  Here a sparse one does:

1. Anchors.  Of every 337 neighbouring 64-byte strings of a text, those with the smallest hash are anchors.  The choice
   depends on these bytes only, so two equal 400-byte strings, wherever they are, hold equal anchors at equal places.
2. An anchor's context reaches 336 bytes to its left and 400 from its start: all 400-byte strings that contain it.
   Anchors whose whole context occurs twice are settled without looking at any text.
3. What remains, anchors met in several contexts, is sorted: suffixes that start at the anchor, and the reversed
   text before it, both by deep-shallow sorting with the common prefixes of neighbours.  A
   400-byte string that starts ``d`` bytes before the anchor is repeated where two contexts share ``400 - d`` bytes
   to the right and ``d`` to the left.
4. Each text loses the union of its repeated strings.

Contexts of one anchor meet in one task up to ``group_max``; those of a more frequent anchor are
settled by counting the hashes of their 400-byte strings, a row each, which spread over all tasks.

51 whole words may be fewer than 400 bytes, and an anchor of theirs need not be one of a 400-byte string.  Where such passages
are asked for as well, every 51 words under 400 bytes give an anchor too, and around an anchor that two contexts share
their windows of 51 words are counted by hash, where the shared text holds so many at all.  Longer ones are 400-byte strings.

``cut_passages`` does the same over words: each word becomes eight bytes of hash, so 51 words are a string of 408 bytes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import free, only, raw_texts, staged, trimmed
from llm.shape import SPACES
from llm.suffix_sort import deep_shallow

LENGTH = 400
ANCHOR = 64
GROUP_MAX = 50_000
# Words of the shortest repeated passage, and bytes that stand for a word in ``cut_passages``.
WORDS = 51
CODE = 8
# Texts are scanned in parts of so many bytes, so that a very long one needs no more memory.
PART = 1 << 21
# Low bits that hold a place within a part, where places are ordered by their hashes.
PLACE = 22

_RNG = np.random.default_rng(711)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = _RNG.integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def string_hashes(data: np.ndarray, size: int = ANCHOR) -> np.ndarray:
    """A hash of each ``size`` bytes in a row (a power of two), by doubling."""
    h = _BYTE[data]
    for k in range(size.bit_length() - 1):
        half = 1 << k
        h = h[:-half] * _STEP[k] + h[half:]
        h ^= h >> np.uint64(32)
    return h * _STEP[7]


def sliding(values: np.ndarray, size: int, least: bool) -> np.ndarray:
    """Smallest (or largest) of every ``size`` neighbours."""
    take = np.minimum if least else np.maximum
    n = len(values)
    fill = np.iinfo(values.dtype).max if least else np.iinfo(values.dtype).min
    rows = -(-n // size)
    padded = np.full(rows * size, fill, dtype=values.dtype)
    padded[:n] = values
    grid = padded.reshape(rows, size)
    ahead = take.accumulate(grid, axis=1).ravel()
    behind = take.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return take(behind[: n - size + 1], ahead[size - 1 : n])


def word_windows(text: memoryview | bytes, words: int = WORDS, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each ``words`` whole words in a row that take under ``length`` bytes."""
    space = np.concatenate([[True], _SPACE[np.frombuffer(text, np.uint8)], [True]])
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[: max(0, len(edges) - 2 * words + 2) : 2], edges[2 * words - 1 :: 2]
    few = ends - starts < length
    return starts[few], ends[few]


def least_places(h: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Places of the smallest hash within each ``first`` to ``stop``, of equal ones the first."""
    key = h >> np.uint64(PLACE) << np.uint64(PLACE) | np.arange(len(h), dtype=np.uint64)
    level = np.frexp(stop - first)[1] - 1
    least = np.empty(len(first), np.uint64)
    for k, n in enumerate(np.bincount(level).tolist()):
        if k:
            key = np.minimum(key[: -(1 << k - 1)], key[1 << k - 1 :])
        if n:
            own = slice(None) if n == len(first) else np.flatnonzero(level == k)
            least[own] = np.minimum(key[first[own]], key[stop[own] - (1 << k)])
    # The windows' ends ascend, and so do these places.
    place = (least & np.uint64((1 << PLACE) - 1)).astype(np.int64)
    return place[np.diff(place, prepend=-1) > 0]


def anchors(
    text: memoryview | bytes, length: int = LENGTH, size: int = ANCHOR, part: int = PART, words: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors and their hashes; with ``words`` those of so many words under ``length`` bytes as well."""
    data = np.frombuffer(text, np.uint8)
    window = length - size + 1
    begin, end = word_windows(text, words, length) if words else (np.empty(0, np.int64),) * 2
    long = end - begin >= size
    begin, end = begin[long], end[long]
    if len(data) < length and not len(begin):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    places, hashes = [], []
    starts = max(1, len(data) - length + 1)
    for first in range(0, starts, part):
        stop = min(starts, first + part)
        h = string_hashes(data[first : stop + length - 1], size)
        if len(h) >= window:
            least = sliding(h, window, least=True)
            # A place is an anchor if it holds the smallest hash of any window that it lies in.
            around = np.zeros(len(h) + window - 1, dtype=np.uint64)
            around[window - 1 : window - 1 + len(least)] = least
            own = np.flatnonzero(h == sliding(around, window, least=False))
            places.append(own + first)
            hashes.append(h[own])
        if len(begin):
            a, b = np.searchsorted(begin, [first, stop if stop < starts else len(data)])
            own = least_places(h, begin[a:b] - first, end[a:b] - first - size + 1)
            places.append(own + first)
            hashes.append(h[own])
    where = np.concatenate(places)
    where, at = np.unique(where, return_index=True)
    return where.astype(np.int64), np.concatenate(hashes)[at]


WORD = re.compile(rb"[^%s]+" % re.escape(SPACES))
_SPACE = np.isin(np.arange(256), list(SPACES))


def word_codes(text: memoryview | bytes) -> bytes:
    """A hash for each word, one after the other."""
    return b"".join(map(xxhash.xxh3_64_digest, bytes(text).split()))


def near_few_words(text: memoryview | bytes, where: np.ndarray, length: int = LENGTH, words: int = WORDS) -> np.ndarray:
    """Which anchors lie in a string of ``length`` bytes that holds under ``words`` whole words."""
    if not len(where):
        return np.empty(0, bool)
    space = np.concatenate([[True], _SPACE[np.frombuffer(text, np.uint8)], [True]])
    starts, ends = np.cumsum(space[:-2] & ~space[1:-1]), np.cumsum(~space[1:-1] & space[2:])
    # Words that end before the string's last byte, without those that start at its first byte or earlier.
    few = ends[length - 2 : -1] - starts[: len(starts) - length + 1] < words
    sums = np.concatenate([[0], np.cumsum(few)])
    return sums[np.minimum(where + 1, len(few))] > sums[np.maximum(where - (length - ANCHOR), 0)]


def _anchor_rows(docs: DataFrame, length: int, view: Callable | None, keep: Callable | None, words: int | None) -> DataFrame:
    """A row for each anchor and context of a document: its first place there, and the others if there are ``more``."""
    before = length - ANCHOR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row1, row2 = batch.column("row1").to_pylist(), batch.column("row2").to_pylist()
            out: list[tuple] = []
            for r1, r2, text in zip(row1, row2, raw_texts(batch, "text"), strict=True):
                text = view(text) if view else text
                where, hashes = anchors(text, length, words=words)
                if keep:
                    kept = keep(text, where)
                    where, hashes = where[kept], hashes[kept]
                found: dict[tuple[int, bytes], list[int]] = {}
                for p, h in zip(where.tolist(), hashes.view(np.int64).tolist(), strict=True):
                    left = min(p, before)
                    context = xxhash.xxh3_128_digest(text[p - left : p + length], seed=left)
                    found.setdefault((h, context), []).append(p)
                out += [(r1, r2, h, context, places[0], places[1:] or None) for (h, context), places in found.items()]
            if out:
                row1, row2, anchor, context, place, more = zip(*out, strict=True)
                halves = np.frombuffer(b"".join(context), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row1, pa.int64()), pa.array(row2, pa.int64()), pa.array(anchor, pa.int64()), pa.array(halves[:, 0]),
                     pa.array(halves[:, 1]), pa.array(place, pa.int64()), pa.array(more, pa.list_(pa.int64()))],
                    names=["row1", "row2", "anchor", "context1", "context2", "place", "more"],
                )

    return docs.mapInArrow(trimmed(run), "row1 long, row2 long, anchor long, context1 long, context2 long, place long, more array<long>")


Sorted = tuple[list[int], list[int]]


def longest_shared(found: Sorted) -> list[int]:
    """For each string that was sorted its longest common prefix with another."""
    order, prefix = found
    out = [0] * len(order)
    for k, p, q in zip(order, prefix, [*prefix[1:], 0], strict=True):
        out[k] = p if p > q else q
    return out


def shared_reach(left: Sorted, right: Sorted, most_l: list[int], most_r: list[int], length: int = LENGTH) -> list[tuple[int, int] | None]:
    """For contexts of one anchor: the smallest and largest ``d`` at which the string that starts ``d`` bytes
    before the anchor also lies in another context; None where there is none.

    ``left`` is the order and common prefixes of the bytes before the anchor in reverse, ``right`` of those from its start
    on, ``most_l`` and ``most_r`` are their longest ones.
    """
    (order_l, prefix_l), (order_r, prefix_r) = left, right
    n = len(order_l)
    most = length - ANCHOR
    out: list[tuple[int, int] | None] = [None] * n
    own = [k for k in range(n) if min(most_l[k], most) + most_r[k] >= length]
    if not own:
        return out
    if n == 2:
        return [(max(0, length - prefix_r[1]), min(prefix_l[1], most))] * 2
    lowest, highest = length - max(most_r[k] for k in own), max(most_l[k] for k in own)
    cut = {min(p, most) for p in prefix_l[1:]} | {length - p for p in prefix_r[1:] if p >= ANCHOR}
    order_l, order_r, own = np.array(order_l), np.array(order_r), np.array(own)
    prefix_l, prefix_r = np.array(prefix_l), np.array(prefix_r)
    low, high = np.full(n, most + 1), np.full(n, -1)
    group_l, group_r = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in sorted(c for c in cut if max(0, lowest) <= c <= min(most, highest)):
        # Which contexts share d bytes to the left and length - d to the right with one another.
        group_l[order_l] = (prefix_l < d).cumsum()
        group_r[order_r] = (prefix_r < length - d).cumsum()
        if d == 0:
            group_l[:] = 0
        group = (group_l * (n + 1) + group_r)[own]
        order = group.argsort()
        group = group[order]
        equal = group[1:] == group[:-1]
        twice = np.concatenate([own[order[1:][equal]], own[order[:-1][equal]]])
        low[twice] = np.minimum(low[twice], d)
        high[twice] = d
    return [(int(a), int(b)) if b >= 0 else None for a, b in zip(low, high, strict=True)]


def _windows_around(left: bytes, right: bytes, words: int, length: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """A context's text, and the bytes before and from the anchor's start on of its windows of ``words`` that contain the anchor.

    An edge of the context that is not the text's lies so far off that no window under ``length`` bytes reaches it.
    """
    whole = left[::-1] + right
    first, stop = word_windows(whole, words, length)
    own = (first <= len(left)) & (stop >= len(left) + ANCHOR)
    return whole, len(left) - first[own], stop[own] - len(left)


def _window_hashes(whole: bytes, at: int, ahead: np.ndarray, behind: np.ndarray) -> list[bytes]:
    return [xxhash.xxh3_128_digest(whole[at - d : at + e], seed=d) for d, e in zip(ahead.tolist(), behind.tolist(), strict=True)]


def shared_windows(
    left: list[bytes], right: list[bytes], most_l: list[int], most_r: list[int], reach: list, asked: list[bool], length: int = LENGTH, words: int = WORDS
) -> list[list[tuple[int, int]]]:
    """For contexts of one anchor: the outermost windows of ``words`` whole words under ``length`` bytes that other
    contexts hold too, as bytes before and from the anchor's start on.

    There may be none where ``reach`` covers all that is shared, or where none is ``asked`` for.
    """
    out: list[list[tuple[int, int]]] = [[] for _ in left]
    # What a context shares with any other must hold so many words.
    own = [
        k
        for k, (a, b) in enumerate(zip(most_l, most_r, strict=True))
        if a + b >= 2 * words - 1 and len((left[k][:a][::-1] + right[k][:b]).split()) >= words
    ]
    if len(own) < 2 or not any(asked[k] and (not reach[k] or reach[k][1] < most_l[k] or length - reach[k][0] < most_r[k]) for k in own):
        return out
    hashes, of, found = bytearray(), [], {}
    for k in own:
        whole, ahead, behind = _windows_around(left[k], right[k], words, length)
        inside = (ahead <= most_l[k]) & (behind <= most_r[k])
        found[k] = ahead, behind = ahead[inside], behind[inside]
        hashes += b"".join(_window_hashes(whole, len(left[k]), ahead, behind))
        of.append(len(ahead))
    halves = np.frombuffer(bytes(hashes), "<u8").reshape(-1, 2)
    order = np.lexsort((halves[:, 0], halves[:, 1]))
    equal = (halves[order[1:]] == halves[order[:-1]]).all(axis=1)
    twice = np.zeros(len(halves), bool)
    twice[order[1:][equal]] = twice[order[:-1][equal]] = True
    for k, hit in zip(own, np.split(twice, np.cumsum(of)[:-1]), strict=True):
        at = np.flatnonzero(hit)
        if len(at):
            out[k] = [(int(found[k][0][i]), int(found[k][1][i])) for i in sorted({at[0], at[-1]})]
    return out


CONTEXTS = "anchor long, seen long, row1 long, row2 long, place long, before binary, after binary"


def _context_rows(chosen: DataFrame, docs: DataFrame, length: int, view: Callable | None) -> DataFrame:
    """The text around each chosen anchor; one context each."""
    wanted = chosen.groupBy("row1", "row2").agg(F.collect_list(F.struct("anchor", "seen", "place")).alias("wanted"))
    wanted = wanted.withColumnsRenamed({"row1": "own1", "row2": "own2"})
    joined = docs.join(wanted.hint("shuffle_hash"), (F.col("row1") == F.col("own1")) & (F.col("row2") == F.col("own2")))
    before = length - ANCHOR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            ids = zip(batch.column("row1").to_pylist(), batch.column("row2").to_pylist(), batch.column("wanted").to_pylist(), strict=True)
            for (r1, r2, listed), text in zip(ids, raw_texts(batch, "text"), strict=True):
                text = view(text) if view else text
                for w in listed:
                    p = w["place"]
                    out.append((w["anchor"], w["seen"], r1, r2, p, bytes(text[max(0, p - before) : p])[::-1], bytes(text[p : p + length])))
            if out:
                types = [pa.int64()] * 5 + [pa.binary()] * 2
                names = ["anchor", "seen", "row1", "row2", "place", "before", "after"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    # A row that the table holds twice gives its contexts twice; they are seen more than once, so nothing is asked of them,
    # and to the others they are the same partner twice.
    # All columns of ``docs`` are taken, so that whoever joins it by row again finds it shuffled already.
    return joined.select(*docs.columns, "wanted").mapInArrow(trimmed(run), CONTEXTS)


def _sorted_reach(contexts: DataFrame, length: int, words: int | None) -> DataFrame:
    """Repeated stretches around anchors whose contexts fit in one task."""

    def settle(rows: list[dict]) -> Iterator[tuple]:
        if len(rows) < 2:
            return
        left, right = [r["before"] for r in rows], [r["after"] for r in rows]
        sorted_l, sorted_r = deep_shallow(left), deep_shallow(right)
        most_l, most_r = longest_shared(sorted_l), longest_shared(sorted_r)
        reach = shared_reach(sorted_l, sorted_r, most_l, most_r, length)
        asked = [r["seen"] == 1 for r in rows]
        windows = shared_windows(left, right, most_l, most_r, reach, asked, length, words) if words else [[]] * len(rows)
        for r, found, short in zip(rows, reach, windows, strict=True):
            if r["seen"] > 1:
                continue
            if found:
                yield r["row1"], r["row2"], r["place"] - found[1], r["place"] + length - found[0]
            for ahead, behind in short:
                yield r["row1"], r["row2"], r["place"] - ahead, r["place"] + behind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        rows: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                if rows and rows[-1]["anchor"] != r["anchor"]:
                    out += settle(rows)
                    rows = []
                rows.append(r)
            if out:
                yield _stretches(out)
                out = []
        out += settle(rows)
        if out:
            yield _stretches(out)

    return contexts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(trimmed(run), "row1 long, row2 long, first long, stop long")


def _stretches(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["row1", "row2", "first", "stop"])


def _counted_reach(contexts: DataFrame, length: int, words: int | None) -> DataFrame:
    """The same for anchors of any frequency: a row for each 400-byte string around them, counted, and for each window of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                left, right = r["before"], r["after"]
                whole = left[::-1] + right
                steps = list(range(max(0, length - len(right)), len(left) + 1))
                strings = [xxhash.xxh3_128_digest(whole[len(left) - d : len(left) - d + length]) for d in steps]
                reach = [length - d for d in steps]
                if words:
                    _, ahead, behind = _windows_around(left, right, words, length)
                    strings += _window_hashes(whole, len(left), ahead, behind)
                    steps, reach = steps + ahead.tolist(), reach + behind.tolist()
                n = len(strings)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k]] * n, pa.int64()) for k in ("anchor", "seen", "row1", "row2", "place")]
                    + [pa.array(steps, pa.int64()), pa.array(reach, pa.int64()), pa.array(strings, pa.binary())],
                    names=["anchor", "seen", "row1", "row2", "place", "d", "e", "string"],
                )

    rows = contexts.mapInArrow(run, "anchor long, seen long, row1 long, row2 long, place long, d long, e long, string binary")
    keys = {"anchor": "a", "d": "at", "e": "to", "string": "of"}
    twice = rows.groupBy(*[F.col(k).alias(v) for k, v in keys.items()]).agg(F.count("*").alias("n")).filter("n > 1")
    hit = rows.filter("seen = 1").join(twice, [F.col(k) == F.col(v) for k, v in keys.items()])
    # Strings around one place overlap there: the two outermost of a kind cover what all of them do.
    ends = hit.groupBy("row1", "row2", "place", F.expr(f"d + e < {length}")).agg(F.max(F.struct("d", "e")).alias("l"), F.max(F.struct("e", "d")).alias("r"))
    both = F.array(*[F.struct((F.col("place") - F.col(f"{s}.d")).alias("first"), (F.col("place") + F.col(f"{s}.e")).alias("stop")) for s in "lr"])
    return ends.select("row1", "row2", F.explode(F.array_distinct(both)).alias("s")).select("row1", "row2", "s.first", "s.stop")


def stretches(
    docs: DataFrame,
    length: int = LENGTH,
    group_max: int = GROUP_MAX,
    view: Callable | None = None,
    keep: Callable | None = None,
    words: int | None = None,
) -> DataFrame:
    """Repeated stretches ``first, stop`` (they may overlap) by ``row1, row2`` of ``docs``, which also has ``text``.

    They are places in what ``view`` makes of a text, or in its bytes.  ``keep`` says which anchors of it are asked for.
    With ``words`` stretches under ``length`` bytes are repeated runs of so many whole words; a text under ``length`` bytes
    has longer ones, beyond its ends, where all of it is repeated.
    """
    before = length - ANCHOR
    rows = staged(_anchor_rows(docs, length, view, keep, words), "anchors")
    n_places = 1 + F.coalesce(F.array_size("more"), F.lit(0))
    # An anchor that occurs once in the corpus, as most do, goes no further.
    met = rows.groupBy(F.col("anchor").alias("of")).agg(
        F.sum(n_places).alias("n"), F.min("context1").alias("c1"), F.max("context1").alias("c2")
    )
    # Stored before it is joined, so that Spark can split a hot anchor.
    met = staged(met.filter("n > 1").select("of", (F.col("c1") != F.col("c2")).alias("mixed")), "anchors-met")
    again = staged(rows.join(met, F.col("anchor") == F.col("of")).drop("of"), "anchors-again")

    places = F.concat(F.array("place"), F.coalesce("more", F.array().cast("array<long>")))
    around = F.transform(places, lambda p: F.struct((p - before).alias("first"), (p + length).alias("stop")))
    plain = again.filter("NOT mixed").select("row1", "row2", F.explode(around).alias("s"))

    mixed = again.filter("mixed")
    keys = {"anchor": "a", "context1": "k1", "context2": "k2"}
    contexts = mixed.groupBy(*[F.col(k).alias(v) for k, v in keys.items()]).agg(
        F.sum(n_places).alias("seen"), F.min(F.struct("row1", "row2", "place")).alias("one")
    )
    contexts = staged(contexts, "contexts")
    full = mixed.join(contexts.filter("seen > 1").select(*keys.values()), [F.col(k) == F.col(v) for k, v in keys.items()])
    full = full.select("row1", "row2", F.explode(around).alias("s"))

    size = staged(contexts.groupBy(F.col("a").alias("of")).agg(F.count("*").alias("n")), "contexts-size")
    chosen = contexts.join(size, F.col("a") == F.col("of")).select(
        F.col("a").alias("anchor"), "seen", F.col("one.row1").alias("row1"), F.col("one.row2").alias("row2"), F.col("one.place").alias("place"), "n"
    )
    found = []
    for part, settle in (("n <= {}", _sorted_reach), ("n > {}", _counted_reach)):
        own = chosen.filter(part.format(group_max)).drop("n")
        if settle is _counted_reach and size.filter(part.format(group_max)).isEmpty():
            continue
        found.append(settle(_context_rows(own, docs, length, view), length, words))
    out = plain.union(full).select("row1", "row2", "s.first", "s.stop")
    for f in found:
        out = out.union(f)
    return out


def _keys() -> tuple[F.Column, F.Column]:
    return F.xxhash64("doc_id", "text"), F.xxhash64("text", "doc_id", F.lit(1))


def _keyed(docs: DataFrame) -> DataFrame:
    key1, key2 = _keys()
    return docs.select(key1.alias("row1"), key2.alias("row2"), "text")


def _joined(docs: DataFrame, found: DataFrame, *fields: str) -> DataFrame:
    key1, key2 = _keys()
    own1, own2 = free(docs, "__own1", "__own2")
    by_row = found.groupBy(F.col("row1").alias(own1), F.col("row2").alias(own2)).agg(F.collect_set(F.struct(*fields)).alias(cut_name(docs)))
    return docs.join(by_row.hint("shuffle_hash"), (key1 == F.col(own1)) & (key2 == F.col(own2)), "left").drop(own1, own2)


def cut_name(docs: DataFrame) -> str:
    """The column of repeated stretches that ``docs`` is given."""
    return free(docs, "__cut")[0]


def _with_cuts(docs: DataFrame, length: int, group_max: int) -> DataFrame:
    """``docs`` with all repeated stretches of its text."""
    return _joined(docs, stretches(_keyed(docs), length, group_max), "first", "stop")




def merged(size: int, cut: list | None) -> list[list[int]]:
    """Maximal runs of ``cut`` within ``size`` places."""
    spans: list[list[int]] = []
    for a, b in sorted((max(0, s["first"]), min(size, s["stop"])) for s in (() if cut is None else cut)):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    return spans


def cut_out(raw: bytes | memoryview, cut: list | None) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed runs and what is left."""
    spans = merged(len(raw), cut)
    edges = [0, *(x for s in spans for x in s), len(raw)]
    return [(a, b) for a, b in spans], b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def repeated_spans(raw: bytes | memoryview, cut: list | None, length: int = LENGTH) -> tuple[list[list[int]], list[list[int]]]:
    """Maximal runs of repeated strings of ``length`` bytes, and of these and repeated runs of words together."""
    long = [s for s in cut or () if s["stop"] - s["first"] >= length]
    if not long or len(raw) >= length:
        return merged(len(raw), long), merged(len(raw), cut)
    # No string of ``length`` bytes, but a copy of a text: all its words are repeated.
    edges = np.flatnonzero(~_SPACE[np.frombuffer(raw, np.uint8)])
    return [], [[int(edges[0]), int(edges[-1]) + 1]]


def deduplicate(docs: DataFrame, length: int = LENGTH, group_max: int = GROUP_MAX, text: bool = True, words: int | None = WORDS) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id, n_bytes, spans, n_removed, kept_sha256``, with ``text`` the bytes ``kept``, and ``passages``.

    ``spans`` are the maximal removed runs as byte offsets.  Null text is the empty text; texts under
    ``length`` bytes lose nothing; rows that repeat another row lose everything, as all copies do; a null or repeated
    ``doc_id`` is no obstacle, as a row is known by its id and text together; other columns are ignored.

    ``passages`` are the maximal runs of bytes in strings that start elsewhere too and hold ``length`` bytes or ``words``
    whole words, the latter between whitespace or a text's ends in both places.  What is removed does not depend on ``words``.
    """
    docs = only(docs, doc_id="doc_id", text="text").withColumn("text", F.coalesce("text", F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))
        types = [pa.int64(), span, pa.int64(), pa.string(), pa.binary(), span]
        names = ["doc_id", "n_bytes", "spans", "n_removed", "kept_sha256", "kept", "passages"]
        listed = lambda spans: [{"first": a, "stop": b} for a, b in spans]
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            for cut, raw in zip(batch.column("cut").to_pylist(), raw_texts(batch, "text"), strict=True):
                spans, passages = repeated_spans(raw, cut, length)
                _, left = cut_out(raw, listed(spans))
                new = (len(raw), listed(spans), len(raw) - len(left), hashlib.sha256(left).hexdigest(), left if text else None, listed(passages))
                for c, v in zip(columns, new, strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names=names)

    key1, key2 = _keys()
    keyed = docs.select(key1.alias("row1"), key2.alias("row2"), "doc_id", "text")
    found = stretches(keyed, length, group_max, words=words)
    by_row = found.groupBy(F.col("row1").alias("own1"), F.col("row2").alias("own2")).agg(F.collect_set(F.struct("first", "stop")).alias("cut"))
    joined = keyed.join(by_row.hint("shuffle_hash"), (F.col("row1") == F.col("own1")) & (F.col("row2") == F.col("own2")), "left")
    spans = "array<struct<first:long,stop:long>>"
    ddl = f"doc_id long, n_bytes long, spans {spans}, n_removed long, kept_sha256 string, kept binary, passages {spans}"
    return joined.select("doc_id", "text", "cut").mapInArrow(trimmed(run), ddl)


def cut_texts(docs: DataFrame, length: int = LENGTH, group_max: int = GROUP_MAX) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``; a character that the cut splits goes as well, null stays null."""

    @F.pandas_udf("string")
    def shorter(text, cut):
        return text.combine(cut, lambda t, c: t if t is None or c is None else cut_out(t.encode(), c)[1].decode(errors="ignore"))

    return _with_cuts(docs, length, group_max).withColumn("text", shorter("text", cut_name(docs))).select(*docs.columns)


def passage_spans(raw: bytes, cut: list) -> list[dict]:
    """``cut`` with runs of words, which are places among their codes, as bytes of ``raw``."""
    out = [s for s in cut if not s["words"]]
    places = [m.span() for m in WORD.finditer(raw)]
    runs = [{"first": -(-s["first"] // CODE), "stop": s["stop"] // CODE} for s in cut if s["words"]]
    for a, b in merged(len(places), runs):
        out.append({"first": places[a][0], "stop": places[b - 1][1]})
    return out


def cut_passages(docs: DataFrame, words: int = WORDS, length: int = LENGTH, group_max: int = GROUP_MAX) -> DataFrame:
    """``docs`` without the runs of ``words`` or more words that start elsewhere too, whatever whitespace parts them.

    Strings of ``length`` bytes that hold fewer whole words, as those of very long words do, are cut as in ``cut_texts``.
    A character that the cut splits goes as well, null stays null.
    """
    keyed = _keyed(docs)
    runs = stretches(keyed, words * CODE, group_max, view=word_codes)
    others = stretches(keyed, length, group_max, keep=lambda text, where: near_few_words(text, where, length, words))
    found = runs.withColumn("words", F.lit(True)).union(others.withColumn("words", F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = []
            for t, c in zip(batch.column("text").to_pylist(), batch.column(cut).to_pylist(), strict=True):
                if t is not None and c is not None:
                    raw = t.encode()
                    t = cut_out(raw, passage_spans(raw, c))[1].decode(errors="ignore")
                left.append(t)
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(left, batch.schema.field(at).type)).select(docs_columns)

    docs_columns, cut = docs.columns, cut_name(docs)
    return _joined(docs, found, "words", "first", "stop").mapInArrow(trimmed(run), docs.schema)
