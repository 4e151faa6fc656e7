"""Self-join of documents by the Jaccard similarity of their word five-grams, through a MinHash LSH forest.

1. Texts with equal shingle sets collapse to one node; only nodes go on.
2. A node's signature is a path of six hashes in each of 21 prefix tries.  Each trie's paths are sorted over range partitions, so the nodes below one
   trie node are neighbours, and the common prefix of neighbours tells how deep they part.  Paths that share less than the least depth with both neighbours go no further.
3. All tries are matched at full depth first.  Then matched prefixes are shortened, one trie after the other, until the expected recall at the threshold
   reaches the target.  Each time that trie is shortened which brings the fewest additional pairs of the data for the recall that it adds.
4. Among the nodes of one trie and prefix (a bucket) all signatures are compared in one task, and only a spanning forest of the pairs that
   may reach the threshold leaves it: rows grow with the members, not with their pairs.
5. Components of these forests are candidate groups: every pair of one bucket that may be similar lies in one group.
6. Each group's shingle sets are compared exactly, all pairs, inside tasks.  What leaves is each node's
   number of links and again a spanning forest, whose components are the classes.

A bucket or group of more than ``block`` nodes is dealt into blocks, and each pair of blocks is a unit of its own, so no
task ever gathers an unbounded group and no pair is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import free, only, raw_texts, staged, trimmed
from llm.components import components

WORDS = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.9995
TREES, DEPTH = 21, 6
BLOCK = 2048
# A unit of exact comparison holds at most about so many bytes of text from each of its blocks.
BLOCK_BYTES = 16 << 20
# Pairs whose signatures agree in fewer places than this share don't reach the threshold (over four
# standard deviations below it).
MAYBE = 0.64
REMEMBERED = 300_000
MATRIX_BYTES = 64 << 20


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = WordHashes()


def forget_words() -> None:
    """Give up the words that this worker remembers."""
    _HASHES.clear()


ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(text, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of ``size`` words in a row; a shorter text is one shingle, one without words none."""
    words = bytes(text).split()
    if not words:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(size, len(own))
    n = len(own) - size + 1
    key = own[:n].copy()
    for k in range(1, size):
        key *= ODD
        key ^= key >> np.uint64(29)
        key += own[k : n + k]
    key ^= key >> np.uint64(32)
    key *= np.uint64(0xD6E8FEB86659FD93)
    key ^= key >> np.uint64(32)
    return np.unique(key)


@dataclass(frozen=True)
class Forest:
    """The forest's shape and the depths to which its prefixes are shortened."""

    threshold: float = THRESHOLD
    trees: int = TREES
    depth: int = DEPTH
    recall: float = TARGET_RECALL

    def expected(self, depths: list[int]) -> float:
        """The chance that a pair at the threshold shares a prefix of one of the depths."""
        return 1 - math.prod(1 - self.threshold**d for d in depths)

    @property
    def least(self) -> int:
        """The depth that reaches the target recall in all tries alike; none is shortened beyond it."""
        for depth in range(self.depth, 0, -1):
            if self.expected([depth] * self.trees) >= self.recall:
                return depth
        raise ValueError("more trees are needed for this recall")

    def depths(self, pairs: dict[tuple[int, int], float]) -> list[int]:
        """A depth for each trie; ``pairs[tree, depth]`` are the pairs of nodes that share a prefix there."""
        chosen, least = [self.depth] * self.trees, self.least

        def price(tree: int) -> tuple[float, int]:
            now = chosen[tree]
            gain = math.log(1 - self.threshold**now) - math.log(1 - self.threshold ** (now - 1))
            return (pairs.get((tree, now - 1), 0) - pairs.get((tree, now), 0)) / gain, tree

        while self.expected(chosen) < self.recall:
            _, tree = min(price(t) for t in range(self.trees) if chosen[t] > least)
            chosen[tree] -= 1
        return chosen

    def signature(self, keys: np.ndarray) -> np.ndarray:
        """The smallest of each hash function, 32 bits of it."""
        rng = np.random.default_rng(20240229)
        n = self.trees * self.depth
        odd = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        mix = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        least = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
        step = 512
        for i in range(0, len(keys), step):
            least = np.minimum(least, ((keys[i : i + step, None] ^ mix) * odd).min(axis=0))
        least ^= least >> np.uint64(31)
        return (least * ODD >> np.uint64(32)).astype(np.uint32)

    def paths(self, signature: np.ndarray) -> list[bytes]:
        """The signature's path in each trie; paths sort as their hashes do."""
        return [row.astype(">u4").tobytes() for row in signature.reshape(self.trees, self.depth)]


def forest_edges(n: int, pairs: Iterator[tuple[int, np.ndarray]]) -> list[tuple[int, int]]:
    """Spanning edges of ``n`` nodes under links given row by row."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    edges = []
    for i, linked in pairs:
        for j in linked.tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                edges.append((i, j))
    return edges


def _nodes(docs: DataFrame, forest: Forest) -> DataFrame:
    """Each row's node, and the node's signature."""
    rows = docs.withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, paths, whole = [], [], []
            for text in raw_texts(batch, "text"):
                own = shingles(text)
                nodes.append(xxhash.xxh3_128_digest(own.tobytes()))
                if len(own):
                    signature = forest.signature(own)
                    paths.append(forest.paths(signature))
                    whole.append((signature & np.uint32(255)).astype(np.uint8).tobytes())
                else:
                    paths.append([])
                    whole.append(b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("row1"), batch.column("row2"), batch.column("bytes"),
                 pa.array(nodes, pa.binary()), pa.array(paths, pa.list_(pa.binary())), pa.array(whole, pa.binary())],
                names=["doc_id", "row1", "row2", "bytes", "node", "paths", "bits"],
            )
        forget_words()

    return rows.mapInArrow(trimmed(run), "doc_id long, row1 long, row2 long, bytes long, node binary, paths array<binary>, bits binary")


def _neighbours(nodes: DataFrame, forest: Forest) -> DataFrame:
    """``tree, path, node`` of the paths that share at least the least depth with a neighbour of their sorted trie.

    A path at the edge of a partition stays, as its neighbour is in another one.
    """
    least, depth = forest.least, forest.depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, and whether it shares enough with the one before it
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held[0], table])
            hashes = np.frombuffer(b"".join(table.column("path").to_pylist()), dtype=np.uint32).reshape(-1, depth)
            tree = table.column("tree").to_numpy()
            alike = np.logical_and.accumulate(hashes[1:] == hashes[:-1], axis=1).sum(axis=1) >= least
            alike &= tree[1:] == tree[:-1]
            # The first row of all is at the partition's edge.
            before = np.r_[True if held is None else held[1], alike]
            keep = before.copy()
            keep[:-1] |= alike
            done = table.slice(0, table.num_rows - 1).filter(pa.array(keep[:-1]))
            held = (table.slice(table.num_rows - 1), bool(before[-1]))
            yield from done.to_batches()
        if held is not None:
            yield from held[0].to_batches()

    every = nodes.select(F.posexplode("paths").alias("tree", "path"), "node")
    order = ["tree", "path", "node"]
    return every.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "tree int, path binary, node binary")


def _buckets(met: DataFrame, forest: Forest) -> DataFrame:
    """``node, key`` for each path, cut off at its trie's depth."""
    prefix = lambda depth: F.substring("path", 1, 4 * depth)
    pairs = {}
    for depth in range(forest.least, forest.depth + 1):
        groups = met.groupBy("tree", prefix(depth).alias("prefix")).agg(F.count("*").alias("n"))
        counted = groups.groupBy("tree").agg(F.sum(F.expr("cast(n AS double) * (n - 1) / 2")).alias("pairs"))
        pairs |= {(r.tree, depth): r.pairs for r in counted.collect()}  # a row for each trie
    depths = F.array(*[F.lit(d) for d in forest.depths(pairs)])
    cut = met.withColumn("depth", F.get(depths, F.col("tree")))
    return cut.select("node", F.xxhash64("tree", F.expr("substring(path, 1, 4 * depth)")).alias("key"))


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with two hashes that know a row by its id and text together."""
    return docs.withColumn("row1", F.xxhash64("doc_id", "text")).withColumn("row2", F.xxhash64("text", "doc_id", F.lit(1)))


def _dealt(rows: DataFrame, sizes: DataFrame, key: str, block: int, block_bytes: int | None = None) -> DataFrame:
    """``rows`` with a ``unit`` for each pair of blocks of their ``key``, and their ``block``.

    ``sizes(key, n)`` counts each key's nodes; with ``block_bytes`` it also has their ``bytes``.
    """
    sizes = sizes.withColumnRenamed(key, "of")
    count = F.ceil(F.col("n") / block)
    if block_bytes:
        count = F.greatest(count, F.ceil(F.col("bytes") / block_bytes))
    rows = rows.join(sizes, F.col(key) == F.col("of")).drop("of")
    rows = rows.withColumn("blocks", count.cast("int"))
    rows = rows.withColumn("block", F.expr("pmod(xxhash64(node), blocks)").cast("int"))
    other = F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")
    rows = rows.select("*", other)
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return rows.withColumn("unit", F.xxhash64(key, low, high)).withColumn("across", F.col("block") != F.col("other")).drop("n", "blocks", "other")


def _units(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Rows of a sorted partition, a list for each key."""
    rows, last = [], None
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if key != last and rows:
                yield rows
                rows = []
            last = key
            rows.append(row)
    if rows:
        yield rows


def _across(rows: list[dict]) -> np.ndarray | None:
    """The blocks of a unit of two blocks; a unit of one block compares all its pairs."""
    return np.array([r["block"] for r in rows]) if rows[0]["across"] else None


def _candidates(units: DataFrame, maybe: float) -> DataFrame:
    """Spanning edges, for each unit of a bucket, of the pairs whose signatures may reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _units(batches, ["unit", "key"]):
            if len(rows) < 2:
                continue
            bits = np.frombuffer(b"".join(r["bits"] for r in rows), np.uint8).reshape(len(rows), -1)
            blocks = _across(rows)
            least = maybe * bits.shape[1]

            def pairs():
                for i in range(len(rows) - 1):
                    alike = (bits[i + 1 :] == bits[i]).sum(axis=1) >= least  # noqa: B023
                    if blocks is not None:  # noqa: B023
                        alike &= blocks[i + 1 :] != blocks[i]  # noqa: B023
                    yield i, np.flatnonzero(alike) + i + 1

            found = forest_edges(len(rows), pairs())
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows[i]["node"] for i, _ in found], pa.binary()), pa.array([rows[j]["node"] for _, j in found], pa.binary())], names=["a", "b"]
                )

    sorted_units = units.select("unit", "key", "node", "bits", "block", "across").repartition("unit").sortWithinPartitions("unit", "key", "bits")
    return sorted_units.mapInArrow(trimmed(run), "a binary, b binary")


def exact_links(
    sets: list[np.ndarray], threshold: float, blocks: np.ndarray | None = None, matrix_bytes: int = MATRIX_BYTES
) -> Iterator[tuple[int, np.ndarray]]:
    """For each set, the later sets whose Jaccard similarity reaches the threshold."""
    n = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    _, column, count = np.unique(every, return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], place[column[keep]]
    total = int(shared.sum())
    # The bits of some shared shingles at a time, so that the matrix of sets and shingles has a bound in bytes.
    step = max(64, 8 * matrix_bytes // max(1, n) // 64 * 64)
    parts = []
    for first in range(0, max(1, total), step):
        own = (column >= first) & (column < first + step)
        at = column[own] - first
        words = np.zeros((n, max(1, (min(step, total - first) + 63) // 64)), dtype=np.uint64)
        np.bitwise_or.at(words, (owner[own], at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
        if total <= step:
            parts.append(words)
            break
        held = np.zeros((n, n), dtype=np.int32) if first == 0 else held
        for i in range(n - 1):
            held[i, i + 1 :] += np.bitwise_count(words[i + 1 :] & words[i]).sum(axis=1, dtype=np.int32)
    for i in range(n - 1):
        ratio = np.minimum(size[i], size[i + 1 :]) >= threshold * np.maximum(size[i], size[i + 1 :]) - 1e-9
        if blocks is not None:
            ratio &= blocks[i + 1 :] != blocks[i]
        later = np.flatnonzero(ratio) + i + 1
        if not len(later):
            continue
        common = np.bitwise_count(words[later] & words[i]).sum(axis=1, dtype=np.int64) if parts else held[i, later].astype(np.int64)
        yield i, later[common >= threshold * (size[i] + size[later] - common) - 1e-9]


def _verify(units: DataFrame, threshold: float) -> DataFrame:
    """Exact links inside each unit: ``a, b`` of a spanning forest, and counts ``a, n`` with a null ``b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _units(batches, ["unit", "key"]):
            kept: dict[bytes, dict] = {}
            for r in rows:  # copies of one text arrive once for each copy
                kept.setdefault(r["node"], r)
            rows = list(kept.values())
            if len(rows) < 2:
                continue
            sets = [shingles((r["text"] or "").encode()) for r in rows]
            weight = np.array([r["copies"] for r in rows], dtype=np.int64)
            links, others = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)

            def pairs():
                for i, linked in exact_links(sets, threshold, _across(rows)):  # noqa: B023
                    links[i] += len(linked)  # noqa: B023
                    links[linked] += 1  # noqa: B023
                    others[i] += weight[linked].sum()  # noqa: B023
                    others[linked] += weight[i]  # noqa: B023
                    yield i, linked

            found = forest_edges(len(rows), pairs())
            out = [(rows[i]["node"], rows[j]["node"], 0, 0) for i, j in found]
            out += [(rows[i]["node"], None, int(links[i]), int(others[i])) for i in np.flatnonzero(links)]
            if out:
                a, b, n, m = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64()), pa.array(m, pa.int64())], names=["a", "b", "links", "others"]
                )

    ordered = units.select("unit", "key", "node", "text", "copies", "block", "across").repartition("unit").sortWithinPartitions("unit", "key", "node")
    return ordered.mapInArrow(trimmed(run), "a binary, b binary, links long, others long")


def _classes(docs: DataFrame, forest: Forest, block: int, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their nodes, and each node's class and link counts."""
    rows = staged(_nodes(docs, forest), "forest")
    nodes = rows.groupBy("node").agg(
        F.min("doc_id").alias("copy_id"), F.count("*").alias("copies"), F.first("paths").alias("paths"),
        F.first("bits").alias("bits"), F.min(F.struct("row1", "row2", "bytes")).alias("one"),
    )
    nodes = staged(nodes, "forest-nodes")

    # Buckets of two nodes or more.
    every = _buckets(staged(_neighbours(nodes, forest), "forest-met"), forest)
    sizes = staged(every.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "forest-sizes")
    buckets = _dealt(every, sizes, "key", block)
    units = buckets.join(nodes.select(F.col("node").alias("of"), "bits"), F.col("node") == F.col("of")).drop("of")
    group = components(_candidates(units, MAYBE))

    # Texts of the groups' nodes: one row's text stands for all of a node's copies.
    members = group.join(nodes.select(F.col("node").alias("of"), "one", "copies"), F.col("node") == F.col("of"))
    members = staged(members.select("node", F.col("component").alias("key"), "copies", "one.*"), "forest-groups")
    weights = staged(members.groupBy("key").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")), "forest-weights")
    units = _dealt(members.drop("bytes"), weights, "key", block, block_bytes).withColumnsRenamed({"row1": "m1", "row2": "m2"})
    texts = docs.select("text", "row1", "row2")
    texts = texts.join(units.hint("shuffle_hash"), (F.col("row1") == F.col("m1")) & (F.col("row2") == F.col("m2")))
    checked = staged(_verify(texts, forest.threshold), "forest-links")

    classes = components(checked.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "of")
    counts = checked.filter("b IS NULL").groupBy(F.col("a").alias("at")).agg(F.sum("links").alias("links"), F.sum("others").alias("others"))
    known = classes.join(counts, F.col("of") == F.col("at"), "left").drop("at")
    own = nodes.select("node", "copy_id", "copies").join(known, F.col("node") == F.col("of"), "left").drop("of")
    own = own.withColumn("component", F.coalesce("component", "node"))
    return rows.select("doc_id", "row1", "row2", "node"), own.withColumnRenamed("node", "of")


def join(docs: DataFrame, forest: Forest = Forest(), block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each row of ``docs(doc_id, text)``.

    ``class_id`` is the smallest ``doc_id`` among documents connected by links, ``copy_id`` the smallest with an
    equal shingle set, ``n_links`` the number of other documents that reach the threshold, copies included, and
    ``n_text_links`` the number of other shingle sets that do.  Texts without words (null and empty ones) equal one another;
    one to four words are one shingle.  Repeated rows are copies; a null ``doc_id`` belongs to a class like any
    other but never names it, unless no other does (null); other columns are ignored.
    """
    docs = _keyed(only(docs, doc_id="doc_id", text="text"))
    rows, own = _classes(docs, forest, block, block_bytes)
    names = own.groupBy(F.col("component").alias("name")).agg(F.min("copy_id").alias("class_id"))
    own = own.join(names, F.col("component") == F.col("name")).drop("name")
    out = rows.join(own, F.col("node") == F.col("of"))
    return out.select(
        "doc_id",
        "class_id",
        "copy_id",
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_text_links"),
    )


def representatives(docs: DataFrame, forest: Forest = Forest(), block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row of ``docs`` for each class, with all its columns: that with the smallest ``doc_id``, null ids last."""
    keyed = _keyed(only(docs, doc_id="doc_id", text="text"))
    rows, own = _classes(keyed, forest, block, block_bytes)
    same = rows.groupBy("doc_id", "row1", "row2", "node").agg(F.count("*").alias("n"))
    member = same.join(own.select("of", "component"), F.col("node") == F.col("of"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row1", "row2", "n")).alias("one")
    keep = staged(member.groupBy("component").agg(first).select("one.row1", "one.row2", "one.n"), "forest-kept")
    row1, row2, m1, m2, n = free(docs, "__row1", "__row2", "__m1", "__m2", "__n")
    keep = keep.withColumnsRenamed({"row1": m1, "row2": m2, "n": n})
    every = docs.withColumn(row1, F.xxhash64("doc_id", "text")).withColumn(row2, F.xxhash64("text", "doc_id", F.lit(1)))
    found = every.join(keep.hint("shuffle_hash"), (F.col(row1) == F.col(m1)) & (F.col(row2) == F.col(m2)))
    if not keep.filter(F.col(n) > 1).isEmpty():  # a row that the table holds more than once
        found = found.dropDuplicates([row1, row2])
    return found.select(*docs.columns)
