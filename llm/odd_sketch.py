"""Near-duplicate classes by MinHash bands, odd sketches and exact verification.

1. A document's set is its distinct four-word shingles.  Documents with equal sets are one node; only nodes go on.
2. A node has 24 bands of four MinHash samples.  Equal bands are a bucket; a pair at the threshold misses every bucket with a chance of 3 in a million.
3. More samples, one for each bin of a single hash (the least hash of the bin), are folded into an odd sketch: a bitmap that holds the parity of the samples
   that fall on each bit.  The ones in the XOR of two sketches estimate how many samples differ, most precisely where few do; a set of up to a
   few hundred shingles has nearly all of them in its sketch.  Only pairs whose count of ones is likely at the threshold or above it are candidates.
4. First the stars: in each bucket the nodes against the one with the first document.  These few pairs connect most of a class.
5. Then every pair of a bucket whose two nodes are not connected yet: the nodes outside the bucket's largest component against all of its
   nodes, in the first bucket that both share.  A large group of near copies is mostly one component by then.  Only nodes with a candidate go on
   with their texts, and inside a task the closest candidates are verified first, until their components are connected or no candidate is left.
6. Each candidate pair's full sets decide.  Components of the links are the classes.

A link is left unverified only where its ends are connected anyway.  All groupings combine before they shuffle and are stored before they are joined,
so hot buckets and leaders split; step 5 deals large buckets into blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import only, raw_texts, staged, trimmed
from llm.components import components
from llm.jaccard_forest import shingles

WORDS = 4
PERCENT = 80  # a link shares this part of the union, in hundredths
BANDS, ROWS = 24, 4
BINS, BITS = 1024, 1024  # samples and bits of an odd sketch
DEVIATIONS = 4.5  # so far above what a pair at the threshold shows, a pair is no candidate
BLOCK = 2048
# A task of step 5 holds at most about so many bytes of text from each of its two blocks.
BLOCK_BYTES = 16 << 20


@dataclass(frozen=True)
class Sketch:
    bands: int = BANDS
    rows: int = ROWS
    bins: int = BINS
    bits: int = BITS

    def band_keys(self, keys: np.ndarray) -> list[int]:
        """A signed 64-bit key for each band of MinHash samples of a set of 64-bit hashes."""
        rng = np.random.default_rng(20140407)
        odd = rng.integers(0, 1 << 63, self.bands * self.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        mix = rng.integers(0, 1 << 63, self.bands * self.rows, dtype=np.uint64)
        least = np.full(self.bands * self.rows, np.iinfo(np.uint64).max, dtype=np.uint64)
        for i in range(0, len(keys), 512):
            least = np.minimum(least, ((keys[i : i + 512, None] ^ mix) * odd).min(axis=0))
        keys = (xxhash.xxh3_64_intdigest(row.tobytes(), seed=k) for k, row in enumerate(least.reshape(self.bands, self.rows)))
        return [k - (1 << 64) if k >> 63 else k for k in keys]

    def fold(self, keys: np.ndarray) -> np.ndarray:
        """The odd sketch of a set's samples: of each bin of the sorted hashes the least one."""
        bin_of = keys >> np.uint64(64 - (self.bins - 1).bit_length())
        samples = keys[np.flatnonzero(np.r_[True, bin_of[1:] != bin_of[:-1]])]
        samples = (samples ^ (samples >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        place = ((samples ^ (samples >> np.uint64(33))) % np.uint64(self.bits)).astype(np.int64)
        return np.packbits((np.bincount(place, minlength=self.bits) & 1).astype(np.uint8)).view(np.int64)

    def limit(self, size: np.ndarray, other: np.ndarray, similarity: float = PERCENT / 100, deviations: float = DEVIATIONS) -> np.ndarray:
        """The most ones that the XOR of two sketches shows, but for so many deviations, if sets of these sizes are so similar."""
        union = (size + other) / (1 + similarity)
        filled = self.bins * -np.expm1(-union / self.bins)
        # Differing bins, drawn from a finite set of shingles; the other set's sample of such a bin is there or not.
        differ = filled * (1 - similarity)
        both = -np.expm1(-np.maximum(size, other) / self.bins)
        spread = (1 + both) ** 2 * differ * similarity * np.maximum(0, 1 - filled / union) + differ * both * (1 - both)
        toggled = differ * (1 + both)
        # Toggles that meet on one bit cancel out.
        once, twice = (1 - 2 / self.bits) ** toggled, (1 - 4 / self.bits) ** toggled
        variance = self.bits / 4 * (1 - twice) + self.bits**2 / 4 * (twice - once**2) + spread * once**2
        return np.ceil(self.bits / 2 * (1 - once) + deviations * np.sqrt(np.maximum(variance, 0)))

    def near(self, size: np.ndarray, odd: np.ndarray, other_size: np.ndarray, other_odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs may be linked, by the sizes of their sets and by their sketches, and the ones of their XOR."""
        ones = np.bitwise_count(odd ^ other_odd).sum(axis=1, dtype=np.int64)
        fits = 100 * np.minimum(size, other_size) >= PERCENT * np.maximum(size, other_size)
        return fits & (ones <= self.limit(size, other_size)), ones


def _nodes(docs: DataFrame, sketch: Sketch) -> DataFrame:
    """Each row's node, with the size, band keys and odd sketch of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, keys, odd = [], [], [], []
            for text in raw_texts(batch, "text"):
                own = shingles(bytes(text).lower(), WORDS)
                nodes.append(xxhash.xxh3_128_digest(own.tobytes()))
                sizes.append(len(own))
                keys.append(sketch.band_keys(own) if len(own) else [])
                odd.append(sketch.fold(own).tobytes() if len(own) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("row1"), batch.column("row2"), batch.column("bytes"),
                 pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(odd, pa.binary())],
                names=["doc_id", "row1", "row2", "bytes", "node", "size", "keys", "odd"],
            )

    rows = docs.withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return rows.mapInArrow(trimmed(run), "doc_id long, row1 long, row2 long, bytes long, node binary, size long, keys array<long>, odd binary")


def _bits(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint64).reshape(len(column), -1)


def _stars(shared: DataFrame, nodes: DataFrame, sketch: Sketch) -> DataFrame:
    """Candidate pairs ``a, b``: the node of a bucket's first document with each other one."""
    some = shared.join(nodes.select(F.col("node").alias("of"), "copy_id"), F.col("node") == F.col("of")).drop("of")
    place = F.struct(F.col("copy_id").isNull(), "copy_id", "node")
    lead = staged(some.groupBy(F.col("key").alias("of")).agg(F.min(place)["node"].alias("lead")), "odd-leads")
    met = shared.join(lead, F.col("key") == F.col("of")).filter("node <> lead")
    pairs = staged(met.select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct(), "odd-pairs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            number = lambda c: batch.column(c).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            near, _ = sketch.near(number("size_a"), _bits(batch.column("odd_a").to_pylist()), number("size_b"), _bits(batch.column("odd_b").to_pylist()))
            yield batch.select(["a", "b"]).filter(pa.array(near))

    mine = nodes.select(F.col("node").alias("of_a"), F.col("size").alias("size_a"), F.col("odd").alias("odd_a"))
    other = nodes.select(F.col("node").alias("of_b"), F.col("size").alias("size_b"), F.col("odd").alias("odd_b"))
    both = pairs.join(mine, F.col("a") == F.col("of_a")).join(other, F.col("b") == F.col("of_b")).drop("of_a", "of_b")
    return staged(both.mapInArrow(run, "a binary, b binary"), "odd-stars")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets share at least 80 of 100 of their union."""
    common = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that are linked by their full sets; ``texts(node, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = []
            for node, text, other in zip(a, raw_texts(batch, "text_a"), raw_texts(batch, "text_b"), strict=True):
                if node != last:
                    last, held = node, shingles(bytes(text).lower(), WORDS)
                keep.append(linked(held, shingles(bytes(other).lower(), WORDS)))
            chosen = [k for k, yes in enumerate(keep) if yes]
            yield pa.RecordBatch.from_arrays([pa.array([a[k] for k in chosen], pa.binary()), pa.array([b[k] for k in chosen], pa.binary())], names=["a", "b"])

    mine = texts.select(F.col("node").alias("of_a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("node").alias("of_b"), F.col("text").alias("text_b"))
    both = pairs.join(mine, F.col("a") == F.col("of_a")).join(other, F.col("b") == F.col("of_b"))
    return staged(both.select("a", "b", "text_a", "text_b").sortWithinPartitions("a").mapInArrow(run, "a binary, b binary"), "odd-links")


def _labelled(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label(node, comp)`` after links between nodes have joined their components."""
    left = label.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    right = label.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    edges = links.join(left, "a").join(right, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    joined = staged(components(edges).select(F.col("node").alias("was"), "component"), "odd-joined")
    after = label.join(joined, F.col("comp") == F.col("was"), "left")
    return staged(after.select("node", F.coalesce("component", "comp").alias("comp")), "odd-labels")


def _dealt(shared: DataFrame, nodes: DataFrame, label: DataFrame, block: int, block_bytes: int) -> DataFrame:
    """Units ``key, x, y`` of the buckets with several components: a block of the nodes outside the largest one (``out``) and a block of all nodes."""
    known = label.join(nodes.select(F.col("node").alias("of"), "bytes"), F.col("node") == F.col("of")).drop("of")
    marked = staged(shared.join(known, "node"), "odd-marked")
    parts = marked.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    most = F.max(F.struct("n", "comp", "bytes"))
    sizes = parts.groupBy("key").agg(most.alias("most"), F.count("*").alias("parts"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    count = lambda n, size: F.greatest(F.ceil(n / block), F.ceil(size / block_bytes), F.lit(1)).cast("long")
    sizes = sizes.filter("parts > 1").select(
        F.col("key").alias("of"), F.col("most.comp").alias("main"), count(F.col("n"), F.col("bytes")).alias("blocks"),
        count(F.col("n") - F.col("most.n"), F.col("bytes") - F.col("most.bytes")).alias("outer"),
    )
    rows = marked.join(staged(sizes, "odd-sizes"), F.col("key") == F.col("of")).withColumn("out", F.col("comp") != F.col("main"))
    mine = lambda n: F.expr(f"pmod(xxhash64(node), {n})")
    outside = rows.filter("out").select("*", mine("outer").alias("x"), F.explode(F.expr("sequence(0L, blocks - 1L)")).alias("y"))
    everyone = rows.withColumn("out", F.lit(False)).select("*", F.explode(F.expr("sequence(0L, outer - 1L)")).alias("x"), mine("blocks").alias("y"))
    return outside.unionByName(everyone).select("key", "band", "x", "y", "out", "node", "comp")


class _Unit:
    """The rows of one unit, and which of its pairs are candidates."""

    def __init__(self, rows: list[dict], sketch: Sketch) -> None:
        first = next((k for k, r in enumerate(rows) if r["out"]), len(rows))
        self.all, self.out, self.sketch, self.band = rows[:first], rows[first:], sketch, rows[0]["band"]
        if self.all:
            self.odd, self.keys = _bits([r["odd"] for r in self.all]), np.array([r["keys"] for r in self.all], dtype=np.int64)
            self.size = np.array([r["size"] for r in self.all], dtype=np.int64)
            self.comp = np.array([xxhash.xxh3_64_intdigest(r["comp"]) for r in self.all], dtype=np.uint64)

    def candidates(self, r: dict) -> tuple[np.ndarray, np.ndarray]:
        """Places among all nodes, and the ones of the sketches, of a row's candidates of which this is the first common bucket."""
        if not self.all:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        near, ones = self.sketch.near(self.size, self.odd, np.int64(r["size"]), _bits([r["odd"]]))
        near &= self.comp != np.uint64(xxhash.xxh3_64_intdigest(r["comp"]))
        near[near] = (self.keys[near] == np.array(r["keys"], dtype=np.int64)).argmax(axis=1) == self.band
        found = np.flatnonzero(near)
        return found, ones[found]


def _with_candidates(units: DataFrame, nodes: DataFrame, sketch: Sketch) -> DataFrame:
    """The rows of the units that have a candidate there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            unit, keep = _Unit(rows, sketch), []
            met = np.zeros(len(unit.all), dtype=bool)
            for r in unit.out:
                found, _ = unit.candidates(r)
                met[found] = True
                if len(found):
                    keep.append(r)
            keep += [unit.all[k] for k in np.flatnonzero(met).tolist()]
            if keep:
                kinds = (("key", pa.int64()), ("band", pa.int32()), ("x", pa.int64()), ("y", pa.int64()), ("out", pa.bool_()), ("node", pa.binary()), ("comp", pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in keep], t) for c, t in kinds], names=[c for c, _ in kinds])

    return _in_units(units, nodes).mapInArrow(run, "key long, band int, x long, y long, out boolean, node binary, comp binary")


def _in_units(units: DataFrame, nodes: DataFrame, *more: str) -> DataFrame:
    """The units' rows with what is known of their nodes, each unit whole and its outer nodes last."""
    known = nodes.select(F.col("node").alias("of"), "size", "odd", "keys", *more)
    rows = units.join(known, F.col("node") == F.col("of")).drop("of")
    return rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "out", "node")


def _linked(units: DataFrame, nodes: DataFrame, sketch: Sketch) -> DataFrame:
    """Links ``a, b`` that connect the components of each unit as all of its links would; ``nodes`` with their ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            unit, pairs = _Unit(rows, sketch), []
            for i, r in enumerate(unit.out):
                found, ones = unit.candidates(r)
                pairs += zip(ones.tolist(), [i] * len(found), found.tolist(), strict=True)
            root: dict[bytes, bytes] = {}
            sets: dict[bytes, np.ndarray] = {}

            def find(c: bytes) -> bytes:
                while (up := root.get(c, c)) != c:  # noqa: B023
                    c = up
                return c

            def set_of(r: dict) -> np.ndarray:
                if r["node"] not in sets:  # noqa: B023
                    sets[r["node"]] = shingles(r["text"].encode().lower(), WORDS)  # noqa: B023
                return sets[r["node"]]  # noqa: B023

            links = []
            for _, i, k in sorted(pairs):
                left, right = unit.out[i], unit.all[k]
                c, d = find(left["comp"]), find(right["comp"])
                if c != d and linked(set_of(left), set_of(right)):
                    root[max(c, d)] = min(c, d)
                    links.append((left["node"], right["node"]))
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return _in_units(units, nodes, "text").mapInArrow(run, "a binary, b binary")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    rows, last = [], None
    for batch in batches:
        for row in batch.to_pylist():
            unit = (row["key"], row["x"], row["y"])
            if unit != last and rows:
                yield rows
                rows = []
            last = unit
            rows.append(row)
    if rows:
        yield rows


def classes(docs: DataFrame, sketch: Sketch = Sketch(), block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row ``doc_id, n_shingles, component_id, kept`` for each row of ``docs(doc_id, text)``.

    ``n_shingles`` is the size of the document's set (one to three words are one shingle), ``component_id`` the smallest ``doc_id`` that links lead to, its own
    included, and ``kept`` says that this is its own.  Null, empty and blank texts have no shingle and are linked with nothing, not even with each other.  Repeated rows are copies of one
    another.  A null ``doc_id`` belongs to a class like any other but names it only where no other does (null); it is then kept.  Other columns are ignored.
    """
    docs = only(docs, doc_id="doc_id", text="text")
    docs = docs.withColumn("row1", F.xxhash64("doc_id", "text")).withColumn("row2", F.xxhash64("text", "doc_id", F.lit(1)))
    rows = staged(_nodes(docs, sketch), "odd-rows")
    nodes = rows.filter("size > 0").groupBy("node").agg(
        F.min("doc_id").alias("copy_id"), F.min(F.struct("row1", "row2")).alias("one"), F.first("size").alias("size"),
        F.first("keys").alias("keys"), F.first("odd").alias("odd"), F.max("bytes").alias("bytes"),
    )
    nodes = staged(nodes, "odd-nodes")

    # Buckets of two nodes or more, and the texts of all that lie in one.
    every = nodes.select("node", F.posexplode("keys").alias("band", "key"))
    several = staged(every.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("key").alias("of")), "odd-several")
    shared = staged(every.join(several, F.col("key") == F.col("of")).drop("of"), "odd-shared")
    met = shared.select("node").distinct()
    nearby = staged(nodes.join(met, "node"), "odd-met")
    wanted = nearby.select("node", F.col("one.row1").alias("m1"), F.col("one.row2").alias("m2"))
    texts = docs.join(wanted, (F.col("row1") == F.col("m1")) & (F.col("row2") == F.col("m2"))).select("node", "text")
    texts = staged(texts, "odd-texts").dropDuplicates(["node"]) if _repeated(rows) else staged(texts, "odd-texts")

    label = staged(nearby.select("node", F.col("node").alias("comp")), "odd-labels")
    stars = _stars(shared, nearby, sketch)
    label = _labelled(label, verified(stars, texts))

    units = staged(_with_candidates(_dealt(shared, nearby, label, block, block_bytes), nearby, sketch), "odd-units")
    if not units.isEmpty():
        asked = units.select("node").distinct()
        known = staged(nearby.join(asked, "node").join(texts, "node"), "odd-asked")
        label = _labelled(label, staged(_linked(units, known, sketch), "odd-links"))

    own = nodes.select("node", "copy_id").join(label.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    own = staged(own.select("node", "copy_id", F.coalesce("comp", "node").alias("comp")), "odd-own")
    names = staged(own.groupBy(F.col("comp").alias("of")).agg(F.min("copy_id").alias("component_id")), "odd-names")
    named = staged(own.join(names, F.col("comp") == F.col("of")).select(F.col("node").alias("of"), "component_id"), "odd-named")
    found = rows.join(named, F.col("node") == F.col("of"), "left")
    component = F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _repeated(rows: DataFrame) -> bool:
    """Whether the table holds a row more than once."""
    return not rows.groupBy("row1", "row2").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
