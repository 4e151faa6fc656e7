"""Merkle manifest of a dataset: a hash tree for each group of rows, a tree over the groups' roots, and a proof for every row.

Time-forward processing: a node's label is its level and its place, and every node sends its digest to its parent, whose label is
later.  The messages wait in a priority queue ordered by label.  The queue is external: a slice of ``2 ** levels`` leaves and their
ancestors keeps its messages in a heap, and what a slice sends to a later one waits in Spark's sorted shuffle.  The reversed sweep
visits the nodes from the roots down; each one sends its children the proof suffix that all leaves below them share.

Rows of one group are dealt by their place, so one group may hold any share of the rows: no task has more than a slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import BATCH_ROWS, staged
from llm.sweeps import batched, climb, descend, each_unit, numbered

LEVELS = 13  # levels of a slice, so 8,192 leaves
STEP = "struct<left: boolean, digest: string>"
SUMMARY = "tree string, pos long, alone string, padded string"
HANDED = "tree string, pos long, lone boolean, steps array<struct<left: boolean, digest: string>>, subroot string, root string"
_STEP = pa.struct([("left", pa.bool_()), ("digest", pa.string())])


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def row_digest(columns: dict[str, Column]) -> Column:
    """H of a row: of each value ``-`` if null, else its UTF-8 byte count, ``:`` and the value (integers in decimal)."""
    parts = []
    for value in columns.values():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def tree_of(leaves: list[str], levels: int | None = None) -> list[list[str]]:
    """The digests of every level, the leaves first; without ``levels`` up to the one node that remains.

    Messages ``(level, parent, child, digest)`` leave the heap by label, so a node's children arrive together and before
    those of any later node.
    """
    rows, wait = [leaves], []

    def send(level: int) -> None:
        """All of a level's messages, if there is a next level."""
        if level < levels if levels is not None else len(rows[level]) > 1:
            for k, d in enumerate(rows[level]):
                heappush(wait, (level + 1, k >> 1, k, d))

    send(0)
    while wait:
        level, parent, _, first = heappop(wait)
        children = [first]
        while wait and wait[0][:2] == (level, parent):
            children.append(heappop(wait)[3])
        if level == len(rows):
            rows.append([])
        rows[level].append(digest(*children))
        if 2 * len(rows[level]) >= len(rows[level - 1]):
            send(level)
    return rows


def paths(rows: list[list[str]], suffix: list[tuple]) -> list[list[tuple]]:
    """Each leaf's steps to the root: siblings from the leaf up, then ``suffix``.  A node without a sibling gives ``(None, None)``."""
    above = [suffix]
    for level in range(len(rows) - 2, -1, -1):
        own = rows[level]
        below = []
        for k in range(len(own)):
            other = k ^ 1
            step = (other < k, own[other]) if other < len(own) else (None, None)
            below.append([step, *above[k >> 1]])
        above = below
    return above


def _summarise(levels: int):
    def of_level(bottom: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def found():
                for (tree, block), rows in each_unit(batches, "tree"):
                    own, lone = _values(rows, block, bottom)
                    alone = rows[0]["alone"] if lone and not bottom else tree_of(own)[-1][0]
                    yield tree, block, alone, tree_of(own, levels)[-1][0]

            yield from batched(found(), pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("alone", pa.string()), ("padded", pa.string())]))

        return run

    return of_level


def _values(rows: list[dict], block: int, bottom: bool) -> tuple[list[str], bool]:
    """A slice's lowest digests, and whether its one node is the whole tree's."""
    if bottom:
        return [r["leaf"] for r in rows], len(rows) == 1 and block == 0
    return [r["padded"] for r in rows], len(rows) == 1 and block == 0


def _assign(levels: int):
    def of_level(bottom: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def found():
                for (tree, block), (head, *rows) in each_unit(batches, "tree"):
                    own, single = _values(rows, block, bottom)
                    suffix = [(s["left"], s["digest"]) for s in head["steps"]]
                    if head["lone"] and single:
                        steps = [suffix]
                    else:
                        steps = paths(tree_of(own, None if head["lone"] else levels), suffix)
                    for row, step in zip(rows, steps, strict=True):
                        if bottom:
                            yield row["key"], row["tampered"], row["leaf"], tree, row["pos"], step, head["subroot"], head["root"]
                        else:
                            yield tree, row["pos"], head["lone"] and single, step, head["subroot"], head["root"]

            names = ["key", "tampered", "leaf", "tree", "pos", "steps", "subroot", "root"] if bottom else ["tree", "pos", "lone", "steps", "subroot", "root"]
            yield from _with_steps(found(), names)

        return run

    return of_level


_ARROW = {"key": pa.int64(), "pos": pa.int64(), "lone": pa.bool_()}


def _with_steps(rows: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Record batches whose ``steps`` are built from flat arrays."""

    def batch(held: list[tuple]) -> pa.RecordBatch:
        arrays = []
        for name, column in zip(names, zip(*held, strict=True), strict=True):
            if name == "steps":
                ends = [0]
                for steps in column:
                    ends.append(ends[-1] + len(steps))
                flat = [s for steps in column for s in steps]
                pair = pa.StructArray.from_arrays([pa.array([s[0] for s in flat], pa.bool_()), pa.array([s[1] for s in flat], pa.string())], fields=list(_STEP))
                arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pair))
            else:
                arrays.append(pa.array(column, _ARROW.get(name, pa.string())))
        return pa.RecordBatch.from_arrays(arrays, names=names)

    held = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield batch(held)
            held = []
    if held:
        yield batch(held)


def manifest(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Trees over ``leaves(key long, tree string, leaf string, tampered string)`` and a proof for every leaf.

    A tree's leaves ascend by ``key`` (null first, equal keys by leaf); while there are several nodes, every two in a row become H of their digests
    as text, and a last one alone becomes H of its own.  What remains is the tree's ``subroot``; subroots in the order of ``tree`` (null first, then
    bytewise) become the ``root`` likewise.  ``steps`` are the siblings from the leaf to the root, with the side on which each stands; a step of nulls
    is a node without a sibling.  ``tampered`` is handed through.  No leaves, no rows.
    """
    size = 1 << levels
    up, down = _summarise(levels), _assign(levels)
    rows = numbered(leaves.select("key", "tree", "leaf", "tampered"), "tree", ["key", "leaf"], "merkle-leaves")
    own = climb(rows, "tree", size, up, SUMMARY, "merkle-up")

    # The tree over the subroots: one group, whose leaves are the groups.
    subroots = own[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("alone").alias("leaf"))
    tops = numbered(subroots, "tree", ["of"], "merkle-roots")
    over = climb(tops.select("tree", "pos", "leaf"), "tree", size, up, SUMMARY, "merkle-over")
    last = over[-1].select("tree", "pos", F.lit(True).alias("lone"), F.array().cast(f"array<{STEP}>").alias("steps"), F.col("alone").alias("subroot"), F.col("alone").alias("root"))
    columns = ["lone", "steps", "subroot", "root"]
    bottom = f"key long, tampered string, leaf string, tree string, pos long, steps array<{STEP}>, subroot string, root string"
    known = [tops.select("tree", "pos", "leaf", F.lit(None).cast("long").alias("key"), F.lit(None).cast("string").alias("tampered")), *over[1:]]
    reached = descend(known, last, "tree", size, columns, down, bottom, "merkle-down")
    named = reached.withColumnRenamed("pos", "at").join(tops.select("of", F.col("pos").alias("place")), F.col("at") == F.col("place"))
    first = named.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("pos"), F.lit(True).alias("lone"), "steps", F.col("leaf").alias("subroot"), "root")
    return descend(own, staged(first, "merkle-first"), "tree", size, columns, down, bottom, "merkle-down")


def proof_digest(steps: str = "steps") -> Column:
    """H of the proof's siblings from the leaf up; the levels without a sibling add nothing."""
    return F.sha2(F.concat_ws("", F.col(f"{steps}.digest")).cast("binary"), 256)


def folded(leaf: Column, steps: str = "steps") -> Column:
    """The root that a leaf and its proof lead to."""

    def up(known: Column, step: Column) -> Column:
        pair = F.when(step["digest"].isNull(), known).when(step["left"], F.concat(step["digest"], known)).otherwise(F.concat(known, step["digest"]))
        return F.sha2(pair.cast("binary"), 256)

    return F.aggregate(steps, leaf, up)


def verify_documents(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of ``docs(doc_id, source, lang, n_chars, text)`` by language, and each row's proof against a copy that was tampered with.

    Where 7 divides the crc32 of ``doc_id`` in decimal, the copy's ``n_chars`` is one larger.  A null is a value of its own in a digest; a null ``doc_id`` or
    ``n_chars`` is never tampered with, null ``doc_id`` come first, and rows equal in all five columns are leaves of their own with neighbouring proofs.
    Rows of equal ``doc_id`` ascend by leaf.  Other columns are ignored.  No documents, no rows.
    """
    fields = {c: F.col(f"`{c}`") for c in ("doc_id", "source", "lang", "n_chars", "text")}
    hit = (F.crc32(fields["doc_id"].cast("string").cast("binary")) % 7 == 0) & fields["n_chars"].isNotNull()
    more = row_digest(fields | {"n_chars": fields["n_chars"].cast("decimal(20,0)") + 1})
    leaves = docs.select(
        fields["doc_id"].cast("long").alias("key"),
        fields["lang"].cast("string").alias("tree"),
        row_digest(fields).alias("leaf"),
        F.when(hit, more).alias("tampered"),
    )
    found = manifest(staged(leaves, "merkle-rows"), levels)
    root = folded(F.coalesce("tampered", "leaf"))
    found = found.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), root.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
