"""Files that hold one JSON array each, read by many tasks.

A file is cut at every ``}`` by Spark's own line reader, so its splits are read in parallel from any store that Spark reads.  A split can't know whether
it begins inside a string or how deep in brackets, so a first pass gives, for both cases, what the split changes; the sums of the splits before it tell
which case holds.  A second pass then closes a record wherever a brace outside strings leads back to the array.  A record that goes on from one split
to the next leaves a piece in each, and only these pieces are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ESCAPE = re.compile(r"\\.", re.DOTALL)
_SUMMARY = "file string, begin long, flips long, outer_depth long, inner_depth long"
_PIECES = "file string, begin long, text string, opens boolean, closes boolean"


def read_json_array_files(spark: SparkSession, path: str | list[str], schema: str | T.StructType) -> DataFrame:
    """The objects in the arrays of the files under ``path``, as rows of ``schema``.

    Elements of an array that are no objects are passed over; an object that doesn't fit the schema gives NULLs as ``from_json`` does.
    Empty files and empty arrays have no rows.  A file whose brackets or strings don't close is an error that names it.
    """
    pieces = _pieces(spark, path, _states(spark, path))
    whole = pieces.filter("opens AND closes").select("text")
    parsed = whole.unionByName(_joined(pieces.filter("NOT (opens AND closes)"))).select(F.from_json("text", schema).alias("record"))
    return parsed.select("record.*")


def _fragments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The text between braces, in order within each split of a file; the brace after a fragment is left out."""
    lines = spark.read.option("lineSep", "}").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), "value")


def _outside(text: str, inside: int) -> tuple[list[str], int]:
    """The parts of a fragment outside strings, and whether its end is inside one."""
    parts = (_ESCAPE.sub("__", text) if "\\" in text else text).split('"')
    return parts[inside::2], (inside + len(parts) - 1) & 1


def _depth(parts: list[str]) -> int:
    bare = "".join(parts)
    return bare.count("{") + bare.count("[") - bare.count("]") - bare.count("}")


def _states(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """For each split whether it begins inside a string, and how many brackets are open there.

    One row for each split of a file, so the windows over a file's splits stay small.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found = None, []

        def row() -> None:
            found.append((*now, inside[0], depth[0], depth[1]))

        inside, depth = [0, 1], [0, 0]
        for batch in batches:
            for file, begin, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, begin) != now:
                    if now:
                        row()
                    now, inside, depth = (file, begin), [0, 1], [0, 0]
                for case in (0, 1):
                    parts, inside[case] = _outside(text, inside[case])
                    depth[case] += _depth(parts) - (not inside[case])
        if now:
            row()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=["file", "begin", "flips", "outer_depth", "inner_depth"])

    changes = _fragments(spark, path).mapInArrow(run, _SUMMARY)
    in_order = Window.partitionBy("file").orderBy("begin")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    known = changes.withColumn("inside", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2)
    change = F.when(F.col("inside") == 0, F.col("outer_depth")).otherwise(F.col("inner_depth"))
    known = known.withColumn("change", change).withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
    # The fragment that ends a file has no brace after it, but is counted as if it had.
    ends = F.sum("change").over(Window.partitionBy("file")) + 1
    open_string = F.sum("flips").over(Window.partitionBy("file")) % 2 == 1
    broken = F.when((ends != 0) | open_string, F.raise_error(F.concat(F.lit("not a closed JSON array: "), F.col("file"))).cast("int"))
    return known.select("file", "begin", F.coalesce(broken, F.col("inside").cast("int")).alias("inside"), F.col("depth").cast("int").alias("depth"))


def _opening(text: str, inside: int, depth: int) -> int | None:
    """Where the first object that lies directly in the array begins in a fragment, if it does."""
    skip = False
    for place, char in enumerate(text):
        if skip:
            skip = False
        elif inside:
            skip, inside = char == "\\", int(char != '"')
        elif char == '"':
            inside = 1
        elif char == "{" and depth == 1:
            return place
        elif char in "{[":
            depth += 1
        elif char in "]}":
            depth -= 1
    return None


def _pieces(spark: SparkSession, path: str | list[str], states: DataFrame) -> DataFrame:
    """Whole records, and of records that cross splits a piece for each; the first of these ``opens`` its record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, opens, inside, depth = None, None, False, 0, 0
        for batch in batches:
            out = []
            for file, begin, text, first_inside, first_depth in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, begin) != now:
                    if now and held is not None:
                        out.append((*now, "".join(held), opens, False))
                    now, inside, depth = (file, begin), first_inside, first_depth
                    # A split may begin within a record that an earlier one has opened, or within a nested array.
                    held, opens = ([], False) if depth > 1 else (None, False)
                place = None if opens and held is not None else _opening(text, inside, depth)
                if place is not None:
                    held, opens = [text[place:]], True
                elif held is not None:
                    held.append(text)
                parts, inside = _outside(text, inside)
                depth += _depth(parts)
                if not inside:
                    depth -= 1
                    if depth == 1 and held is not None:
                        out.append((*now, "".join(held) + "}", opens, True))
                        held = None
                        continue
                if held is not None:
                    held.append("}")
            if out:
                yield _piece_batch(out)
        if now and held is not None:
            yield _piece_batch([(*now, "".join(held), opens, False)])

    rows = _fragments(spark, path)
    # One row for each split; a shuffle would lose the order of the fragments.
    known = F.broadcast(states.select(F.col("file").alias("of"), F.col("begin").alias("at"), "inside", "depth"))
    started = rows.join(known, (F.col("file") == F.col("of")) & (F.col("begin") == F.col("at")))
    return started.select("file", "begin", "value", "inside", "depth").mapInArrow(run, _PIECES)


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
    names = ["file", "begin", "text", "opens", "closes"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _joined(pieces: DataFrame) -> DataFrame:
    """Records from their pieces: at most one that ends and one that begins in each split.

    A piece that closes a record comes before the one that opens the next.  Pieces that follow a closing one are of arrays nested in the array.
    """
    in_order = Window.partitionBy("file").orderBy("begin", "opens").rowsBetween(Window.unboundedPreceding, 0)
    owned = pieces.withColumn("record", F.sum(F.col("opens").cast("int")).over(in_order)).filter("record > 0")
    before = Window.partitionBy("file", "record").orderBy("begin", "opens").rowsBetween(Window.unboundedPreceding, -1)
    closed = F.coalesce(F.max("closes").over(before), F.lit(False))
    owned = owned.withColumn("closed", closed).filter("NOT closed")
    parts = owned.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("begin", "text"))).alias("parts"))
    return parts.select(F.concat_ws("", "parts.text").alias("text"))
