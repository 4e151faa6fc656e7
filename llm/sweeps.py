"""Sequences of any length, one for each group, worked through in blocks: gapless places, and sweeps up and down.

A sequence is cut into blocks of ``size`` rows.  The sweep up turns every block into one row, and these rows are the
next level's sequence, until each group has one row left.  The sweep down hands each block what its row was given one level above.
A group with a third of all rows so spreads over as many tasks as it has blocks, and no task holds more than a block.
Between levels the rows travel through Spark's sorted shuffle, which is kept on disk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import BATCH_ROWS, staged

Unit = tuple[tuple, list[dict]]


def numbered(rows: DataFrame, group: str, order: Sequence[str], label: str) -> DataFrame:
    """``rows``, staged, with ``pos``: a row's place among its group's rows in ascending ``order``, nulls first, from 0.

    Range partitions hold a group's rows in order, so a task counts its own share of a group; only the first group of a
    partition can begin earlier.  What the driver sees is one row for each partition.  Rows that tie in the order
    should be equal, as any of them may come first.
    """
    every = [F.col(c).asc_nulls_first() for c in (group, *order)]
    schema = T.StructType([*rows.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__run", T.LongType()), T.StructField("__local", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, runs, local, last = TaskContext.get().partitionId(), -1, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            encoded = pc.run_end_encode(batch.column(group).cast(_plain(batch.column(group).type)), run_end_type=pa.int32())
            ends, values = encoded.run_ends.to_pylist(), encoded.values.to_pylist()
            begin, index, place = 0, [], []
            for end, value in zip(ends, values, strict=True):
                if runs < 0 or value != last:
                    runs, local, last = runs + 1, 0, value
                index += [runs] * (end - begin)
                place += range(local, local + end - begin)
                local, begin = local + end - begin, end
            columns = [*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(index, pa.int64()), pa.array(place, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "__part", "__run", "__local"])

    kept = staged(rows.repartitionByRange(*every).sortWithinPartitions(*every).mapInArrow(run, schema), label)
    ends = kept.groupBy("__part").agg(
        F.min_by(F.struct(group), F.struct("__run", "__local")).alias("first"),
        F.max_by(F.struct(group, "__run", "__local"), F.struct("__run", "__local")).alias("last"),
    )
    offsets, open_group, count = [], None, 0
    for row in sorted(ends.collect(), key=lambda r: r["__part"]):
        begun = count if open_group == (row.first[0],) else 0
        if begun:
            offsets.append((row["__part"], begun))
        count = row.last["__local"] + 1 + (begun if row.last["__run"] == 0 else 0)
        open_group = (row.last[0],)
    starts = kept.sparkSession.createDataFrame(offsets, "__of int, __start long")
    found = kept.join(F.broadcast(starts), (F.col("__part") == F.col("__of")) & (F.col("__run") == 0), "left")
    pos = F.col("__local") + F.coalesce("__start", F.lit(0))
    return found.withColumn("pos", pos).drop("__of", "__start", "__part", "__run", "__local")


def _plain(kind: pa.DataType) -> pa.DataType:
    """A type that run-end encoding takes."""
    return {pa.large_string(): pa.string(), pa.large_binary(): pa.binary()}.get(kind, kind)


def units(rows: DataFrame, group: str, size: int) -> DataFrame:
    """``rows`` with their ``block``, each block whole and in order within one task."""
    blocks = rows.withColumn("block", F.expr(f"pos div {size}"))
    return blocks.repartition(group, "block").sortWithinPartitions(group, "block", "pos")


def each_unit(batches: Iterator[pa.RecordBatch], group: str) -> Iterator[Unit]:
    """``(group, block)`` and its rows, from partitions made by ``units``."""
    rows, last = [], None
    for batch in batches:
        for row in batch.to_pylist():
            key = (row[group], row["block"])
            if key != last and rows:
                yield last, rows
                rows = []
            last = key
            rows.append(row)
    if rows:
        yield last, rows


def batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def climb(rows: DataFrame, group: str, size: int, summarise: Callable[[bool], Callable], schema: str, label: str) -> list[DataFrame]:
    """The levels of a sweep up: ``rows``, then a row for each block, and so on to one row for each group.

    ``summarise(bottom)`` gives the function over a partition's batches; its rows are ``(group, pos = block, ...)``.
    """
    levels = [rows]
    while True:
        above = staged(units(levels[-1], group, size).mapInArrow(summarise(len(levels) == 1), schema), label)
        levels.append(above)
        if not above.agg(F.max("pos")).first()[0]:
            return levels


def descend(levels: list[DataFrame], top: DataFrame, group: str, size: int, columns: list[str], assign: Callable[[bool], Callable], schema: str, label: str) -> DataFrame:
    """The sweep down: ``top(group, pos = 0, given columns)`` is handed from level to level to the rows of the lowest.

    ``columns`` are those of ``top`` that every block is handed; its row comes first, with ``pos`` -1.  ``assign(bottom)`` gives the
    function over a partition's batches; above the bottom its rows look like ``top``.  The last level comes unstaged, in ``schema``.
    """
    handed = top
    for k in range(len(levels) - 2, -1, -1):
        head = handed.select(group, F.lit(-1).cast("long").alias("pos"), F.col("pos").alias("block"), *columns)
        rows = levels[k].withColumn("block", F.expr(f"pos div {size}"))
        both = head.unionByName(rows, allowMissingColumns=True)
        both = both.repartition(group, "block").sortWithinPartitions(group, "block", "pos")
        if k == 0:
            return both.mapInArrow(assign(True), schema)
        handed = staged(both.mapInArrow(assign(False), top.schema), label)
    raise ValueError("two levels are the least")
