"""Helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import functools
import os
import posixpath
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.session import landing, staged  # noqa: F401

# Rows and bytes in one Arrow batch: a batch of the longest texts stays within a worker's memory.
BATCH_ROWS = 500
BATCH_BYTES = 4 << 20
ROOT = str(Path(__file__).resolve().parents[1])
_SHIPPED: list = []  # contexts whose executors have been sent the packages


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, skew joins on, and workers that find this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    context = spark.sparkContext
    if context.master.startswith("local"):
        paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
        if ROOT not in paths:
            context.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    elif context not in _SHIPPED:
        context.addPyFile(packed_sources())
        _SHIPPED.append(context)
    return spark


def packed_sources(packages: tuple[str, ...] = ("llm", "cohortline")) -> str:
    """An archive of the packages, for executors that don't see this folder."""
    path = os.path.join(tempfile.mkdtemp(prefix="sources-"), "sources.zip")
    with zipfile.ZipFile(path, "w") as out:
        for package in packages:
            for file in sorted(Path(ROOT, package).rglob("*.py")):
                out.write(file, str(file.relative_to(ROOT)))
    return path


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run``, after which a worker gives back the memory that it has freed; workers live on and serve other stages."""

    @functools.wraps(run)
    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            ctypes.CDLL(None).malloc_trim(0)

    return done


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder of the run in the shared folder; ``session.drop_run`` deletes it."""
    return landing(spark, "llm-" + label)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder, on the driver and in tasks alike."""
    if uri.startswith("file:/") and not uri.startswith("file://"):  # as Hadoop writes local paths
        uri = "file://" + uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


def write_once(uri: str, name: str, write) -> str:
    """Write a file under an attempt's own name, then move it to ``name``.

    A task that runs twice writes the same bytes, so whichever attempt moves last wins and no
    reader sees half a file.
    """
    store, folder = filesystem(uri)
    store.create_dir(folder, recursive=True)
    attempt = posixpath.join(folder, f"_{uuid.uuid4().hex}")
    with store.open_output_stream(attempt) as out:
        write(out)
    store.move(attempt, posixpath.join(folder, name))
    return f"{uri.rstrip('/')}/{name}"


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """A string column as Python strings; null is the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def raw_texts(batch: pa.RecordBatch, column: str) -> Iterator[memoryview]:
    """A string column's UTF-8 bytes without copies; null is the empty text."""
    values = batch.column(column).cast(pa.large_binary())
    for v in values:
        yield memoryview(v.as_buffer() if v.is_valid else b"")


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each made longer until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the operator's own names, so that no extra column can clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])
