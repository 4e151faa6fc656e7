"""Sinks: appended rows, keyed tables, CSV extracts, JSON documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_rows(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Append to a log or event table; a repeated call appends again, ``append_run`` does not."""
    df.write.mode("append").format(format).save(path)


def append_run(df: DataFrame, path: str, run_id: str) -> None:
    """Append a run's rows so that a repeat of the run replaces them.

    Each run has a partition ``run_id`` of its own and overwrites no other.  A run that repeats without any row leaves what it wrote before.
    """
    marked = df.withColumn("run_id", F.lit(run_id))
    marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def write_keyed_table(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str) -> None:
    """A state table bucketed by its key: writes by key and joins on it then need no exchange.

    A job that reads the old state writes the new one under a new name and path.
    """
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)


def write_extract(df: DataFrame, path: str) -> None:
    """CSV part files with a header; ``path`` may be any URI that Spark can write to."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_documents(df: DataFrame, path: str, column: str = "payload", records_per_file: int = 0) -> None:
    """One JSON document per line, ready for a client that posts them; 0 sets no limit for a file."""
    df.select(column).write.mode("overwrite").option("maxRecordsPerFile", records_per_file).text(path)
