"""Key checks, one row per key, and writes by key into a stored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter("n_rows > 1")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in a stated order.

    The rank filter lets Spark keep one row per key and task before the exchange, so a hot key
    sends at most one row from each task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def absent_from(incoming: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not stored; both sides are read once."""
    return incoming.join(stored.select(*keys), list(keys), "left_anti")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, if no key occurs twice; else an error that names some of them.

    The check is a job of its own; the writes below rely on it and don't run it themselves.
    """
    repeated = duplicate_keys(df, keys).limit(5).collect()
    if repeated:
        raise ValueError(f"repeated keys: {[tuple(r)[:-1] for r in repeated]}")
    return df


def _like(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """``incoming`` in the target's column order; a column more or less is an error."""
    if sorted(target.columns) != sorted(incoming.columns):
        odd = sorted(set(target.columns) ^ set(incoming.columns))
        raise ValueError(f"columns on one side only: {odd}")
    return incoming.select(*target.columns)


def upsert_replace(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Put: an incoming row replaces the stored row of its key as a whole.

    ``incoming`` holds one row per key (``require_unique`` checks that) and the target's columns.
    """
    kept = target.join(incoming.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(_like(target, incoming))


def upsert_insert_only(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert if absent: stored rows keep their values; ``incoming`` as for ``upsert_replace``."""
    return target.unionByName(absent_from(_like(target, incoming), target, keys).select(*target.columns))


def upsert_patch(
    target: DataFrame,
    patch: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    create: bool = False,
) -> DataFrame:
    """Update the named columns of matched keys; a patch may set NULL.

    With ``create`` an unmatched patch row becomes a new row whose other columns are NULL.  ``patch``
    holds one row per key.  Either way it is one join of both sides.
    """
    renamed = patch.select(*keys, *columns).withColumnsRenamed({c: f"_new_{c}" for c in columns})
    joined = target.join(renamed.withColumn("_hit", F.lit(True)), list(keys), "full_outer" if create else "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )
