"""Column-level steps: renames, defaults, fills, casts, required values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions.text import nonblank


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Constant columns; an existing column of the same name is replaced."""
    return df.withColumns({name: F.lit(value) for name, value in defaults.items()})


def fill_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Replace NULL, column by column."""
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in defaults.items()})


def blank_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Read the three forms of missing text, NULL, empty and blank, as one."""
    return df.withColumns({c: nonblank(c) for c in columns})


def require_nonblank(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text column holds something."""
    return df.filter(nonblank(column).isNotNull())


def try_casts(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; text that does not fit gives NULL."""
    return df.withColumns({n: F.col(n).try_cast(t) for n, t in types.items()})


def missing_columns(columns: Iterable[str]) -> Column:
    """The names of the columns that are NULL in a row, or empty text."""
    return F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])


def split_on_required(df: DataFrame, columns: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required columns known, and the others with the names of what they miss."""
    missing = missing_columns(columns)
    marked = df.withColumn("reject_reason", missing)
    complete = marked.filter("reject_reason = ''").drop("reject_reason")
    return complete, marked.filter("reject_reason <> ''")
