"""Tables by the date of an event: a typed date beside the text, partitions by its month, and the due part of them.

Text dates stop a scan from pruning, as each must be parsed first.  Here the date is parsed once, when the row is stored.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from cohortline.functions import dates

EVENT_DATE, EVENT_MONTH = "event_date", "event_month"


def with_event_date(df: DataFrame, text_col: str, parse: Callable[[str], Column] = dates.parse_text_ts) -> DataFrame:
    """The typed date of a text column, and the first day of its month; both NULL where the text is no date."""
    day = F.to_date(parse(text_col))
    return df.withColumns({EVENT_DATE: day, EVENT_MONTH: F.trunc(day, "month")})


def write_dated(df: DataFrame, path: str, text_col: str, key: str, parse: Callable[[str], Column] = dates.parse_text_ts) -> None:
    """``df`` partitioned by the month of its date and ordered by day inside, so that files and row groups can be skipped.

    Rows without a date have a partition of their own.  Ranges of month, day and a hash of ``key`` spread a month that holds
    most rows, or most rows without a date, over as many tasks as their share asks for.
    """
    typed = with_event_date(df, text_col, parse)
    order = [EVENT_MONTH, EVENT_DATE]
    spread = typed.repartitionByRange(*order, F.xxhash64(key)).sortWithinPartitions(*order)
    spread.write.mode("errorifexists").partitionBy(EVENT_MONTH).parquet(path)


def read_dated(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table that ``write_dated`` stored from rows of ``schema``, with both typed columns."""
    full = StructType(list(schema.fields)).add(EVENT_DATE, DateType()).add(EVENT_MONTH, DateType())
    return spark.read.schema(full).parquet(path)


def between(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Rows whose event lies in the range: months choose the partitions, days the row groups."""
    months = F.col(EVENT_MONTH).between(F.lit(first.replace(day=1)), F.lit(last.replace(day=1)))
    return df.filter(months & F.col(EVENT_DATE).between(F.lit(first), F.lit(last)))


def unparsed(df: DataFrame) -> DataFrame:
    """Rows whose text is no date: one partition."""
    return df.filter(F.col(EVENT_MONTH).isNull())


def due_in_windows(df: DataFrame, windows: DataFrame) -> DataFrame:
    """Each row with every window ``first_day, last_day`` of ``windows`` that its event lies in.

    The join on the month lets Spark prune partitions by the windows while it runs (dynamic partition pruning); a window
    of several months is looked up in each of them and matches a row once.
    """
    month = F.explode(F.expr("sequence(trunc(first_day, 'month'), trunc(last_day, 'month'), interval 1 month)"))
    by_month = windows.filter("first_day <= last_day").withColumn("_month", month)
    met = df.join(by_month, F.col(EVENT_MONTH) == F.col("_month"))
    return met.filter(F.col(EVENT_DATE).between(F.col("first_day"), F.col("last_day"))).drop("_month")
