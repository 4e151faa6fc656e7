"""The time slots of a day, and how timestamps fall into them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
FIRST_SLOT = dt.time(8, 0)
LAST_SLOT = dt.time(19, 0)
STEP_MINUTES = 15


def _minutes(time: dt.time) -> int:
    return time.hour * 60 + time.minute


def _label(minute: Column) -> Column:
    hour, rest = F.floor(minute / 60), F.pmod(minute, F.lit(60))
    return F.format_string("%02d:%02d", hour, rest)


def time_slots(
    spark: SparkSession, first: dt.time = FIRST_SLOT, last: dt.time = LAST_SLOT, step: int = STEP_MINUTES
) -> DataFrame:
    """Slot labels ``HH:mm`` from first to last, both included."""
    return spark.range(_minutes(first), _minutes(last) + 1, step).select(_label(F.col("id")).alias("slot"))


def slot_of(ts: Column, step: int = STEP_MINUTES) -> Column:
    """Label of the slot that a timestamp falls into."""
    minute = F.hour(ts) * 60 + F.minute(ts)
    return _label((minute - F.pmod(minute, F.lit(step))).cast("long"))
