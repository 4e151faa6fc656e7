"""Date rules shared by the operators.  Every "today" is an explicit ``as_of`` date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
OPEN_END = dt.date(3000, 1, 1)  # how an open (NULL) end date compares
NO_CONVERSION = dt.date(2000, 1, 1)  # corporate services without any quote
NEVER_SCHEDULED = "31/12/2050 09:00:00"
TEXT_TS = "d/M/yyyy H:m:s"  # reads padded and unpadded day, month and time

_TEXT_PARTS = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}):(\d{1,2}):(\d{1,2})$"


def open_end(end: str | Column) -> Column:
    """End date with NULL read as the open end."""
    return F.coalesce(_col(end), F.lit(OPEN_END))


def is_live(start: str | Column, end: str | Column) -> Column:
    """At least one day long; zero-day spells are cancelled enrolments."""
    return _col(end).isNull() | (_col(end) > _col(start))


def ends_on_or_after(end: str | Column, day: dt.date) -> Column:
    return _col(end).isNull() | (_col(end) >= F.lit(day))


def ends_after(end: str | Column, day: dt.date) -> Column:
    return _col(end).isNull() | (_col(end) > F.lit(day))


def lasts_into_year(start: str | Column, end: str | Column, year: int) -> Column:
    """The spell touches the calendar year; written as ranges so the scan can prune."""
    return (_col(start) < F.lit(dt.date(year + 1, 1, 1))) & ends_on_or_after(end, dt.date(year, 1, 1))


def month_after(day: dt.date) -> dt.date:
    """First day of the month after ``day``."""
    return dt.date(day.year + day.month // 12, day.month % 12 + 1, 1)


def parse_text_ts(text: str | Column) -> Column:
    """``d/M/yyyy H:m:s`` text to a timestamp; blank or malformed text gives NULL.

    The parts are put in ISO order and cast, so no time zone shifts a midnight that a change of
    the clocks skips.
    """
    written = F.trim(_col(text))
    iso = F.regexp_replace(written, _TEXT_PARTS, "$3-$2-$1 $4:$5:$6")
    return F.when(written.rlike(_TEXT_PARTS), iso).try_cast("timestamp_ntz")


def iso_text(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a date or timestamp."""
    return F.substring(moment.cast("timestamp_ntz").cast("string"), 1, 19)


def midnight(day: dt.date) -> Column:
    """The start of a day as a timestamp literal without time zone."""
    return F.lit(day).cast("timestamp_ntz")


def as_ts(value: str | Column) -> Column:
    """A timestamp from a timestamp, a date or ISO text; malformed text gives NULL."""
    return _col(value).try_cast("timestamp_ntz")


def falls_on(ts: Column, day: dt.date) -> Column:
    """The timestamp lies on the day; written as a range that a typed scan can prune by."""
    return (ts >= midnight(day)) & (ts < midnight(day + dt.timedelta(days=1)))


def falls_between(ts: Column, first: dt.date, last: dt.date) -> Column:
    """The timestamp lies on a day of the range; written as a range that a typed scan can prune by."""
    return (ts >= midnight(first)) & (ts < midnight(last + dt.timedelta(days=1)))


def days_from(as_of: dt.date, event: str | Column) -> Column:
    """Signed days from ``as_of`` to the event; negative for past events."""
    return F.datediff(_col(event), F.lit(as_of))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
