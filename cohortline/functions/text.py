"""Text rules: padded names, blanks, tags."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def nonblank(text: str | Column) -> Column:
    """NULL for text that is empty or only blanks, else the text itself."""
    c = F.col(text) if isinstance(text, str) else text
    return F.when(F.trim(c) != "", c)


def full_name(first: Column, last: Column, second_last: Column) -> Column:
    """Names joined by one blank, padding removed.

    An unknown first or last name makes the whole name unknown; a second last name counts only
    when it is known and not blank.
    """
    tail = F.when(F.rtrim(second_last) != "", F.concat(F.lit(" "), F.rtrim(second_last)))
    return F.concat(F.rtrim(first), F.lit(" "), F.rtrim(last), F.coalesce(tail, F.lit("")))


def clean_email(email: Column) -> Column:
    return F.rtrim(F.lower(email))


def flag(condition: Column) -> Column:
    """Text flag as the state tables store it: unknown counts as false."""
    return F.when(condition, "true").otherwise("false")


def in_list_flag(column: Column, values: list[str] | tuple[str, ...]) -> Column:
    return flag(column.isin(*values))


def audience_tag(service: Column, child: Column, guardian: Column, as_of: dt.date) -> Column:
    """Digits of the three ids and the date in one label, without dashes."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (service, child, guardian)]
    return F.translate(F.concat(*parts, F.lit(as_of.isoformat())), "-", "")


def service_day_tag(service: Column, as_of: dt.date) -> Column:
    """The older tag: service and date, dashes kept."""
    return F.concat_ws("-", service.cast("string"), F.lit(as_of.isoformat()))


def event_key(service: Column, code: Column) -> Column:
    return F.concat_ws("-", service.cast("string"), code)
