"""Dates that a calendar year is built around, as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def easter(year: Column) -> Column:
    """Easter Sunday of a year in the Gregorian calendar.

    The golden number, the century's leap years left out and its lunar correction give the age of the moon (the epact); the
    Sunday after the full moon follows from the weekday of its date.
    """
    golden = year % 19
    century = _div(year, 100)
    left_out = century - _div(century, 4)
    lunar = _div(century * 8 + 13, 25)
    moon = (golden * 19 + left_out - lunar + 15) % 30
    # The full moon falls on 21 March plus ``moon``; late ones are drawn forward so that no month repeats.
    early = _div(moon, 28) * (F.lit(1) - _div(moon, 28) * _div(F.lit(29), moon + 1) * _div(F.lit(21) - golden, 11))
    full = moon - early
    weekday = (year + _div(year, 4) + full + 2 - left_out) % 7
    return F.date_add(F.make_date(year, F.lit(3), F.lit(28)), (full - weekday).cast("int"))


def nth_weekday(year: Column, month: Column, weekday: Column, nth: Column) -> Column:
    """The ``nth`` given weekday (1 Monday to 7 Sunday) of a month; a negative ``nth`` counts from its end.

    NULL where the month has fewer.
    """
    first = F.make_date(year, month, F.lit(1))
    last = F.last_day(first)
    forward = F.date_add(first, F.pmod(weekday - _iso(first), F.lit(7)) + (nth - 1) * 7)
    backward = F.date_sub(last, F.pmod(_iso(last) - weekday, F.lit(7)) + (-nth - 1) * 7)
    day = F.when(nth > 0, forward).when(nth < 0, backward)
    return F.when(F.month(day) == month, day)


def _iso(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + 1


def _div(value: Column, by: Column | int) -> Column:
    return F.floor(value / by).cast("int")
