"""Business-day counts against a holiday calendar, as one arithmetic column expression."""

from __future__ import annotations

import bisect
import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EPOCH = dt.date(1970, 1, 1)
_MONDAY = 3  # days from Monday 1969-12-29 to the epoch
_BLOCK = 32  # days that share one entry of the holiday lookup


def business_days_between(
    begin: Column, end: Column, holidays: Iterable[dt.date] | DataFrame = (), convention: str = "legacy"
) -> Column:
    """Signed count of weekdays that are no holidays from ``begin`` to ``end``.

    A forward count covers ``[begin, end)``.  For ``begin > end`` the count is negative and covers
    ``[end, begin)`` under ``legacy`` and ``(end, begin]`` under ``modern`` (the two behaviours of
    ``numpy.busday_count`` before and since 1.25).
    """
    if convention not in ("legacy", "modern"):
        raise ValueError(f"unknown convention {convention!r}")
    before = _business_days_before(holiday_dates(holidays))
    days = before(end) - before(begin)
    if convention == "modern":
        shifted = before(F.date_add(end, 1)) - before(F.date_add(begin, 1))
        days = F.when(begin <= end, days).otherwise(shifted)
    return days.cast("int")


def holiday_dates(holidays: Iterable[dt.date] | DataFrame, column: str = "holiday") -> list[dt.date]:
    """Distinct dates in order, from a holiday table or from dates as they are.

    Spark combines a table into one row, which has at most one value per calendar day.
    """
    if isinstance(holidays, DataFrame):
        days = F.sort_array(F.collect_set(F.to_date(column)))
        return list(holidays.agg(days.alias("days")).first()["days"])
    return sorted(set(holidays))


def _business_days_before(holidays: Iterable[dt.date]):
    """A function of a date: business days from the reference Monday up to that date.

    The signed count between two dates is the difference of two such numbers.
    """
    offs = sorted({(h - _EPOCH).days for h in holidays if h.weekday() < 5})

    def weekdays(day: Column) -> Column:
        n = F.unix_date(day) + _MONDAY
        return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))

    if not offs:
        return weekdays

    # An entry for each block of days from the first holiday to the last: the holidays before the block above, a bit for each
    # of its own below.  A lookup costs the same however many holidays there are, and a calendar
    # from year 1 to 9999 has 114 thousand entries.
    first, last = offs[0] // _BLOCK, offs[-1] // _BLOCK
    own = [0] * (last - first + 1)
    for off in offs:
        own[off // _BLOCK - first] |= 1 << off % _BLOCK
    entries, before = ["0"], 0
    for bits in [*own, 0]:
        entries.append(str(before << _BLOCK | bits))
        before += bits.bit_count()
    table = F.split(F.lit(",".join(entries)), ",").cast("array<long>")

    def business(day: Column) -> Column:
        number = F.unix_date(day)
        slot = F.floor(number / _BLOCK) - first + 1
        entry = F.get(table, F.least(F.greatest(slot, F.lit(0)), F.lit(len(entries) - 1)).cast("int"))
        earlier = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(_BLOCK))) - 1
        taken = F.shiftright(entry, _BLOCK) + F.bit_count(entry.bitwiseAND(earlier))
        # least/greatest skip NULLs, so an unknown date must be kept unknown here.
        return F.when(day.isNotNull(), weekdays(day) - taken)

    return business


def dates_counting(
    as_of: dt.date, count: int, holidays: Iterable[dt.date] | DataFrame = (), convention: str = "legacy"
) -> tuple[dt.date, dt.date]:
    """The first and the last date whose signed count from ``as_of`` is ``count``.

    The inverse of ``business_days_between``: the count never falls from one day to the next and never skips
    a number, so these dates are one range, and those that count at most ``count`` end with it.  As a range it reaches a scan.
    """
    if convention not in ("legacy", "modern"):
        raise ValueError(f"unknown convention {convention!r}")
    ordinal = _Ordinals(holiday_dates(holidays))
    one = dt.timedelta(days=1)
    if convention == "legacy" or count > 0:
        number = ordinal.before(as_of) + count
        return ordinal.day(number - 1) + one, ordinal.day(number)
    # Backwards, (date, as_of] is counted: the day after the date takes the place of the date.
    number = ordinal.before(as_of + one) + count
    first = ordinal.day(number - 1)
    if count < 0:
        return first, ordinal.day(number) - one
    return min(first, as_of), ordinal.day(ordinal.before(as_of))


class _Ordinals:
    """Business days by number, counted from the reference Monday."""

    def __init__(self, holidays: Iterable[dt.date]) -> None:
        self.numbers = sorted(self._weekdays(h) for h in holidays if h.weekday() < 5)
        # A holiday puts off all business days from this number on.
        self.shifts = [n - i for i, n in enumerate(self.numbers)]

    @staticmethod
    def _weekdays(day: dt.date) -> int:
        weeks, rest = divmod((day - _EPOCH).days + _MONDAY, 7)
        return weeks * 5 + min(rest, 5)

    def before(self, day: dt.date) -> int:
        """Business days before ``day``."""
        number = self._weekdays(day)
        return number - bisect.bisect_left(self.numbers, number)

    def day(self, number: int) -> dt.date:
        """The business day that has ``number`` others before it."""
        weeks, rest = divmod(number + bisect.bisect_right(self.shifts, number), 5)
        return _EPOCH + dt.timedelta(days=weeks * 7 + rest - _MONDAY)
