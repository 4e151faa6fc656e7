"""A holiday table from rules: one row per rule, years and dates made by Spark.

A rule names a day of the year in one of three ways (``kind``):

- ``fixed``: ``month`` and ``day``;
- ``weekday``: the ``nth`` ``weekday`` (1 Monday to 7 Sunday) of ``month``, from its end if ``nth`` is negative;
- ``easter``: ``offset`` days from Easter Sunday.

``shift`` says where it is kept if it falls elsewhere: ``monday`` (Tuesday to Thursday on the Monday before, Friday on the Monday after),
``friday`` (Tuesday on the Friday before, Wednesday on the Friday after), ``weekend`` (Saturday on the Friday before, Sunday on the Monday after).
``only_on`` lists the weekdays on which the day is a holiday at all, and ``first_year`` and ``last_year`` when the rule held; NULL is no limit.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.functions.calendar import easter, nth_weekday

RULES = (
    "name string, kind string, month int, day int, weekday int, nth int, offset int, shift string, only_on array<int>, "
    "first_year int, last_year int"
)


def fixed(name: str, month: int, day: int, shift: str | None = None, only_on: Iterable[int] | None = None, years: tuple = (None, None)) -> tuple:
    return (name, "fixed", month, day, None, None, None, shift, list(only_on) if only_on else None, *years)


def by_weekday(name: str, month: int, weekday: int, nth: int, shift: str | None = None, years: tuple = (None, None)) -> tuple:
    return (name, "weekday", month, None, weekday, nth, None, shift, None, *years)


def by_easter(name: str, offset: int, years: tuple = (None, None)) -> tuple:
    return (name, "easter", None, None, None, None, offset, None, None, *years)


# Public holidays of Chile since 1990, as its laws set them.
CHILE = [
    fixed("New Year", 1, 1),
    fixed("day after New Year", 1, 2, only_on=[1], years=(2017, None)),
    by_easter("Good Friday", -2),
    by_easter("Holy Saturday", -1),
    fixed("Labour Day", 5, 1),
    fixed("Navy Day", 5, 21),
    by_easter("Corpus Christi", 60, years=(None, 1999)),
    by_easter("Corpus Christi, Monday", 57, years=(2000, 2006)),
    fixed("Saint Peter and Saint Paul", 6, 29, years=(None, 1999)),
    fixed("Saint Peter and Saint Paul, moved", 6, 29, "monday", years=(2000, None)),
    fixed("Our Lady of Mount Carmel", 7, 16, years=(2007, None)),
    fixed("Assumption", 8, 15),
    fixed("11 September", 9, 11, years=(None, 1998)),
    by_weekday("National Unity", 9, 1, 1, years=(1999, 2001)),
    fixed("Monday before Independence", 9, 17, only_on=[1], years=(2007, None)),
    fixed("Friday before Independence", 9, 17, only_on=[5], years=(2017, None)),
    fixed("Independence", 9, 18),
    fixed("Army Day", 9, 19),
    fixed("Friday after Army Day", 9, 20, only_on=[5], years=(2007, None)),
    fixed("Columbus Day", 10, 12, years=(None, 1999)),
    fixed("Columbus Day, moved", 10, 12, "monday", years=(2000, None)),
    fixed("Reformation Day", 10, 31, "friday", years=(2008, None)),
    fixed("All Saints", 11, 1),
    fixed("Immaculate Conception", 12, 8),
    fixed("Christmas", 12, 25),
]


def rule_table(spark: SparkSession, rules: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULES)


def expanded(rules: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """``holiday, name``: every rule's day in each year from the first to the last in which it held.

    Two rules may give one day; a day that a shift moves out of its year keeps its date.  A rule without what its kind needs, or
    of an unknown kind or shift, is an error; 29 February is a holiday in leap years only.
    """
    begin = F.greatest(F.coalesce("first_year", F.lit(first_year)), F.lit(first_year))
    end = F.least(F.coalesce("last_year", F.lit(last_year)), F.lit(last_year))
    held = rules.withColumns({"_begin": begin, "_end": end}).filter("_begin <= _end")
    by_year = held.withColumn("_year", F.explode(F.sequence("_begin", "_end")))
    # Columns of their own, so that no expression holds another many times over.
    named = by_year.withColumn("_easter", easter(F.col("_year"))).withColumn("_named", _named_day(F.col("_year"), F.col("_easter")))
    named = named.filter("_named IS NOT NULL AND (kind <> 'fixed' OR month(_named) = month)")
    days = named.withColumn("_weekday", F.weekday("_named") + 1).withColumn("holiday", _kept(F.col("_named"), F.col("_weekday")))
    return days.filter(F.col("only_on").isNull() | F.array_contains("only_on", F.col("_weekday"))).select("holiday", "name")


def _named_day(year: Column, easter_day: Column) -> Column:
    """The day that a rule names in a year; NULL where the year has none."""
    kind = F.col("kind")
    known = {
        "fixed": (["month", "day"], F.date_add(F.make_date(year, F.col("month"), F.lit(1)), F.col("day") - 1)),
        "weekday": (["month", "weekday", "nth"], nth_weekday(year, F.col("month"), F.col("weekday"), F.col("nth"))),
        "easter": (["offset"], F.date_add(easter_day, F.col("offset"))),
    }
    found = F.raise_error(F.concat(F.lit("unknown kind of rule: "), F.coalesce(kind, F.lit("none")))).cast("date")
    for name, (needed, value) in known.items():
        complete = F.lit(True)
        for column in needed:
            complete = complete & F.col(column).isNotNull()
        lacking = F.raise_error(F.concat(F.lit(f"a rule of kind {name} needs {', '.join(needed)}: "), "name")).cast("date")
        found = F.when(kind == name, F.when(complete, value).otherwise(lacking)).otherwise(found)
    return found


def _kept(day: Column, weekday: Column) -> Column:
    """The day on which a named day is kept."""
    shift = F.coalesce("shift", F.lit("none"))
    move = (
        F.when(shift == "none", 0)
        .when(shift == "monday", F.when(weekday.between(2, 4), 1 - weekday).when(weekday == 5, 3).otherwise(0))
        .when(shift == "friday", F.when(weekday == 2, -4).when(weekday == 3, 2).otherwise(0))
        .when(shift == "weekend", F.when(weekday == 6, -1).when(weekday == 7, 1).otherwise(0))
        .otherwise(F.raise_error(F.concat(F.lit("unknown shift: "), shift)).cast("int"))
    )
    return F.date_add(day, move)
