"""Holiday rules against known dates."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from dateutil.easter import easter as computed
from pyspark.sql import functions as F

from cohortline.functions.business_days import business_days_between
from cohortline.functions.calendar import easter, nth_weekday
from cohortline.operators import holidays

D = dt.date


def test_easter_of_many_years(spark):
    found = spark.range(1583, 4100).select(F.col("id").cast("int").alias("y")).select("y", easter(F.col("y")).alias("d"))
    assert {r.y: r.d for r in found.collect()} == {y: computed(y) for y in range(1583, 4100)}


def test_easter_of_known_years(spark):
    known = {1954: D(1954, 4, 18), 1981: D(1981, 4, 19), 2000: D(2000, 4, 23), 2008: D(2008, 3, 23), 2011: D(2011, 4, 24), 2024: D(2024, 3, 31), 2038: D(2038, 4, 25)}
    df = spark.createDataFrame([(y,) for y in known], "y int")
    assert {r.y: r.d for r in df.select("y", easter(F.col("y")).alias("d")).collect()} == known


def test_weekdays_of_a_month(spark):
    asked = [(y, m, w, n) for y in (2023, 2024) for m in (2, 5, 12) for w in range(1, 8) for n in (1, 2, 5, -1, -4, -5)]
    df = spark.createDataFrame(asked, "y int, m int, w int, n int")
    found = df.select("*", nth_weekday(F.col("y"), F.col("m"), F.col("w"), F.col("n")).alias("d")).collect()
    for r in found:
        days = [D(r.y, r.m, 1) + dt.timedelta(days=k) for k in range(31)]
        days = [d for d in days if d.month == r.m and d.isoweekday() == r.w]
        place = r.n - 1 if r.n > 0 else r.n
        assert r.d == (days[place] if -len(days) <= place < len(days) else None)


def test_chile(spark):
    """Two years as they were published: moved days, bridges and the law's changes."""
    table = holidays.expanded(holidays.rule_table(spark, holidays.CHILE), 1998, 2024)
    by_year = {}
    for (day,) in rows(table, "holiday"):
        by_year.setdefault(day.year, set()).add(day)
    assert by_year[1998] == {
        D(1998, 1, 1), D(1998, 4, 10), D(1998, 4, 11), D(1998, 5, 1), D(1998, 5, 21), D(1998, 6, 11), D(1998, 6, 29), D(1998, 8, 15),
        D(1998, 9, 11), D(1998, 9, 18), D(1998, 9, 19), D(1998, 10, 12), D(1998, 11, 1), D(1998, 12, 8), D(1998, 12, 25),
    }
    assert by_year[2023] == {
        D(2023, 1, 1), D(2023, 1, 2), D(2023, 4, 7), D(2023, 4, 8), D(2023, 5, 1), D(2023, 5, 21), D(2023, 6, 26), D(2023, 7, 16), D(2023, 8, 15),
        D(2023, 9, 18), D(2023, 9, 19), D(2023, 10, 9), D(2023, 10, 27), D(2023, 11, 1), D(2023, 12, 8), D(2023, 12, 25),
    }
    assert {D(2001, 6, 11), D(2001, 7, 2), D(2001, 9, 3), D(2001, 10, 15)} <= by_year[2001]
    assert {D(2024, 9, 20), D(2024, 10, 31)} <= by_year[2024] and D(2024, 9, 17) not in by_year[2024]


def test_shifts_and_limits(spark):
    rules = [
        holidays.fixed("leap", 2, 29),
        holidays.fixed("observed", 7, 4, "weekend"),
        holidays.by_weekday("fourth Thursday", 11, 4, 4),
        holidays.by_weekday("last Monday", 5, 1, -1),
        holidays.fixed("once", 3, 3, years=(2021, 2021)),
        holidays.fixed("new year observed", 1, 1, "weekend"),
    ]
    found = holidays.expanded(holidays.rule_table(spark, rules), 2020, 2022)
    assert rows(found, "holiday") == [
        (d,) for d in sorted([
            D(2020, 2, 29), D(2020, 7, 3), D(2021, 7, 5), D(2022, 7, 4), D(2020, 11, 26), D(2021, 11, 25), D(2022, 11, 24),
            D(2020, 5, 25), D(2021, 5, 31), D(2022, 5, 30), D(2021, 3, 3), D(2020, 1, 1), D(2021, 1, 1), D(2021, 12, 31),
        ])
    ]
    assert holidays.expanded(holidays.rule_table(spark, rules), 2022, 2020).count() == 0
    assert holidays.expanded(holidays.rule_table(spark, []), 2020, 2022).count() == 0


@pytest.mark.parametrize("rule", [("x", "lunar", 1, 1, *[None] * 7), ("x", "fixed", None, 1, *[None] * 7), ("x", "fixed", 1, 1, None, None, None, "tuesday", *[None] * 3)])
def test_a_rule_that_says_nothing_is_an_error(spark, rule):
    with pytest.raises(Exception, match="unknown kind|needs month|unknown shift"):
        holidays.expanded(holidays.rule_table(spark, [rule]), 2020, 2021).collect()


def test_the_table_feeds_the_count(spark):
    table = holidays.expanded(holidays.rule_table(spark, holidays.CHILE), 2023, 2024)
    day = spark.createDataFrame([(D(2023, 9, 15), D(2023, 9, 21))], "a date, b date")
    assert day.select(business_days_between(F.col("a"), F.col("b"), table).alias("n")).first().n == 2
