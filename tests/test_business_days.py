import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortline.functions.business_days import business_days_between, dates_counting, holiday_dates

DAYS = st.dates(dt.date(1995, 1, 1), dt.date(2030, 12, 31))
HOLIDAYS = [dt.date(y, m, d) for y in range(1996, 2029) for m, d in ((1, 1), (5, 1), (9, 18), (12, 25))]


def counted(spark, pairs, holidays, convention):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a date, b date")
    days = business_days_between(F.col("a"), F.col("b"), holidays, convention)
    return [r.n for r in df.select("i", days.alias("n")).orderBy("i").collect()]


def by_numpy(a, b, holidays, convention):
    """numpy >= 1.25 counts (b, a] backwards; the older rule is a forward count with the sign turned."""
    if a > b and convention == "legacy":
        return -int(np.busday_count(b, a, holidays=holidays))
    if a > b:
        one = dt.timedelta(days=1)
        return -int(np.busday_count(b + one, a + one, holidays=holidays))
    return int(np.busday_count(a, b, holidays=holidays))


@pytest.mark.parametrize("convention", ["legacy", "modern"])
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    pairs=st.lists(st.tuples(DAYS, DAYS), min_size=1, max_size=60),
    holidays=st.lists(DAYS, max_size=25),
)
def test_matches_numpy(spark, convention, pairs, holidays):
    want = [by_numpy(a, b, holidays, convention) for a, b in pairs]
    assert counted(spark, pairs, holidays, convention) == want


@pytest.mark.parametrize("convention", ["legacy", "modern"])
def test_every_day_around_a_year_end(spark, convention):
    today = dt.date(2024, 1, 3)
    days = [today + dt.timedelta(days=n) for n in range(-40, 41)]
    pairs = [(today, d) for d in days] + [(d, today) for d in days]
    want = [by_numpy(a, b, HOLIDAYS, convention) for a, b in pairs]
    assert counted(spark, pairs, HOLIDAYS, convention) == want


def test_dates_outside_the_holiday_range(spark):
    pairs = [(dt.date(1960, 2, 29), dt.date(2099, 12, 31)), (dt.date(2099, 12, 31), dt.date(1960, 2, 29))]
    want = [by_numpy(a, b, HOLIDAYS, "legacy") for a, b in pairs]
    assert counted(spark, pairs, HOLIDAYS, "legacy") == want


def test_last_years_holidays_count(spark):
    christmas = dt.date(2023, 12, 25)
    pair = [(dt.date(2024, 1, 2), dt.date(2023, 12, 22))]
    assert counted(spark, pair, [], "legacy") == [-7]
    assert counted(spark, pair, [christmas], "legacy") == [-6]


def test_unknown_dates_stay_unknown(spark):
    day = dt.date(2024, 5, 6)
    for convention in ("legacy", "modern"):
        for holidays in ([], HOLIDAYS):
            assert counted(spark, [(None, day), (day, None)], holidays, convention) == [None, None]


def test_unknown_convention():
    with pytest.raises(ValueError, match="convention"):
        business_days_between(None, None, (), "other")


def test_holiday_table_is_read_once_per_day(spark):
    table = spark.createDataFrame(
        [(dt.date(2024, 5, 1),), (dt.date(2024, 1, 1),), (dt.date(2024, 5, 1),), (None,)], "holiday date"
    )
    assert holiday_dates(table) == [dt.date(2024, 1, 1), dt.date(2024, 5, 1)]


@pytest.mark.parametrize("convention", ["legacy", "modern"])
@settings(max_examples=25, deadline=None)
@given(today=st.dates(dt.date(2020, 6, 1), dt.date(2021, 6, 1)), holidays=st.lists(st.dates(dt.date(2020, 1, 1), dt.date(2021, 12, 31)), max_size=150))
def test_days_of_a_count_are_one_range(convention, today, holidays):
    """Over all days of two years: the range holds exactly the days that count so many."""
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=n) for n in range(731)]
    by_count = {}
    for day in days:
        by_count.setdefault(by_numpy(today, day, holidays, convention), []).append(day)
    for count in sorted(by_count)[1:-1]:  # the outer ones go on beyond the two years
        first, last = dates_counting(today, count, holidays, convention)
        assert by_count[count] == [d for d in days if first <= d <= last]


def test_a_calendar_of_millennia(spark):
    """Holidays of far apart years take the same lookup."""
    holidays = [dt.date(1, 1, 1), dt.date(2024, 1, 1), dt.date(9999, 12, 31)]
    pairs = [(dt.date(2023, 12, 29), dt.date(2024, 1, 3)), (dt.date(2024, 1, 3), dt.date(2023, 12, 29)), (dt.date(1, 1, 1), dt.date(9999, 12, 31))]
    want = [by_numpy(a, b, holidays, "legacy") for a, b in pairs]
    assert counted(spark, pairs, holidays, "legacy") == want
