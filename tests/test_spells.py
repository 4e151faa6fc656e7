import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortline.operators import spells as sp
from cohortline.operators.running import max_before
from cohortline.sources import schemas

AS_OF = dt.date(2024, 3, 15)
OPEN = dt.date(3000, 1, 1)


def spell_frame(spark, spells):
    """Spells from (service, child, start, end)."""
    full = [(s, c, "N1", 1, 1, s, a, b) for s, c, a, b in spells]
    return spark.createDataFrame(full, schemas.SPELLS)


def month_before(day):
    return (day.year, day.month - 1) if day.month > 1 else (day.year - 1, 12)


def live(start, end):
    return end is None or start is not None and end > start


def brute_current(spells, as_of):
    ahead = as_of + dt.timedelta(days=14)
    latest = {}
    for _, child, start, end in spells:
        if live(start, end) and start and (end is None or end > as_of) and (start.year, start.month) <= (ahead.year, ahead.month):
            latest[child] = max(latest.get(child, dt.date.min), end or OPEN)
    return {s for s, c, _, e in spells if latest.get(c) == (e or OPEN)}


def brute_first(spells):
    kept = set()
    for service, child, start, _ in spells:
        earlier = [
            e or OPEN for s, c, a, e in spells if c == child and s != service and start and a and a < start and live(a, e)
        ]
        if not any((e.year, e.month) >= month_before(start) for e in earlier):
            kept.add(service)
    return kept


def brute_window(spells, as_of, days):
    kept = set()
    for service, _, start, end in spells:
        if start is None:
            continue
        later = start + dt.timedelta(days=14)
        stays = dt.date(later.year + later.month // 12, later.month % 12 + 1, 1)
        if start >= as_of - dt.timedelta(days=days) and live(start, end) and (end is None or end >= stays):
            kept.add(service)
    return kept


def some_spells(seed, n=400, hot=False):
    """Random spells on few dates, so that ties, gaps of a month and zero-day spells all occur."""
    rng = random.Random(seed)
    result = []
    for service in range(n):
        child = 0 if hot and service % 3 == 0 else rng.randrange(1, 60)
        start = dt.date(2023, 10, 1) + dt.timedelta(days=rng.randrange(0, 220))
        length = rng.choice([0, 1, 10, 29, 30, 31, 60, 120, 400])
        end = None if rng.random() < 0.15 else start + dt.timedelta(days=length)
        result.append((service, child, None if rng.random() < 0.08 else start, end))
    return result


@pytest.mark.parametrize(
    ("seed", "hot", "as_of"),
    [(1, False, AS_OF), (2, True, AS_OF), (3, True, dt.date(2024, 2, 29)), (4, False, dt.date(2023, 12, 31))],
)
def test_spell_rules_match_pairwise_checks(spark, seed, hot, as_of):
    spells = some_spells(seed, hot=hot)
    frame = spell_frame(spark, spells)
    current, first = brute_current(spells, as_of), brute_first(spells)
    assert {r.service_id for r in sp.current_spell(frame, as_of).collect()} == current
    assert {r.service_id for r in sp.first_admission(frame).collect()} == first
    for days in (0, 10, 90):
        window = brute_window(spells, as_of, days)
        kept = {r.service_id for r in frame.filter(sp.admission_window(as_of, days)).collect()}
        assert kept == window
        admitted = {r.service_id for r in sp.new_admissions(frame, as_of, days).collect()}
        assert admitted == current & first & window


def test_current_spell_keeps_ties_and_skips_cancelled(spark):
    d = dt.date
    frame = spell_frame(
        spark,
        [
            (1, 1, d(2024, 1, 1), None),
            (2, 1, d(2024, 2, 1), None),  # tie with 1: both open
            (3, 1, d(2024, 2, 1), d(2024, 12, 1)),
            (4, 2, d(2024, 3, 15), d(2024, 3, 15)),  # cancelled
            (5, 3, d(2024, 1, 1), AS_OF),  # ended with the midnight that today begins with
            (8, 6, d(2024, 1, 1), AS_OF + dt.timedelta(days=1)),
            (9, 7, None, None),
            (6, 4, d(2024, 1, 1), AS_OF - dt.timedelta(days=1)),
            (7, 5, d(2024, 4, 1), None),  # starts after the month of as_of + 14 days
        ],
    )
    assert rows(sp.current_spell(frame, AS_OF), "service_id") == [(1,), (2,), (8,)]


def test_first_admission_month_gap(spark):
    d = dt.date
    frame = spell_frame(
        spark,
        [
            (1, 1, d(2023, 5, 1), d(2024, 2, 1)),
            (2, 1, d(2024, 3, 31), None),  # the spell before ended in the previous month
            (3, 2, d(2023, 5, 1), d(2024, 1, 31)),
            (4, 2, d(2024, 3, 31), None),  # ended two months before: a first admission
            (5, 3, d(2023, 5, 1), d(2023, 5, 1)),
            (6, 3, d(2024, 3, 31), None),  # the one before was cancelled
            (7, 4, d(2024, 3, 31), None),
            (8, 4, d(2024, 3, 31), None),  # the same start is not earlier
            (9, None, d(2024, 3, 31), None),
        ],
    )
    assert rows(sp.first_admission(frame), "service_id") == [(1,), (3,), (4,), (5,), (6,), (7,), (8,), (9,)]


def test_latest_conversion_orders_unknown_last_and_breaks_ties(spark):
    d = dt.date
    frame = spell_frame(
        spark,
        [(i, c, d(2024, m, 1), None) for i, c, m in ((1, 1, 1), (2, 1, 2), (3, 1, 3), (4, 2, 1), (5, 2, 1), (6, 3, 4), (7, 4, 3))],
    )
    ts = dt.datetime
    quotes = spark.createDataFrame(
        [(1, ts(2024, 1, 5)), (2, None), (3, ts(2023, 12, 5)), (4, ts(2024, 1, 1)), (5, ts(2024, 1, 1)), (6, ts(2024, 4, 1)), (7, None)],
        schemas.QUOTES,
    )
    latest = sp.latest_conversion(frame, quotes, AS_OF)
    # Child 3 starts after the month of as_of; child 4 has only an unknown date.
    assert rows(latest, "child_id", "service_id") == [(1, 1), (2, 5), (4, 7)]


def test_renewal_action_band_and_enrolment(spark):
    d, ts = dt.date, dt.datetime
    frame = spell_frame(
        spark,
        [(1, 1, d(2023, 12, 31), None), (2, 2, d(2024, 1, 1), None), (3, 3, d(2022, 1, 1), d(2023, 1, 1)), (4, 4, d(2023, 5, 1), d(2023, 5, 1))],
    )
    actions = spark.createDataFrame(
        [
            (1, 15, 2024, ts(2023, 6, 30, 23, 59)),  # before the band
            (1, 15, 2024, ts(2024, 2, 29, 23, 59)),
            (1, 15, 2024, ts(2023, 7, 1)),
            (1, 7, 2024, ts(2023, 7, 1)),
            (1, 15, 2023, ts(2023, 7, 1)),
            (2, 15, 2024, ts(2023, 8, 1)),  # not enrolled last year
            (3, 15, 2024, ts(2024, 3, 1)),  # after the band
            (4, 15, 2024, ts(2023, 8, 1)),  # only a cancelled spell
        ],
        schemas.ACTION_HISTORY,
    )
    first = sp.renewal_first_action(actions, frame, AS_OF)
    assert rows(first) == [(1, 2024, ts(2023, 7, 1))]


def test_attendance_any_flag(spark):
    frame = spark.createDataFrame(
        [(1, 1, 0, 0), (1, 1, 1, 1), (1, 0, 0, 0), (1, None, 0, 1), (2, 0, 0, 0)], schemas.ATTENDANCE
    )
    assert rows(sp.attendance_days(frame)) == [(1, 3), (2, 0)]


RENEWAL_CASES = [
    # corporate, quote, conversion, has_renewal, history, action, enrolled, wanted
    (False, None, None, True, "2023-11-01", "2023-08-01", False, "2023-11-01"),
    (False, None, None, True, None, "2023-08-01", False, "2023-08-01"),
    (False, "2023-05-05", None, True, None, None, False, None),  # a history row without a date
    (False, "2023-05-05", "2022-01-01", False, None, None, False, "2023-05-05"),
    (False, None, "2022-01-01", False, None, None, False, "2022-01-01"),
    (False, "2024-01-01", None, False, None, None, True, None),
    (False, None, None, False, None, None, True, None),
    (True, "2023-12-31", None, True, "2023-11-01", None, False, "2024-01-01"),
    (True, None, None, False, None, None, False, "2024-01-01"),
    (True, "2024-01-31", None, False, None, None, True, "2024-01-31"),
    (True, "2024-01-01", None, False, None, None, False, None),
    (True, "2024-02-01", None, False, None, None, True, None),
]


def test_renewal_rules(spark):
    df = spark.createDataFrame(
        [(i, *case) for i, case in enumerate(RENEWAL_CASES)],
        "i int, corporate boolean, q string, c string, r boolean, h string, a string, e boolean, want string",
    )
    ts = {n: F.col(n).cast("timestamp_ntz") for n in "qcha"}
    got = sp.renewal_ts(
        is_corporate=F.col("corporate"), quote_ts=ts["q"], conversion_ts=ts["c"], has_renewal=F.col("r"),
        history_ts=ts["h"], action_ts=ts["a"], enrolled_last_year=F.col("e"), as_of=AS_OF,
    )
    wrong = df.withColumn("got", F.date_format(got, "yyyy-MM-dd")).filter(~F.col("got").eqNullSafe(F.col("want")))
    assert wrong.collect() == []


def test_last_enrollment_falls_back(spark):
    df = spark.createDataFrame(
        [("2024-01-02 10:00:00", "2024-01-01 00:00:00"), (None, "2024-01-01 00:00:00"), (None, None)], "q string, c string"
    )
    got = sp.last_enrollment_ts(
        F.col("q").cast("timestamp_ntz"), F.col("c").cast("timestamp_ntz"), F.lit(dt.date(2023, 9, 9))
    )
    assert rows(df.select(got)) == [
        (dt.datetime(2023, 9, 9),), (dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 2, 10),),
    ]


def test_a_spell_without_a_start_is_not_earlier(spark):
    frame = spell_frame(spark, [(1, 7, dt.date(2024, 3, 10), None), (2, 7, None, None)])
    assert rows(sp.first_admission(frame), "service_id") == [(1,), (2,)]
    assert rows(sp.new_admissions(frame, AS_OF), "service_id") == [(1,)]


def moments(seed, hot):
    """Spells with hours: many equal days, some equal moments."""
    rng = random.Random(seed)
    data = []
    for service in range(400):
        start = dt.datetime(2023, 1, 1) + dt.timedelta(days=rng.randint(0, 500), hours=rng.choice([0, 8, 8, 9, 17]))
        length = dt.timedelta(days=rng.choice([0, 1, 20, 45, 90, 200]), hours=rng.choice([0, 5]))
        child = 1 if hot and rng.random() < 0.7 else rng.randint(1, 60)
        data.append((service, child, None if rng.random() < 0.05 else start, None if rng.random() < 0.05 else start + length))
    return data


@pytest.mark.parametrize(("seed", "hot"), [(1, False), (2, True), (3, True)])
def test_moments_match_pairwise_checks(spark, seed, hot):
    spells = moments(seed, hot)

    def month_before(moment):
        first = moment.replace(day=1, hour=0, minute=0)
        return (first - dt.timedelta(days=1)).replace(day=1)

    far = dt.datetime(3000, 1, 1)
    want = {
        s for s, child, start, _ in spells
        if start is None or not any(
            c == child and b is not None and b < start and (e is None or e > b) and (e or far) >= month_before(start) for _, c, b, e in spells
        )
    }
    frame = spark.createDataFrame(spells, "service_id long, child_id long, start_ts timestamp_ntz, end_ts timestamp_ntz").repartition(5)
    assert {r.service_id for r in sp.first_admission_by_moment(frame).collect()} == want
    assert sp.first_admission_by_moment(frame.limit(0)).count() == 0


def test_running_maximum_over_many_ranges(spark):
    """One group with most rows fills several ranges, and what each begins with is carried into it."""
    rng = random.Random(9)
    data = [(None if k % 50 == 0 else 1 if k % 4 else k % 13, rng.randint(0, 5000) if k % 31 else None, rng.choice([None, rng.randint(0, 10**6)])) for k in range(6000)]
    frame = spark.createDataFrame(data, "g long, o long, v long").repartition(6)
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = {(r.g, r.o): r.prior for r in max_before(own.createDataFrame(data, "g long, o long, v long"), "g", "o", "v").collect()}
    want = {}
    for g in {g for g, _, _ in data if g is not None}:
        best = None
        for o in sorted({o for h, o, _ in data if h == g and o is not None}):
            want[g, o] = best
            here = [v for h, p, v in data if h == g and p == o and v is not None]
            best = max([*here, *([best] if best is not None else [])], default=None)
    assert got == want
    assert {(r.g, r.o): r.prior for r in max_before(frame, "g", "o", "v").collect()} == want
    ranges = own.createDataFrame(data, "g long, o long, v long").filter("g = 1 AND o IS NOT NULL").select("g", "o").distinct().repartitionByRange("g", "o")
    assert ranges.withColumn("p", F.spark_partition_id()).select("p").distinct().count() > 1
