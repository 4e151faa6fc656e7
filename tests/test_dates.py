import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortline.functions import dates
from cohortline.operators import spells

TEXTS = {
    "1/3/2023 9:5:7": dt.datetime(2023, 3, 1, 9, 5, 7),
    "01/03/2023 09:05:07": dt.datetime(2023, 3, 1, 9, 5, 7),
    " 29/2/2024 0:0:0 ": dt.datetime(2024, 2, 29),
    "3/9/2023 0:0:0": dt.datetime(2023, 9, 3),  # a midnight that the clocks skip in Santiago
    "31/12/2050 09:00:00": dt.datetime(2050, 12, 31, 9),
    "29/2/2023 0:0:0": None,
    "1/13/2023 0:0:0": None,
    "1/3/2023 24:0:1": None,
    "1/3/2023": None,
    "2023-03-01 09:05:07": None,
    "soon": None,
    "": None,
    "  ": None,
}


@pytest.fixture(params=["UTC", "America/Santiago", "Asia/Tokyo"])
def zoned(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_dates_in_any_session_zone(zoned):
    df = zoned.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    got = {r.t: r.ts for r in df.select("t", dates.parse_text_ts("t").alias("ts")).collect()}
    assert got == {**TEXTS, None: None}


def test_iso_text(zoned):
    df = zoned.sql("SELECT DATE'2023-09-03' AS d, TIMESTAMP_NTZ'2023-09-03 00:00:00.25' AS ts")
    assert rows(df.select(dates.iso_text(F.col("d")), dates.iso_text(F.col("ts")))) == [
        ("2023-09-03 00:00:00", "2023-09-03 00:00:00")
    ]


def test_day_and_year_limits(zoned):
    df = zoned.sql("SELECT explode(sequence(0, 3)) AS i").withColumn(
        "ts", F.expr("element_at(array('2024-01-01 00:00:00', '2023-12-31 23:59:59', '2024-01-01 23:59:59', '2024-01-02'), i + 1)")
    )
    assert rows(df.filter(dates.falls_on(dates.as_ts("ts"), dt.date(2024, 1, 1))), "i") == [(0,), (2,)]
    none = F.lit(None).cast("timestamp_ntz")
    renewed = spells.renewal_ts(
        is_corporate=F.lit(True), quote_ts=dates.as_ts("ts"), conversion_ts=none, has_renewal=F.lit(False),
        history_ts=none, action_ts=none, enrolled_last_year=F.lit(True), as_of=dt.date(2024, 3, 15),
    )
    assert [r[0] for r in df.orderBy("i").select(renewed).collect()] == [
        dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 23, 59, 59), dt.datetime(2024, 1, 2),
    ]


def test_month_after():
    assert dates.month_after(dt.date(2023, 12, 31)) == dt.date(2024, 1, 1)
    assert dates.month_after(dt.date(2024, 1, 31)) == dt.date(2024, 2, 1)
