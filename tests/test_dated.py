"""Tables by date: which partitions and row groups a question reads, and the same answers as from text."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortline.functions.business_days import dates_counting
from cohortline.operators import audience as au
from cohortline.session import landing
from cohortline.sources import dated

AS_OF = dt.date(2024, 3, 15)
HOLIDAYS = [dt.date(2024, 3, 1), dt.date(2024, 2, 28)]
SCHEMA = (
    "child_service_id long, child_id long, child_name string, child_educational_guardian_id long, child_financial_guardian_email string, "
    "child_educational_guardian_email string, child_adaptation_scheduling_flag string, scheduled string"
)


@pytest.fixture(scope="module")
def admissions(spark):
    rng = random.Random(8)
    texts = [f"{d.day}/{d.month}/{d.year} 9:0:0" for d in (AS_OF + dt.timedelta(days=rng.randint(-90, 60)) for _ in range(400))]
    texts += [None, "", "31/2/2024 9:0:0", "soon"] * 20
    data = [(k, k, f"n{k}", k, f"p{k}@x.cl", rng.choice([f"g{k}@x.cl", "", None]), rng.choice(["true", "true", "false"]), t) for k, t in enumerate(texts)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def stored(spark, admissions):
    path = landing(spark, "dated")
    dated.write_dated(admissions, path, "scheduled", "child_service_id")
    return dated.read_dated(spark, path, admissions.schema)


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_come_back_with_their_typed_date(admissions, stored):
    assert rows(stored.select(admissions.columns)) == rows(admissions)
    assert dated.unparsed(stored).count() == 80
    assert stored.filter(f"{dated.EVENT_DATE} IS NULL AND {dated.EVENT_MONTH} IS NOT NULL").isEmpty()
    folders = {f.split("/")[-2] for f in dated.unparsed(stored).inputFiles()}
    assert "event_month=__HIVE_DEFAULT_PARTITION__" in folders


@pytest.mark.parametrize("convention", ["legacy", "modern"])
@pytest.mark.parametrize("days", [0, 1, 4, 9, 12])
def test_same_contacts_as_from_text(admissions, stored, days, convention):
    from_text = au.contacts_by_working_days(admissions, AS_OF, days, "R", HOLIDAYS, convention, "scheduled")
    counted = au.scheduled_contacts(admissions, AS_OF, days, "R", HOLIDAYS, convention, "scheduled")
    counted = counted.filter(f"send_email_flag = '{au.SEND}' AND trim(child_educational_guardian_email) <> ''")
    typed = au.contacts_by_working_days(stored, AS_OF, days, "R", HOLIDAYS, convention, dated.EVENT_DATE)
    assert rows(typed) == rows(from_text)
    assert rows(typed, "child_service_id") == rows(counted, "child_service_id")


def test_only_due_partitions_are_read(stored):
    due = au.contacts_by_working_days(stored, AS_OF, 4, "R", HOLIDAYS, date_col=dated.EVENT_DATE)
    text = plan(due)
    assert "PartitionFilters: [isnotnull(event_month" in text and "event_month#" in text.split("PartitionFilters: [")[1].split("]")[0]
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(event_date,2024-03-09)" in pushed and "LessThanOrEqual(event_date,2024-03-11)" in pushed
    first, last = dates_counting(AS_OF, -4, HOLIDAYS)
    assert (first, last) == (dt.date(2024, 3, 9), dt.date(2024, 3, 11))  # the weekend counts as its Monday does
    metrics = due._jdf.queryExecution().executedPlan()
    due.collect()
    scan = metrics.collectLeaves().apply(0)
    assert scan.metrics().apply("numPartitions").value() == 1


def test_windows_prune_while_running(spark, stored):
    windows = spark.createDataFrame(
        [("a", dt.date(2024, 3, 11), dt.date(2024, 3, 11)), ("b", dt.date(2024, 2, 20), dt.date(2024, 3, 12)), ("none", dt.date(2024, 3, 2), dt.date(2024, 3, 1)), ("null", None, None)],
        "code string, first_day date, last_day date",
    )
    due = dated.due_in_windows(stored, windows)
    want = [(r.child_service_id, w.code) for r in stored.collect() for w in windows.collect() if w.first_day and r.event_date and w.first_day <= r.event_date <= w.last_day]
    assert rows(due, "child_service_id", "code") == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])
    assert "dynamicpruning" in plan(dated.due_in_windows(stored, windows.withColumn("code", F.upper("code")).filter("code <> 'NONE'")))


def test_an_empty_table_and_a_hot_month(spark, admissions):
    path = landing(spark, "dated")
    dated.write_dated(admissions.limit(0), path, "scheduled", "child_service_id")
    assert dated.read_dated(spark, path, admissions.schema).count() == 0
    path = landing(spark, "dated")
    hot = admissions.withColumn("scheduled", F.lit("")).unionByName(admissions.limit(5)).repartition(4)
    dated.write_dated(hot, path, "scheduled", "child_service_id")
    kept = dated.read_dated(spark, path, admissions.schema)
    assert kept.count() == 485 and len(dated.unparsed(kept).inputFiles()) > 1
