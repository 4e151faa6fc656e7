"""Whole runs: ingestion and mailings."""

import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortline import session
from cohortline.operators.keys import duplicate_keys
from cohortline.operators.journeys import SUBSCRIBED
from cohortline.plans import admissions as base
from cohortline.plans import ingestion, mailings, upkeep
from cohortline.operators import reporting
from cohortline.sources import schemas as s
from cohortline.sources.readers import read_runs
from cohortline.sources.state import BucketedState

AS_OF = dt.date(2024, 3, 15)
NOW = dt.datetime(2024, 3, 15, 7, 4, 24)
PILOTS = ("NPL2", "QLC", "SMH", "CCBA")


@pytest.fixture(scope="module")
def tables(spark):
    d, ts = dt.date, dt.datetime
    frame = spark.createDataFrame
    return base.OperationalTables(
        spells=frame(
            [
                (1, 1, "N1  ", 1, 1, 1, d(2024, 3, 10), None),
                (2, 2, "QLC", 2, 1, None, d(2024, 3, 11), d(2024, 12, 31)),
                (3, 3, "N1", 1, 9, 3, d(2024, 3, 12), None),
                (4, 4, "N1", 1, 1, 4, d(2023, 3, 1), None),
                (5, 5, "N9", 8, 1, None, d(2024, 3, 12), None),  # a child that is not on file
            ],
            s.SPELLS,
        ),
        children=frame(
            [
                (1, 11, 101, "Ana ", "Diaz", " ", 1000, d(2023, 1, 1), "F"),
                (2, 12, 102, "Leo", "O'Neil", "Paz", 2000, d(2023, 2, 1), "M"),
                (3, 13, None, "Eva", "Rey", None, 3000, None, None),
            ],
            s.CHILDREN,
        ),
        child_payers=frame([(1, 201), (1, 202), (2, 102), (5, 201), (5, 202)], s.CHILD_PAYERS),
        persons=frame(
            [
                (101, "Gia", "Diaz", "", 51, "Gia@Example.org  "),
                (102, "Hal", "O'Neil", "Paz", 52, "HAL@example.org"),
                (201, "Ina", "Diaz", None, 53, "ina@example.org"),
                (202, "Jon", "Diaz", None, 54, None),
            ],
            s.PERSONS,
        ),
        family_members=frame([(11, 101, 1), (11, 201, 2), (12, 102, 1)], s.FAMILY_MEMBERS),
        relations=frame([(1, "Mother  "), (2, "Father")], s.DESCRIPTIONS),
        service_status=frame([(1, "Active")], s.DESCRIPTIONS),
        centers=frame([("N1", "North"), ("QLC", "South ")], s.CENTERS),
        center_products=frame([(1, 1, 1, 71), (2, 1, 2, 72)], s.CENTER_PRODUCTS),
        levels=frame([(1, "Nursery ")], s.DESCRIPTIONS),
        shifts=frame([(1, "Morning"), (2, "Full ")], s.DESCRIPTIONS),
        company_services=frame([(2,)], s.COMPANY_SERVICES),
        quotes=frame([(1, ts(2024, 2, 20, 9)), (4, ts(2023, 2, 1))], s.QUOTES),
        renewals_history=frame([(1, 2023, ts(2023, 11, 2))], s.RENEWALS_HISTORY),
        action_history=frame([], s.ACTION_HISTORY),
        attendance=frame([(1, 1, 0, 0), (1, 0, 0, 1), (2, 0, 0, 0)], s.ATTENDANCE),
    )


def test_base(spark, tables):
    got = {(r.service_id, r.payer_id): r for r in base.admissions_base(tables, AS_OF).collect()}
    assert set(got) == {(1, 201), (1, 202), (2, 102), (3, None), (5, None)}
    one, two, three = got[1, 201], got[2, 102], got[3, None]
    assert got[5, None].child_full_name is None and got[5, None].payer_dni is None
    assert (one.child_full_name, one.payer_relation, one.guardian_email) == ("Ana Diaz", "Father", "gia@example.org")
    assert (one.center_id, one.center_name, one.level, one.shift, one.channel) == ("N1", "North", "Nursery", "Morning", "Familia")
    assert (one.last_enrollment_ts, one.last_renewal_ts) == (dt.datetime(2024, 2, 20, 9), dt.datetime(2023, 11, 2))
    assert (one.attendance_days, two.attendance_days, three.attendance_days) == (2, 0, 0)
    assert got[1, 202].payer_relation is None and got[1, 202].payer_email is None
    assert (two.channel, two.child_full_name, two.guardian_relation) == ("Empresa", "Leo O'Neil Paz", "Mother")
    assert (two.last_enrollment_ts, two.last_renewal_ts) == (dt.datetime(2024, 3, 11), dt.datetime(2024, 1, 1))
    assert (three.guardian_full_name, three.status, three.last_renewal_ts) == (None, None, None)
    assert list(one.asDict()) == base.BASE_COLUMNS and len(base.BASE_COLUMNS) == 28


def test_ingestion_sets_incomplete_rows_aside_and_is_idempotent(spark, tables):
    store = spark.createDataFrame([], s.ADMISSIONS)
    load = ingestion.ingest_admissions(tables, store, AS_OF, NOW, PILOTS)
    assert rows(load.loaded, "child_service_id", "child_financial_guardian_id") == [(1, 201), (1, 202), (2, 102)]
    missing = {r.child_service_id: r.reject_reason for r in load.rejected.collect()}
    assert set(missing) == {3, 5} and "child_financial_guardian_id" in missing[3]
    assert rows(load.log) == [("15/03/2024 07:04:24", 3)]
    assert duplicate_keys(load.state, ["child_service_id"]).count() == 0
    assert rows(load.state, "child_service_id", "flag_poc_center", "child_adaptation_scheduling_flag", "child_service_start_dt") == [
        (1, "false", "false", "2024-03-10 00:00:00"), (2, "true", "false", "2024-03-11 00:00:00"),
    ]
    documents = load.documents(size=2).collect()
    assert sorted(d.n_items for d in documents) == [1, 2]
    first = json.loads(min(documents, key=lambda d: d.batch_id).payload)["items"][0]
    assert list(first) == s.ADMISSION_COLUMNS and first["child_name"] == "Ana Diaz"

    kept = load.state.selectExpr("* EXCEPT (child_adaptation_scheduling_flag)", "'true' AS child_adaptation_scheduling_flag")
    again = ingestion.ingest_admissions(tables, kept.select(load.state.columns), AS_OF, NOW, PILOTS)
    assert rows(again.state, "child_service_id", "child_adaptation_scheduling_flag") == [(1, "true"), (2, "true")]


def test_mailings(spark, tables):
    published = base.published(base.admissions_base(tables, AS_OF), PILOTS)
    config = spark.createDataFrame(
        [("WEL", "Automatico", "7", "Team", "t@example.org", "Hello", "4"), ("REM", "Manual", "8", "Team", "t@example.org", "Hi", "2")],
        s.CAMPAIGN_CONFIG,
    )
    members = spark.createDataFrame([("list", "nobody@example.org")], "audience_id string, email_address string")
    run = mailings.welcome(published, config, members, "list", "WEL", AS_OF)
    assert run.sends_automatically
    assert rows(run.accepted, "child_service_id", "email") == [(2, "hal@example.org")]
    payload = json.loads(run.payloads.first().payload)
    assert payload == {"email_address": "hal@example.org", "status": SUBSCRIBED}
    assert rows(run.events, "process_email_key", "process_email_dt") == [("2-WEL", "2024-03-15")]
    listed = spark.createDataFrame([("list", "Hal@Example.org")], members.schema)
    assert mailings.welcome(published, config, listed, "list", "WEL", AS_OF).events.count() == 0

    scheduled = published.selectExpr(
        "* EXCEPT (child_adaptation_scheduling_flag, child_adaptation_scheduling_start_dt)",
        "'true' AS child_adaptation_scheduling_flag", "'13/3/2024 9:0:0' AS child_adaptation_scheduling_start_dt",
    )
    reminder = mailings.reminder(scheduled, config, members, "list", "REM", AS_OF)
    assert not reminder.sends_automatically
    assert rows(reminder.accepted, "child_service_id", "email") == [(1, "gia@example.org"), (2, "hal@example.org")]
    assert mailings.reminder(scheduled, config, members, "list", "REM", AS_OF, min_rows=3).accepted.count() == 0
    with pytest.raises(LookupError):
        mailings.reminder(scheduled, config, members, "list", "NONE", AS_OF)

    ended = published.selectExpr("*", "'13/03/2024 18:00:00' AS child_adaptation_end_process_dt")
    survey = mailings.survey(ended, config, members, "list", "REM", AS_OF, "child_adaptation_end_process_dt")
    assert json.loads(survey.payloads.first().payload)["merge_fields"]["TIPO"] == "REM"
    assert rows(survey.accepted, "email") == [("gia@example.org",), ("hal@example.org",)]
    # Service 1 has two payers, so it is due twice; its second row carries an address that the first already uses.
    assert rows(survey.rejected, "child_service_id", "reject_reason") == [(1, "repeated"), (3, "missing"), (5, "missing")]
    assert survey.accepted.count() + survey.rejected.count() == published.count()


def test_a_dangling_link_gives_no_id(spark, tables):
    """Payer 999 and guardian 998 are on no file: the links stay, the ids don't."""
    children = tables.children.union(spark.createDataFrame([(6, 16, 998, "Kim", "Lee", "", 6000, None, "F")], s.CHILDREN))
    payers = tables.child_payers.union(spark.createDataFrame([(6, 999)], s.CHILD_PAYERS))
    family = base.with_family(children.select("child_id"), children, payers)
    known = base.with_people(family, tables).filter("child_id IN (2, 6)")
    assert rows(known, "child_id", "payer_id", "payer_link", "guardian_id", "guardian_link") == [
        (2, 102, 102, 102, 102), (6, None, 999, None, 998),
    ]


def test_the_runs_work_on_what_the_load_stores(spark, tables):
    """From an empty table: load, marking, schedule, mailings and monitoring, no column added by hand."""
    load = ingestion.ingest_admissions(tables, spark.createDataFrame([], s.ADMISSIONS), AS_OF, NOW, PILOTS)
    state = session.staged(load.state, "state")
    assert sorted(state.columns) == sorted(s.ADMISSION_COLUMNS)
    config = spark.createDataFrame([("REM", "Manual", "8", "Team", "t@example.org", "Hi", "2")], s.CAMPAIGN_CONFIG)
    members = spark.createDataFrame([("list", "gia@example.org")], "audience_id string, email_address string")
    holidays = spark.createDataFrame([(dt.date(2024, 3, 14),)], s.HOLIDAYS)

    marked, calendar = upkeep.mark_overdue(state, spark.createDataFrame([], s.CALENDAR), AS_OF + dt.timedelta(days=30), holidays)
    assert rows(marked, "child_service_id", "child_adaptation_scheduling_start_dt", "interview_flag") == [
        (1, "31/12/2050 09:00:00", "Sin respuesta"), (2, "31/12/2050 09:00:00", "Sin respuesta"),
    ]
    assert rows(calendar, "child_service_id", "first_interview_flag") == [(1, "Sin respuesta"), (2, "Sin respuesta")]

    scheduled = state.selectExpr(
        *[c for c in state.columns if c not in ("child_adaptation_scheduling_flag", s.SCHEDULED_COLUMN, s.ENDED_COLUMN)],
        "'true' AS child_adaptation_scheduling_flag", f"'12/3/2024 9:0:0' AS {s.SCHEDULED_COLUMN}", f"'13/3/2024 9:0:0' AS {s.ENDED_COLUMN}",
    )
    reminder = mailings.reminder(scheduled, config, members, "list", "REM", AS_OF, holidays)
    assert rows(reminder.accepted, "email") == [("hal@example.org",)]
    assert rows(reminder.rejected, "email", "reject_reason") == [("gia@example.org", "member")]
    survey = mailings.survey(scheduled, config, members, "list", "REM", AS_OF)
    assert survey.accepted.count() + survey.rejected.count() == 2
    extract = reporting.monitoring_extract(scheduled, spark.createDataFrame([], s.JOURNEY_CONTROL))
    assert rows(extract, "child_service_id", "child_adaptation_scheduling_day") == [(1, 12), (2, 12)]


def test_refused_contacts_have_a_reason(spark):
    contacts = session.staged(
        spark.createDataFrame(
            [(1, "A@b.cl"), (2, "a@b.cl "), (2, "a@b.cl "), (3, "c@d.cl"), (4, "e@f.cl")], "child_service_id long, email string"
        ).withColumn("contact_id", F.monotonically_increasing_id()),
        "contacts",
    )
    members = spark.createDataFrame([("list", "C@d.cl"), ("other", "e@f.cl"), ("list", "c@D.cl")], "audience_id string, email_address string")
    judged = mailings.au.with_refusal(contacts, members, "list")
    assert rows(judged, "child_service_id", "reject_reason") == [(1, None), (2, "repeated"), (2, "repeated"), (3, "member"), (4, None)]
    accepted = mailings.au.new_members_only(contacts, members, "list")
    assert rows(judged.filter("reject_reason IS NULL"), "child_service_id") == rows(accepted, "child_service_id")


def test_a_finished_run_leaves_nothing(spark):
    own = spark.newSession()
    own.conf.set(session.RUN, "")
    session.staged(own.range(5), "some")
    folder = session.run_dir(own).removeprefix("file:")
    assert os.listdir(folder)
    session.drop_run(own)
    assert not os.path.exists(folder) and own.conf.get(session.RUN, None) is None


def test_the_job_that_stages_the_rows_counts_them(spark):
    kept, seen = session.staged_observed(spark.range(10), "counted", rows=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1))
    assert seen == {"rows": 10, "odd": 5} and kept.count() == 10
    assert session.staged_observed(spark.range(0), "counted", rows=F.count(F.lit(1)))[1] == {"rows": 0}
    assert session.staged_observed(spark.createDataFrame([], "a long").filter("false"), "counted", rows=F.count(F.lit(1)))[1] == {"rows": 0}


def test_a_load_is_counted_by_one_scan(spark, tables):
    """The log row needs no job: its plan has no scan, and equals a count of the loaded rows."""
    load = ingestion.ingest_admissions(tables, spark.createDataFrame([], s.ADMISSIONS), AS_OF, NOW, PILOTS)
    assert (load.rows, load.rejects) == (load.loaded.count() + load.rejected.count(), load.rejected.count())
    assert rows(load.log) == rows(reporting.ingestion_log_row(load.loaded, NOW))
    assert "Scan parquet" not in load.log._jdf.queryExecution().executedPlan().toString()


def test_a_load_stored_twice_changes_nothing(spark, tables):
    load = ingestion.ingest_admissions(tables, spark.createDataFrame([], s.ADMISSIONS), AS_OF, NOW, PILOTS)
    stored = spark.createDataFrame([], s.ADMISSIONS).select(load.incoming.columns)
    state = BucketedState.create(stored, session.landing(spark, "state"), ["child_service_id"], 8)
    log = session.landing(spark, "log")
    for _ in range(2):
        ingestion.store_load(load, state, log, "2024-03-15")
    assert rows(state.read()) == rows(load.state.select(state.read().columns))
    written = read_runs(spark, log, "data_ingestion_process_dt string, loaded_rows_value long")
    assert rows(written) == [("15/03/2024 07:04:24", 3, "2024-03-15")]
    ingestion.store_load(load, state, log, "2024-03-16")
    assert written.sparkSession.read.parquet(log).count() == 2
