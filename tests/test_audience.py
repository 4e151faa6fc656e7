import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortline.operators import audience as au
from cohortline.operators import journeys

AS_OF = dt.date(2024, 3, 15)  # a Friday
ADMISSIONS = (
    "child_service_id long, child_id long, child_name string, child_educational_guardian_id long, "
    "child_financial_guardian_email string, child_educational_guardian_email string, "
    "child_last_enrollment_dt string, child_adaptation_scheduling_start_dt string, "
    "child_adaptation_scheduling_end_dt string, child_adaptation_scheduling_flag string"
)


def admissions(spark, *changes):
    base = {
        "child_service_id": 1,
        "child_id": 10,
        "child_name": "Ana O'Neil",
        "child_educational_guardian_id": 100,
        "child_financial_guardian_email": "payer@example.org",
        "child_educational_guardian_email": "guardian@example.org",
        "child_last_enrollment_dt": "2024-03-13 08:30:00",
        "child_adaptation_scheduling_start_dt": "13/03/2024 09:00:00",
        "child_adaptation_scheduling_end_dt": "13/3/2024 9:5:7",
        "child_adaptation_scheduling_flag": "true",
    }
    made = [tuple({**base, "child_service_id": i, **c}.values()) for i, c in enumerate(changes, 1)]
    return spark.createDataFrame(made, ADMISSIONS)


def test_new_admissions_on_the_exact_day(spark):
    df = admissions(
        spark,
        {},
        {"child_last_enrollment_dt": "2024-03-13 23:59:59"},
        {"child_last_enrollment_dt": "2024-03-14 00:00:00"},
        {"child_last_enrollment_dt": "2024-03-12 23:59:59"},
        {"child_last_enrollment_dt": "2024-03-17 00:00:00"},
        {"child_last_enrollment_dt": None},
        {"child_last_enrollment_dt": "soon"},
    )
    due = au.new_admission_audience(df, AS_OF, 2, "WELCOME")
    assert rows(due, "child_service_id", "days_difference") == [(1, -2), (2, -2)]


def test_typed_enrolment_dates_work_too(spark):
    df = admissions(spark, {}).withColumn(
        "child_last_enrollment_dt", F.col("child_last_enrollment_dt").cast("timestamp_ntz")
    )
    assert au.new_admission_audience(df, AS_OF, 2, "W").count() == 1


def test_end_of_period_reads_both_text_forms(spark):
    df = admissions(
        spark,
        {},
        {"child_adaptation_scheduling_end_dt": "13/03/2024 00:00:00"},
        {"child_adaptation_scheduling_end_dt": ""},
        {"child_adaptation_scheduling_end_dt": "   "},
        {"child_adaptation_scheduling_end_dt": None},
        {"child_adaptation_scheduling_end_dt": "2024-03-13"},
    )
    due = au.end_of_period_audience(df, AS_OF, 2, "SURVEY")
    assert rows(due, "child_service_id", "adaptation_end_date", "email") == [
        (1, "13/03/2024", "guardian@example.org"),
        (2, "13/03/2024", "guardian@example.org"),
    ]


def test_working_days_skip_weekend_and_holiday(spark):
    dates = ["11/3/2024 8:0:0", "8/3/2024 8:0:0", "9/3/2024 8:0:0", "10/3/2024 8:0:0", "7/3/2024 8:0:0"]
    df = admissions(spark, *[{"child_adaptation_scheduling_start_dt": d} for d in dates])
    contacts = au.contacts_by_working_days(df, AS_OF, 4, "R")
    assert rows(contacts, "child_service_id") == [(1,), (3,), (4,)]
    contacts = au.contacts_by_working_days(df, AS_OF, 4, "R", [dt.date(2024, 3, 12)])
    assert rows(contacts, "child_service_id") == [(2,)]


def test_contacts_need_flag_and_address(spark):
    df = admissions(
        spark,
        {},
        {"child_adaptation_scheduling_flag": "false"},
        {"child_adaptation_scheduling_flag": None},
        {"child_educational_guardian_email": " "},
        {"child_educational_guardian_email": None},
    )
    contacts = au.contacts_by_working_days(df, AS_OF, 2, "R")
    assert contacts.columns == ["child_service_id", "current_date", "email", "tag", "campaign_code"]
    assert rows(contacts) == [(1, AS_OF, "guardian@example.org", "11010020240315", "R")]


def test_tag_with_unknown_guardian(spark):
    df = admissions(spark, {"child_educational_guardian_id": None, "child_id": -7})
    assert rows(au.with_tag(df, AS_OF, "R"), "tag") == [("1720240315",)]


def test_split_contacts(spark):
    good = ["a@b.cl", "A.b+c@d-e.example.org ", "o'neil@example.org"]
    bad = ["a@b", "a b@c.cl", "a@@b.cl", "@b.cl", "a@b.", "a@.cl", "plain"]
    df = spark.createDataFrame([(e,) for e in [*good, *bad, "", "  ", None]], "email string")
    accepted, rejected = au.split_contacts(df)
    assert {r.email for r in accepted.collect()} == set(good)
    reasons = {}
    for r in rejected.collect():
        reasons.setdefault(r.reject_reason, set()).add(r.email)
    assert reasons == {"invalid": set(bad), "missing": {"", "  ", None}}


def test_new_members_once_per_address_whatever_the_case(spark):
    contacts = spark.createDataFrame(
        [(3, "Ana@x.cl"), (2, "ana@X.cl "), (1, "listed@x.cl"), (4, "other@x.cl")], "child_service_id long, email string"
    )
    members = spark.createDataFrame(
        [("list", "LISTED@x.cl"), ("elsewhere", "other@x.cl")], "audience_id string, email_address string"
    )
    new = au.new_members_only(contacts, members, "list")
    assert rows(new) == [(2, "ana@X.cl "), (4, "other@x.cl")]


def test_gate(spark):
    df = spark.range(4)
    assert au.audience_gate(df, 3).count() == 4
    assert au.audience_gate(df, 4).count() == 0
    assert au.audience_gate(df.filter("id < 0")).count() == 0


def test_survey_audience_and_missing_type(spark):
    people = spark.createDataFrame([("a@x.cl", "2"), ("a@x.cl", "1"), ("b@x.cl", "3")], "email string, tag string")
    types = spark.createDataFrame([(13, "Adaptation"), (14, None)], "type_id int, name string")
    assert rows(au.survey_audience(people, types, 13)) == [("a@x.cl", "1", "Adaptation"), ("b@x.cl", "3", "Adaptation")]
    # The row exists, its name is unknown: an inner join would keep the people.
    assert rows(au.survey_audience(people, types, 14)) == [("a@x.cl", "1", None), ("b@x.cl", "3", None)]
    assert au.survey_audience(people, types, 15).count() == 0


def test_campaign_settings(spark):
    config = spark.createDataFrame(
        [("A", "Automatico", "77", "Team", "t@x.cl", "Hello", "5"), ("B", "Manual", "78", "Team", "t@x.cl", "Hi", "1")],
        "campaign_email_code string, automation_send_email_flag string, html_template_code string, "
        "email_from_name string, email_reply_to string, email_subject string, trigger_threshold_days string",
    )
    assert au.load_campaign(config, "A") == au.Campaign("A", "Automatico", 77, "Team", "t@x.cl", "Hello", 5)
    with pytest.raises(LookupError):
        au.load_campaign(config, "C")
    flags = config.select(au.sends_automatically(F.col("automation_send_email_flag")))
    assert rows(flags) == [(False,), (True,)]


def test_member_rows_merge_equal_addresses(spark):
    df = admissions(
        spark,
        {},
        {"child_financial_guardian_email": "guardian@example.org"},
        {"child_financial_guardian_email": None},
    )
    members = journeys.member_rows(au.with_tag(df, AS_OF, "W"))
    assert rows(members, "child_service_id", "email") == [
        (1, "guardian@example.org"),
        (1, "payer@example.org"),
        (2, "guardian@example.org"),
        (3, None),
        (3, "guardian@example.org"),
    ]


def test_payloads_and_events(spark):
    members = spark.createDataFrame(
        [(7, AS_OF, 'o"neil@x.cl', "tag'1", "W")],
        "child_service_id int, current_date date, email string, tag string, campaign_code string",
    )
    with_fields = journeys.member_payloads(members, "list").first()
    assert with_fields.payload == (
        '{"email_address":"o\\"neil@x.cl","status":"subscribed","merge_fields":{"TIPO":"W","TAG":"tag\'1"}}'
    )
    plain = journeys.member_payloads(members, "list", merge_fields=False).first()
    assert plain.payload == '{"email_address":"o\\"neil@x.cl","status":"subscribed"}'
    assert rows(journeys.journey_events(members)) == [("7-W", 7, "sent", "2024-03-15", "W", "tag'1")]
    control = journeys.journey_control_rows(members).first().asDict()
    assert control["child_service_id"] == 7 and control["child_adaptation_survey_tag"] == "tag'1"
    assert control["child_adaptation_survey_email_sent_flag"] == "true"
    assert len(control) == 12
