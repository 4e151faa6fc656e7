"""Business days, audiences, contacts, members and their documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cohortline.functions import dates
from cohortline.functions.business_days import business_days_between, dates_counting
from cohortline.operators import audience as au
from cohortline.operators import journeys, slots
from cohortline.operators.holidays import CHILE, expanded, rule_table
from cohortline.plans import mailings
from cohortline.session import landing, staged
from cohortline.sources.dated import EVENT_DATE, EVENT_MONTH, due_in_windows, read_dated, write_dated
from workload import standins as st
from workload.registry import query

AS_OF = dt.date(1998, 6, 15)
OLDER_DATE = "child_adaptation_scheduling_dt"  # what older admissions call the date
CODE = "ENADAP"
CAMPAIGN = "Supplier#000000009"  # its threshold is nine days, in every scale factor
DAYS = 9
SURVEY_CAMPAIGN = "Supplier#000000006"
HOLIDAYS = [
    dt.date(1997, 12, 25), dt.date(1998, 1, 1), dt.date(1998, 5, 1), dt.date(1998, 5, 21),
    dt.date(1998, 5, 31), dt.date(1998, 6, 1), dt.date(1998, 6, 29), dt.date(1999, 1, 1),
]


def _holiday_table(spark):
    """The holidays as the table that a run reads."""
    return spark.createDataFrame([(h,) for h in HOLIDAYS], "holiday date")


_HOLIDAY_LIST = ", ".join(f"DATE '{h}'" for h in HOLIDAYS)


def _working_days(low: str, high: str) -> str:
    """Days of ``[low, high)`` counted one by one."""
    return (
        f"len(list_filter(generate_series({low}, {high} - INTERVAL 1 DAY, INTERVAL 1 DAY), "
        f"lambda d: isodow(d) < 6 AND CAST(d AS DATE) NOT IN ({_HOLIDAY_LIST})))"
    )


def _difference(event: str) -> str:
    today = "DATE '1998-06-15'"
    return (
        f"CAST(CASE WHEN {event} IS NULL THEN NULL WHEN {today} <= {event} THEN {_working_days(today, event)} "
        f"ELSE -{_working_days(event, today)} END AS INTEGER)"
    )


TAG = """replace(CAST(child_service_id AS VARCHAR) || CAST(child_id AS VARCHAR) ||
         coalesce(CAST(child_educational_guardian_id AS VARCHAR), '') || '1998-06-15', '-', '')"""
TEXT_DATE = "CAST(try_strptime({0}, '%d/%m/%Y %H:%M:%S') AS DATE)"
CONTACTS = f"""
    SELECT child_service_id, DATE '1998-06-15' AS "current_date", child_educational_guardian_email AS email,
           {TAG} AS tag, '{{code}}' AS campaign_code
    FROM admissions
    WHERE child_adaptation_scheduling_flag = 'true' AND trim(child_educational_guardian_email) <> ''
      AND {_difference(TEXT_DATE.format('child_adaptation_scheduling_dt'))} = -9"""
REMINDED = CONTACTS.format(code=CODE)
NEW = f"""
    SELECT child_service_id, child_id, child_name, child_educational_guardian_id, child_financial_guardian_email,
           child_educational_guardian_email, child_last_enrollment_dt, DATE '1998-06-06' AS event_date,
           CAST(-9 AS INTEGER) AS days_difference, DATE '1998-06-15' AS "current_date", {TAG} AS tag, '{{code}}' AS campaign_code
    FROM admissions WHERE CAST(CAST(child_last_enrollment_dt AS TIMESTAMP) AS DATE) - DATE '1998-06-15' = -9"""
MEMBER_ROWS = f"""
    SELECT child_service_id, "current_date", tag, campaign_code, child_educational_guardian_email AS email
    FROM ({NEW.format(code=CODE)})
    UNION ALL
    SELECT child_service_id, "current_date", tag, campaign_code, child_financial_guardian_email FROM ({NEW.format(code=CODE)})
    WHERE child_educational_guardian_email IS DISTINCT FROM child_financial_guardian_email"""
REASON = """CASE WHEN email IS NULL OR trim(email) = '' THEN 'missing'
         WHEN NOT regexp_full_match(trim(email), '[^@\\s]+@[^@\\s.]+(\\.[^@\\s.]+)+') THEN 'invalid' END"""


def _accepted(rows: str) -> str:
    return f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY lower(trim(email)) ORDER BY child_service_id, email) AS rn
        FROM ({rows}) WHERE {REASON} IS NULL)
    WHERE rn = 1 AND lower(trim(email)) NOT IN (SELECT lower(trim(email_address)) FROM members WHERE audience_id = 'journey')"""


EVERY_ADDRESS = """
    SELECT child_service_id, child_financial_guardian_email AS email FROM admissions
    UNION ALL SELECT child_service_id, child_educational_guardian_email FROM admissions"""


def _every_address(spark, sf_dir):
    stored = st.admissions(spark, sf_dir)
    both = F.array("child_financial_guardian_email", "child_educational_guardian_email")
    return stored.select("child_service_id", F.explode(both).alias("email"))


@query(f"SELECT service_id, {_difference('start_dt')} AS working_days FROM spells", "spells")
def business_days(spark, sf_dir):
    days = business_days_between(F.lit(AS_OF), F.col("start_dt"), HOLIDAYS)
    return st.spells(spark, sf_dir).select("service_id", days.alias("working_days"))


@query(
    f"""SELECT service_id, CAST(CASE WHEN end_dt IS NULL THEN NULL
           WHEN DATE '1998-06-15' <= end_dt THEN {_working_days("DATE '1998-06-15'", 'end_dt')}
           ELSE -{_working_days('(end_dt + 1)', "DATE '1998-06-16'")} END AS INTEGER) AS working_days FROM spells""",
    "spells",
)
def business_days_modern(spark, sf_dir):
    days = business_days_between(F.lit(AS_OF), F.col("end_dt"), HOLIDAYS, "modern")
    return st.spells(spark, sf_dir).select("service_id", days.alias("working_days"))


@query(NEW.format(code=CODE), "admissions")
def new_admission_audience(spark, sf_dir):
    return au.new_admission_audience(st.admissions(spark, sf_dir), AS_OF, DAYS, CODE)


@query(
    f"""SELECT child_service_id, child_id, child_name, child_educational_guardian_id, child_financial_guardian_email,
           child_educational_guardian_email AS email, child_adaptation_scheduling_end_dt, DATE '1998-06-06' AS event_date,
           CAST(-9 AS INTEGER) AS days_difference, strftime({TEXT_DATE.format('child_adaptation_scheduling_end_dt')}, '%d/%m/%Y') AS adaptation_end_date,
           DATE '1998-06-15' AS "current_date", {TAG} AS tag, 'ENADAP' AS campaign_code
    FROM admissions
    WHERE trim(child_adaptation_scheduling_end_dt) <> ''
      AND {TEXT_DATE.format('child_adaptation_scheduling_end_dt')} - DATE '1998-06-15' = -9""",
    "admissions",
)
def end_of_period_audience(spark, sf_dir):
    return au.end_of_period_audience(st.admissions(spark, sf_dir), AS_OF, DAYS, CODE)


@query(REMINDED, "admissions")
def contacts_by_working_days(spark, sf_dir):
    return au.contacts_by_working_days(st.admissions(spark, sf_dir), AS_OF, DAYS, CODE, HOLIDAYS, date_col=OLDER_DATE)


def _dated(spark, sf_dir):
    """Admissions stored by the month of their scheduled date."""
    path, stored = landing(spark, "dated"), st.admissions(spark, sf_dir)
    write_dated(stored, path, OLDER_DATE, "child_service_id")
    return read_dated(spark, path, stored.schema)


@query(REMINDED, "admissions")
def contacts_from_due_partitions(spark, sf_dir):
    return au.contacts_by_working_days(_dated(spark, sf_dir), AS_OF, DAYS, CODE, HOLIDAYS, date_col=EVENT_DATE)


@query(
    f"""SELECT child_service_id, campaign_email_code, event AS event_date
    FROM (SELECT child_service_id, {TEXT_DATE.format('child_adaptation_scheduling_dt')} AS event FROM admissions) a
    JOIN campaign_config c ON DATE '1998-06-15' - event = try_cast(c.trigger_threshold_days AS INTEGER)""",
    "admissions", "campaign_config",
)
def due_by_campaign(spark, sf_dir):
    """Every campaign with what is due for it today, from the partitions that any of them needs."""
    day = F.date_sub(F.lit(AS_OF), F.col("trigger_threshold_days").try_cast("int"))
    windows = st.campaign_config(spark, sf_dir).select("campaign_email_code", day.alias("first_day"), day.alias("last_day"))
    due = due_in_windows(_dated(spark, sf_dir).select("child_service_id", EVENT_DATE, EVENT_MONTH), windows)
    return due.select("child_service_id", "campaign_email_code", EVENT_DATE)


@query(
    f"""SELECT o_orderkey AS service_id, CAST(o_orderdate AS DATE) AS order_day FROM orders
    WHERE {_difference('CAST(o_orderdate AS DATE)')} BETWEEN -25 AND -20"""
)
def days_by_working_day_count(spark, sf_dir):
    """Orders 20 to 25 working days ago, by the range of days that count so many."""
    first, last = dates_counting(AS_OF, -25, HOLIDAYS)[0], dates_counting(AS_OF, -20, HOLIDAYS)[1]
    due = st.table(spark, sf_dir, "orders").filter(dates.falls_between(F.col("o_orderdate"), first, last))
    return due.select(F.col("o_orderkey").alias("service_id"), F.to_date("o_orderdate").alias("order_day"))


# The holidays of 1995 to 2001, written out by year where a law moved them.
PUBLISHED = """
    SELECT make_date(y, m, k) FROM generate_series(1995, 2001) t(y), (VALUES (1, 1, 2001), (5, 1, 2001), (5, 21, 2001), (6, 29, 1999), (8, 15, 2001),
        (9, 11, 1998), (9, 18, 2001), (9, 19, 2001), (10, 12, 1999), (11, 1, 2001), (12, 8, 2001), (12, 25, 2001)) f(m, k, until) WHERE y <= until
    UNION ALL SELECT make_date(y, m, k) + o FROM (VALUES (1995, 4, 16), (1996, 4, 7), (1997, 3, 30), (1998, 4, 12), (1999, 4, 4), (2000, 4, 23),
        (2001, 4, 15)) e(y, m, k), (VALUES (-2), (-1)) o(o)
    UNION ALL SELECT unnest([DATE '1995-06-15', DATE '1996-06-06', DATE '1997-05-29', DATE '1998-06-11', DATE '1999-06-03', DATE '2000-06-19', DATE '2001-06-11',
        DATE '2000-06-26', DATE '2001-07-02', DATE '2000-10-09', DATE '2001-10-15', DATE '1999-09-06', DATE '2000-09-04', DATE '2001-09-03'])"""
COUNTED_DAYS = f"""
    SELECT d, sum(CASE WHEN isodow(d) < 6 AND d NOT IN ({PUBLISHED}) THEN 1 ELSE 0 END) OVER (ORDER BY d) AS n
    FROM (SELECT CAST(unnest(generate_series(DATE '1994-12-31', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d)"""


@query(
    f"""SELECT o_orderkey AS service_id, CAST(today.n - own.n AS INTEGER) AS days_waited
    FROM orders JOIN ({COUNTED_DAYS}) own ON own.d = CAST(o_orderdate AS DATE) - 1
    JOIN ({COUNTED_DAYS}) today ON today.d = DATE '1998-06-14'"""
)
def working_days_by_rules(spark, sf_dir):
    """Working days since each order, by the holidays that the country's rules make of the years."""
    table = expanded(rule_table(spark, CHILE), 1995, 2001)
    days = business_days_between(F.to_date("o_orderdate"), F.lit(AS_OF), table)
    return st.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("service_id"), days.alias("days_waited"))


@query(
    f"""SELECT a.child_service_id, a.child_educational_guardian_email AS email,
           coalesce(j.child_adaptation_survey_tag, a.child_service_id || '-1998-06-15') AS tag,
           CASE WHEN j.child_service_id IS NOT NULL THEN 'ENADAP' END AS campaign_code
    FROM admissions a LEFT JOIN journey_control j ON j.child_service_id = a.child_service_id
    WHERE trim(a.child_adaptation_scheduling_dt) <> ''
      AND {TEXT_DATE.format('a.child_adaptation_scheduling_dt')} - DATE '1998-06-15' = -9""",
    "admissions", "journey_control",
)
def contacts_by_days(spark, sf_dir):
    tags = st.journey_control(spark, sf_dir).select(
        "child_service_id", F.col("child_adaptation_survey_tag").alias("tag"), F.lit(CODE).alias("campaign_code")
    )
    return au.contacts_by_days(st.admissions(spark, sf_dir), tags, AS_OF, DAYS, OLDER_DATE)


@query(
    f"""SELECT child_service_id, {TEXT_DATE.format('child_adaptation_scheduling_dt')} AS event_date,
           CAST({TEXT_DATE.format('child_adaptation_scheduling_dt')} - DATE '1998-06-15' AS INTEGER) AS days_difference,
           {_difference(TEXT_DATE.format('child_adaptation_scheduling_dt'))} AS working_days_difference,
           CASE WHEN {_difference(TEXT_DATE.format('child_adaptation_scheduling_dt'))} = -9 THEN 'Enviar' ELSE 'No enviar' END AS send_email_flag
    FROM admissions WHERE child_adaptation_scheduling_flag = 'true'""",
    "admissions",
)
def send_flag(spark, sf_dir):
    contacts = au.scheduled_contacts(st.admissions(spark, sf_dir), AS_OF, DAYS, CODE, HOLIDAYS, date_col=OLDER_DATE)
    return contacts.select(
        "child_service_id", "event_date", "days_difference", "working_days_difference", "send_email_flag"
    )


@query(f"SELECT child_service_id, {TAG} AS tag, 'ENADAP' AS campaign_code FROM admissions", "admissions")
def audience_tag(spark, sf_dir):
    tagged = au.with_tag(st.admissions(spark, sf_dir), AS_OF, CODE)
    return tagged.select("child_service_id", "tag", "campaign_code")


@query(
    f"""SELECT child_service_id, email FROM (
        SELECT *, row_number() OVER (PARTITION BY email ORDER BY child_service_id) AS rn FROM ({EVERY_ADDRESS}))
    WHERE rn = 1""",
    "admissions",
)
def dedupe_contacts(spark, sf_dir):
    return au.dedupe_contacts(_every_address(spark, sf_dir), "email", ["child_service_id"])


@query(
    f"SELECT child_service_id, email, {REASON} AS reject_reason FROM ({EVERY_ADDRESS}) WHERE {REASON} IS NOT NULL",
    "admissions",
)
def contact_quality(spark, sf_dir):
    _, rejected = au.split_contacts(_every_address(spark, sf_dir))
    return rejected


@query(f"SELECT child_service_id, email FROM ({EVERY_ADDRESS}) WHERE {REASON} IS NULL", "admissions")
def usable_contacts(spark, sf_dir):
    accepted, _ = au.split_contacts(_every_address(spark, sf_dir))
    return accepted


@query(
    f"""SELECT child_service_id, email, CASE WHEN m.address IS NOT NULL THEN 'member' ELSE 'repeated' END AS reject_reason
    FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(email)) ORDER BY child_service_id, email) AS place
          FROM ({EVERY_ADDRESS}) WHERE {REASON} IS NULL) c
    LEFT JOIN (SELECT DISTINCT lower(trim(email_address)) AS address FROM members WHERE audience_id = 'journey') m
      ON m.address = lower(trim(email))
    WHERE m.address IS NOT NULL OR place > 1
    UNION ALL SELECT child_service_id, email, {REASON} FROM ({EVERY_ADDRESS}) WHERE {REASON} IS NOT NULL""",
    "admissions", "members",
)
def rejected_contacts(spark, sf_dir):
    numbered = _every_address(spark, sf_dir).withColumn("contact_id", F.monotonically_increasing_id())
    usable, unusable = au.split_contacts(staged(numbered, "addresses"))
    refused = au.with_refusal(usable, st.members(spark, sf_dir), "journey").filter("reject_reason IS NOT NULL")
    return unusable.unionByName(refused).drop("contact_id")


@query(_accepted(EVERY_ADDRESS), "admissions", "members")
def new_members_only(spark, sf_dir):
    usable, _ = au.split_contacts(_every_address(spark, sf_dir))
    return au.new_members_only(usable, st.members(spark, sf_dir), "journey")


def _survey_tables(spark, sf_dir):
    recipients = st.admissions(spark, sf_dir).select(
        F.col("child_financial_guardian_email").alias("email"), F.col("child_service_id").cast("string").alias("tag")
    )
    return recipients, st.table(spark, sf_dir, "region").selectExpr("r_regionkey AS type_id", "r_name AS name")


@query(
    """SELECT u.email, u.tag, t.r_name AS campaign_code FROM (
        SELECT child_financial_guardian_email AS email, min(CAST(child_service_id AS VARCHAR)) AS tag FROM admissions GROUP BY 1) u
    JOIN region t ON t.r_regionkey = 3""",
    "admissions",
)
def survey_audience(spark, sf_dir):
    return au.survey_audience(*_survey_tables(spark, sf_dir), 3)


@query(
    "SELECT s.service_id, t.r_name FROM spells s JOIN region t ON t.r_regionkey = 3", "spells"
)
def constant_lookup_join(spark, sf_dir):
    every = st.spells(spark, sf_dir).select("service_id")
    return au.with_constant_lookup(every, st.table(spark, sf_dir, "region"), "r_regionkey", 3, "r_name")


@query(
    """SELECT campaign_email_code, automation_send_email_flag, CAST(html_template_code AS INTEGER) AS html_template_code,
           email_from_name, email_reply_to, email_subject, CAST(trigger_threshold_days AS INTEGER) AS trigger_threshold_days
    FROM campaign_config WHERE campaign_email_code = 'Supplier#000000009'""",
    "campaign_config",
)
def campaign_config_pick(spark, sf_dir):
    return au.campaign_config(st.campaign_config(spark, sf_dir), CAMPAIGN)


@query(f"SELECT * FROM ({REMINDED}) WHERE (SELECT count(*) FROM ({REMINDED})) > 3", "admissions")
def audience_gate(spark, sf_dir):
    contacts = au.contacts_by_working_days(st.admissions(spark, sf_dir), AS_OF, DAYS, CODE, HOLIDAYS, date_col=OLDER_DATE)
    return au.audience_gate(contacts, 3)


@query(MEMBER_ROWS, "admissions")
def member_rows(spark, sf_dir):
    due = au.new_admission_audience(st.admissions(spark, sf_dir), AS_OF, DAYS, CODE)
    return journeys.member_rows(due)


def _every_member(spark, sf_dir):
    """All stored admissions as members, no audience chosen."""
    tagged = au.with_tag(st.admissions(spark, sf_dir), AS_OF, CODE)
    return journeys.member_rows(tagged)


EVERY_MEMBER = f"""
    SELECT child_service_id, {TAG} AS tag, child_educational_guardian_email AS email FROM admissions
    UNION ALL SELECT child_service_id, {TAG}, child_financial_guardian_email FROM admissions
    WHERE child_educational_guardian_email IS DISTINCT FROM child_financial_guardian_email"""


@query(
    f"""SELECT 'journey' AS audience_id, child_service_id, email AS email_address, 'subscribed' AS status,
           'ENADAP' AS field_tipo, tag AS field_tag FROM ({EVERY_MEMBER})""",
    "admissions",
)
def member_payloads(spark, sf_dir):
    payloads = journeys.member_payloads(_every_member(spark, sf_dir), "journey")
    parsed = F.from_json(
        "payload", "email_address string, status string, merge_fields struct<TIPO: string, TAG: string>"
    )
    return payloads.select("audience_id", "child_service_id", parsed.alias("p")).select(
        "audience_id", "child_service_id", "p.email_address", "p.status",
        F.col("p.merge_fields.TIPO").alias("field_tipo"), F.col("p.merge_fields.TAG").alias("field_tag"),
    )


@query(
    f"""SELECT child_service_id || '-ENADAP' AS process_email_key, child_service_id, 'sent' AS process_email_step_value,
           '1998-06-15' AS process_email_dt, 'ENADAP' AS process_email_name, tag AS process_email_tag
    FROM ({EVERY_MEMBER})""",
    "admissions",
)
def journey_events(spark, sf_dir):
    return journeys.journey_events(_every_member(spark, sf_dir))


@query(
    f"""SELECT child_service_id, {TAG} AS child_adaptation_survey_tag, '1998-06-15' AS child_adaptation_survey_email_sent_dt,
           'true' AS child_adaptation_survey_email_sent_flag, 'false' AS child_adaptation_survey_email_read_flag,
           'false' AS child_adaptation_survey_completed_flag, 'false' AS child_welcome_email_sent_flag,
           'false' AS child_welcome_email_read_flag, '' AS child_welcome_email_sent_dt,
           'false' AS child_adaptation_scheduling_reminder_email_sent_flag,
           'false' AS child_adaptation_scheduling_reminder_email_read_flag,
           'false' AS child_adaptation_scheduling_reminder_email_dt
    FROM admissions""",
    "admissions",
)
def journey_control(spark, sf_dir):
    tagged = au.with_tag(st.admissions(spark, sf_dir), AS_OF, CODE)
    return journeys.journey_control_rows(tagged)


EVENT = """
    SELECT child_service_id || '-{code}' AS process_email_key, child_service_id, 'sent' AS process_email_step_value,
           '1998-06-15' AS process_email_dt, '{code}' AS process_email_name, tag AS process_email_tag FROM ({rows})"""


@query(
    EVENT.format(code=CAMPAIGN, rows=_accepted(CONTACTS.format(code=CAMPAIGN))), "admissions", "members"
)
def reminder_mailing(spark, sf_dir):
    return mailings.reminder(
        st.admissions(spark, sf_dir), st.campaign_config(spark, sf_dir), st.members(spark, sf_dir),
        "journey", CAMPAIGN, AS_OF, _holiday_table(spark), date_col=OLDER_DATE,
    ).events


@query(
    EVENT.format(code=CAMPAIGN, rows=_accepted(MEMBER_ROWS.replace(f"'{CODE}'", f"'{CAMPAIGN}'"))), "admissions", "members"
)
def welcome_mailing(spark, sf_dir):
    return mailings.welcome(
        st.admissions(spark, sf_dir), st.campaign_config(spark, sf_dir), st.members(spark, sf_dir),
        "journey", CAMPAIGN, AS_OF,
    ).events


@query(
    EVENT.format(
        code=SURVEY_CAMPAIGN,
        rows=_accepted(
            f"""SELECT child_service_id, {TAG} AS tag, child_educational_guardian_email AS email FROM admissions
            WHERE trim(child_adaptation_scheduling_end_dt) <> ''
              AND {TEXT_DATE.format('child_adaptation_scheduling_end_dt')} - DATE '1998-06-15' = -6"""
        ),
    ),
    "admissions", "members",
)
def survey_mailing(spark, sf_dir):
    return mailings.survey(
        st.admissions(spark, sf_dir), st.campaign_config(spark, sf_dir), st.members(spark, sf_dir),
        "journey", SURVEY_CAMPAIGN, AS_OF, "child_adaptation_scheduling_end_dt",
    ).events


@query(
    f"""SELECT 'journey' AS audience_id, u.email AS email_address, t.r_name AS field_tipo, u.tag AS field_tag FROM (
        SELECT child_financial_guardian_email AS email, min(CAST(child_service_id AS VARCHAR)) AS tag FROM admissions GROUP BY 1) u
    JOIN region t ON t.r_regionkey = 3
    WHERE {REASON} IS NULL AND lower(email) NOT IN (SELECT lower(email_address) FROM members WHERE audience_id = 'journey')""",
    "admissions", "members",
)
def view_survey_mailing(spark, sf_dir):
    payloads = mailings.view_survey(
        *_survey_tables(spark, sf_dir), 3, st.campaign_config(spark, sf_dir), st.members(spark, sf_dir), "journey", CAMPAIGN
    ).payloads
    parsed = F.from_json("payload", "email_address string, merge_fields struct<TIPO: string, TAG: string>")
    return payloads.select("audience_id", parsed.alias("p")).select(
        "audience_id", "p.email_address", F.col("p.merge_fields.TIPO").alias("field_tipo"),
        F.col("p.merge_fields.TAG").alias("field_tag"),
    )


@query(
    """SELECT d.slot, count(e.event_id) AS n_events
    FROM (SELECT strftime(m, '%H:%M') AS slot
          FROM generate_series(TIMESTAMP '2024-01-01 08:00:00', TIMESTAMP '2024-01-01 19:00:00', INTERVAL 15 MINUTE) g(m)) d
    LEFT JOIN events e ON strftime(time_bucket(INTERVAL 15 MINUTE, e.ts), '%H:%M') = d.slot
    GROUP BY d.slot"""
)
def time_slots(spark, sf_dir):
    """How many events fall into each slot of the day."""
    filled = st.table(spark, sf_dir, "events").groupBy(slots.slot_of(F.col("ts")).alias("slot")).count()
    every = slots.time_slots(spark).join(filled, "slot", "left")
    return every.select("slot", F.coalesce("count", F.lit(0)).alias("n_events"))
