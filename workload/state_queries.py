"""State tables: scans, column steps, scheduling, writes by key, documents, reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cohortline.functions import dates
from cohortline.functions.text import clean_email, full_name, in_list_flag
from cohortline.operators import columns, delivery, keys, migrate, outbox, reporting, scheduling
from cohortline.plans.admissions import LOAD_DEFAULTS
from cohortline.session import landing, staged, staged_observed
from cohortline.sources.readers import TableSpec, flatten_typed_items, read_records_json, read_runs, read_table
from cohortline.sources.state import BucketedState
from cohortline.sources.writers import append_rows, append_run, write_documents, write_extract
from workload import standins as st
from workload.audience_queries import AS_OF, HOLIDAYS, OLDER_DATE, TEXT_DATE, _difference
from workload.registry import query

PILOTS = ("N2", "N3", "N5", "N7")
OLDER_INTERVIEW = "first_interview_flag"


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-05'")
def scan_orders(spark, sf_dir):
    orders = read_table(spark, TableSpec("parquet", f"{sf_dir}/orders.parquet"))
    recent = orders.filter(F.col("o_orderdate") >= dates.midnight(dt.date(1998, 6, 5)))
    return recent.select("o_orderkey", "o_custkey", "o_orderdate")


@query(
    """SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value, value > 10 AS is_large,
           CAST(NULL AS VARCHAR) AS absent FROM events"""
)
def typed_items_flatten(spark, sf_dir):
    number = F.get_json_object("props", "$.k")
    tagged = F.struct(
        F.struct(F.col("event_id").cast("string").alias("N")).alias("event_id"),
        F.struct(F.col("event_type").alias("S")).alias("event_type"),
        F.struct(number.alias("N")).alias("k"),
        F.struct(F.col("value").cast("string").alias("N")).alias("value"),
        F.struct((F.col("value") > 10).alias("BOOL")).alias("is_large"),
    )
    items = st.table(spark, sf_dir, "events").select(F.to_json(tagged).alias("item"))
    schema = "event_id long, event_type string, k int, value double, is_large boolean, absent string"
    return flatten_typed_items(items, "item", schema)


@query(
    """SELECT service_id, 'false' AS child_adaptation_scheduling_flag, 'Sin comentarios' AS child_adaptation_scheduling_comment,
           '' AS child_adaptation_scheduling_start_dt, '' AS child_adaptation_responsible, 'false' AS interview_flag,
           '' AS child_interview_start_dt, '' AS child_interview_responsible, '' AS child_interview_end_dt,
           '' AS scheduling_channel_value, '' AS child_adaptation_scheduling_end_dt, '' AS center_interview_responsible
    FROM spells""",
    "spells",
)
def default_columns(spark, sf_dir):
    return columns.with_defaults(st.spells(spark, sf_dir).select("service_id"), LOAD_DEFAULTS)


@query(
    """SELECT child_service_id, CASE WHEN educational_center_code IN ('N2', 'N3', 'N5', 'N7') THEN 'true' ELSE 'false' END AS flag_poc_center
    FROM admissions""",
    "admissions",
)
def flag_in_list(spark, sf_dir):
    flag = in_list_flag(F.col("educational_center_code"), PILOTS)
    return st.admissions(spark, sf_dir).select("child_service_id", flag.alias("flag_poc_center"))


@query(
    """SELECT child_service_id, TRY_CAST(child_attendance_days_value AS BIGINT) AS child_attendance_days_value,
           TRY_CAST(child_adaptation_scheduling_dt AS INTEGER) AS child_adaptation_scheduling_dt,
           CAST(child_service_id AS INTEGER) AS short_id
    FROM admissions""",
    "admissions",
)
def cast_columns(spark, sf_dir):
    kept = st.admissions(spark, sf_dir).select(
        "child_service_id", "child_attendance_days_value", "child_adaptation_scheduling_dt",
        F.col("child_service_id").alias("short_id"),
    )
    wanted = {"child_attendance_days_value": "long", "child_adaptation_scheduling_dt": "int", "short_id": "int"}
    return columns.try_casts(kept, wanted)


@query(
    """SELECT child_service_id, child_name, child_educational_guardian_email FROM admissions
    WHERE trim(child_educational_guardian_email) <> ''""",
    "admissions",
)
def nonblank_filter(spark, sf_dir):
    kept = columns.require_nonblank(st.admissions(spark, sf_dir), "child_educational_guardian_email")
    return kept.select("child_service_id", "child_name", "child_educational_guardian_email")


@query(
    """SELECT child_service_id, child_id, 'child_educational_guardian_id' AS reject_reason FROM admissions
    WHERE child_educational_guardian_id IS NULL""",
    "admissions",
)
def rejected_rows(spark, sf_dir):
    required = ["child_service_id", "child_id", "child_educational_guardian_id"]
    _, rejected = columns.split_on_required(st.admissions(spark, sf_dir), required)
    return rejected.select("child_service_id", "child_id", "reject_reason")


@query(
    """SELECT child_id, rtrim(first_name) || ' ' || rtrim(last_name) ||
           CASE WHEN rtrim(second_last_name) <> '' THEN ' ' || rtrim(second_last_name) ELSE '' END AS full_name,
           length(last_name) AS padded_length, substr(last_name, 1, 10) AS first_ten, contains(last_name, '12') AS has_12,
           replace(CAST(birth_dt AS VARCHAR), '-', '') AS compact_birth, lower(gender) AS gender
    FROM children""",
    "children",
)
def scalar_text(spark, sf_dir):
    name = full_name(F.col("first_name"), F.col("last_name"), F.col("second_last_name"))
    return st.children(spark, sf_dir).select(
        "child_id",
        name.alias("full_name"),
        F.length("last_name").cast("long").alias("padded_length"),
        F.substring("last_name", 1, 10).alias("first_ten"),
        F.col("last_name").contains("12").alias("has_12"),
        F.translate(F.col("birth_dt").cast("string"), "-", "").alias("compact_birth"),
        clean_email(F.col("gender")).alias("gender"),
    )


@query(
    """SELECT service_id, strftime(start_dt, '%Y%m') AS start_month, strftime(start_dt, '%Y%m%d') AS start_day,
           CAST(year(start_dt) AS INTEGER) AS start_year, CAST(month(start_dt) AS INTEGER) AS month_no, CAST(day(start_dt) AS INTEGER) AS day_no,
           CAST(end_dt - start_dt AS INTEGER) AS length_days, start_dt + 14 AS two_weeks_on,
           CAST(start_dt - INTERVAL 1 MONTH AS DATE) AS month_before, coalesce(end_dt, DATE '3000-01-01') AS open_end,
           CAST(start_dt - DATE '1998-06-15' AS INTEGER) AS days_difference, strftime(start_dt, '%-d/%-m/%Y %-H:%-M:%-S') AS unpadded,
           strftime(start_dt, '%Y%-m%-d') AS unpadded_day
    FROM spells""",
    "spells",
)
def scalar_dates(spark, sf_dir):
    start = F.col("start_dt")
    return st.spells(spark, sf_dir).select(
        "service_id",
        F.date_format(start, "yyyyMM").alias("start_month"),
        F.date_format(start, "yyyyMMdd").alias("start_day"),
        F.year(start).alias("start_year"),
        F.month(start).alias("month_no"),
        F.day(start).alias("day_no"),
        F.datediff("end_dt", start).alias("length_days"),
        F.date_add(start, 14).alias("two_weeks_on"),
        F.add_months(start, -1).alias("month_before"),
        dates.open_end("end_dt").alias("open_end"),
        dates.days_from(AS_OF, start).alias("days_difference"),
        F.date_format(start, dates.TEXT_TS).alias("unpadded"),
        F.date_format(start, "yyyyMd").alias("unpadded_day"),
    )


@query(
    """SELECT child_service_id, try_strptime(child_adaptation_scheduling_dt, '%d/%m/%Y %H:%M:%S') AS scheduled_ts,
           try_strptime(child_adaptation_scheduling_end_dt, '%d/%m/%Y %H:%M:%S') AS ended_ts,
           CAST(child_last_enrollment_dt AS TIMESTAMP) AS enrolled_ts
    FROM admissions""",
    "admissions",
)
def parse_text_timestamps(spark, sf_dir):
    return st.admissions(spark, sf_dir).select(
        "child_service_id",
        dates.parse_text_ts("child_adaptation_scheduling_dt").alias("scheduled_ts"),
        dates.parse_text_ts("child_adaptation_scheduling_end_dt").alias("ended_ts"),
        dates.as_ts("child_last_enrollment_dt").alias("enrolled_ts"),
    )


@query(
    """SELECT a.child_service_id, a.educational_center_code,
           CASE WHEN c.child_adaptation_responsible = 'No agendado' THEN 'wasnt scheduled'
                WHEN c.child_adaptation_scheduling_dt IS NOT NULL THEN 'true' ELSE 'false' END AS child_adaptation_scheduling_flag,
           coalesce(c.child_adaptation_scheduling_comment, 'Sin comentarios') AS child_adaptation_scheduling_comment,
           coalesce(c.child_adaptation_scheduling_dt, '') AS child_adaptation_scheduling_dt,
           coalesce(c.child_adaptation_responsible, '') AS child_adaptation_responsible,
           coalesce(c.first_interview_flag, '') AS first_interview_flag,
           CASE WHEN a.educational_center_code IN ('N2', 'N3', 'N5', 'N7') THEN 'true' ELSE 'false' END AS flag_poc_center
    FROM admissions a LEFT JOIN calendar c ON c.child_service_id = a.child_service_id""",
    "admissions", "calendar",
)
def scheduling_state(spark, sf_dir):
    loaded = st.admissions(spark, sf_dir).select("child_service_id", "educational_center_code")
    return scheduling.scheduling_state(loaded, st.calendar(spark, sf_dir), PILOTS)


@query(
    """SELECT child_service_id, CASE WHEN child_adaptation_scheduling_dt IS NOT NULL THEN 'true' ELSE 'false' END AS scheduled
    FROM calendar""",
    "calendar",
)
def two_state_flag(spark, sf_dir):
    scheduled = scheduling.two_state_flag(F.col("child_adaptation_scheduling_dt"))
    return st.calendar(spark, sf_dir).select("child_service_id", scheduled.alias("scheduled"))


OVERDUE = f"""(child_adaptation_scheduling_flag = 'false' AND (
    {_difference('CAST(CAST(child_service_start_dt AS TIMESTAMP) AS DATE)')} <= -10 OR CAST(child_attendance_days_value AS INTEGER) >= 6))"""


@query(
    f"""SELECT child_service_id,
           CASE WHEN {OVERDUE} THEN '31/12/2050 09:00:00' ELSE child_adaptation_scheduling_dt END AS child_adaptation_scheduling_dt,
           CASE WHEN {OVERDUE} THEN 'No agendado' ELSE child_adaptation_responsible END AS child_adaptation_responsible,
           CASE WHEN {OVERDUE} THEN 'Adaptación no agendada por aplicación' ELSE child_adaptation_scheduling_comment END AS child_adaptation_scheduling_comment,
           CASE WHEN {OVERDUE} THEN 'Sin respuesta' ELSE first_interview_flag END AS first_interview_flag,
           CASE WHEN {OVERDUE} THEN 'wasnt scheduled' ELSE child_adaptation_scheduling_flag END AS child_adaptation_scheduling_flag
    FROM admissions""",
    "admissions",
)
def mark_unscheduled(spark, sf_dir):
    marked, _ = scheduling.mark_unscheduled(st.admissions(spark, sf_dir), AS_OF, HOLIDAYS, date_col=OLDER_DATE, interview_col=OLDER_INTERVIEW)
    return marked.select("child_service_id", *scheduling.unscheduled_values(OLDER_DATE, OLDER_INTERVIEW))


@query(
    f"""SELECT coalesce(c.child_service_id, o.child_service_id) AS child_service_id,
           CASE WHEN o.child_service_id IS NOT NULL THEN 'No agendado' ELSE c.child_adaptation_responsible END AS child_adaptation_responsible,
           CASE WHEN o.child_service_id IS NOT NULL THEN '31/12/2050 09:00:00' ELSE c.child_adaptation_scheduling_dt END AS child_adaptation_scheduling_dt,
           CASE WHEN o.child_service_id IS NOT NULL THEN 'Sin respuesta' ELSE c.first_interview_flag END AS first_interview_flag,
           CASE WHEN o.child_service_id IS NOT NULL THEN 'Adaptación no agendada por aplicación' ELSE c.child_adaptation_scheduling_comment END AS child_adaptation_scheduling_comment
    FROM calendar c FULL JOIN (SELECT child_service_id FROM admissions WHERE {OVERDUE}) o ON o.child_service_id = c.child_service_id""",
    "admissions", "calendar",
)
def calendar_after_marking(spark, sf_dir):
    _, rows = scheduling.mark_unscheduled(st.admissions(spark, sf_dir), AS_OF, HOLIDAYS, date_col=OLDER_DATE, interview_col=OLDER_INTERVIEW)
    return scheduling.calendar_with(st.calendar(spark, sf_dir), rows)


# Writes by key: all orders are on one side or on both; those of a priority that both name are matched.
STORED = """SELECT o_orderkey AS child_service_id, o_custkey AS child_id, 'stored' AS origin,
    o_totalprice AS amount FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')"""
INCOMING = """SELECT o_orderkey AS child_service_id, o_custkey AS child_id, 'incoming' AS origin,
    CASE WHEN o_orderstatus <> 'P' THEN o_totalprice + 1 END AS amount
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM', '4-NOT SPECIFIED')"""


def _stored(spark, sf_dir):
    return st.table(spark, sf_dir, "orders").filter("o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')").selectExpr(
        "o_orderkey AS child_service_id", "o_custkey AS child_id", "'stored' AS origin",
        "o_totalprice AS amount",
    )


def _incoming(spark, sf_dir):
    return st.table(spark, sf_dir, "orders").filter("o_orderpriority IN ('1-URGENT', '3-MEDIUM', '4-NOT SPECIFIED')").selectExpr(
        "o_orderkey AS child_service_id", "o_custkey AS child_id", "'incoming' AS origin",
        "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice + 1 END AS amount",
    )


KEY = ["child_service_id"]


@query(
    f"""WITH t AS ({STORED}), i AS ({INCOMING})
    SELECT * FROM t WHERE child_service_id NOT IN (SELECT child_service_id FROM i) UNION ALL SELECT * FROM i"""
)
def upsert_replace(spark, sf_dir):
    return keys.upsert_replace(_stored(spark, sf_dir), _incoming(spark, sf_dir), KEY)


@query(
    f"""WITH t AS ({STORED}), i AS ({INCOMING})
    SELECT * FROM t UNION ALL SELECT * FROM i WHERE child_service_id NOT IN (SELECT child_service_id FROM t)"""
)
def upsert_insert_only(spark, sf_dir):
    return keys.upsert_insert_only(_stored(spark, sf_dir), _incoming(spark, sf_dir), KEY)


@query(
    f"""WITH t AS ({STORED}), i AS ({INCOMING})
    SELECT t.child_service_id, t.child_id, t.origin, CASE WHEN i.child_service_id IS NOT NULL THEN i.amount ELSE t.amount END AS amount
    FROM t LEFT JOIN i ON i.child_service_id = t.child_service_id"""
)
def upsert_patch(spark, sf_dir):
    return keys.upsert_patch(_stored(spark, sf_dir), _incoming(spark, sf_dir), KEY, ["amount"])


@query(
    f"""WITH t AS ({STORED}), i AS ({INCOMING}),
    put AS (SELECT * FROM t WHERE child_service_id NOT IN (SELECT child_service_id FROM i WHERE child_service_id % 10 = 3)
            UNION ALL SELECT * FROM i WHERE child_service_id % 10 = 3),
    patched AS (SELECT p.child_service_id, p.child_id, p.origin,
                       CASE WHEN i.child_service_id IS NOT NULL THEN i.amount ELSE p.amount END AS amount
                FROM put p LEFT JOIN i ON i.child_service_id = p.child_service_id AND i.child_id % 5 = 0)
    SELECT * FROM patched UNION ALL SELECT * FROM i WHERE child_service_id NOT IN (SELECT child_service_id FROM patched)"""
)
def bucketed_state(spark, sf_dir):
    """A stored state in buckets after a put, a patch and an insert by three loads, read back by its last manifest."""
    incoming = _incoming(spark, sf_dir)
    state = BucketedState.create(_stored(spark, sf_dir), _landing(spark, "bucketed"), KEY, buckets=16)
    state.replace(incoming.filter("child_service_id % 10 = 3"))
    state.patch(incoming.filter("child_id % 5 = 0").select(*KEY, "amount"), ["amount"])
    state.insert(incoming)
    return state.read()


DOCUMENT_COLUMNS = ["child_service_id", "child_name", "child_educational_guardian_id", "child_adaptation_scheduling_comment"]
DOCUMENT_SCHEMA = (
    "child_service_id long, child_name string, child_educational_guardian_id long, "
    "child_adaptation_scheduling_comment string"
)


def _landing(spark, label):
    """A new folder in the shared place for files that a query writes and reads back."""
    return landing(spark, label)


@query(f"SELECT {', '.join(DOCUMENT_COLUMNS)} FROM admissions", "admissions")
def records_json_scan(spark, sf_dir):
    """Records landed as JSON lines, read with a fixed schema."""
    path = _landing(spark, "records")
    record = F.to_json(F.struct(*DOCUMENT_COLUMNS)).alias("payload")
    write_documents(st.admissions(spark, sf_dir).select(record), path)
    return read_records_json(spark, path, DOCUMENT_SCHEMA, array_files=False)


@query(f"SELECT {', '.join(DOCUMENT_COLUMNS)} FROM admissions", "admissions")
def records_array_scan(spark, sf_dir):
    """Records landed as JSON arrays, a file for each range of ids."""
    path = _landing(spark, "arrays")
    part = F.expr("child_service_id div 20000")
    records = st.admissions(spark, sf_dir).groupBy(part).agg(F.collect_list(F.struct(*DOCUMENT_COLUMNS)).alias("records"))
    write_documents(records.select(F.to_json("records").alias("payload")), path, records_per_file=1)
    return read_records_json(spark, path, DOCUMENT_SCHEMA, array_files=True)


@query(
    """SELECT child_service_id, child_name, nullif(child_adaptation_scheduling_dt, '') AS child_adaptation_scheduling_dt,
           child_attendance_days_value FROM admissions""",
    "admissions",
)
def csv_extract_scan(spark, sf_dir):
    """An extract with a header, read back; CSV has one form for NULL and for empty text."""
    path = _landing(spark, "extract")
    kept = ["child_service_id", "child_name", "child_adaptation_scheduling_dt", "child_attendance_days_value"]
    write_extract(st.admissions(spark, sf_dir).select(*kept), path)
    schema = "child_service_id long, child_name string, child_adaptation_scheduling_dt string, child_attendance_days_value string"
    return columns.blank_to_null(read_table(spark, TableSpec("csv", path, schema)), ["child_adaptation_scheduling_dt"])


@query(
    """SELECT '15/06/1998 07:04:24' AS data_ingestion_process_dt, count(*) AS loaded_rows_value FROM orders
    UNION ALL SELECT '16/06/1998 07:04:24', count(*) FROM lineitem"""
)
def append_log(spark, sf_dir):
    """Two loads, each adding its row to the log."""
    path = _landing(spark, "log")
    for day, name in ((15, "orders"), (16, "lineitem")):
        row = reporting.ingestion_log_row(st.table(spark, sf_dir, name), dt.datetime(1998, 6, day, 7, 4, 24))
        append_rows(row, path)
    return read_table(spark, TableSpec("parquet", path))


@query(
    """SELECT '15/06/1998 07:04:24' AS data_ingestion_process_dt, count(*) AS loaded_rows_value, 'orders-15' AS run_id FROM orders
    UNION ALL SELECT '16/06/1998 07:04:24', count(*), 'lineitem-16' FROM lineitem"""
)
def append_log_again(spark, sf_dir):
    """Two loads, of which the first runs twice: its row is there once."""
    path = _landing(spark, "runs")
    for day, name in ((15, "orders"), (16, "lineitem"), (15, "orders")):
        rows, seen = staged_observed(st.table(spark, sf_dir, name), "load", rows=F.count(F.lit(1)))
        row = reporting.counted_log_row(spark, seen["rows"], dt.datetime(1998, 6, day, 7, 4, 24))
        append_run(row, path, f"{name}-{day}")
    return read_runs(spark, path, "data_ingestion_process_dt string, loaded_rows_value long")


@query(f"SELECT {', '.join(DOCUMENT_COLUMNS)} FROM admissions", "admissions")
def outbox_items(spark, sf_dir):
    documents = outbox.outbox_items(st.admissions(spark, sf_dir), DOCUMENT_COLUMNS)
    parsed = F.from_json("payload", f"item struct<{DOCUMENT_SCHEMA}>")
    return documents.select(parsed.alias("p")).select("p.item.*")


@query(
    f"""SELECT batch_id, count(*) OVER (PARTITION BY batch_id) AS n_items, position, {', '.join(DOCUMENT_COLUMNS)}
    FROM (SELECT *, (row_number() OVER (ORDER BY child_service_id) - 1) // 300 AS batch_id,
                 CAST((row_number() OVER (ORDER BY child_service_id) - 1) % 300 AS INTEGER) AS position FROM admissions)""",
    "admissions",
)
def outbox_batches(spark, sf_dir):
    """Batches of 300, read back from their documents row by row."""
    batches = outbox.outbox_batches(st.admissions(spark, sf_dir), KEY, columns=DOCUMENT_COLUMNS)
    parsed = F.from_json("payload", f"items array<struct<{DOCUMENT_SCHEMA}>>")
    rows = batches.select("batch_id", "n_items", F.posexplode(parsed["items"]).alias("position", "item"))
    return rows.select("batch_id", "n_items", "position", "item.*")


@query(
    """SELECT batch_id, count(*) AS n_items, CAST(CASE WHEN batch_id % 3 = 1 THEN 2 ELSE 0 END AS BIGINT) AS n_attempts, batch_id % 3 = 1 AS given_up
    FROM (SELECT (row_number() OVER (ORDER BY child_service_id) - 1) // 300 AS batch_id FROM admissions)
    WHERE batch_id % 3 > 0 AND batch_id % 7 <> 1 GROUP BY batch_id""",
    "admissions",
)
def undelivered_batches(spark, sf_dir):
    """Batches still to send after a run with gaps: every third arrived, a third failed twice, some of these arrived after all, the others were never tried."""
    batches = delivery.keyed_batches(outbox.outbox_batches(st.admissions(spark, sf_dir), KEY, columns=DOCUMENT_COLUMNS))
    stored = staged(batches, "batches")
    path = _landing(spark, "ledger")
    tried = stored.select("batch_key", "batch_id", F.lit(dt.datetime(1998, 6, 15, 8)).cast("timestamp_ntz").alias("attempted_ts"))
    first = tried.withColumn("status", F.when(F.expr("batch_id % 3 = 0"), delivery.SENT).when(F.expr("batch_id % 3 = 1"), delivery.FAILED))
    append_run(first.filter("status IS NOT NULL").drop("batch_id"), path, "morning")
    again = first.filter("status = 'failed' OR batch_id % 7 = 1").withColumn("status", F.when(F.expr("batch_id % 7 = 1"), delivery.SENT).otherwise(delivery.FAILED))
    append_run(again.drop("batch_id"), path, "noon")
    ledger = read_runs(spark, path, delivery.LEDGER)
    return delivery.due_again(stored, ledger, max_attempts=2).select("batch_id", "n_items", "n_attempts", "given_up")



@query(
    """SELECT educational_center_code, count(*) AS adaptations_total_Q,
           CAST(sum(CASE WHEN child_adaptation_scheduling_flag = 'wasnt scheduled' THEN 1 ELSE 0 END) AS BIGINT) AS adaptations_not_schedulled_flag,
           CAST(sum(CASE WHEN child_adaptation_scheduling_flag = 'true' THEN 1 ELSE 0 END) AS BIGINT) AS adaptations_schedulled_flag
    FROM admissions GROUP BY educational_center_code""",
    "admissions",
)
def scheduling_indicators(spark, sf_dir):
    return reporting.scheduling_indicators(st.admissions(spark, sf_dir))


SCHEDULED_TS = "try_strptime(a.child_adaptation_scheduling_dt, '%d/%m/%Y %H:%M:%S')"


@query(
    f"""SELECT a.child_service_id, a.child_adaptation_scheduling_flag, CAST(1 AS INTEGER) AS adaptations_total_Q,
           CAST(CASE WHEN a.child_adaptation_scheduling_flag = 'wasnt scheduled' THEN 1 ELSE 0 END AS INTEGER) AS adaptations_not_schedulled_flag,
           CAST(CASE WHEN a.child_adaptation_scheduling_flag = 'true' THEN 1 ELSE 0 END AS INTEGER) AS adaptations_schedulled_flag,
           {SCHEDULED_TS} AS child_adaptation_scheduling_dt, CAST({SCHEDULED_TS} AS DATE) AS child_adaptation_scheduling_date,
           CAST(day({SCHEDULED_TS}) AS INTEGER) AS child_adaptation_scheduling_day,
           CAST(month({SCHEDULED_TS}) AS INTEGER) AS child_adaptation_scheduling_month,
           CAST(year({SCHEDULED_TS}) AS INTEGER) AS child_adaptation_scheduling_year,
           coalesce(child_adaptation_survey_email_sent_flag, 'false') AS child_adaptation_survey_email_sent_flag,
           coalesce(child_adaptation_survey_email_read_flag, 'false') AS child_adaptation_survey_email_read_flag,
           coalesce(child_adaptation_survey_completed_flag, 'false') AS child_adaptation_survey_completed_flag,
           coalesce(child_adaptation_survey_tag, 'false') AS child_adaptation_survey_tag,
           coalesce(child_adaptation_survey_email_sent_dt, '') AS child_adaptation_survey_email_sent_dt,
           coalesce(child_welcome_email_sent_flag, 'false') AS child_welcome_email_sent_flag,
           coalesce(child_welcome_email_read_flag, 'false') AS child_welcome_email_read_flag,
           coalesce(child_welcome_email_sent_dt, '') AS child_welcome_email_sent_dt,
           coalesce(child_adaptation_scheduling_reminder_email_sent_flag, 'false') AS child_adaptation_scheduling_reminder_email_sent_flag,
           coalesce(child_adaptation_scheduling_reminder_email_read_flag, 'false') AS child_adaptation_scheduling_reminder_email_read_flag,
           coalesce(child_adaptation_scheduling_reminder_email_dt, '') AS child_adaptation_scheduling_reminder_email_dt
    FROM admissions a LEFT JOIN journey_control j ON j.child_service_id = a.child_service_id""",
    "admissions", "journey_control",
)
def monitoring_extract(spark, sf_dir):
    kept = st.admissions(spark, sf_dir).select(
        "child_service_id", "child_adaptation_scheduling_flag", "child_adaptation_scheduling_dt"
    )
    return reporting.monitoring_extract(kept, st.journey_control(spark, sf_dir), OLDER_DATE)


@query(
    """SELECT CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS data_ingestion_process_dt,
           event_id AS loaded_rows_value FROM events"""
)
def ingestion_log(spark, sf_dir):
    return reporting.ingestion_log(st.ingestion_log(spark, sf_dir))


REPORT = """
    SELECT o_orderkey AS campaign_web_id, 'sent' AS campaign_status, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS campaign_create_date,
           'list' || o_custkey AS list_id, o_orderpriority = '1-URGENT' AS list_is_active, 'Audience ' || o_custkey AS list_name,
           o_orderkey % 500 AS list_total_contacts,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN 'About ' || o_orderkey ELSE '' END AS email_subject,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'Encuesta ' ELSE 'Adaptación ' END || o_orderkey AS campaign_title,
           CASE WHEN o_orderpriority <> '5-LOW' THEN 'Team' ELSE '' END AS campaign_from_name,
           CASE WHEN o_orderpriority <> '5-LOW' THEN 'team@example.org' ELSE '' END AS campaign_reply_to,
           o_orderkey % 7 AS campaign_template_id,
           CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 90 ELSE 0 END AS report_opens_value,
           CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 40 ELSE 0 END AS report_unique_opens_value,
           CAST(CASE WHEN o_orderstatus = 'F' THEN (o_orderkey % 8) / 8 ELSE 0 END AS DOUBLE) AS report_open_rate,
           CAST(CASE WHEN o_orderstatus = 'F' THEN (o_orderkey % 4) / 4 ELSE 0 END AS DOUBLE) AS report_click_rate
    FROM orders"""


@query(REPORT)
def campaign_report_flatten(spark, sf_dir):
    return reporting.campaign_report(st.campaign_json(spark, sf_dir))


@query(f"SELECT * FROM ({REPORT}) WHERE contains(campaign_title, 'Adaptación') ORDER BY campaign_web_id DESC")
def campaign_report_filter(spark, sf_dir):
    report = reporting.campaign_report(st.campaign_json(spark, sf_dir))
    return reporting.campaigns_titled(report, "Adaptación")


@query(
    """SELECT child_service_id, CASE WHEN length(child_adaptation_scheduling_dt) > 0 THEN child_adaptation_scheduling_dt ELSE '' END AS child_adaptation_scheduling_start_dt,
           coalesce(child_adaptation_responsible, '') AS child_adaptation_responsible, 'false' AS interview_flag,
           '' AS child_interview_start_dt, '' AS child_interview_responsible, '' AS child_interview_end_dt,
           '' AS scheduling_channel_value, '' AS child_adaptation_scheduling_end_dt, '' AS center_interview_responsible
    FROM admissions""",
    "admissions",
)
def backfill_columns(spark, sf_dir):
    moved = migrate.migrate_admissions(st.admissions(spark, sf_dir))
    return moved.select(
        "child_service_id", "child_adaptation_scheduling_start_dt", "child_adaptation_responsible",
        *migrate.ADDED_ADMISSION_COLUMNS,
    )


@query(
    """SELECT c.child_service_id, c.child_adaptation_responsible, c.child_adaptation_scheduling_dt, c.first_interview_flag,
           c.child_adaptation_scheduling_comment,
           CASE WHEN length(c.child_adaptation_scheduling_dt) > 0 THEN c.child_adaptation_scheduling_dt ELSE '' END AS child_adaptation_scheduling_start_dt,
           '' AS child_adaptation_scheduling_end_dt, a.child_service_start_dt AS process_date
    FROM calendar c LEFT JOIN admissions a ON a.child_service_id = c.child_service_id""",
    "calendar", "admissions",
)
def backfill_calendar(spark, sf_dir):
    return migrate.migrate_calendar(st.calendar(spark, sf_dir), st.admissions(spark, sf_dir))
