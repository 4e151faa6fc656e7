"""Spells, conversions, renewals, star joins and the admissions base."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.operators import enrich, reporting, scheduling, spells
from cohortline.operators.columns import rename_columns
from cohortline.operators.keys import duplicate_keys
from cohortline.operators.reporting import ingestion_log_row
from cohortline.plans import admissions as base
from cohortline.plans import ingestion
from cohortline.session import landing
from cohortline.sources.readers import TableSpec, read_table
from cohortline.sources.schemas import ADMISSIONS, RENEWALS_HISTORY
from cohortline.sources.writers import write_extract
from workload import standins as st
from workload.registry import query

AS_OF = dt.date(1998, 6, 15)
LOOKBACK_DAYS = 60
LOADED_AT = dt.datetime(1998, 6, 15, 7, 4, 24)

# The rules by their meaning, for a second engine: ranks, windows over a child's spells, and date ranges.
LIVE = "(end_dt IS NULL OR end_dt > start_dt)"
CURRENT = f"""
    SELECT * FROM (
        SELECT p.*, rank() OVER (PARTITION BY child_id ORDER BY coalesce(end_dt, DATE '3000-01-01') DESC) AS place,
               count(*) FILTER (WHERE {LIVE} AND start_dt < DATE '1998-07-01') OVER (PARTITION BY child_id, end_dt) AS supporters
        FROM spells p WHERE end_dt IS NULL OR end_dt > DATE '1998-06-15')
    WHERE supporters > 0
    QUALIFY rank() OVER (PARTITION BY child_id ORDER BY place) = 1"""
WITH_PAST = f"""
    SELECT p.*, max(CASE WHEN {LIVE} THEN coalesce(end_dt, DATE '3000-01-01') END) OVER (
               PARTITION BY child_id ORDER BY start_dt RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING) AS past_end
    FROM spells p WHERE start_dt IS NOT NULL"""
FIRST = f"""
    SELECT service_id, child_id, start_dt, end_dt FROM ({WITH_PAST})
    WHERE past_end IS NULL OR past_end < date_trunc('month', start_dt - INTERVAL 1 MONTH)
    UNION ALL SELECT service_id, child_id, start_dt, end_dt FROM spells WHERE start_dt IS NULL"""
IN_WINDOW = f"""
    SELECT * FROM spells
    WHERE {LIVE} AND start_dt >= DATE '1998-04-16'
      AND (end_dt IS NULL OR end_dt >= date_trunc('month', start_dt + INTERVAL 14 DAY) + INTERVAL 1 MONTH)"""
ADMITTED = f"""
    SELECT w.* FROM ({IN_WINDOW}) w
    SEMI JOIN ({CURRENT}) c ON c.service_id = w.service_id
    SEMI JOIN ({FIRST}) f ON f.service_id = w.service_id"""
CONVERSIONS = """
    SELECT DISTINCT ON (child_id) child_id, service_id, start_dt, modified_ts AS converted_ts
    FROM spells JOIN quotes USING (quote_id) WHERE start_dt < DATE '1998-07-01'
    ORDER BY child_id, modified_ts DESC NULLS LAST, service_id DESC"""
IN_LAST_YEAR = f"""
    SELECT DISTINCT child_id FROM spells
    WHERE {LIVE} AND start_dt < DATE '1998-01-01' AND (end_dt IS NULL OR end_dt >= DATE '1997-01-01')"""
FIRST_ACTIONS = f"""
    SELECT child_id, period, min(action_ts) AS first_action_ts
    FROM action_history SEMI JOIN ({IN_LAST_YEAR}) USING (child_id)
    WHERE action_id = 15 AND period = 1998 AND action_ts >= DATE '1997-07-01' AND action_ts < DATE '1998-03-01'
    GROUP BY ALL"""
# A name with an unknown first or last part is unknown; only the second surname may be missing.
FULL_NAME = "rtrim(first_name) || ' ' || rtrim(last_name) || coalesce(' ' || nullif(rtrim(second_last_name), ''), '')"
ATTENDANCE = """
    SELECT service_id, count(*) FILTER (WHERE 1 IN (day_flag, retail_flag, night_flag)) AS attendance_days
    FROM attendance GROUP BY service_id"""
# Every spell with its channel and the dates that its renewal depends on.
DATED = f"""
    SELECT p.service_id, p.child_id, p.start_dt, p.service_id IN (FROM company_services) AS is_corporate,
           coalesce(q.modified_ts, cv.converted_ts) AS enrolled_ts,
           h.child_id IS NOT NULL OR r.child_id IS NOT NULL AS has_renewal,
           coalesce(h.renewal_ts, r.first_action_ts) AS renewed_ts, p.child_id IN ({IN_LAST_YEAR}) AS in_last_year
    FROM spells p
    LEFT JOIN quotes q USING (quote_id)
    LEFT JOIN (SELECT * FROM renewals_history WHERE year = 1997) h ON h.child_id = p.child_id
    LEFT JOIN ({FIRST_ACTIONS}) r ON r.child_id = p.child_id
    LEFT JOIN ({CONVERSIONS}) cv ON cv.child_id = p.child_id"""
RENEWED = f"""
    SELECT service_id, child_id, is_corporate, coalesce(enrolled_ts, start_dt::TIMESTAMP) AS last_enrollment_ts,
           CASE WHEN is_corporate AND coalesce(enrolled_ts, DATE '2000-01-01') < DATE '1998-01-01' THEN TIMESTAMP '1998-01-01'
                WHEN is_corporate THEN CASE WHEN in_last_year AND date_trunc('month', enrolled_ts) = DATE '1998-01-01' THEN enrolled_ts END
                WHEN has_renewal THEN renewed_ts
                WHEN enrolled_ts < DATE '1998-01-01' THEN enrolled_ts END AS last_renewal_ts
    FROM ({DATED})"""
RENEWAL_TABLES = ("spells", "company_services", "quotes", "renewals_history", "action_history")
PEOPLE = f"SELECT person_id, {FULL_NAME} AS full_name, dni, rtrim(lower(email)) AS email FROM persons"
ROLES = """
    SELECT family_id, person_id, rtrim(description) AS relation
    FROM family_members LEFT JOIN descriptions ON id = relation_id"""
# Each child with each of its payers; ids are those of people on file.
FAMILIES = f"""
    SELECT k.child_id, k.full_name AS child_full_name, k.dni AS child_dni, k.birth_dt AS child_birth_dt, k.gender AS child_gender,
           p.person_id AS payer_id, p.full_name AS payer_full_name, p.dni AS payer_dni, pr.relation AS payer_relation, p.email AS payer_email,
           g.person_id AS guardian_id, g.full_name AS guardian_full_name, g.dni AS guardian_dni, gr.relation AS guardian_relation,
           g.email AS guardian_email
    FROM (SELECT *, {FULL_NAME} AS full_name FROM children) k
    LEFT JOIN (SELECT child_id, person_id AS payer_link FROM child_payers) l USING (child_id)
    LEFT JOIN ({PEOPLE}) p ON p.person_id = payer_link
    LEFT JOIN ({ROLES}) pr ON (pr.family_id, pr.person_id) = (k.family_id, payer_link)
    LEFT JOIN ({PEOPLE}) g ON g.person_id = k.edu_guardian_id
    LEFT JOIN ({ROLES}) gr ON (gr.family_id, gr.person_id) = (k.family_id, k.edu_guardian_id)"""
PLACED = """
    SELECT service_id, (SELECT description FROM descriptions WHERE id = status_id) AS status, rtrim(ce.name) AS center_name,
           (SELECT rtrim(description) FROM descriptions WHERE id = level_id) AS level,
           (SELECT rtrim(description) FROM descriptions WHERE id = shift_id) AS shift, room_id,
           if(service_id IN (FROM company_services), 'Empresa', 'Familia') AS channel
    FROM spells LEFT JOIN centers ce USING (center_id) LEFT JOIN center_products USING (product_id)"""
BASE_TABLES = (
    "spells", "children", "child_payers", "persons", "family_members", "descriptions", "centers", "center_products",
    "company_services", "quotes", "renewals_history", "action_history", "attendance",
)
BASE_SQL = f"""
    SELECT child_id, service_id, f.* EXCLUDE (child_id), center_id, center_name, channel, level, shift, room_id, last_enrollment_ts,
           last_renewal_ts, start_dt, end_dt, status, coalesce(attendance_days, 0) AS attendance_days
    FROM ({ADMITTED})
    JOIN ({PLACED}) USING (service_id)
    JOIN (SELECT service_id, last_enrollment_ts, last_renewal_ts FROM ({RENEWED})) USING (service_id)
    LEFT JOIN ({FAMILIES}) f USING (child_id)
    LEFT JOIN ({ATTENDANCE}) USING (service_id)"""


@query(BASE_SQL, *BASE_TABLES)
def admissions_base(spark, sf_dir):
    return base.admissions_base(st.operational(spark, sf_dir), AS_OF, LOOKBACK_DAYS)


PUBLISHED_SQL = f"""
    SELECT service_id AS child_service_id, child_id, child_full_name AS child_name, child_dni AS child_dni_code,
           strftime(child_birth_dt, '%Y-%m-%d %H:%M:%S') AS child_date_birth, child_gender AS child_gender_desc,
           payer_id AS child_financial_guardian_id, payer_full_name AS child_financial_guardian_name,
           payer_dni AS child_financial_guardian_dni_code, payer_relation AS child_financial_guardian_relationship_desc,
           payer_email AS child_financial_guardian_email, guardian_id AS child_educational_guardian_id,
           guardian_full_name AS child_educational_guardian_name, guardian_dni AS child_educational_guardian_dni_code,
           guardian_relation AS child_educational_guardian_relationship_desc, guardian_email AS child_educational_guardian_email,
           center_id AS educational_center_code, center_name AS educational_center_name, channel AS child_admission_channel_value,
           level AS child_level_name, shift AS child_service_type_desc, room_id AS educational_center_room_id,
           strftime(last_enrollment_ts, '%Y-%m-%d %H:%M:%S') AS child_last_enrollment_dt,
           strftime(last_renewal_ts, '%Y-%m-%d %H:%M:%S') AS child_last_renewal_process_dt,
           strftime(start_dt, '%Y-%m-%d %H:%M:%S') AS child_service_start_dt, status AS child_service_status,
           attendance_days AS child_attendance_days_value, 'false' AS child_adaptation_scheduling_flag,
           'Sin comentarios' AS child_adaptation_scheduling_comment, '' AS child_adaptation_scheduling_start_dt,
           '' AS child_adaptation_responsible, 'false' AS interview_flag, '' AS child_interview_start_dt,
           '' AS child_interview_responsible, '' AS child_interview_end_dt, '' AS scheduling_channel_value,
           '' AS child_adaptation_scheduling_end_dt, '' AS center_interview_responsible,
           CASE WHEN center_id IN ('NPL2', 'QLC', 'SMH', 'CCBA') THEN 'true' ELSE 'false' END AS flag_poc_center
    FROM ({BASE_SQL})"""
COMPLETE = """
    child_service_id IS NOT NULL AND child_dni_code IS NOT NULL AND child_educational_guardian_dni_code IS NOT NULL
    AND child_educational_guardian_id IS NOT NULL AND child_financial_guardian_dni_code IS NOT NULL
    AND child_financial_guardian_id IS NOT NULL AND child_id IS NOT NULL AND educational_center_room_id IS NOT NULL
    AND child_attendance_days_value IS NOT NULL"""
PILOTS = ("NPL2", "QLC", "SMH", "CCBA")
STORED = """
    SELECT child_service_id, child_name, child_adaptation_scheduling_flag FROM admissions
    WHERE child_service_id IN (FROM company_services) OR child_service_start_dt < '1998'"""


def _load(spark, sf_dir):
    """A load into a store that already holds the admissions of earlier years and the urgent ones of this."""
    known = st.admissions(spark, sf_dir).select("child_service_id", "child_name", "child_adaptation_scheduling_flag", "child_service_start_dt")
    urgent = st.company_services(spark, sf_dir).select(F.col("service_id").alias("child_service_id"), F.lit(True).alias("urgent"))
    stored = known.join(urgent, "child_service_id", "left").filter("urgent OR child_service_start_dt < '1998'")
    given = {f.name: f.dataType for f in T.StructType.fromDDL(ADMISSIONS)}
    store = stored.select(*[F.col(n) if n in stored.columns else F.lit(None).cast(t).alias(n) for n, t in given.items()])
    return ingestion.ingest_admissions(st.operational(spark, sf_dir), store, AS_OF, LOADED_AT, PILOTS, LOOKBACK_DAYS)


@query(f"SELECT * FROM ({PUBLISHED_SQL}) WHERE {COMPLETE}", *BASE_TABLES)
def loaded_admissions(spark, sf_dir):
    return _load(spark, sf_dir).loaded


@query(
    f"""{STORED}
    UNION ALL
    SELECT DISTINCT child_service_id, child_name, child_adaptation_scheduling_flag
    FROM ({PUBLISHED_SQL}) ANTI JOIN ({STORED}) USING (child_service_id) WHERE {COMPLETE}""",
    "admissions", *BASE_TABLES,
)
def ingested_state(spark, sf_dir):
    state = _load(spark, sf_dir).state
    return state.select("child_service_id", "child_name", "child_adaptation_scheduling_flag")


@query(f"SELECT service_id, child_id, start_dt, end_dt FROM ({ADMITTED})", "spells")
def new_admissions(spark, sf_dir):
    admitted = spells.new_admissions(st.spells(spark, sf_dir), AS_OF, LOOKBACK_DAYS)
    return admitted.select("service_id", "child_id", "start_dt", "end_dt")


@query(
    f"SELECT service_id, child_id, start_dt, end_dt FROM ({CURRENT})",
    "spells",
)
def current_spell(spark, sf_dir):
    current = spells.current_spell(st.spells(spark, sf_dir), AS_OF)
    return current.select("service_id", "child_id", "start_dt", "end_dt")


@query(FIRST, "spells")
def first_admission(spark, sf_dir):
    first = spells.first_admission(st.spells(spark, sf_dir))
    return first.select("service_id", "child_id", "start_dt", "end_dt")


MOMENTS = """
    SELECT service_id, child_id, start_dt + to_hours(CAST(service_id % 24 AS INTEGER)) AS start_ts,
           end_dt + to_hours(CAST(service_id % 7 AS INTEGER)) AS end_ts FROM spells"""


@query(
    f"""SELECT * FROM ({MOMENTS}) m WHERE NOT EXISTS (
        SELECT 1 FROM ({MOMENTS}) p WHERE p.child_id = m.child_id AND p.start_ts < m.start_ts AND (p.end_ts IS NULL OR p.end_ts > p.start_ts)
          AND coalesce(p.end_ts, TIMESTAMP '3000-01-01') >= date_trunc('month', m.start_ts - INTERVAL 1 MONTH))""",
    "spells",
)
def first_admission_by_moment(spark, sf_dir):
    moments = st.spells(spark, sf_dir).selectExpr(
        "service_id", "child_id",
        "CAST(start_dt AS TIMESTAMP_NTZ) + make_dt_interval(0, CAST(service_id % 24 AS INT)) AS start_ts",
        "CAST(end_dt AS TIMESTAMP_NTZ) + make_dt_interval(0, CAST(service_id % 7 AS INT)) AS end_ts",
    )
    return spells.first_admission_by_moment(moments)



@query(
    f"SELECT service_id, child_id, start_dt, end_dt FROM ({IN_WINDOW})",
    "spells",
)
def admission_window(spark, sf_dir):
    window = spells.admission_window(AS_OF, LOOKBACK_DAYS)
    return st.spells(spark, sf_dir).filter(window).select("service_id", "child_id", "start_dt", "end_dt")


@query(CONVERSIONS, "spells", "quotes")
def latest_conversion(spark, sf_dir):
    return spells.latest_conversion(st.spells(spark, sf_dir), st.quotes(spark, sf_dir), AS_OF)


@query(
    """SELECT service_id, child_id, quote_id, modified_ts AS converted_ts
    FROM spells JOIN quotes USING (quote_id) WHERE start_dt < DATE '1998-07-01'""",
    "spells",
    "quotes",
)
def quote_inner_join(spark, sf_dir):
    conversions = spells.spell_conversions(st.spells(spark, sf_dir), st.quotes(spark, sf_dir), AS_OF)
    return conversions.select("service_id", "child_id", F.col("service_id").alias("quote_id"), "converted_ts")


@query(FIRST_ACTIONS, "action_history", "spells")
def renewal_first_action(spark, sf_dir):
    return spells.renewal_first_action(st.action_history(spark, sf_dir), st.spells(spark, sf_dir), AS_OF)


@query(f"SELECT service_id, child_id, child_id IN ({IN_LAST_YEAR}) AS enrolled_last_year FROM spells", "spells")
def enrolled_last_year(spark, sf_dir):
    every = st.spells(spark, sf_dir)
    marked = spells.with_enrolled_flag(every.select("service_id", "child_id"), every, AS_OF.year - 1)
    return marked.withColumnRenamed("enrolled", "enrolled_last_year")


@query(ATTENDANCE, "attendance")
def attendance_days(spark, sf_dir):
    return spells.attendance_days(st.attendance(spark, sf_dir))


def _dated(spark, sf_dir):
    """All spells with channel and dates, without narrowing to new admissions."""
    tables = st.operational(spark, sf_dir)
    channelled = enrich.with_channel(tables.spells, tables.company_services)
    return base.with_enrollment_dates(channelled, tables, AS_OF)


@query(f"SELECT service_id, child_id, is_corporate, last_renewal_ts FROM ({RENEWED})", *RENEWAL_TABLES)
def renewal_date(spark, sf_dir):
    return _dated(spark, sf_dir).select("service_id", "child_id", "is_corporate", "last_renewal_ts")


@query(f"SELECT service_id, child_id, last_enrollment_ts FROM ({RENEWED})", *RENEWAL_TABLES)
def last_enrollment(spark, sf_dir):
    every, quotes = st.spells(spark, sf_dir), st.quotes(spark, sf_dir)
    return spells.with_last_enrollment(every, every, quotes, AS_OF).select("service_id", "child_id", "last_enrollment_ts")


@query(
    """SELECT s.service_id, h.year AS renewal_year, h.renewal_ts
    FROM spells s LEFT JOIN renewals_history h ON h.child_id = s.child_id AND h.year = 1997""",
    "spells",
    "renewals_history",
)
def left_join_filtered_right(spark, sf_dir):
    """The history comes from a source of its own, landed as CSV."""
    path = landing(spark, "renewals-history")
    write_extract(st.renewals_history(spark, sf_dir), path)
    source = TableSpec("csv", path, RENEWALS_HISTORY)
    history = read_table(spark, source).filter(F.col("year") == AS_OF.year - 1)
    joined = st.spells(spark, sf_dir).select("service_id", "child_id").join(history, "child_id", "left")
    return joined.select("service_id", F.col("year").alias("renewal_year"), "renewal_ts")


@query(
    f"SELECT service_id, rtrim(status) AS status, center_name, level, shift, room_id, channel FROM ({PLACED})",
    "spells", "descriptions", "centers", "center_products", "company_services",
)
def star_enrich(spark, sf_dir):
    tables = st.operational(spark, sf_dir)
    served = base.with_service(tables.spells, tables)
    return served.select(
        "service_id", F.rtrim("status").alias("status"), "center_name", "level", "shift", "room_id", "channel"
    )


@query(
    f"SELECT * EXCLUDE (child_full_name, child_dni, child_birth_dt, child_gender, payer_dni, guardian_dni) FROM ({FAMILIES})",
    "children", "child_payers", "persons", "family_members", "descriptions",
)
def two_role_join(spark, sf_dir):
    tables = st.operational(spark, sf_dir)
    every = tables.children.select("child_id")
    known = base.with_people(base.with_family(every, tables.children, tables.child_payers), tables)
    return known.select(
        "child_id", "payer_id", "payer_full_name", "payer_relation", "payer_email",
        "guardian_id", "guardian_full_name", "guardian_relation", "guardian_email",
    )


@query(
    """SELECT s.service_id, CASE WHEN c.service_id IS NOT NULL THEN 'Empresa' ELSE 'Familia' END AS channel
    FROM spells s LEFT JOIN company_services c ON c.service_id = s.service_id""",
    "spells", "company_services",
)
def channel_case(spark, sf_dir):
    served = enrich.with_channel(st.spells(spark, sf_dir), st.company_services(spark, sf_dir))
    return served.select("service_id", "channel")


@query("SELECT child_id, count(*) AS n_rows FROM child_payers GROUP BY child_id HAVING count(*) > 1", "child_payers")
def duplicate_payers(spark, sf_dir):
    return duplicate_keys(st.child_payers(spark, sf_dir), ["child_id"])


@query(
    "SELECT service_id, child_id, start_dt, end_dt FROM spells ORDER BY start_dt DESC, service_id DESC LIMIT 5", "spells"
)
def top_recent_spells(spark, sf_dir):
    ordered = st.spells(spark, sf_dir).orderBy(F.desc("start_dt"), F.desc("service_id"))
    return ordered.select("service_id", "child_id", "start_dt", "end_dt").limit(5)


@query(
    f"SELECT '15/06/1998 07:04:24' AS data_ingestion_process_dt, count(*) AS loaded_rows_value FROM ({ADMITTED})",
    "spells",
    name="ingestion_log_row",
)
def log_row_of_load(spark, sf_dir):
    admitted = spells.new_admissions(st.spells(spark, sf_dir), AS_OF, LOOKBACK_DAYS)
    return ingestion_log_row(admitted, LOADED_AT)


@query(
    """SELECT service_id AS child_service_id, child_id, start_dt AS child_service_start_dt,
           end_dt AS child_service_end_dt FROM spells""",
    "spells",
    name="rename_columns",
)
def renamed_spells(spark, sf_dir):
    kept = st.spells(spark, sf_dir).select("service_id", "child_id", "start_dt", "end_dt")
    return rename_columns(kept, base.PUBLISHED_NAMES)


# The run over the state that a load writes: new admissions, marked if a week of working days has passed.
MARKED = f"""
    SELECT child_service_id, child_attendance_days_value >= 3 OR CAST(child_service_start_dt AS TIMESTAMP) <= DATE '1998-06-08' AS overdue
    FROM (SELECT DISTINCT ON (child_service_id) * FROM ({PUBLISHED_SQL}) WHERE {COMPLETE} ORDER BY child_service_id, child_financial_guardian_id)"""


@query(
    f"""SELECT child_service_id, if(overdue, '31/12/2050 09:00:00', '') AS child_adaptation_scheduling_start_dt,
           if(overdue, 'wasnt scheduled', 'false') AS child_adaptation_scheduling_flag, if(overdue, 'Sin respuesta', 'false') AS interview_flag,
           if(overdue, 1, 0)::INTEGER AS adaptations_not_schedulled_flag
    FROM ({MARKED})""",
    *BASE_TABLES,
)
def stored_state_marking(spark, sf_dir):
    """A load into an empty table, the marking of its overdue rows, and the monitoring extract of that."""
    store = spark.createDataFrame([], ADMISSIONS)
    load = ingestion.ingest_admissions(st.operational(spark, sf_dir), store, AS_OF, LOADED_AT, PILOTS, LOOKBACK_DAYS)
    marked, _ = scheduling.mark_unscheduled(load.state, AS_OF, max_wait=5, min_attendance=3)
    extract = reporting.monitoring_extract(marked, st.journey_control(spark, sf_dir))
    return extract.select(
        "child_service_id", "child_adaptation_scheduling_start_dt", "child_adaptation_scheduling_flag", "interview_flag",
        "adaptations_not_schedulled_flag",
    )
