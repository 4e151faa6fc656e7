"""The driver's tables in the shape of the domain tables, for Spark and as SQL.

Every stand-in keeps all rows of its source or selects by an attribute that makes domain sense
(an order without a quote, an urgent order as a corporate service).  ``SQL`` holds the same
definitions as common table expressions.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.plans.admissions import OperationalTables


@functools.cache
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; each file is opened once per session, its rows are read by every query."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS service_id",
        "o_custkey AS child_id",
        "concat('N', o_orderkey % 25, '  ') AS center_id",
        "o_orderkey % 2500 AS product_id",
        "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 7 END AS status_id",
        "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS quote_id",
        "CASE WHEN o_orderkey % 41 <> 0 THEN to_date(o_orderdate) END AS start_dt",
        "CASE WHEN o_orderstatus <> 'P' THEN date_add(to_date(o_orderdate), CAST(o_orderkey % 400 AS INT)) END AS end_dt",
    )


def children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS child_id",
        "c_custkey div 2 AS family_id",
        "c_custkey + CASE WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 1 END AS edu_guardian_id",
        "CASE WHEN c_acctbal >= 0 THEN concat(split_part(c_name, '#', 1), '  ') END AS first_name",
        "concat(split_part(c_name, '#', 2), ' ') AS last_name",
        "CASE WHEN c_nationkey < 8 THEN '   ' WHEN c_nationkey >= 16 THEN concat(\"O'Nation \", c_nationkey, ' ') END AS second_last_name",
        "c_custkey * 10 + 7 AS dni",
        "date_add(DATE'1993-01-01', CAST(c_custkey AS INT)) AS birth_dt",
        "CASE WHEN c_nationkey < 13 THEN 'F' ELSE 'M' END AS gender",
    )


def child_payers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next customer pays; a negative balance brings in a second payer."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS child_id",
        "explode(CASE WHEN c_acctbal < 0 THEN array(c_custkey + 1, c_custkey + 3) ELSE array(c_custkey + 1) END) AS person_id",
    )


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS person_id",
        "concat(c_mktsegment, '  ') AS first_name",
        "split_part(c_name, '#', 2) AS last_name",
        "CASE WHEN c_nationkey < 5 THEN '' WHEN c_nationkey < 15 THEN concat('of ', c_nationkey, '  ') END AS second_last_name",
        "c_custkey * 10 + 3 AS dni",
        "CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN concat('Person.', c_custkey, '@Example.ORG  ') END AS email",
    )


def family_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "(c_custkey - 1) div 2 AS family_id", "c_custkey AS person_id", "c_nationkey % 6 AS relation_id"
    )


def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").selectExpr(
        "r_regionkey AS id", "concat(r_name, '  ') AS description"
    )


def centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "concat('N', n_nationkey) AS center_id", "concat(n_name, ' ') AS name"
    )


def center_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id", "p_size % 6 AS level_id", "p_size % 5 AS shift_id", "p_partkey + 1000 AS room_id"
    )


def company_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").selectExpr("o_orderkey AS service_id")


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most quotes change shortly before the start; those of open orders were never changed."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS quote_id",
        "CASE WHEN o_orderstatus <> 'O' THEN o_orderdate - make_dt_interval(o_orderkey % 45, 15) END AS modified_ts",
    )


def renewals_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first renewal of each child and year; its date may be unknown."""
    renewed = table(spark, sf_dir, "orders").filter("o_orderpriority = '2-HIGH'").selectExpr(
        "o_custkey AS child_id",
        "year(o_orderdate) AS year",
        "CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS renewal_ts",
    )
    return renewed.groupBy("child_id", "year").agg(F.min("renewal_ts").alias("renewal_ts"))


def action_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS child_id",
        "CASE WHEN o_orderpriority = '3-MEDIUM' THEN 15 ELSE 7 END AS action_id",
        "year(o_orderdate) + CASE WHEN month(o_orderdate) >= 6 THEN 1 ELSE 0 END AS period",
        "o_orderdate AS action_ts",
    )


def attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS service_id",
        "CAST(l_returnflag = 'A' AS INT) AS day_flag",
        "CAST(l_linestatus = 'F' AS INT) AS retail_flag",
        "CAST(l_linenumber = 1 AS INT) AS night_flag",
    )


def operational(spark: SparkSession, sf_dir: str) -> OperationalTables:
    described = descriptions(spark, sf_dir)
    return OperationalTables(
        spells=spells(spark, sf_dir),
        children=children(spark, sf_dir),
        child_payers=child_payers(spark, sf_dir),
        persons=persons(spark, sf_dir),
        family_members=family_members(spark, sf_dir),
        relations=described,
        service_status=described,
        centers=centers(spark, sf_dir),
        center_products=center_products(spark, sf_dir),
        levels=described,
        shifts=described,
        company_services=company_services(spark, sf_dir),
        quotes=quotes(spark, sf_dir),
        renewals_history=renewals_history(spark, sf_dir),
        action_history=action_history(spark, sf_dir),
        attendance=attendance(spark, sf_dir),
    )


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored admissions with text dates, dirty e-mails and attendance as text."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS child_service_id",
        "o_custkey AS child_id",
        "concat('Child ', o_custkey) AS child_name",
        "CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_custkey + 1 END AS child_educational_guardian_id",
        "concat('payer', o_custkey, '@example.org') AS child_financial_guardian_email",
        """CASE o_orderpriority WHEN '1-URGENT' THEN concat('payer', o_custkey, '@example.org')
                WHEN '2-HIGH' THEN concat('Guardian', o_custkey, '@Example.org')
                WHEN '3-MEDIUM' THEN concat('guardian', o_custkey, ' at example')
                WHEN '4-NOT SPECIFIED' THEN '  ' END AS child_educational_guardian_email""",
        "concat('N', o_orderkey % 25) AS educational_center_code",
        """CASE WHEN o_orderstatus = 'O' THEN 'false' WHEN o_orderpriority = '5-LOW' THEN 'wasnt scheduled'
                ELSE 'true' END AS child_adaptation_scheduling_flag""",
        """CASE WHEN o_orderstatus = 'O' THEN '' WHEN o_orderpriority = '5-LOW' THEN 'not a date'
                ELSE date_format(o_orderdate, 'd/M/yyyy H:m:s') END AS child_adaptation_scheduling_dt""",
        """CASE WHEN o_orderstatus <> 'O' THEN
                date_format(date_add(to_date(o_orderdate), CAST(o_orderkey % 30 AS INT)), 'd/M/yyyy H:m:s')
                ELSE '' END AS child_adaptation_scheduling_end_dt""",
        "CASE WHEN o_orderstatus = 'F' THEN 'Planner' ELSE '' END AS child_adaptation_responsible",
        "CASE WHEN o_orderstatus = 'F' THEN 'Agreed' END AS child_adaptation_scheduling_comment",
        "CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE '' END AS first_interview_flag",
        "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') AS child_last_enrollment_dt",
        "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') AS child_service_start_dt",
        "CAST(o_orderkey % 12 AS STRING) AS child_attendance_days_value",
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduling calendar; not every service has an entry."""
    return (
        table(spark, sf_dir, "orders")
        .filter("o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
        .selectExpr(
            "o_orderkey AS child_service_id",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'No agendado' WHEN '2-HIGH' THEN 'Planner' END AS child_adaptation_responsible",
            "CASE WHEN o_orderstatus <> 'P' THEN date_format(o_orderdate, 'd/M/yyyy H:m:s') END AS child_adaptation_scheduling_dt",
            "CASE WHEN o_orderstatus = 'F' THEN 'Yes' END AS first_interview_flag",
            "CASE WHEN o_orderstatus = 'O' THEN \"It's agreed\" END AS child_adaptation_scheduling_comment",
        )
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt are already on the mailing list."""
    return table(spark, sf_dir, "customer").filter("c_acctbal < 0").selectExpr(
        "'journey' AS audience_id", "concat('PAYER', c_custkey, '@example.org') AS email_address"
    )


def journey_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter("o_orderpriority IN ('1-URGENT', '5-LOW')").selectExpr(
        "o_orderkey AS child_service_id",
        "'true' AS child_adaptation_survey_email_sent_flag",
        "'false' AS child_adaptation_survey_email_read_flag",
        "'false' AS child_adaptation_survey_completed_flag",
        "concat('tag', o_custkey) AS child_adaptation_survey_tag",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS child_adaptation_survey_email_sent_dt",
        "CASE WHEN o_orderstatus = 'F' THEN 'true' END AS child_welcome_email_sent_flag",
        "CASE WHEN o_orderstatus = 'F' THEN 'false' END AS child_welcome_email_read_flag",
        "CASE WHEN o_orderstatus = 'F' THEN '1/2/1998' END AS child_welcome_email_sent_dt",
        "CAST(NULL AS STRING) AS child_adaptation_scheduling_reminder_email_sent_flag",
        "CAST(NULL AS STRING) AS child_adaptation_scheduling_reminder_email_read_flag",
        "CAST(NULL AS STRING) AS child_adaptation_scheduling_reminder_email_dt",
    )


def campaign_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_name AS campaign_email_code",
        "CASE WHEN s_acctbal >= 5000 THEN 'Automatico' ELSE 'Manual' END AS automation_send_email_flag",
        "CAST(s_suppkey + 100 AS STRING) AS html_template_code",
        "concat('Sender ', s_nationkey) AS email_from_name",
        "concat('reply', s_suppkey, '@example.org') AS email_reply_to",
        "concat('Subject ', s_suppkey) AS email_subject",
        "CAST(s_suppkey AS STRING) AS trigger_threshold_days",
    )


def ingestion_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "CASE WHEN event_type <> 'error' THEN date_format(ts, 'd/M/yyyy H:m:s') ELSE 'failed' END AS data_ingestion_process_dt",
        "event_id AS loaded_rows_value",
    )


def campaign_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One campaign document per order; settings and report may lack fields."""
    report = F.when(
        F.col("o_orderstatus") != "P",
        F.struct(
            (F.col("o_orderkey") % 90).alias("opens"),
            (F.col("o_orderkey") % 40).alias("unique_opens"),
            (F.col("o_orderkey") % 8 / F.lit(8.0)).alias("open_rate"),
            F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey") % 4 / F.lit(4.0)).alias("click_rate"),
        ),
    )
    urgent = F.col("o_orderpriority") == "1-URGENT"
    low = F.col("o_orderpriority") == "5-LOW"
    document = F.struct(
        F.col("o_orderkey").alias("web_id"),
        F.lit("sent").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("create_time"),
        F.struct(
            F.concat(F.lit("list"), F.col("o_custkey")).alias("list_id"),
            urgent.alias("list_is_active"),
            F.concat(F.lit("Audience "), F.col("o_custkey")).alias("list_name"),
            (F.col("o_orderkey") % 500).alias("recipient_count"),
        ).alias("recipients"),
        F.struct(
            F.when(~urgent, F.concat(F.lit("About "), F.col("o_orderkey"))).alias("subject_line"),
            F.concat(F.when(low, "Encuesta").otherwise("Adaptación"), F.lit(" "), F.col("o_orderkey")).alias("title"),
            F.when(~low, F.lit("Team")).alias("from_name"),
            F.when(~low, F.lit("team@example.org")).alias("reply_to"),
            (F.col("o_orderkey") % 7).alias("template_id"),
        ).alias("settings"),
        report.alias("report_summary"),
    )
    return table(spark, sf_dir, "orders").select(F.to_json(document).alias("document"))


SQL = {
    "spells": """
        SELECT o_orderkey AS service_id, o_custkey AS child_id, 'N' || (o_orderkey % 25) AS center_id,
               o_orderkey % 2500 AS product_id,
               CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 7 END AS status_id,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS quote_id,
               CASE WHEN o_orderkey % 41 <> 0 THEN CAST(o_orderdate AS DATE) END AS start_dt,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) END AS end_dt
        FROM orders""",
    "children": """
        SELECT c_custkey AS child_id, c_custkey // 2 AS family_id,
               c_custkey + CASE WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 1 END AS edu_guardian_id,
               CASE WHEN c_acctbal >= 0 THEN split_part(c_name, '#', 1) || '  ' END AS first_name,
               split_part(c_name, '#', 2) || ' ' AS last_name,
               CASE WHEN c_nationkey < 8 THEN '   ' WHEN c_nationkey >= 16 THEN 'O''Nation ' || c_nationkey || ' ' END AS second_last_name,
               c_custkey * 10 + 7 AS dni, DATE '1993-01-01' + CAST(c_custkey AS INTEGER) AS birth_dt,
               CASE WHEN c_nationkey < 13 THEN 'F' ELSE 'M' END AS gender
        FROM customer""",
    "child_payers": """
        SELECT c_custkey AS child_id, c_custkey + 1 AS person_id FROM customer
        UNION ALL SELECT c_custkey, c_custkey + 3 FROM customer WHERE c_acctbal < 0""",
    "persons": """
        SELECT c_custkey AS person_id, c_mktsegment || '  ' AS first_name, split_part(c_name, '#', 2) AS last_name,
               CASE WHEN c_nationkey < 5 THEN '' WHEN c_nationkey < 15 THEN 'of ' || c_nationkey || '  ' END AS second_last_name,
               c_custkey * 10 + 3 AS dni,
               CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'Person.' || c_custkey || '@Example.ORG  ' END AS email
        FROM customer""",
    "family_members": """
        SELECT CASE WHEN c_custkey = 0 THEN 0 ELSE (c_custkey - 1) // 2 END AS family_id, c_custkey AS person_id,
               c_nationkey % 6 AS relation_id
        FROM customer""",
    "descriptions": "SELECT r_regionkey AS id, r_name || '  ' AS description FROM region",
    "centers": "SELECT 'N' || n_nationkey AS center_id, n_name || ' ' AS name FROM nation",
    "center_products": """
        SELECT p_partkey AS product_id, p_size % 6 AS level_id, p_size % 5 AS shift_id, p_partkey + 1000 AS room_id
        FROM part""",
    "company_services": "SELECT o_orderkey AS service_id FROM orders WHERE o_orderpriority = '1-URGENT'",
    "quotes": """
        SELECT o_orderkey AS quote_id,
               CASE WHEN o_orderstatus <> 'O'
                    THEN o_orderdate - to_days(CAST(o_orderkey % 45 AS INTEGER)) - INTERVAL 15 HOUR END AS modified_ts
        FROM orders""",
    "renewals_history": """
        SELECT o_custkey AS child_id, CAST(year(o_orderdate) AS INTEGER) AS year,
               min(CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END) AS renewal_ts
        FROM orders WHERE o_orderpriority = '2-HIGH'
        GROUP BY o_custkey, CAST(year(o_orderdate) AS INTEGER)""",
    "action_history": """
        SELECT o_custkey AS child_id, CASE WHEN o_orderpriority = '3-MEDIUM' THEN 15 ELSE 7 END AS action_id,
               CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS period,
               o_orderdate AS action_ts
        FROM orders""",
    "attendance": """
        SELECT l_orderkey AS service_id, CAST(l_returnflag = 'A' AS INTEGER) AS day_flag,
               CAST(l_linestatus = 'F' AS INTEGER) AS retail_flag, CAST(l_linenumber = 1 AS INTEGER) AS night_flag
        FROM lineitem""",
    "admissions": """
        SELECT o_orderkey AS child_service_id, o_custkey AS child_id, 'Child ' || o_custkey AS child_name,
               CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_custkey + 1 END AS child_educational_guardian_id,
               'payer' || o_custkey || '@example.org' AS child_financial_guardian_email,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'payer' || o_custkey || '@example.org'
                    WHEN '2-HIGH' THEN 'Guardian' || o_custkey || '@Example.org'
                    WHEN '3-MEDIUM' THEN 'guardian' || o_custkey || ' at example'
                    WHEN '4-NOT SPECIFIED' THEN '  ' END AS child_educational_guardian_email,
               'N' || (o_orderkey % 25) AS educational_center_code,
               CASE WHEN o_orderstatus = 'O' THEN 'false' WHEN o_orderpriority = '5-LOW' THEN 'wasnt scheduled'
                    ELSE 'true' END AS child_adaptation_scheduling_flag,
               CASE WHEN o_orderstatus = 'O' THEN '' WHEN o_orderpriority = '5-LOW' THEN 'not a date'
                    ELSE strftime(o_orderdate, '%-d/%-m/%Y %-H:%-M:%-S') END AS child_adaptation_scheduling_dt,
               CASE WHEN o_orderstatus <> 'O'
                    THEN strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER), '%-d/%-m/%Y %-H:%-M:%-S')
                    ELSE '' END AS child_adaptation_scheduling_end_dt,
               CASE WHEN o_orderstatus = 'F' THEN 'Planner' ELSE '' END AS child_adaptation_responsible,
               CASE WHEN o_orderstatus = 'F' THEN 'Agreed' END AS child_adaptation_scheduling_comment,
               CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE '' END AS first_interview_flag,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS child_last_enrollment_dt,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS child_service_start_dt,
               CAST(o_orderkey % 12 AS VARCHAR) AS child_attendance_days_value
        FROM orders""",
    "calendar": """
        SELECT o_orderkey AS child_service_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'No agendado' WHEN '2-HIGH' THEN 'Planner' END AS child_adaptation_responsible,
               CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%-d/%-m/%Y %-H:%-M:%-S') END AS child_adaptation_scheduling_dt,
               CASE WHEN o_orderstatus = 'F' THEN 'Yes' END AS first_interview_flag,
               CASE WHEN o_orderstatus = 'O' THEN 'It''s agreed' END AS child_adaptation_scheduling_comment
        FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
    "members": """
        SELECT 'journey' AS audience_id, 'PAYER' || c_custkey || '@example.org' AS email_address
        FROM customer WHERE c_acctbal < 0""",
    "journey_control": """
        SELECT o_orderkey AS child_service_id, 'true' AS child_adaptation_survey_email_sent_flag,
               'false' AS child_adaptation_survey_email_read_flag, 'false' AS child_adaptation_survey_completed_flag,
               'tag' || o_custkey AS child_adaptation_survey_tag,
               strftime(o_orderdate, '%Y-%m-%d') AS child_adaptation_survey_email_sent_dt,
               CASE WHEN o_orderstatus = 'F' THEN 'true' END AS child_welcome_email_sent_flag,
               CASE WHEN o_orderstatus = 'F' THEN 'false' END AS child_welcome_email_read_flag,
               CASE WHEN o_orderstatus = 'F' THEN '1/2/1998' END AS child_welcome_email_sent_dt,
               CAST(NULL AS VARCHAR) AS child_adaptation_scheduling_reminder_email_sent_flag,
               CAST(NULL AS VARCHAR) AS child_adaptation_scheduling_reminder_email_read_flag,
               CAST(NULL AS VARCHAR) AS child_adaptation_scheduling_reminder_email_dt
        FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')""",
    "campaign_config": """
        SELECT s_name AS campaign_email_code,
               CASE WHEN s_acctbal >= 5000 THEN 'Automatico' ELSE 'Manual' END AS automation_send_email_flag,
               CAST(s_suppkey + 100 AS VARCHAR) AS html_template_code, 'Sender ' || s_nationkey AS email_from_name,
               'reply' || s_suppkey || '@example.org' AS email_reply_to, 'Subject ' || s_suppkey AS email_subject,
               CAST(s_suppkey AS VARCHAR) AS trigger_threshold_days
        FROM supplier""",
}


def with_ctes(query: str, *names: str) -> str:
    """The query behind a WITH list of the named stand-ins."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + "\n" + query.strip()
