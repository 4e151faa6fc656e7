"""Monitoring extract, ingestion log, campaign report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.functions import dates
from cohortline.operators.columns import fill_defaults
from cohortline.sources.schemas import CAMPAIGN_REPORT, SCHEDULED_COLUMN

# Fixed values.
CONTROL_FILLS = {
    "child_adaptation_survey_email_sent_flag": "false",
    "child_adaptation_survey_email_read_flag": "false",
    "child_adaptation_survey_completed_flag": "false",
    "child_adaptation_survey_tag": "false",
    "child_adaptation_survey_email_sent_dt": "",
    "child_welcome_email_sent_flag": "false",
    "child_welcome_email_read_flag": "false",
    "child_welcome_email_sent_dt": "",
    "child_adaptation_scheduling_reminder_email_sent_flag": "false",
    "child_adaptation_scheduling_reminder_email_read_flag": "false",
    "child_adaptation_scheduling_reminder_email_dt": "",
}


def with_indicators(admissions: DataFrame) -> DataFrame:
    """A one per row, and whether it was scheduled or given up."""
    state = F.col("child_adaptation_scheduling_flag")
    return admissions.withColumns(
        {
            "adaptations_total_Q": F.lit(1),
            "adaptations_not_schedulled_flag": F.when(state == "wasnt scheduled", 1).otherwise(0),
            "adaptations_schedulled_flag": F.when(state == "true", 1).otherwise(0),
        }
    )


def scheduling_indicators(admissions: DataFrame, by: str = "educational_center_code") -> DataFrame:
    """The indicators summed per center."""
    totals = ["adaptations_total_Q", "adaptations_not_schedulled_flag", "adaptations_schedulled_flag"]
    return with_indicators(admissions).groupBy(by).agg(*[F.sum(c).alias(c) for c in totals])


def monitoring_extract(admissions: DataFrame, control: DataFrame, date_col: str = SCHEDULED_COLUMN) -> DataFrame:
    """One flat row per admission with indicators, date parts and mailing flags, newest id first.

    The extract names the date ``child_adaptation_scheduling_dt``, whatever the table calls it.
    """
    measured = with_indicators(
        admissions.withColumns(
            {
                "child_service_id": F.col("child_service_id").try_cast("long"),
                "child_adaptation_scheduling_dt": dates.parse_text_ts(date_col),
            }
        )
    )
    scheduled = F.col("child_adaptation_scheduling_dt")
    dated = measured.withColumns(
        {
            "child_adaptation_scheduling_date": F.to_date(scheduled),
            "child_adaptation_scheduling_day": F.day(scheduled),
            "child_adaptation_scheduling_month": F.month(scheduled),
            "child_adaptation_scheduling_year": F.year(scheduled),
        }
    )
    mailed = control.withColumn("child_service_id", F.col("child_service_id").try_cast("long"))
    joined = dated.join(mailed, "child_service_id", "left")
    return fill_defaults(joined, CONTROL_FILLS).orderBy(F.desc("child_service_id"))


def ingestion_log_row(loaded: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """The audit row of a load, by a job of its own; ``counted_log_row`` needs none."""
    return loaded.agg(F.count(F.lit(1)).alias("loaded_rows_value")).select(
        F.lit(loaded_at.strftime("%d/%m/%Y %H:%M:%S")).alias("data_ingestion_process_dt"),
        "loaded_rows_value",
    )


def counted_log_row(spark: SparkSession, loaded_rows: int, loaded_at: dt.datetime) -> DataFrame:
    """The same row from a count that the load's own job has taken."""
    row = (loaded_at.strftime("%d/%m/%Y %H:%M:%S"), loaded_rows)
    return spark.createDataFrame([row], "data_ingestion_process_dt string, loaded_rows_value long")


def ingestion_log(log: DataFrame) -> DataFrame:
    """The log with its text dates parsed."""
    return log.withColumn("data_ingestion_process_dt", dates.parse_text_ts("data_ingestion_process_dt"))


def campaign_report(documents: DataFrame, column: str = "document") -> DataFrame:
    """Nested campaign documents as flat rows.

    Missing text settings become blank.  The four report numbers count only together: if one is
    missing, all are zero.
    """
    parsed = documents.select(F.from_json(column, CAMPAIGN_REPORT).alias("c")).select("c.*")
    report = [F.col(f"report_summary.{n}") for n in ("opens", "unique_opens", "open_rate", "click_rate")]
    complete = report[0].isNotNull() & report[1].isNotNull() & report[2].isNotNull() & report[3].isNotNull()

    def number(value: Column) -> Column:
        return F.when(complete, value).otherwise(0)

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    return parsed.select(
        F.col("web_id").alias("campaign_web_id"),
        F.col("status").alias("campaign_status"),
        _wall_clock(F.col("create_time")).alias("campaign_create_date"),
        "recipients.list_id",
        "recipients.list_is_active",
        "recipients.list_name",
        F.col("recipients.recipient_count").alias("list_total_contacts"),
        text("settings.subject_line").alias("email_subject"),
        F.col("settings.title").alias("campaign_title"),
        text("settings.from_name").alias("campaign_from_name"),
        text("settings.reply_to").alias("campaign_reply_to"),
        F.col("settings.template_id").alias("campaign_template_id"),
        number(report[0]).alias("report_opens_value"),
        number(report[1]).alias("report_unique_opens_value"),
        number(report[2]).alias("report_open_rate"),
        number(report[3]).alias("report_click_rate"),
    )


def _wall_clock(iso: Column) -> Column:
    """Date and time as written, whatever the offset behind them."""
    return dates.iso_text(dates.as_ts(F.substring(iso, 1, 19)))


def campaigns_titled(report: DataFrame, needle: str) -> DataFrame:
    """Campaigns with the text in their title, newest first."""
    return report.filter(F.col("campaign_title").contains(needle)).orderBy(F.desc("campaign_web_id"))
