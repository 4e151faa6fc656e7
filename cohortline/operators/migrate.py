"""Older state tables brought to the newer columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.operators.columns import fill_defaults, with_defaults

# Fixed values.
ADDED_ADMISSION_COLUMNS = {
    "interview_flag": "false",
    "child_interview_start_dt": "",
    "child_interview_responsible": "",
    "child_interview_end_dt": "",
    "scheduling_channel_value": "",
    "child_adaptation_scheduling_end_dt": "",
    "center_interview_responsible": "",
}


def text_or_blank(column: str) -> Column:
    return F.when(F.length(column) > 0, F.col(column)).otherwise("")


def migrate_admissions(admissions: DataFrame) -> DataFrame:
    """The scheduling date under its new name, and the columns that were added since."""
    dated = admissions.withColumn(
        "child_adaptation_scheduling_start_dt", text_or_blank("child_adaptation_scheduling_dt")
    )
    known = fill_defaults(dated, {"child_adaptation_responsible": ""})
    return with_defaults(known, ADDED_ADMISSION_COLUMNS)


def migrate_calendar(calendar: DataFrame, admissions: DataFrame) -> DataFrame:
    """Calendar rows with start and end column and the start of the service as process date."""
    dated = calendar.withColumns(
        {
            "child_adaptation_scheduling_start_dt": text_or_blank("child_adaptation_scheduling_dt"),
            "child_adaptation_scheduling_end_dt": F.lit(""),
        }
    )
    process_dates = admissions.select("child_service_id", F.col("child_service_start_dt").alias("process_date"))
    return dated.join(process_dates, "child_service_id", "left")
