"""Scheduling state of enrolments, and the marking of those never scheduled."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions import dates
from cohortline.functions.business_days import dates_counting
from cohortline.functions.text import flag, in_list_flag
from cohortline.operators.columns import fill_defaults
from cohortline.operators.keys import upsert_patch
from cohortline.sources.schemas import INTERVIEW_COLUMN, SCHEDULED_COLUMN

# Fixed values.
NOT_SCHEDULED_BY = "No agendado"
NO_COMMENT = "Sin comentarios"
CALENDAR_DATE, CALENDAR_INTERVIEW = "child_adaptation_scheduling_dt", "first_interview_flag"
NO_ANSWER = "Sin respuesta"
UNSCHEDULED_PATCH = {
    "child_adaptation_responsible": NOT_SCHEDULED_BY,
    "child_adaptation_scheduling_comment": "Adaptación no agendada por aplicación",
    "child_adaptation_scheduling_flag": "wasnt scheduled",
}
CALENDAR_PATCH_COLUMNS = [
    CALENDAR_DATE, "child_adaptation_responsible", "child_adaptation_scheduling_comment", CALENDAR_INTERVIEW
]


def scheduling_flag(responsible: Column, scheduled: Column) -> Column:
    """Three states: given up, scheduled, open.  An unknown responsible is not "given up"."""
    return (
        F.when(responsible.eqNullSafe(F.lit(NOT_SCHEDULED_BY)), "wasnt scheduled")
        .when(scheduled.isNotNull(), "true")
        .otherwise("false")
    )


def two_state_flag(scheduled: Column) -> Column:
    """The older flag, which knows no "given up"."""
    return flag(scheduled.isNotNull())


def scheduling_state(
    admissions: DataFrame, calendar: DataFrame, pilot_centers: tuple[str, ...]
) -> DataFrame:
    """Admissions with what the calendar says about them, and the pilot-center flag."""
    entries = calendar.select(
        "child_service_id",
        "child_adaptation_responsible",
        "child_adaptation_scheduling_dt",
        "first_interview_flag",
        "child_adaptation_scheduling_comment",
    )
    joined = admissions.join(entries, "child_service_id", "left").withColumns(
        {
            "child_adaptation_scheduling_flag": scheduling_flag(
                F.col("child_adaptation_responsible"), F.col("child_adaptation_scheduling_dt")
            ),
            "flag_poc_center": in_list_flag(F.col("educational_center_code"), pilot_centers),
        }
    )
    return fill_defaults(
        joined,
        {
            "child_adaptation_scheduling_comment": NO_COMMENT,
            "child_adaptation_scheduling_dt": "",
            "child_adaptation_responsible": "",
            "first_interview_flag": "",
        },
    )


def is_overdue(
    as_of: dt.date,
    holidays: Iterable[dt.date] | DataFrame = (),
    max_wait: int = 10,
    min_attendance: int = 6,
    convention: str = "legacy",
) -> Column:
    """Still open, and started ``max_wait`` working days ago or attended often enough."""
    _, last = dates_counting(as_of, -max_wait, holidays, convention)
    waited = F.to_date(dates.as_ts("child_service_start_dt")) <= F.lit(last)
    attended = F.col("child_attendance_days_value").try_cast("int") >= min_attendance
    return (F.col("child_adaptation_scheduling_flag") == "false") & (waited | attended)


def unscheduled_values(date_col: str = SCHEDULED_COLUMN, interview_col: str = INTERVIEW_COLUMN) -> dict[str, str]:
    """New values of an overdue row, under the names that its table uses."""
    return {date_col: dates.NEVER_SCHEDULED, interview_col: NO_ANSWER, **UNSCHEDULED_PATCH}


def unscheduled_patch(
    admissions: DataFrame, overdue: Column, date_col: str = SCHEDULED_COLUMN, interview_col: str = INTERVIEW_COLUMN
) -> DataFrame:
    """Key and new values of the overdue rows, for a store that takes patches."""
    values = [F.lit(v).alias(c) for c, v in unscheduled_values(date_col, interview_col).items()]
    return admissions.filter(overdue).select(F.col("child_service_id").cast("long").alias("child_service_id"), *values)


def mark_unscheduled(
    admissions: DataFrame,
    as_of: dt.date,
    holidays: Iterable[dt.date] | DataFrame = (),
    max_wait: int = 10,
    min_attendance: int = 6,
    convention: str = "legacy",
    date_col: str = SCHEDULED_COLUMN,
    interview_col: str = INTERVIEW_COLUMN,
) -> tuple[DataFrame, DataFrame]:
    """Admissions with overdue rows marked, and the rows to add to the calendar.

    The rule looks at one row at a time, so the marking is a projection without any join.
    """
    overdue = is_overdue(as_of, holidays, max_wait, min_attendance, convention)
    values = unscheduled_values(date_col, interview_col)
    marked = admissions.withColumn("_overdue", overdue).withColumns(
        {c: F.when(F.col("_overdue"), F.lit(v)).otherwise(F.col(c)) for c, v in values.items()}
    )
    calendar_rows = unscheduled_patch(admissions, overdue, CALENDAR_DATE, CALENDAR_INTERVIEW)
    return marked.drop("_overdue"), calendar_rows.select("child_service_id", *CALENDAR_PATCH_COLUMNS)


def calendar_with(calendar: DataFrame, calendar_rows: DataFrame) -> DataFrame:
    """Update the calendar entry of each marked service, or create it."""
    return upsert_patch(calendar, calendar_rows, ["child_service_id"], CALENDAR_PATCH_COLUMNS, create=True)
