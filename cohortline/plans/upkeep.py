"""Jobs over the stored tables: overdue marking, monitoring extracts, migration."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame

from cohortline.operators import migrate, reporting, scheduling
from cohortline.session import staged
from cohortline.sources.schemas import INTERVIEW_COLUMN, SCHEDULED_COLUMN
from cohortline.sources.writers import write_extract


def mark_overdue(
    admissions: DataFrame,
    calendar: DataFrame,
    as_of: dt.date,
    holidays: Iterable[dt.date] | DataFrame = (),
    convention: str = "legacy",
    date_col: str = SCHEDULED_COLUMN,
    interview_col: str = INTERVIEW_COLUMN,
) -> tuple[DataFrame, DataFrame]:
    """New state of the admissions and of the calendar; the few new entries are staged."""
    marked, rows = scheduling.mark_unscheduled(admissions, as_of, holidays, convention=convention, date_col=date_col, interview_col=interview_col)
    return marked, scheduling.calendar_with(calendar, staged(rows, "unscheduled"))


def write_monitoring(
    admissions: DataFrame, control: DataFrame, log: DataFrame, target: str
) -> None:
    """Both monitoring extracts as CSV under ``target``."""
    write_extract(reporting.monitoring_extract(admissions, control), f"{target}/adaptation_monitoring")
    write_extract(reporting.ingestion_log(log), f"{target}/inserted_rows")


def migrated(admissions: DataFrame, calendar: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both state tables in the newer shape."""
    return migrate.migrate_admissions(admissions), migrate.migrate_calendar(calendar, admissions)
