"""Mailing audiences: who is due today, with which address, and whether to send at all."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions import dates
from cohortline.functions.business_days import business_days_between, dates_counting
from cohortline.functions.text import audience_tag, nonblank, service_day_tag
from cohortline.operators.columns import require_nonblank, try_casts
from cohortline.operators.keys import absent_from, first_per_key
from cohortline.session import staged_observed
from cohortline.sources.dated import EVENT_DATE, between
from cohortline.sources.schemas import ENDED_COLUMN, SCHEDULED_COLUMN

# Fixed values.
SEND, DO_NOT_SEND = "Enviar", "No enviar"
AUTOMATIC = "Automatico"
# One @, no blanks, and a dot inside the domain.  The mailing service has its own, unpublished rule.
ADDRESS_PATTERN = r"^[^@\s]+@[^@\s.]+(\.[^@\s.]+)+$"

_PERSON_COLUMNS = [
    "child_service_id",
    "child_id",
    "child_name",
    "child_educational_guardian_id",
    "child_financial_guardian_email",
    "child_educational_guardian_email",
]


def with_tag(df: DataFrame, as_of: dt.date, code: str) -> DataFrame:
    """The run date, the campaign code, and a tag of service, child, guardian and date."""
    tag = audience_tag(
        F.col("child_service_id"), F.col("child_id"), F.col("child_educational_guardian_id"), as_of
    )
    return df.withColumns({"current_date": F.lit(as_of), "tag": tag, "campaign_code": F.lit(code)})


def _due(df: DataFrame, event: Column, as_of: dt.date, days: int) -> DataFrame:
    """Rows whose event happened exactly ``days`` days before ``as_of``."""
    due = df.filter(dates.falls_on(event, as_of - dt.timedelta(days=days)))
    return due.withColumns(
        {"event_date": F.to_date(event), "days_difference": dates.days_from(as_of, event)}
    )


def new_admission_audience(admissions: DataFrame, as_of: dt.date, days: int, code: str) -> DataFrame:
    """Enrolments of exactly ``days`` days ago."""
    known = admissions.select(*_PERSON_COLUMNS, "child_last_enrollment_dt")
    return with_tag(_due(known, dates.as_ts("child_last_enrollment_dt"), as_of, days), as_of, code)


def end_of_period_audience(
    admissions: DataFrame,
    as_of: dt.date,
    days: int,
    code: str,
    end_col: str = ENDED_COLUMN,
) -> DataFrame:
    """Adaptations that ended exactly ``days`` days ago, by the chosen end column."""
    shown = ENDED_COLUMN
    columns = list(dict.fromkeys([*_PERSON_COLUMNS, shown, end_col]))
    ended = require_nonblank(admissions.select(*columns), end_col)
    due = _due(ended, dates.parse_text_ts(end_col), as_of, days)
    dated = due.withColumn("adaptation_end_date", F.date_format(dates.parse_text_ts(shown), "dd/MM/yyyy"))
    return with_tag(dated, as_of, code).withColumnRenamed("child_educational_guardian_email", "email")


def send_flag(difference: Column, days: int) -> Column:
    """Send when the event lies exactly ``days`` days back: a stored N compares as -N."""
    return F.when(difference == -days, SEND).otherwise(DO_NOT_SEND)


def scheduled_contacts(
    admissions: DataFrame,
    as_of: dt.date,
    days: int,
    code: str,
    holidays: Iterable[dt.date] | DataFrame = (),
    convention: str = "legacy",
    date_col: str = SCHEDULED_COLUMN,
) -> DataFrame:
    """Scheduled adaptations with calendar and working days from today and the send flag."""
    scheduled = admissions.filter(F.col("child_adaptation_scheduling_flag") == "true").select(
        *_PERSON_COLUMNS, F.to_date(dates.parse_text_ts(date_col)).alias("event_date")
    )
    working = business_days_between(F.lit(as_of), F.col("event_date"), holidays, convention)
    counted = scheduled.withColumns(
        {"days_difference": dates.days_from(as_of, "event_date"), "working_days_difference": working}
    )
    flagged = counted.withColumn("send_email_flag", send_flag(F.col("working_days_difference"), days))
    return with_tag(flagged, as_of, code)


def contacts_by_working_days(
    admissions: DataFrame,
    as_of: dt.date,
    days: int,
    code: str,
    holidays: Iterable[dt.date] | DataFrame = (),
    convention: str = "legacy",
    date_col: str = SCHEDULED_COLUMN,
) -> DataFrame:
    """Guardians whose scheduled adaptation was exactly ``days`` working days ago.

    The days that count so many are one range, so no row's working days are counted.  With ``date_col`` the typed date of a
    table written by ``write_dated``, only the due partitions are read.
    """
    first, last = dates_counting(as_of, -days, holidays, convention)
    if date_col == EVENT_DATE:
        due = between(admissions, first, last)
    else:
        due = admissions.filter(dates.falls_between(dates.parse_text_ts(date_col), first, last))
    due = require_nonblank(due.filter(F.col("child_adaptation_scheduling_flag") == "true"), "child_educational_guardian_email")
    return with_tag(due.select(*_PERSON_COLUMNS), as_of, code).select(
        "child_service_id",
        "current_date",
        F.col("child_educational_guardian_email").alias("email"),
        "tag",
        "campaign_code",
    )


def contacts_by_days(
    admissions: DataFrame, tags: DataFrame, as_of: dt.date, days: int, date_col: str = SCHEDULED_COLUMN
) -> DataFrame:
    """Guardians whose adaptation was scheduled exactly ``days`` calendar days ago.

    The tag and the campaign code come from a table of tags by service; a service without a tag
    stays, tagged with service and date.
    """
    scheduled = require_nonblank(admissions, date_col).select(
        "child_service_id", "child_educational_guardian_email", date_col
    )
    due = _due(scheduled, dates.parse_text_ts(date_col), as_of, days)
    own_tag = service_day_tag(F.col("child_service_id"), as_of)
    return due.join(tags.select("child_service_id", "tag", "campaign_code"), "child_service_id", "left").select(
        "child_service_id",
        F.col("child_educational_guardian_email").alias("email"),
        F.coalesce("tag", own_tag).alias("tag"),
        "campaign_code",
    )


def with_constant_lookup(df: DataFrame, lookup: DataFrame, key: str, value: object, column: str) -> DataFrame:
    """Attach one column of the lookup row with a constant key; no such row, no result.

    A key that is not unique gives a row for each of its lookup rows, as a join does.  The rows come in
    as one list by a scalar subquery, so nothing is shuffled; ``lookup`` is a table of types, of which one key has few rows.
    """
    found = lookup.filter(F.col(key) == F.lit(value)).agg(F.collect_list(F.struct(column)).alias("found")).scalar()
    attached = df.withColumn("_row", F.explode(found))
    return attached.withColumn(column, F.col("_row")[column]).drop("_row")


def survey_audience(recipients: DataFrame, types: DataFrame, type_id: int) -> DataFrame:
    """Recipients of one survey type, each address once (the lowest tag of an address stays)."""
    typed = with_constant_lookup(recipients, types, "type_id", type_id, "name")
    unique = dedupe_contacts(typed, "email", ["tag"])
    return unique.select("email", "tag", F.col("name").alias("campaign_code"))


def dedupe_contacts(df: DataFrame, email: str, order: Sequence[Column | str]) -> DataFrame:
    """One row per address, the first in the stated order."""
    return first_per_key(df, [email], order)


def split_contacts(df: DataFrame, email: str = "email") -> tuple[DataFrame, DataFrame]:
    """Rows with a usable address, and the others with the reason."""
    reason = F.when(nonblank(email).isNull(), "missing").when(
        ~F.trim(email).rlike(ADDRESS_PATTERN), "invalid"
    )
    marked = df.withColumn("reject_reason", reason)
    accepted = marked.filter("reject_reason IS NULL").drop("reject_reason")
    return accepted, marked.filter("reject_reason IS NOT NULL")


def new_members_only(
    contacts: DataFrame,
    members: DataFrame,
    audience_id: str,
    email: str = "email",
    order: Sequence[Column | str] = ("child_service_id", "email"),
) -> DataFrame:
    """Contacts the mailing list would accept: not yet a member, and the first with its address.

    Addresses compare without case, as a list does.
    """
    keyed = contacts.withColumn("_address", F.lower(F.trim(email)))
    first = first_per_key(keyed, ["_address"], order)
    listed = members.filter(F.col("audience_id") == audience_id).select(
        F.lower(F.trim("email_address")).alias("_address")
    )
    return absent_from(first, listed, ["_address"]).drop("_address")


def with_refusal(
    contacts: DataFrame,
    members: DataFrame,
    audience_id: str,
    email: str = "email",
    order: Sequence[str] = ("child_service_id", "email"),
    row_id: str = "contact_id",
) -> DataFrame:
    """Each contact with the reason why the list would refuse it: ``member``, ``repeated`` or NULL.

    The accepted ones are those of ``new_members_only``.  ``row_id`` names a stored column that tells the contacts apart.  No window
    holds an address's rows: its first row is cut before the exchange and joined back.
    """
    keyed = contacts.withColumn("_address", F.lower(F.trim(email)))
    place = F.struct(*order, row_id)
    first = keyed.groupBy(F.col("_address").alias("_of")).agg(F.min(place)[row_id].alias("_first"))
    listed = members.filter(F.col("audience_id") == audience_id).select(
        F.lower(F.trim("email_address")).alias("_listed")
    )
    known = keyed.join(first, F.col("_address") == F.col("_of"), "left")
    known = known.join(listed.distinct(), F.col("_address") == F.col("_listed"), "left")
    reason = F.when(F.col("_listed").isNotNull(), "member").when(F.col(row_id) != F.col("_first"), "repeated")
    return known.withColumn("reject_reason", reason).select(*contacts.columns, "reject_reason")


@dataclass(frozen=True)
class Campaign:
    """Settings of one campaign; ``threshold_days`` is the positive N of "N days ago"."""

    code: str
    send_flag: str
    template_code: int
    from_name: str
    reply_to: str
    subject: str
    threshold_days: int


def campaign_config(config: DataFrame, code: str) -> DataFrame:
    """The settings rows of a campaign code, numbers cast from text; there should be one."""
    picked = config.filter(F.col("campaign_email_code") == code)
    return try_casts(picked, {"html_template_code": "int", "trigger_threshold_days": "int"})


def load_campaign(config: DataFrame, code: str) -> Campaign:
    """The one settings row on the driver; an unknown or a repeated code is an error."""
    rows = campaign_config(config, code).limit(2).collect()
    if len(rows) != 1:
        raise LookupError(f"{'no' if not rows else 'more than one'} campaign is configured under {code!r}")
    row = rows[0]
    return Campaign(
        code=row["campaign_email_code"],
        send_flag=row["automation_send_email_flag"],
        template_code=row["html_template_code"],
        from_name=row["email_from_name"],
        reply_to=row["email_reply_to"],
        subject=row["email_subject"],
        threshold_days=row["trigger_threshold_days"],
    )


def audience_gate(audience: DataFrame, min_rows: int = 0) -> DataFrame:
    """The audience if it has more than ``min_rows`` rows, else nothing.

    It is computed once: the job that stages its rows counts them.
    """
    kept, seen = staged_observed(audience, "audience", rows=F.count(F.lit(1)))
    return kept if seen["rows"] > min_rows else kept.limit(0)


def sends_automatically(flag: Column, automatic: Sequence[str] = (AUTOMATIC,)) -> Column:
    """Whether a campaign leaves without a person pressing send."""
    return F.coalesce(flag.isin(*automatic), F.lit(False))
