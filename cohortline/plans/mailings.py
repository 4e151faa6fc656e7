"""The mailing runs: working-day reminder, welcome, end-of-adaptation survey, survey from a view."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.operators import audience as au
from cohortline.operators import journeys
from cohortline.session import staged
from cohortline.sources.schemas import ENDED_COLUMN, SCHEDULED_COLUMN

ROW_ID = "contact_id"


@dataclass(frozen=True)
class Mailing:
    """One run: the contacts to subscribe, those set aside, their documents and events.

    A run over contacts without a service has no events.
    """

    accepted: DataFrame
    rejected: DataFrame
    payloads: DataFrame
    events: DataFrame | None
    sends_automatically: bool


def _numbered(contacts: DataFrame) -> DataFrame:
    """The contacts with an id each, to be stored with them."""
    return contacts.withColumn(ROW_ID, F.monotonically_increasing_id())


def _mailing(
    contacts: DataFrame,
    members: DataFrame,
    audience_id: str,
    campaign: au.Campaign,
    merge_fields: bool,
    min_rows: int = 0,
) -> Mailing:
    """The contacts and what the list says of them are staged: both are one day's share of the
    admissions, and documents and events must come from the same rows."""
    due = au.audience_gate(_numbered(contacts), min_rows)
    accepted, rejected = _split(due, members, audience_id)
    return Mailing(
        accepted=accepted,
        rejected=rejected,
        payloads=journeys.member_payloads(accepted, audience_id, merge_fields),
        events=journeys.journey_events(accepted),
        sends_automatically=campaign.send_flag == au.AUTOMATIC,
    )


def _split(
    due: DataFrame, members: DataFrame, audience_id: str, order: tuple[str, ...] = ("child_service_id", "email")
) -> tuple[DataFrame, DataFrame]:
    """Contacts that the list accepts, and all others with the reason; together they are all that is due.

    A service with two payers is due twice, and its second row is refused as repeated if both have one address.
    """
    usable, unusable = au.split_contacts(due)
    judged = staged(au.with_refusal(usable, members, audience_id, order=order, row_id=ROW_ID), "judged")
    accepted = judged.filter("reject_reason IS NULL").drop("reject_reason", ROW_ID)
    refused = judged.filter("reject_reason IS NOT NULL")
    return accepted, unusable.unionByName(refused).drop(ROW_ID)


def reminder(
    admissions: DataFrame,
    config: DataFrame,
    members: DataFrame,
    audience_id: str,
    code: str,
    as_of: dt.date,
    holidays: Iterable[dt.date] | DataFrame = (),
    min_rows: int = 0,
    convention: str = "legacy",
    date_col: str = SCHEDULED_COLUMN,
) -> Mailing:
    """Guardians of adaptations scheduled N working days ago, if there are more than ``min_rows``."""
    campaign = au.load_campaign(config, code)
    contacts = au.contacts_by_working_days(
        admissions, as_of, campaign.threshold_days, code, holidays, convention, date_col
    )
    return _mailing(contacts, members, audience_id, campaign, True, min_rows)


def welcome(
    admissions: DataFrame, config: DataFrame, members: DataFrame, audience_id: str, code: str, as_of: dt.date
) -> Mailing:
    """Both guardians of each enrolment of N days ago."""
    campaign = au.load_campaign(config, code)
    due = au.new_admission_audience(admissions, as_of, campaign.threshold_days, code)
    return _mailing(journeys.member_rows(due), members, audience_id, campaign, False)


def survey(
    admissions: DataFrame,
    config: DataFrame,
    members: DataFrame,
    audience_id: str,
    code: str,
    as_of: dt.date,
    end_col: str = ENDED_COLUMN,
) -> Mailing:
    """Guardians of adaptations that ended N days ago."""
    campaign = au.load_campaign(config, code)
    due = au.end_of_period_audience(admissions, as_of, campaign.threshold_days, code, end_col)
    return _mailing(due, members, audience_id, campaign, True)


def view_survey(
    recipients: DataFrame,
    types: DataFrame,
    type_id: int,
    config: DataFrame,
    members: DataFrame,
    audience_id: str,
    code: str,
    automatic: tuple[str, ...] = (au.AUTOMATIC, "true"),
) -> Mailing:
    """The recipients of a survey view, typed by one row of the survey types."""
    campaign = au.load_campaign(config, code)
    due = staged(_numbered(au.survey_audience(recipients, types, type_id)), "audience")
    accepted, rejected = _split(due, members, audience_id, ("tag", "email"))
    return Mailing(
        accepted=accepted,
        rejected=rejected,
        payloads=journeys.member_payloads(accepted, audience_id, keep=()),
        events=None,
        sends_automatically=campaign.send_flag in automatic,
    )
