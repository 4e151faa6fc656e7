"""Members of a mailing list, the events of their journey, and the control row per service."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions.text import event_key
from cohortline.operators.columns import with_defaults

# Fixed values.
SUBSCRIBED = "subscribed"
SENT = "sent"
CONTROL_DEFAULTS = {
    "child_adaptation_survey_email_sent_flag": "true",
    "child_adaptation_survey_email_read_flag": "false",
    "child_adaptation_survey_completed_flag": "false",
    "child_welcome_email_sent_flag": "false",
    "child_welcome_email_read_flag": "false",
    "child_welcome_email_sent_dt": "",
    "child_adaptation_scheduling_reminder_email_sent_flag": "false",
    "child_adaptation_scheduling_reminder_email_read_flag": "false",
    "child_adaptation_scheduling_reminder_email_dt": "false",
}


def member_rows(contacts: DataFrame) -> DataFrame:
    """One row per guardian address of a service, educational first; equal addresses once."""
    addresses = F.array_distinct(
        F.array("child_educational_guardian_email", "child_financial_guardian_email")
    )
    return contacts.select(
        "child_service_id", "current_date", "tag", "campaign_code", F.explode(addresses).alias("email")
    )


def member_payloads(
    members: DataFrame,
    audience_id: str,
    merge_fields: bool = True,
    keep: Sequence[str] = ("child_service_id",),
) -> DataFrame:
    """The document that subscribes a member, with code and tag unless told otherwise."""
    fields = [F.col("email").alias("email_address"), F.lit(SUBSCRIBED).alias("status")]
    if merge_fields:
        merged = F.struct(F.col("campaign_code").alias("TIPO"), F.col("tag").alias("TAG"))
        fields.append(merged.alias("merge_fields"))
    payload = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return members.select(F.lit(audience_id).alias("audience_id"), *keep, payload.alias("payload"))


def journey_events(members: DataFrame) -> DataFrame:
    """One "sent" event per accepted member."""
    return members.select(
        event_key(F.col("child_service_id"), F.col("campaign_code")).alias("process_email_key"),
        F.col("child_service_id").cast("long").alias("child_service_id"),
        F.lit(SENT).alias("process_email_step_value"),
        F.col("current_date").cast("string").alias("process_email_dt"),
        F.col("campaign_code").alias("process_email_name"),
        F.col("tag").alias("process_email_tag"),
    )


def journey_control_rows(contacts: DataFrame) -> DataFrame:
    """The control row of each service whose survey went out."""
    sent = contacts.select(
        F.col("child_service_id").cast("long").alias("child_service_id"),
        F.col("tag").alias("child_adaptation_survey_tag"),
        F.col("current_date").cast("string").alias("child_adaptation_survey_email_sent_dt"),
    )
    return with_defaults(sent, CONTROL_DEFAULTS)
