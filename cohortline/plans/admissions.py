"""The admissions base: new admissions with everything the back office needs to know."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions import dates
from cohortline.functions.text import in_list_flag
from cohortline.operators import enrich, spells
from cohortline.operators.columns import rename_columns, try_casts, with_defaults
from cohortline.session import staged
from cohortline.sources.schemas import ADMISSION_ID_COLUMNS


@dataclass(frozen=True)
class OperationalTables:
    """The operational inputs; ``renewals_history`` may come from another server."""

    spells: DataFrame
    children: DataFrame
    child_payers: DataFrame
    persons: DataFrame
    family_members: DataFrame
    relations: DataFrame
    service_status: DataFrame
    centers: DataFrame
    center_products: DataFrame
    levels: DataFrame
    shifts: DataFrame
    company_services: DataFrame
    quotes: DataFrame
    renewals_history: DataFrame
    action_history: DataFrame
    attendance: DataFrame


# Published names of the base columns, and defaults at the first load.
PUBLISHED_NAMES = {
    "service_id": "child_service_id",
    "child_full_name": "child_name",
    "child_dni": "child_dni_code",
    "child_birth_dt": "child_date_birth",
    "child_gender": "child_gender_desc",
    "payer_id": "child_financial_guardian_id",
    "payer_full_name": "child_financial_guardian_name",
    "payer_dni": "child_financial_guardian_dni_code",
    "payer_relation": "child_financial_guardian_relationship_desc",
    "payer_email": "child_financial_guardian_email",
    "guardian_id": "child_educational_guardian_id",
    "guardian_full_name": "child_educational_guardian_name",
    "guardian_dni": "child_educational_guardian_dni_code",
    "guardian_relation": "child_educational_guardian_relationship_desc",
    "guardian_email": "child_educational_guardian_email",
    "center_id": "educational_center_code",
    "center_name": "educational_center_name",
    "channel": "child_admission_channel_value",
    "level": "child_level_name",
    "shift": "child_service_type_desc",
    "room_id": "educational_center_room_id",
    "last_enrollment_ts": "child_last_enrollment_dt",
    "last_renewal_ts": "child_last_renewal_process_dt",
    "start_dt": "child_service_start_dt",
    "end_dt": "child_service_end_dt",
    "status": "child_service_status",
    "attendance_days": "child_attendance_days_value",
}
LOAD_DEFAULTS = {
    "child_adaptation_scheduling_flag": "false",
    "child_adaptation_scheduling_comment": "Sin comentarios",
    "child_adaptation_scheduling_start_dt": "",
    "child_adaptation_responsible": "",
    "interview_flag": "false",
    "child_interview_start_dt": "",
    "child_interview_responsible": "",
    "child_interview_end_dt": "",
    "scheduling_channel_value": "",
    "child_adaptation_scheduling_end_dt": "",
    "center_interview_responsible": "",
}

BASE_COLUMNS = ["child_id", *PUBLISHED_NAMES]


def with_family(rows: DataFrame, children: DataFrame, child_payers: DataFrame) -> DataFrame:
    """Child and payers; one row per payer, and a child without payer keeps its row."""
    return enrich.with_payers(enrich.with_children(rows, children), child_payers)


def with_people(families: DataFrame, tables: OperationalTables) -> DataFrame:
    """Payer and educational guardian, each with the relation to the family."""
    known = families
    for role in ("payer", "guardian"):
        known = enrich.with_person(known, tables.persons, role)
        known = enrich.with_relation(known, tables.family_members, tables.relations, role)
    return known


def with_service(rows: DataFrame, tables: OperationalTables) -> DataFrame:
    """Status, center, product and channel of the spell."""
    placed = enrich.with_center(enrich.with_status(rows, tables.service_status), tables.centers)
    sold = enrich.with_product(placed, tables.center_products, tables.levels, tables.shifts)
    return enrich.with_channel(sold, tables.company_services)


def with_enrollment_dates(
    rows: DataFrame, tables: OperationalTables, as_of: dt.date, facts: DataFrame | None = None
) -> DataFrame:
    """Last enrolment and renewal date; the rows must carry ``is_corporate``.

    Without ``facts`` those of all children are staged: fresh from their aggregate they would pin
    the join to its partitions, and Spark could not split the rows of a hot child.
    """
    if facts is None:
        facts = staged(spells.child_facts(tables.spells, tables.quotes, tables.action_history, as_of), "child-facts")
    history = tables.renewals_history.filter(F.col("year") == as_of.year - 1).select(
        "child_id", "renewal_ts", F.lit(True).alias("in_history")
    )
    joined = (
        rows.join(tables.quotes.select("quote_id", "modified_ts"), "quote_id", "left")
        .join(facts, "child_id", "left")
        .join(history, "child_id", "left")
    )
    return joined.withColumns(
        {
            "last_enrollment_ts": spells.last_enrollment_ts(
                F.col("modified_ts"), F.col("converted_ts"), F.col("start_dt")
            ),
            "last_renewal_ts": spells.renewal_ts(
                is_corporate=F.col("is_corporate"),
                quote_ts=F.col("modified_ts"),
                conversion_ts=F.col("converted_ts"),
                # A first action always has a date, a history row may lack one.
                has_renewal=F.col("in_history").isNotNull() | F.col("first_action_ts").isNotNull(),
                history_ts=F.col("renewal_ts"),
                action_ts=F.col("first_action_ts"),
                enrolled_last_year=F.coalesce("enrolled_last_year", F.lit(False)),
                as_of=as_of,
            ),
        }
    )


def with_attendance(rows: DataFrame, attendance: DataFrame) -> DataFrame:
    """Attended days, zero where none are recorded."""
    joined = rows.join(spells.attendance_days(attendance), "service_id", "left")
    return joined.withColumn("attendance_days", F.coalesce("attendance_days", F.lit(0)))


def admissions_base(
    tables: OperationalTables, as_of: dt.date, lookback_days: int = spells.LOOKBACK_DAYS
) -> DataFrame:
    """New admissions as of a date, enriched; several payers of a child give several rows.

    Only the admissions are staged.  All joins are without hints: a staged table carries its
    size, so Spark broadcasts a day's admissions to the scans of the large tables and shuffles a
    load that is too large for that.  A child has few new admissions, so no join key is hot here.
    """
    admitted = staged(spells.new_admissions(tables.spells, as_of, lookback_days), "admitted")
    own = admitted.select("child_id")
    history = tables.spells.join(own, "child_id", "left_semi")
    actions = tables.action_history.join(own, "child_id", "left_semi")
    facts = spells.child_facts(history, tables.quotes, actions, as_of)
    families = with_family(admitted, tables.children, tables.child_payers)
    served = with_service(with_people(families, tables), tables)
    dated = with_enrollment_dates(served, tables, as_of, facts)
    attended = tables.attendance.join(admitted.select("service_id"), "service_id", "left_semi")
    return with_attendance(dated, attended).select(*BASE_COLUMNS)


def published(base: DataFrame, pilot_centers: tuple[str, ...]) -> DataFrame:
    """The base in the shape of the admissions table: its names, load defaults and text dates."""
    moments = ["last_enrollment_ts", "last_renewal_ts", "start_dt", "child_birth_dt"]
    as_text = base.withColumns({c: dates.iso_text(F.col(c)) for c in moments})
    renamed = with_defaults(rename_columns(as_text, PUBLISHED_NAMES), LOAD_DEFAULTS)
    flagged = renamed.withColumn(
        "flag_poc_center", in_list_flag(F.col("educational_center_code"), pilot_centers)
    )
    return try_casts(flagged, {c: "long" for c in ADMISSION_ID_COLUMNS})
