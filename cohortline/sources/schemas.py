"""Schemas of the input and state tables.  Column names are the data contract."""

from __future__ import annotations

# Operational inputs.
SPELLS = "service_id long, child_id long, center_id string, product_id long, status_id int, quote_id long, start_dt date, end_dt date"
CHILDREN = (
    "child_id long, family_id long, edu_guardian_id long, first_name string, last_name string, "
    "second_last_name string, dni long, birth_dt date, gender string"
)
CHILD_PAYERS = "child_id long, person_id long"
PERSONS = "person_id long, first_name string, last_name string, second_last_name string, dni long, email string"
FAMILY_MEMBERS = "family_id long, person_id long, relation_id int"
CENTERS = "center_id string, name string"
CENTER_PRODUCTS = "product_id long, level_id int, shift_id int, room_id long"
COMPANY_SERVICES = "service_id long"
QUOTES = "quote_id long, modified_ts timestamp_ntz"
RENEWALS_HISTORY = "child_id long, year int, renewal_ts timestamp_ntz"
ACTION_HISTORY = "child_id long, action_id int, period int, action_ts timestamp_ntz"
ATTENDANCE = "service_id long, day_flag int, retail_flag int, night_flag int"
DESCRIPTIONS = "id int, description string"  # relations, service status, levels, shifts
HOLIDAYS = "holiday date"

# The id columns an admission must have, and the text columns beside them.
ADMISSION_ID_COLUMNS = [
    "child_service_id",
    "child_dni_code",
    "child_educational_guardian_dni_code",
    "child_educational_guardian_id",
    "child_financial_guardian_dni_code",
    "child_financial_guardian_id",
    "child_id",
    "educational_center_room_id",
    "child_attendance_days_value",
]
ADMISSION_TEXT_COLUMNS = [
    "child_adaptation_scheduling_flag",
    "child_adaptation_scheduling_start_dt",
    "child_adaptation_scheduling_comment",
    "child_adaptation_responsible",
    "child_admission_channel_value",
    "child_date_birth",
    "child_educational_guardian_email",
    "child_educational_guardian_name",
    "child_educational_guardian_relationship_desc",
    "child_financial_guardian_email",
    "child_financial_guardian_name",
    "child_financial_guardian_relationship_desc",
    "child_gender_desc",
    "child_last_enrollment_dt",
    "child_last_renewal_process_dt",
    "child_level_name",
    "child_name",
    "child_service_start_dt",
    "child_service_status",
    "child_service_type_desc",
    "educational_center_code",
    "educational_center_name",
    "flag_poc_center",
    "interview_flag",
    "child_interview_start_dt",
    "child_interview_responsible",
    "child_interview_end_dt",
    "scheduling_channel_value",
    "child_adaptation_scheduling_end_dt",
    "center_interview_responsible",
]
# What the stored admissions call the date and end of an adaptation and the answer to the interview.
SCHEDULED_COLUMN = "child_adaptation_scheduling_start_dt"
ENDED_COLUMN = "child_adaptation_scheduling_end_dt"
INTERVIEW_COLUMN = "interview_flag"

ADMISSION_COLUMNS = ADMISSION_ID_COLUMNS + ADMISSION_TEXT_COLUMNS

JOURNEY_CONTROL_COLUMNS = [
    "child_adaptation_survey_email_sent_flag",
    "child_adaptation_survey_email_read_flag",
    "child_adaptation_survey_completed_flag",
    "child_adaptation_survey_tag",
    "child_adaptation_survey_email_sent_dt",
    "child_welcome_email_sent_flag",
    "child_welcome_email_read_flag",
    "child_welcome_email_sent_dt",
    "child_adaptation_scheduling_reminder_email_sent_flag",
    "child_adaptation_scheduling_reminder_email_read_flag",
    "child_adaptation_scheduling_reminder_email_dt",
]

ADMISSIONS = ", ".join(
    [f"{c} long" for c in ADMISSION_ID_COLUMNS] + [f"{c} string" for c in ADMISSION_TEXT_COLUMNS]
)
CALENDAR = (
    "child_service_id long, child_adaptation_responsible string, child_adaptation_scheduling_dt string, "
    "first_interview_flag string, child_adaptation_scheduling_comment string"
)
JOURNEY_MONITOR = (
    "process_email_key string, child_service_id long, process_email_step_value string, "
    "process_email_dt string, process_email_name string, process_email_tag string"
)
JOURNEY_CONTROL = "child_service_id long, " + ", ".join(f"{c} string" for c in JOURNEY_CONTROL_COLUMNS)
CAMPAIGN_CONFIG = (
    "campaign_email_code string, automation_send_email_flag string, html_template_code string, "
    "email_from_name string, email_reply_to string, email_subject string, trigger_threshold_days string"
)
INGESTION_LOG = "data_ingestion_process_dt string, loaded_rows_value long"
CAMPAIGN_REPORT = (
    "web_id long, status string, create_time string, "
    "recipients struct<list_id:string,list_is_active:boolean,list_name:string,recipient_count:long>, "
    "settings struct<subject_line:string,title:string,from_name:string,reply_to:string,template_id:long>, "
    "report_summary struct<opens:long,unique_opens:long,open_rate:double,click_rate:double>"
)
IMPORT_TEMPLATE = "`Email Address` string, TIPO string, TAG string"
