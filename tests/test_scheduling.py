import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from cohortline.functions.text import full_name
from cohortline.operators import enrich, migrate, scheduling
from cohortline.operators.keys import upsert_patch
from cohortline.plans import upkeep
from cohortline.sources import schemas

AS_OF = dt.date(2024, 3, 15)
STATE = (
    "child_service_id long, child_adaptation_scheduling_flag string, child_service_start_dt string, "
    "child_attendance_days_value string, child_adaptation_scheduling_start_dt string, child_adaptation_responsible string, "
    "child_adaptation_scheduling_comment string, interview_flag string"
)


def state(spark, *cases):
    return spark.createDataFrame([(i, f, s, a, "", "", "note", "") for i, (f, s, a) in enumerate(cases, 1)], STATE)


def cases(spark):
    return state(
        spark,
        ("false", "2024-03-01 00:00:00", "0"),  # ten working days ago
        ("false", "2024-03-04 00:00:00", "0"),  # nine
        ("false", "2024-03-04 00:00:00", "6"),
        ("false", None, "6"),
        ("false", None, "5"),
        ("false", "2024-03-01 00:00:00", "many"),
        ("true", "2024-01-01 00:00:00", "60"),
        ("wasnt scheduled", "2024-01-01 00:00:00", "60"),
        (None, "2024-01-01 00:00:00", "60"),
    )


def test_overdue_rule(spark):
    marked, calendar_rows = scheduling.mark_unscheduled(cases(spark), AS_OF)
    hit = marked.filter("child_adaptation_scheduling_flag = 'wasnt scheduled' AND child_service_id <> 8")
    assert rows(hit, "child_service_id") == [(1,), (3,), (4,), (6,)]
    assert rows(calendar_rows, "child_service_id") == [(1,), (3,), (4,), (6,)]
    assert calendar_rows.columns == ["child_service_id", *scheduling.CALENDAR_PATCH_COLUMNS]
    untouched = "child_service_id NOT IN (1, 3, 4, 6)"
    assert rows(marked.filter(untouched)) == rows(cases(spark).filter(untouched))


def test_a_holiday_postpones_the_mark(spark):
    marked, _ = scheduling.mark_unscheduled(cases(spark), AS_OF, [dt.date(2024, 3, 6)])
    assert rows(marked.filter("child_service_id = 1"), "child_adaptation_scheduling_flag") == [("false",)]


def test_marking_equals_patching(spark):
    df = cases(spark)
    marked, _ = scheduling.mark_unscheduled(df, AS_OF)
    patch = scheduling.unscheduled_patch(df, scheduling.is_overdue(AS_OF))
    patched = upsert_patch(df, patch, ["child_service_id"], list(scheduling.unscheduled_values()))
    assert rows(patched.select(marked.columns)) == rows(marked)
    again, more = scheduling.mark_unscheduled(marked, AS_OF)
    assert rows(again) == rows(marked) and more.count() == 0


def test_calendar_gets_updates_and_new_entries(spark):
    calendar = spark.createDataFrame(
        [(1, "Planner", "1/3/2024 9:0:0", "Yes", "ok"), (2, "Planner", "1/3/2024 9:0:0", "Yes", "ok")], schemas.CALENDAR
    )
    _, new = upkeep.mark_overdue(cases(spark), calendar, AS_OF)
    assert rows(new, "child_service_id", "child_adaptation_responsible") == [
        (1, "No agendado"), (2, "Planner"), (3, "No agendado"), (4, "No agendado"), (6, "No agendado"),
    ]


def test_scheduling_state(spark):
    admissions = spark.createDataFrame([(i, "QLC" if i == 1 else "X") for i in range(1, 6)], "child_service_id long, educational_center_code string")
    calendar = spark.createDataFrame(
        [
            (1, "No agendado", "1/3/2024 9:0:0", "", None),
            (2, "Planner", "1/3/2024 9:0:0", "Yes", "fine"),
            (3, None, "1/3/2024 9:0:0", None, None),
            (4, "Planner", None, None, None),
        ],
        schemas.CALENDAR,
    )
    got = scheduling.scheduling_state(admissions, calendar, ("QLC",))
    assert rows(got, "child_service_id", "child_adaptation_scheduling_flag", "flag_poc_center") == [
        (1, "wasnt scheduled", "true"), (2, "true", "false"), (3, "true", "false"), (4, "false", "false"), (5, "false", "false"),
    ]
    assert rows(got.filter("child_service_id = 5").drop("flag_poc_center", "educational_center_code")) == [
        (5, "", "", "", "Sin comentarios", "false")
    ]


def test_full_name(spark):
    df = spark.createDataFrame(
        [("Ana  ", "Diaz ", "  "), ("Ana", "Diaz", None), ("Ana", "O'Neil", "Paz  "), (None, "Diaz", "Paz"), ("Ana", None, "Paz")],
        "a string, b string, c string",
    )
    got = [r[0] for r in df.select(full_name(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["Ana Diaz", "Ana Diaz", "Ana O'Neil Paz", None, None]


def test_padded_center_ids_match(spark):
    df = spark.createDataFrame([("N1  ",), ("N2",), (None,)], "center_id string")
    centers = spark.createDataFrame([("N1", "One "), ("N2 ", "Two")], schemas.CENTERS)
    assert rows(enrich.with_center(df, centers)) == [(None, None), ("N1", "One"), ("N2", "Two")]


def test_migration(spark):
    admissions = spark.createDataFrame(
        [(1, "1/3/2024 9:0:0", None, "2024-03-01"), (2, "", "P", "2024-03-02"), (3, None, "P", None)],
        "child_service_id long, child_adaptation_scheduling_dt string, child_adaptation_responsible string, child_service_start_dt string",
    )
    calendar = spark.createDataFrame([(2, "2/3/2024 9:0:0"), (9, None)], "child_service_id long, child_adaptation_scheduling_dt string")
    moved, dated = upkeep.migrated(admissions, calendar)
    assert rows(moved, "child_service_id", "child_adaptation_scheduling_start_dt", "child_adaptation_responsible", "interview_flag") == [
        (1, "1/3/2024 9:0:0", "", "false"), (2, "", "P", "false"), (3, "", "P", "false"),
    ]
    assert rows(dated, "child_service_id", "child_adaptation_scheduling_start_dt", "child_adaptation_scheduling_end_dt", "process_date") == [
        (2, "2/3/2024 9:0:0", "", "2024-03-02"), (9, "", "", None),
    ]
    assert rows(migrate.migrate_admissions(moved)) == rows(moved)
