import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortline import session
from cohortline.operators import columns, reporting, slots
from cohortline.operators.keys import upsert_patch
from cohortline.sources import schemas
from cohortline.sources.readers import TableSpec, flatten_typed_items, jdbc_options, read_records_json, read_table
from cohortline.sources.writers import append_rows, write_documents, write_extract, write_keyed_table


def test_json_array_and_line_files(spark, tmp_path):
    records = [{"child_service_id": 1, "child_adaptation_responsible": "O'Neil"}, {"child_service_id": 2}]
    (tmp_path / "array.json").write_text(json.dumps(records, indent=1))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(r) for r in records))
    schema = "child_service_id long, child_adaptation_responsible string"
    want = [(1, "O'Neil"), (2, None)]
    assert rows(read_records_json(spark, str(tmp_path / "array.json"), schema, array_files=True)) == want
    assert rows(read_records_json(spark, str(tmp_path / "lines.json"), schema)) == want


def test_csv_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "slots.csv"
    path.write_text("﻿horas\n08:00\n08:15\n", encoding="utf-8")
    df = read_table(spark, TableSpec("csv", str(path)))
    assert df.columns == ["horas"] and rows(df) == [("08:00",), ("08:15",)]


def test_import_template(spark, tmp_path):
    path = tmp_path / "template.csv"
    path.write_text("Email Address,TIPO,TAG\na@x.cl,T,1\n")
    df = read_table(spark, TableSpec("csv", str(path), schema=schemas.IMPORT_TEMPLATE))
    assert rows(columns.rename_columns(df, {"Email Address": "email"}), "email", "TAG") == [("a@x.cl", "1")]


def test_jdbc_options():
    url = {"url": "jdbc:example"}
    assert jdbc_options(TableSpec("jdbc", "spells", options=url)) == {
        "url": "jdbc:example", "fetchsize": "10000", "dbtable": "spells",
    }
    assert jdbc_options(TableSpec("jdbc", "SELECT 1", is_query=True))["query"] == "SELECT 1"
    split = TableSpec(
        "jdbc", "SELECT * FROM t", is_query=True, split_column="id", split_bounds=("0", "100"), splits=8,
        options={"fetchsize": "50"},
    )
    assert jdbc_options(split) == {
        "fetchsize": "50", "dbtable": "(SELECT * FROM t) source", "partitionColumn": "id",
        "lowerBound": "0", "upperBound": "100", "numPartitions": "8",
    }
    with pytest.raises(ValueError, match="bound"):
        jdbc_options(TableSpec("jdbc", "t", split_column="id"))


def test_typed_items(spark):
    items = [
        '{"id": {"N": "7"}, "name": {"S": "O\'Neil"}, "ok": {"BOOL": true}, "extra": {"S": "x"}}',
        '{"id": {"S": "seven"}, "name": {"N": "1.5"}}',
        "not json",
    ]
    df = spark.createDataFrame([(i,) for i in items], "item string")
    flat = flatten_typed_items(df, "item", "id long, name string, ok boolean")
    assert rows(flat) == [(None, None, None), (None, "1.5", None), (7, "O'Neil", True)]


def test_state_schemas_parse(spark):
    for name in ("ADMISSIONS", "CALENDAR", "JOURNEY_MONITOR", "JOURNEY_CONTROL", "CAMPAIGN_CONFIG", "INGESTION_LOG", "CAMPAIGN_REPORT"):
        assert spark.createDataFrame([], getattr(schemas, name)).columns
    assert len(spark.createDataFrame([], schemas.ADMISSIONS).columns) == 39


def test_append_and_extract(spark, tmp_path):
    log = reporting.ingestion_log_row(spark.range(410), dt.datetime(2024, 2, 3, 7, 4, 9))
    for _ in range(2):
        append_rows(log, str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    assert rows(stored) == [("03/02/2024 07:04:09", 410)] * 2
    write_extract(reporting.ingestion_log(stored), str(tmp_path / "csv"))
    again = read_table(spark, TableSpec("csv", str(tmp_path / "csv"), schema="data_ingestion_process_dt timestamp_ntz, loaded_rows_value long"))
    assert rows(again) == [(dt.datetime(2024, 2, 3, 7, 4, 9), 410)] * 2


def test_keyed_tables_join_without_exchange(spark, tmp_path):
    state = spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    patch = spark.range(50).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    write_keyed_table(state, "state_day_1", ["k"], 4, str(tmp_path / "state"))
    write_keyed_table(patch, "patch_day_1", ["k"], 4, str(tmp_path / "patch"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        patched = upsert_patch(spark.table("state_day_1"), spark.table("patch_day_1"), ["k"], ["v"])
        assert "Exchange" not in patched._jdf.queryExecution().executedPlan().toString()
        assert patched.filter("v = 'new'").count() == 50 and patched.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE state_day_1")
        spark.sql("DROP TABLE patch_day_1")


def test_documents(spark, tmp_path):
    df = spark.createDataFrame([('{"item":{"k":1}}',), ('{"item":{"k":2}}',)], "payload string")
    write_documents(df, str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ['{"item":{"k":1}}', '{"item":{"k":2}}']


def test_campaign_report_needs_all_four_numbers(spark):
    def document(summary, **settings):
        made = {
            "web_id": 1, "status": "sent", "create_time": "2024-01-02T03:04:05-03:00",
            "recipients": {"list_id": "l", "list_is_active": True, "list_name": "n", "recipient_count": 3},
            "settings": {"title": "t", "template_id": 5, **settings},
        }
        return json.dumps({**made, **({"report_summary": summary} if summary else {})})

    full = {"opens": 4, "unique_opens": 2, "open_rate": 0.5, "click_rate": 0.25}
    partial = {"opens": 4, "unique_opens": 2, "open_rate": 0.5}
    df = spark.createDataFrame(
        [(document(full, subject_line="s"),), (document(partial),), (document(None, from_name="f", reply_to="r"),)], "document string"
    )
    report = reporting.campaign_report(df)
    wanted = ["report_opens_value", "report_open_rate", "report_click_rate", "email_subject", "campaign_from_name"]
    assert rows(report, *wanted) == [(0, 0.0, 0.0, "", ""), (0, 0.0, 0.0, "", "f"), (4, 0.5, 0.25, "s", "")]
    assert {r.campaign_create_date for r in report.collect()} == {"2024-01-02 03:04:05"}


def test_monitoring_extract_keeps_unparsed_rows(spark):
    admissions = spark.createDataFrame(
        [("2", "true", "1/3/2024 9:5:7"), ("10", "wasnt scheduled", "31/12/2050 09:00:00"), ("3", "false", "")],
        "child_service_id string, child_adaptation_scheduling_flag string, child_adaptation_scheduling_dt string",
    )
    control = spark.createDataFrame([tuple([2] + ["x"] * 11)], schemas.JOURNEY_CONTROL)
    extract = reporting.monitoring_extract(admissions, control, "child_adaptation_scheduling_dt").collect()
    assert [r.child_service_id for r in extract] == [10, 3, 2]
    assert [r.child_adaptation_scheduling_year for r in extract] == [2050, None, 2024]
    assert [r.child_welcome_email_sent_flag for r in extract] == ["false", "false", "x"]
    assert [r.adaptations_not_schedulled_flag for r in extract] == [1, 0, 0]


def test_required_columns_split(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (None, None)], "a long, b long")
    complete, rejected = columns.split_on_required(df, ["a", "b"])
    assert rows(complete) == [(1, 2)]
    assert rows(rejected, "reject_reason") == [("a",), ("a,b",)]


def test_time_slots(spark):
    labels = [r.slot for r in slots.time_slots(spark).orderBy("slot").collect()]
    assert len(labels) == 45 and labels[0] == "08:00" and labels[1] == "08:15" and labels[-1] == "19:00"
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 8, 14, 59),), (dt.datetime(2024, 1, 1, 8, 15),)], "ts timestamp_ntz")
    assert rows(df.select(slots.slot_of(F.col("ts")))) == [("08:00",), ("08:15",)]


def test_staged_tables_lie_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    kept = session.staged(spark.range(3).withColumn("part", F.lit(None).cast("string")), "kept")
    run = spark.conf.get(session.RUN)
    assert all(f.startswith(f"file://{named}/cohortline/{run}/kept-") for f in kept.inputFiles())
    assert rows(kept, "id") == [(0,), (1,), (2,)]
    assert session.staged(spark.range(0), "empty").count() == 0


def test_two_runs_share_no_folder(spark):
    mine = session.run_dir(spark)
    kept = session.staged(spark.range(2), "kept")
    other = spark.newSession()
    other.conf.unset(session.RUN)
    assert session.run_dir(other) != mine
    session.staged(other.range(5), "kept")
    session.drop_run(other)
    assert session.run_dir(spark) == mine and kept.count() == 2
