"""Physical plans: what must hold for them to survive large and skewed tables."""

from __future__ import annotations

import dataclasses
import datetime as dt
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cohortline import session
from cohortline.operators import spells
from cohortline.plans import admissions as base
from workload import standins

SF_DIR = "/root/testdata/sf0.001"
AS_OF = dt.date(1998, 6, 15)

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the driver's tables")


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def large_tables(spark):
    """Plans as for tables that are too large to broadcast."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield spark
    for name in names:
        spark.conf.unset(name)


OWN = sorted(entry.QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_no_pairing_and_no_python(spark, name):
    plan = planned(entry.queries()[name](spark, SF_DIR))
    assert not re.search(r"CartesianProduct|NestedLoopJoin|Python|ArrowEval", plan)


def test_pair_checks_became_key_joins(large_tables):
    every = standins.spells(large_tables, SF_DIR)
    for df in (spells.first_admission(every), spells.current_spell(every, AS_OF), spells.new_admissions(every, AS_OF)):
        plan = planned(df)
        assert plan.count("SortMergeJoin") == 1
        # Combined by key before the exchange, so a hot child sends few rows.
        assert "partial_max" in plan
        # A window only ever sees combined rows.
        assert "Window [" not in plan or plan.index("Window [") < plan.rindex("HashAggregate")


def dated(every):
    """Enrolment and renewal dates of all spells, without any narrowing."""
    ts = F.col("start_dt").cast("timestamp_ntz")
    tables = dict.fromkeys(f.name for f in dataclasses.fields(base.OperationalTables))
    tables |= {
        "spells": every,
        "quotes": every.select("quote_id", ts.alias("modified_ts")),
        "renewals_history": every.filter("child_id <> 7").select(
            "child_id", F.lit(1997).alias("year"), ts.alias("renewal_ts")
        ),
        "action_history": every.select(
            "child_id", F.lit(15).alias("action_id"), F.lit(1998).alias("period"), ts.alias("action_ts")
        ),
    }
    corporate = every.withColumn("is_corporate", F.col("service_id") % 2 == 0)
    return base.with_enrollment_dates(corporate, base.OperationalTables(**tables), AS_OF)


HOT_QUERIES = {
    "with_enrollment_dates": dated,
    "current_spell": lambda every: spells.current_spell(every, AS_OF),
    "first_admission": spells.first_admission,
    "new_admissions": lambda every: spells.new_admissions(every, AS_OF, 365),
    "with_enrolled_flag": lambda every: spells.with_enrolled_flag(every, every, 1998),
    "with_last_enrollment": lambda every: spells.with_last_enrollment(
        every, every, every.selectExpr("quote_id", "cast(start_dt as timestamp_ntz) AS modified_ts"), AS_OF
    ),
}


@pytest.mark.parametrize("name", HOT_QUERIES)
def test_a_hot_child_is_split_in_joins(large_tables, name):
    """A third of all spells belong to one child; with low limits Spark splits its partition."""
    spark = session.tune(large_tables)
    limits = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        # All spells of the hot child start on one day, so that its join key is hot as well.
        every = session.staged(
            spark.range(90_000).repartition(12).selectExpr(
                "id AS service_id", "id AS quote_id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS child_id",
                "date_add(DATE'1998-01-01', CAST(CASE WHEN id % 3 = 0 THEN 9 ELSE id % 90 END AS INT)) AS start_dt",
                "CASE WHEN id % 2 = 0 THEN DATE'1999-01-01' END AS end_dt", "xxhash64(id) AS payload",
            ),
            "hot",
        )
        df = HOT_QUERIES[name](every)
        df.collect()
        assert "skew=true" in planned(df).split("== Initial Plan ==")[0]
    finally:
        for key in limits:
            spark.conf.unset(key)


def test_one_row_per_key_is_cut_before_the_exchange(spark):
    for name in ("latest_conversion", "dedupe_contacts", "new_members_only"):
        plan = planned(entry.queries()[name](spark, SF_DIR))
        assert re.search(r"WindowGroupLimit.*Partial", plan), name


def test_scans_prune_columns_and_take_filters(spark):
    plan = planned(entry.queries()["scan_orders"](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate,1998-06-05T00:00)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    # The stand-in computes its starts; a start that is a column of the table is pushed to the scan.
    every = standins.table(spark, SF_DIR, "orders").selectExpr(
        "o_orderkey AS service_id", "o_custkey AS child_id", "to_date(o_orderdate) AS start_dt", "CAST(NULL AS DATE) AS end_dt"
    )
    window = planned(spells.new_admissions(every, AS_OF))
    assert "GreaterThanOrEqual(o_orderdate,1998-06-05T00:00)" in window


def scans(df, sf_dir=SF_DIR):
    """Scans of driver tables in the final plan, by table."""
    df.collect()
    final = planned(df).split("== Initial Plan ==")[0]
    found = re.findall(r"FileScan parquet .*?Location: \S+\(1 paths\)\[file:(\S+?)\]", final)
    return Counter(Path(p).stem for p in found if p.startswith(sf_dir))


def test_base_reads_each_large_table_once(large_tables):
    """Each stand-in is scanned once; several of them share a driver table."""
    found = scans(entry.queries()["admissions_base"](large_tables, SF_DIR))
    # customer: children, payers, persons, family members; orders: spells, quotes, actions, history, company services.
    # Spark drops a scan at run time when the other side of its join turns out empty.
    assert found["customer"] <= 4 and found["orders"] <= 5
    assert found["lineitem"] <= 1 and found["part"] <= 1


def test_writes_by_key_read_both_sides_once(large_tables):
    for name in ("upsert_replace", "upsert_insert_only"):  # the union reads its two inputs, the check their keys
        assert scans(entry.queries()[name](large_tables, SF_DIR))["orders"] <= 4, name
    for name in ("upsert_patch", "calendar_after_marking"):
        assert scans(entry.queries()[name](large_tables, SF_DIR))["orders"] == 2, name


def test_renewal_date_shares_its_exchanges(large_tables):
    df = entry.queries()["renewal_date"](large_tables, SF_DIR)
    df.collect()
    final = planned(df).split("== Initial Plan ==")[0]
    # Seven of the plan's own: two each for channel and quotes, and rows, facts and history by child.  The stand-in
    # of the history brings one more for its aggregate.
    assert len(re.findall(r"(?<!Reused)Exchange hashpartitioning", final)) <= 8


def test_state_changes_by_rule_need_no_exchange(spark):
    for name in ("mark_unscheduled", "default_columns", "rename_columns", "backfill_columns", "member_payloads", "business_days"):
        assert "Exchange" not in planned(entry.queries()[name](spark, SF_DIR)), name
