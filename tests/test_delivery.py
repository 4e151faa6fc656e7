"""The ledger of deliveries, and logs that a repeated run doesn't lengthen."""

from __future__ import annotations

import datetime as dt

from conftest import rows

from cohortline.operators import delivery, outbox
from cohortline.session import landing
from cohortline.sources.readers import read_runs
from cohortline.sources.writers import append_rows, append_run

T = [dt.datetime(2024, 3, 15, h) for h in range(5)]


def batches(spark, partitions=3, n=70):
    df = spark.createDataFrame([(k, f"v{k}" if k % 9 else None) for k in range(n)], "k long, v string").repartition(partitions)
    return delivery.keyed_batches(outbox.outbox_batches(df, ["k"], size=10))


def test_keys_come_from_the_content_alone(spark):
    one, other = rows(batches(spark, 2), "batch_id", "batch_key"), rows(batches(spark, 7), "batch_id", "batch_key")
    assert one == other and len({k for _, k in one}) == 7


def test_what_is_still_to_send(spark):
    out = batches(spark)
    keys = [k for _, k in rows(out, "batch_id", "batch_key")]
    ledger = spark.createDataFrame(
        [(keys[0], "sent", T[0]), (keys[1], "failed", T[0]), (keys[1], "sent", T[1]), (keys[2], "sent", T[0]), (keys[2], "failed", T[3]),
         (keys[3], "failed", T[0]), (keys[3], "failed", T[2]), (keys[4], None, None), (None, "sent", T[0]), ("gone", "sent", T[0])],
        delivery.LEDGER,
    )
    left = delivery.undelivered(out, ledger)
    assert rows(left, "batch_id") == [(3,), (4,), (5,), (6,)] and left.columns == out.columns
    assert rows(left.select("n_items").distinct()) == [(10,)]  # whole batches
    again = delivery.due_again(out, ledger, max_attempts=2)
    assert rows(again, "batch_id", "n_attempts", "given_up") == [(3, 2, True), (4, 1, False), (5, 0, False), (6, 0, False)]
    tried = {r.batch_key: (r.n_attempts, r.delivered, r.last_attempt_ts) for r in delivery.attempts(ledger).collect()}
    assert tried[keys[2]] == (2, True, T[3]) and tried[keys[4]] == (1, False, None) and None not in tried


def test_an_empty_ledger_leaves_everything(spark):
    out, none = batches(spark), spark.createDataFrame([], delivery.LEDGER)
    assert delivery.undelivered(out, none).count() == 7 and delivery.due_again(out, none, 1).filter("given_up").count() == 0
    assert delivery.undelivered(out.limit(0), none).count() == 0


def test_a_run_written_twice_is_read_once(spark):
    path, plain = landing(spark, "runs"), landing(spark, "rows")
    one = spark.createDataFrame([(1,), (2,)], "n long")
    for _ in range(2):
        append_run(one, path, "a/b=1 ü")
        append_rows(one, plain)
    append_run(one.limit(1), path, "001")
    assert rows(read_runs(spark, path, "n long").groupBy("run_id").count()) == [("001", 1), ("a/b=1 ü", 2)]
    assert spark.read.parquet(plain).count() == 4
    append_run(one.limit(0), path, "001")
    assert read_runs(spark, path, "n long").filter("run_id = '001'").count() == 1
