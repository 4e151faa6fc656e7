import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortline.operators import outbox


def shuffled(spark, n):
    return spark.range(n).select((F.col("id") * 7 + 3).alias("k"), F.concat(F.lit("it's "), "id").alias("v")).repartition(5, F.rand(3))


@pytest.mark.parametrize("n", [0, 1, 299, 300, 301, 1234])
def test_numbers_are_gapless_and_in_key_order(spark, n):
    numbered = outbox.numbered_rows(shuffled(spark, n), ["k"])
    assert [(r.row_index, r.k) for r in numbered.orderBy("k").collect()] == [(i, i * 7 + 3) for i in range(n)]


def test_batches_hold_all_rows_in_order(spark):
    batches = {r.batch_id: r for r in outbox.outbox_batches(shuffled(spark, 1000), ["k"], 300, ["v", "k"]).collect()}
    assert sorted(batches) == [0, 1, 2, 3]
    assert [batches[b].n_items for b in range(4)] == [300, 300, 300, 100]
    items = [i for b in range(4) for i in json.loads(batches[b].payload)["items"]]
    assert items == [{"v": f"it's {i}", "k": i * 7 + 3} for i in range(1000)]


def test_order_by_two_columns(spark):
    df = spark.createDataFrame([(1, 5), (1, 2), (0, 9)], "a int, b int")
    numbered = outbox.numbered_rows(df, ["a", "b"])
    assert rows(numbered, "row_index", "a", "b") == [(0, 0, 9), (1, 1, 2), (2, 1, 5)]


def test_items_keep_null(spark):
    df = spark.createDataFrame([(1, None, "x\"y")], "k long, v string, w string")
    assert json.loads(outbox.outbox_items(df).first().payload) == {"item": {"k": 1, "v": None, "w": 'x"y'}}
    assert json.loads(outbox.outbox_items(df, ["w"]).first().payload) == {"item": {"w": 'x"y'}}
