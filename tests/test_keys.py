import datetime as dt
import random

from conftest import rows
from pyspark.sql import functions as F

from cohortline.operators import keys

SCHEMA = "k long, a string, b long"
KEY = ["k"]


def frames(spark):
    target = spark.createDataFrame([(1, "t1", 10), (2, "t2", 20), (3, None, 30)], SCHEMA)
    incoming = spark.createDataFrame([(2, "i2", None), (3, "i3", 33), (4, "i4", 44)], SCHEMA)
    return target, incoming


def test_replace(spark):
    target, incoming = frames(spark)
    once = keys.upsert_replace(target, incoming, KEY)
    assert rows(once) == [(1, "t1", 10), (2, "i2", None), (3, "i3", 33), (4, "i4", 44)]
    assert rows(keys.upsert_replace(once, incoming, KEY)) == rows(once)
    assert keys.duplicate_keys(once, KEY).count() == 0


def test_insert_only(spark):
    target, incoming = frames(spark)
    once = keys.upsert_insert_only(target, incoming, KEY)
    assert rows(once) == [(1, "t1", 10), (2, "t2", 20), (3, None, 30), (4, "i4", 44)]
    assert rows(keys.upsert_insert_only(once, incoming, KEY)) == rows(once)


def test_patch_changes_only_named_columns_and_may_set_null(spark):
    target, incoming = frames(spark)
    once = keys.upsert_patch(target, incoming, KEY, ["b"])
    assert rows(once) == [(1, "t1", 10), (2, "t2", None), (3, None, 33)]
    assert rows(keys.upsert_patch(once, incoming, KEY, ["b"])) == rows(once)


def test_patch_can_create(spark):
    target, incoming = frames(spark)
    once = keys.upsert_patch(target, incoming, KEY, ["b"], create=True)
    assert rows(once) == [(1, "t1", 10), (2, "t2", None), (3, None, 33), (4, None, 44)]
    assert rows(keys.upsert_patch(once, incoming, KEY, ["b"], create=True)) == rows(once)


def test_first_per_key_with_a_hot_key(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 7).alias("k"), F.col("id").alias("v")
    )
    first = keys.first_per_key(df, KEY, [F.desc("v")])
    want = {}
    for v in range(3000):
        want[None if v % 3 == 0 else v % 7] = v
    assert {r.k: r.v for r in first.collect()} == want
    assert set(first.columns) == {"k", "v"}


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (1, dt.date(2024, 1, 1)), (2, None)], "k long, d date")
    assert rows(keys.duplicate_keys(df, ["k", "d"])) == [(1, dt.date(2024, 1, 1), 2)]


def test_writes_by_key_match_dictionaries(spark):
    rng = random.Random(5)
    for size in (0, 40, 200):
        stored = {k: (rng.choice(["s", None]), rng.randrange(9)) for k in rng.sample(range(300), size)}
        coming = {k: (rng.choice(["i", None]), rng.choice([None, 7])) for k in rng.sample(range(300), 60)}
        target = spark.createDataFrame([(k, *v) for k, v in stored.items()], SCHEMA)
        incoming = spark.createDataFrame([(k, *v) for k, v in coming.items()], SCHEMA)

        def as_dict(df):
            collected = df.select("k", "a", "b").collect()
            made = {r.k: (r.a, r.b) for r in collected}
            assert len(made) == len(collected)
            return made

        assert as_dict(keys.upsert_replace(target, incoming, KEY)) == {**stored, **coming}
        assert as_dict(keys.upsert_insert_only(target, incoming, KEY)) == {**coming, **stored}
        patched = {k: (a, coming[k][1] if k in coming else b) for k, (a, b) in stored.items()}
        assert as_dict(keys.upsert_patch(target, incoming, KEY, ["b"])) == patched
        created = {k: (None, b) for k, (_, b) in coming.items() if k not in stored}
        assert as_dict(keys.upsert_patch(target, incoming, KEY, ["b"], create=True)) == {**patched, **created}
