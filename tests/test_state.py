"""Bucketed state: what a write touches, what a failed one leaves, and the same rows as the writes by key."""

from __future__ import annotations

import random

import pytest
from conftest import rows

from cohortline.operators import keys as by_key
from cohortline.session import landing
from cohortline.sources.state import BucketedState, Conflict

SCHEMA = "k long, a string, b long"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def state(spark):
    return BucketedState.create(frame(spark, [(k, f"t{k}", k) for k in range(200)]), landing(spark, "state"), ["k"], 16)


def files(state):
    return {f.partition("/data/")[2] for f in state.read().inputFiles()}


def test_what_was_stored_is_read(spark, state):
    assert rows(state.read()) == rows(frame(spark, [(k, f"t{k}", k) for k in range(200)]))
    with pytest.raises(FileExistsError):
        BucketedState.create(frame(spark, []), state.path, ["k"], 16)
    with pytest.raises(FileNotFoundError):
        BucketedState(spark, state.path + "-none").read()


def test_only_touched_buckets_are_rewritten(spark, state):
    before, old = files(state), state.manifest()
    now = state.replace(frame(spark, [(5, "new", None)]))
    touched = {b for b in now.files if now.files[b] != old.files[b]}
    assert len(touched) == 1
    changed = files(state) ^ before
    assert all(f"state_bucket={min(touched)}/" in f for f in changed) and changed
    assert {f for f in before if f"state_bucket={min(touched)}/" not in f} <= files(state)
    assert [r for r in rows(state.read()) if r[0] == 5] == [(5, "new", None)] and state.read().count() == 200


def test_same_rows_as_the_writes_by_key(spark):
    """A run of random writes, with new keys, repeats of old ones and patches that set NULL."""
    rng = random.Random(6)
    want = frame(spark, [(k, "t", k) for k in range(60)])
    state = BucketedState.create(want, landing(spark, "state"), ["k"], 8)
    for step in range(6):
        incoming = frame(spark, [(k, f"i{step}", rng.choice([None, k])) for k in rng.sample(range(90), rng.randint(0, 12))])
        if step % 3 == 0:
            state.replace(incoming)
            want = by_key.upsert_replace(want, incoming, ["k"])
        elif step % 3 == 1:
            state.insert(incoming)
            want = by_key.upsert_insert_only(want, incoming, ["k"])
        else:
            state.patch(incoming.select("k", "b"), ["b"], create=True)
            want = by_key.upsert_patch(want, incoming.select("k", "b"), ["k"], ["b"], create=True)
        want = spark.createDataFrame(want.collect(), SCHEMA)
        assert rows(state.read()) == rows(want)


def test_inserts_add_files_and_compaction_joins_them(spark, state):
    before = files(state)
    for n in range(3):
        state.insert(frame(spark, [(1000 + n, "x", n), (7, "stored stays", 0)]))
    assert before <= files(state) and state.read().filter("a = 'stored stays'").isEmpty()
    want = rows(state.read())
    crowded = {b for b, v in state.manifest().files.items() if len(v) > 1}
    assert {len(state.compact(1).files[b]) for b in crowded} == {1}
    assert rows(state.read()) == want and state.compact(1).number == state.manifest().number


def test_a_write_that_dies_before_the_swap_changes_nothing(spark, state, monkeypatch):
    want, old = rows(state.read()), state.manifest()

    def die(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(BucketedState, "_swap", die)
    with pytest.raises(KeyboardInterrupt):
        state.replace(frame(spark, [(5, "lost", 0)]))
    monkeypatch.undo()
    assert state.manifest() == old and rows(state.read()) == want
    state.replace(frame(spark, [(6, "kept", 0)]))
    assert rows(state.read().filter("a IN ('lost', 'kept')")) == [(6, "kept", 0)]
    kept = rows(state.read())
    state.vacuum()
    assert rows(state.read()) == kept


def test_the_later_of_two_writers_fails(spark, state, monkeypatch):
    mine = state.manifest()
    BucketedState(spark, state.path).replace(frame(spark, [(1, "first", 1)]))
    monkeypatch.setattr(state, "manifest", lambda: mine)
    with pytest.raises(Conflict):
        state.replace(frame(spark, [(2, "second", 2)]))
    monkeypatch.undo()
    assert rows(state.read().filter("a IN ('first', 'second')")) == [(1, "first", 1)]


def test_empty_and_repeated_writes(spark, state):
    want = rows(state.read())
    state.replace(frame(spark, []))
    state.insert(frame(spark, []))
    assert rows(state.read()) == want
    for _ in range(2):
        state.replace(frame(spark, [(500, "again", 1), (None, "no key", 2)]).filter("k IS NOT NULL"))
    assert rows(state.read().filter("k = 500")) == [(500, "again", 1)]
    empty = BucketedState.create(frame(spark, []), landing(spark, "state"), ["k"], 4)
    assert empty.read().count() == 0
    empty.insert(frame(spark, [(1, "a", 1)]))
    assert rows(empty.read()) == [(1, "a", 1)]


def test_keys_of_another_type_find_their_bucket(spark, state):
    state.replace(spark.createDataFrame([(5, "int key", 1)], "k int, a string, b long"))
    assert rows(state.read().filter("k = 5")) == [(5, "int key", 1)]
    with pytest.raises(ValueError, match="columns"):
        state.insert(spark.createDataFrame([(5, "x")], "k long, a string"))
