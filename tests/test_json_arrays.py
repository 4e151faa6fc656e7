"""JSON array files cut anywhere, against Python's own parser."""

from __future__ import annotations

import json
import random

import pytest
from conftest import rows

from cohortline.sources.json_arrays import read_json_array_files

SCHEMA = "id long, name string, tags array<string>, inner struct<a: string, b: array<struct<c: string>>>"
AWKWARD = ["it's", 'say "hi"', "back\\slash", "\\", '\\"', "}{", "][", '"}', "},{", "a\nb", "é {ü}", "", " ", "\\\\", " }", "[{", "{\"id\": 1}"]


def records(seed, n):
    rng = random.Random(seed)
    pick = lambda: rng.choice(AWKWARD) * rng.randint(0, 3)
    return [
        {"id": k, "name": pick(), "tags": [pick() for _ in range(rng.randint(0, 3))], "inner": {"a": pick(), "b": [{"c": pick()} for _ in range(rng.randint(0, 3))]}}
        for k in range(n)
    ]


def as_rows(found):
    return sorted((r["id"], r["name"], tuple(r["tags"]), r["inner"]["a"], tuple(x["c"] for x in r["inner"]["b"])) for r in found)


@pytest.mark.parametrize("split", [7, 64, 1000, 1 << 20])
@pytest.mark.parametrize("layout", ["compact", "indented", "ascii"])
def test_cuts_everywhere(spark, tmp_path, split, layout):
    """Splits inside strings, escapes, records and nested arrays; a record may span many splits."""
    wanted = []
    for k in range(2):
        own = records(10 * k + split, 6 if split < 50 else 40)
        wanted += own
        text = json.dumps(own, ensure_ascii=layout == "ascii", indent=3 if layout == "indented" else None, separators=(",", ":") if layout == "compact" else None)
        (tmp_path / f"{k}.json").write_text(text, encoding="utf-8")
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    own.conf.set("spark.sql.files.openCostInBytes", "1")
    found = read_json_array_files(own, str(tmp_path), SCHEMA)
    assert as_rows(found.collect()) == as_rows(wanted)


def test_one_large_file_is_read_by_several_tasks(spark, tmp_path):
    own = records(1, 300) * 20
    (tmp_path / "one.json").write_text(json.dumps(own), encoding="utf-8")
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    found = read_json_array_files(small, str(tmp_path), SCHEMA)
    lines = small.read.option("lineSep", "}").text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 5
    assert as_rows(found.collect()) == as_rows(own)


def test_other_elements_are_passed_over(spark, tmp_path):
    (tmp_path / "a.json").write_text(' [ 1, "x{\\"id\\": 9}", null, {"id": 1}, [[{"id": 8}]], true, {"id": 2, "inner": {"b": []}} , [] ]\n')
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text("")
    (tmp_path / "d.json").write_text('[{"id": "no number", "name": 5},{}]')
    for split in (3, 11, 1 << 20):
        own = spark.newSession()
        own.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        own.conf.set("spark.sql.files.openCostInBytes", "1")
        found = read_json_array_files(own, str(tmp_path), SCHEMA)
        assert rows(found, "id", "name") == [(None, None), (None, "5"), (1, None), (2, None)]


@pytest.mark.parametrize("text", ['[{"id": 1}, {"id": 2', '[{"id": "open}]', "[[{}]", '{"id": 1}]'])
def test_a_broken_file_is_an_error(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="not a closed JSON array.*bad.json"):
        read_json_array_files(spark, str(tmp_path), SCHEMA).collect()
