"""Registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm.common import packed_sources, staged, table
from llm.queries import ORACLE, QUERIES
from llm_fixtures import awkward, empty, tuned  # noqa: F401
from test_decontaminate import brute as contaminated
from test_jaccard_forest import all_pairs

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in sorted(SF_DIR.glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, str(SF_DIR))
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    want = sorted(repr(r) for r in cursor.fetchall())
    assert sorted(repr(tuple(r)) for r in result.select(*columns).collect()) == want


def test_pipeline_stage_by_stage(spark):
    docs = table(spark, str(SF_DIR), "documents")
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns
    apply = lambda name, d: staged(stages[name](spark, d, str(SF_DIR)), "test")
    texts = lambda d: {r.doc_id: r.text for r in d.collect()}

    mild = apply("toxicity", docs)
    insults = ("idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting")
    gone = texts(docs).keys() - texts(mild).keys()
    assert mild.columns == columns and gone
    assert all(any(i in texts(docs)[k].lower() for i in insults) for k in gone)

    single = apply("n-gram Jaccard join", mild)
    assert single.columns == columns
    assert texts(single).keys() == {c for c, _, _ in all_pairs(sorted(texts(mild).items())).values()}

    cut = apply("suffix-array dedup", single)
    assert cut.columns == columns and texts(cut).keys() == texts(single).keys()
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    clean = apply("benchmark decontamination", cut)
    items = [(r.item_id, r.text) for r in table(spark, str(SF_DIR), "benchmark").collect()]
    judged = contaminated(sorted(texts(cut).items()), items)
    assert clean.columns == columns and texts(clean).keys() == {k for k, v in judged.items() if not v[-1]}

    packed = apply("packing", clean)
    assert {r.doc_id for r in packed.collect()} == texts(clean).keys()
    assert corpus_pipeline.run(spark, str(SF_DIR)).count() == packed.count()


AWKWARD = {"n_words": 1, "hit_items": 2, "hit_spans": 3, "__toxicity": 4, "__row1": 5, "__cut": 6, "__words": 7, "score": 8}


def test_pipeline_over_awkward_rows(awkward, empty):
    """Nulls, blank, long and repeated texts and clashing names through every stage; and no rows at all."""
    for docs in (awkward, empty):
        docs = docs.withColumns({c: F.lit(v) for c, v in AWKWARD.items()})
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = staged(stage(docs.sparkSession, docs, str(SF_DIR)), "awkward")
            assert after.columns == docs.columns and after.count() <= n
            assert all(r[c] == v for r in after.select(*AWKWARD).collect() for c, v in AWKWARD.items())
            if name != "n-gram Jaccard join":
                assert after.count() == n  # none of them is toxic or contaminated, and cuts drop no document
            docs, n = after, after.count()
        packed = corpus_pipeline.STAGES[-1][1](docs.sparkSession, docs, str(SF_DIR))
        assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_packages_travel_in_one_archive(tmp_path):
    """Executors without this folder import the operators from what they are sent."""
    code = f"import sys; sys.path = [{packed_sources()!r}] + [p for p in sys.path if 'repo' not in p and p]; import llm.merkle; print(llm.merkle.__file__)"
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin"}, capture_output=True, text=True, check=True)
    assert "sources.zip" in found.stdout
