"""The corpus pipeline: documents through the stages below, each written as Parquet and read again.

In every stage a null or repeated ``doc_id`` is a row like any other, a null text is the empty text (and stays null where the stage
returns texts), further columns come through unchanged whatever their names, and an empty table gives an empty one.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.session import RUN, drop_run
from llm import decontaminate, jaccard_forest, packing, suffix_dedup, weak_toxicity
from llm.common import free, prepare, staged, table

TOXIC = 0.7
_STORED: dict[str, str] = {}  # by application, the run whose folder holds what the last stage has stored


def stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that stores its tables in a run of its own.

    What the stage before has stored is deleted first: its rows have been written and read again by now.
    """

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        outer, application = spark.conf.get(RUN, None), spark.sparkContext.applicationId
        try:
            if application in _STORED:
                spark.conf.set(RUN, _STORED.pop(application))
                drop_run(spark)
            _STORED[application] = uuid.uuid4().hex
            spark.conf.set(RUN, _STORED[application])
            return function(spark, docs, sf_dir)
        finally:
            if outer:
                spark.conf.set(RUN, outer)
            else:
                spark.conf.unset(RUN)

    return run_stage


@stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; each row is judged by its own text, so copies go together."""
    classifier = weak_toxicity.train(docs, table(prepare(spark), sf_dir, "labels"))
    (score,) = free(docs, "__toxicity")
    scored = weak_toxicity.with_scores(docs, classifier, score)
    return scored.filter(F.col(score) < TOXIC).select(*docs.columns)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of copies and near copies the document with the smallest id stays, null ids last.

    Texts without words are copies of one another.
    """
    prepare(spark)
    return jaccard_forest.representatives(docs)


@stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that start elsewhere too are cut out, and 400-byte strings of fewer words; no document goes."""
    prepare(spark)
    cut = suffix_dedup.cut_passages(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


@stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more lie in benchmark windows go; those without words stay."""
    words, spans, items = free(docs, "__words", "__spans", "__items")
    mine = {"n_words": words, "hit_spans": spans, "hit_items": items}
    names = {c: n for c, n in mine.items() if c in docs.columns}
    found = decontaminate.contamination(docs.withColumnsRenamed(names), table(prepare(spark), sf_dir, "benchmark"))
    kept = found.filter(~decontaminate.contaminated()).drop(*mine)
    return kept.withColumnsRenamed({n: c for c, n in names.items()}).select(*docs.columns)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 token ids: a row for each piece, with its ids; a document without text is its end id alone."""
    prepare(spark)
    return packing.pack_documents(docs, remembered=200_000)


STAGES = [
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", pack),
]

# Classifiers and tokenizers have no SQL form; tests compare run() with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
