"""Bounded training samples and small numeric helpers for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import only


def fold(doc_id: str, folds: int) -> F.Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """One row ``(doc_id, label)`` for each labelled document; the smallest of disagreeing labels counts."""
    rows = only(labels, doc_id="doc_id", label=column).filter("doc_id IS NOT NULL AND label IN (0, 1)")
    return rows.groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))


def sample(rows: DataFrame, size: int) -> DataFrame:
    """At most ``size`` rows, chosen by a hash of the id and so the same on every run."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)


def with_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Texts of a bounded sample; the sample's size is fixed by the caller, so it is broadcast."""
    rows = only(docs, doc_id="doc_id", text="text")
    return rows.join(F.broadcast(chosen), "doc_id").withColumn("text", F.coalesce("text", F.lit("")))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Adam:
    """Steps for one vector of weights."""

    def __init__(self, size: int, rate: float) -> None:
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, weights: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.001 * (gradient**2 - self.v)
        m, v = self.m / (1 - 0.9**self.t), self.v / (1 - 0.999**self.t)
        return weights - self.rate * m / (np.sqrt(v) + 1e-8)
