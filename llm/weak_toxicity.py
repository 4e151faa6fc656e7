"""Toxicity by weak supervision.

Voters: lexicons and word-beginning patterns, most of them found in the labelled training rows by how much more often toxic documents
hold them, plus a few voters for texts without any such sign.  A generative label model estimates each voter's accuracy
from how the voters agree on texts alone, without labels; correlated voters share their weight.  Its posterior
labels train a linear classifier over words, beginnings and hit counts, which scores every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import only, staged, texts, trimmed
from llm.learning import Adam, fold, labelled, sample, sigmoid, with_texts

# Labelled documents of the training folds that voters and classifier are fitted on.
TRAIN_DOCUMENTS = 16_000
# Features that the classifier may weigh.
VOCABULARY = 6000
# Insults that count in any corpus: a fixed list.
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting")
WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6)
GROUPS = 4
ABSTAIN = 0
MIN_GAIN = 12.0
MIN_PRECISION = 0.97


def signs(text: str) -> set[str]:
    """Distinct lower-case words, and their beginnings marked with a star."""
    found = set(WORD.findall(text.lower()))
    return found | {w[:k] + "*" for w in found for k in BEGINNINGS if len(w) >= k}


def mine(rows: DataFrame, min_gain: float = MIN_GAIN, min_precision: float = MIN_PRECISION, size: int = VOCABULARY) -> list[str]:
    """Words and beginnings that the labelled rows hold in toxic documents almost only, best first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic: dict[str, int] = {}
        clean: dict[str, int] = {}
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), texts(batch, "text"), strict=True):
                into = toxic if label else clean
                for s in signs(text):
                    into[s] = into.get(s, 0) + 1
        names = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([toxic.get(s, 0) for s in names], pa.int64()), pa.array([clean.get(s, 0) for s in names], pa.int64())],
            names=["sign", "toxic", "clean"],
        )

    totals = rows.groupBy("label").count().collect()
    n = {r.label: r["count"] for r in totals}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    counts = rows.select("label", "text").mapInArrow(trimmed(count), "sign string, toxic long, clean long")
    counts = counts.groupBy("sign").agg(F.sum("toxic").alias("p"), F.sum("clean").alias("n"))
    odds = F.log((F.col("p") + 0.5) / (n1 + 1)) - F.log((F.col("n") + 0.5) / (n0 + 1))
    base = F.log(F.lit((n0 + n1 + 1) / (n1 + 0.5)))
    gain = F.col("p") * F.least(odds, base + F.log(F.col("p") / (F.col("p") + F.col("n"))))
    good = counts.filter("p > 0").withColumn("gain", gain).filter(F.col("gain") >= min_gain)
    good = good.filter(F.col("p") / (F.col("p") + F.col("n")) >= min_precision)
    return [r.sign for r in good.orderBy(F.desc("gain"), "sign").limit(size).collect()]


@dataclass
class Voters:
    """Lexicons, patterns and clean-text rules; a vote is 1 (toxic), -1 (clean) or 0 (abstains)."""

    lexicon: dict[str, int]
    beginnings: dict[str, int]

    @classmethod
    def of(cls, mined: list[str]) -> "Voters":
        words = [s for s in mined if not s.endswith("*") and s not in INSULTS]
        starts = [s for s in mined if s.endswith("*")]
        lexicon = {w: 1 + k % GROUPS for k, w in enumerate(words)}
        return cls({w: 0 for w in INSULTS} | lexicon, {s: k % GROUPS for k, s in enumerate(starts)})

    def vocabulary(self) -> list[str]:
        return [*self.lexicon, *self.beginnings]

    def hits(self, text: str) -> tuple[set[str], list[str]]:
        """Signs of the voters in a text, and all its word hits in order."""
        words = WORD.findall(text.lower())
        kinds = set(words)
        found = {w for w in kinds if w in self.lexicon}
        starts = {w[:k] + "*" for w in kinds for k in BEGINNINGS if len(w) >= k}
        return found | {s for s in starts if s in self.beginnings}, words

    def votes(self, text: str) -> list[int]:
        signs_found, words = self.hits(text)
        return self.votes_on(signs_found, len(words))

    def votes_on(self, signs_found: set[str], n_words: int) -> list[int]:
        own = [s for s in signs_found if s in self.lexicon]
        starts = [s for s in signs_found if s in self.beginnings]
        by_lexicon = {self.lexicon[s] for s in own}
        by_start = {self.beginnings[s] for s in starts}
        many = len(own) + len(starts)
        return [
            *[1 if g in by_lexicon else ABSTAIN for g in range(GROUPS + 1)],
            *[1 if g in by_start else ABSTAIN for g in range(GROUPS)],
            1 if many >= 2 else ABSTAIN,
            1 if own and len(own) * 200 >= n_words else ABSTAIN,
            -1 if not many else ABSTAIN,
            -1 if not own else ABSTAIN,
            -1 if not starts else ABSTAIN,
            -1 if not many and n_words >= 50 else ABSTAIN,
        ]


# Rates of the votes -1, 0 and 1 that are believed beforehand, for clean and for toxic texts.
BELIEF = ((0.5, 0.49, 0.01), (0.05, 0.55, 0.4))


@dataclass
class LabelModel:
    """Rates of the votes under each class, each voter's share of weight, and the class balance."""

    log_rates: np.ndarray  # class, voter, vote + 1
    share: np.ndarray
    balance: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic) given the votes; correlated voters count by their share."""
        idx = votes + 1
        every = np.arange(votes.shape[1])
        evidence = (self.log_rates[1, every, idx] - self.log_rates[0, every, idx]) * self.share
        return sigmoid(evidence.sum(axis=1) + np.log(self.balance / (1 - self.balance)))

    @classmethod
    def fit(cls, votes: np.ndarray, rounds: int = 30, prior: float = 4.0) -> "LabelModel":
        """Expectation-maximisation from the majority's vote; correlations from what the classes leave unexplained.

        ``prior`` texts of each class stand for the belief that voters are better than chance.
        """
        n, m = votes.shape
        voting = (votes != 0).any(axis=0).astype(float)  # a voter that never votes says nothing
        share = voting
        q = np.where((votes > 0).any(axis=1), 0.9, 0.02)
        model = None
        for step in range(rounds):
            rates = np.empty((2, m, 3))
            for v in (-1, 0, 1):
                on = votes == v
                rates[1, :, v + 1] = (q @ on + prior * BELIEF[1][v + 1]) / (q.sum() + prior)
                rates[0, :, v + 1] = ((1 - q) @ on + prior * BELIEF[0][v + 1]) / (n - q.sum() + prior)
            model = cls(np.log(rates), share, float(np.clip(q.mean(), 1e-3, 0.5)))
            if step == 4:  # two voters that still move together within a class share one weight
                mean1, mean0 = q @ votes / max(q.sum(), 1e-9), (1 - q) @ votes / max((1 - q).sum(), 1e-9)
                left = votes - (q[:, None] * mean1 + (1 - q)[:, None] * mean0)
                spread = np.sqrt((left**2).mean(axis=0)) + 1e-6
                together = np.abs(left.T @ left / n / np.outer(spread, spread))
                share = voting / np.maximum(1.0, np.where(together > 0.1, together, 0).sum(axis=0))
                model.share = share
            q = model.posterior(votes)
        return model


@dataclass
class Classifier:
    voters: Voters
    index: dict[str, int]
    weights: np.ndarray

    def features(self, text: str) -> tuple[list[int], np.ndarray]:
        """Numbers of the vocabulary's signs in a text, and dense hit counts."""
        return self.features_of(self.voters.hits(text)[0])

    def features_of(self, found: set[str]) -> tuple[list[int], np.ndarray]:
        own = sum(1 for s in found if s in self.voters.lexicon)
        starts = len(found) - own
        insults = sum(1 for s in found if self.voters.lexicon.get(s) == 0)
        dense = np.array([1.0, float(own > 0), float(starts > 0), float(insults > 0), np.log1p(own), np.log1p(starts), float(own > 1)])
        return [self.index[s] for s in found], dense

    def score(self, text: str) -> float:
        signs_found, dense = self.features(text)
        z = dense @ self.weights[: len(dense)] + self.weights[N_DENSE:][signs_found].sum()
        return float(sigmoid(np.array(z)))


N_DENSE = 7


def train_classifier(voters: Voters, rows: list[tuple[list[int], np.ndarray]], target: np.ndarray, steps: int = 600, ridge: float = 1e-5) -> Classifier:
    """Logistic regression on the posterior labels."""
    names = voters.vocabulary()
    index = {s: k for k, s in enumerate(names)}
    dense = np.array([d for _, d in rows]).reshape(-1, N_DENSE)
    who = np.repeat(np.arange(len(rows)), [len(s) for s, _ in rows])
    which = np.array([k for s, _ in rows for k in s], dtype=np.int64)
    w, adam = np.zeros(N_DENSE + len(names)), Adam(N_DENSE + len(names), 0.05)
    if not len(rows):
        w[0], w[3] = -4.0, 8.0  # no sample: the fixed insults decide
        return Classifier(voters, index, w)
    for _ in range(steps):
        z = dense @ w[:N_DENSE] + np.bincount(who, weights=w[N_DENSE:][which], minlength=len(rows))
        g = (sigmoid(z) - target) / len(rows)
        gradient = np.concatenate([dense.T @ g, np.bincount(which, weights=g[who], minlength=len(names))])
        w = adam.step(w, gradient + ridge * np.append([0.0], w[1:]))
    return Classifier(voters, index, w)


def train(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, documents: int = TRAIN_DOCUMENTS) -> Classifier:
    """Voters, label model and classifier from at most ``documents`` labelled rows outside the held-out fold."""
    known = labelled(labels, "toxic").filter(fold("doc_id", folds) != held_out)
    rows = staged(with_texts(docs, sample(known, documents)).select("label", "text"), "toxicity-sample")
    voters = Voters.of(mine(rows))
    empty = Classifier(voters, {s: k for k, s in enumerate(voters.vocabulary())}, np.zeros(0))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(empty.features(t), voters.votes(t)) for t in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f, _ in out], pa.list_(pa.int32())), pa.array([f[1].tolist() for f, _ in out], pa.list_(pa.float64())),
                 pa.array([v for _, v in out], pa.list_(pa.int32()))],
                names=["signs", "dense", "votes"],
            )

    found = rows.select("text").mapInArrow(trimmed(features), "signs array<int>, dense array<double>, votes array<int>").collect()
    found.sort(key=lambda r: (r.votes, r.dense, sorted(r.signs)))
    if not found:
        return train_classifier(voters, [], np.empty(0))
    model = LabelModel.fit(np.array([r.votes for r in found]))
    # Texts with a single sign are rare in a sample; one for each sign is added, labelled by the same model.
    alone = [(empty.features_of({s}), voters.votes_on({s}, 100)) for s in voters.vocabulary()]
    target = model.posterior(np.array([r.votes for r in found] + [v for _, v in alone]))
    return train_classifier(voters, [(sorted(r.signs), np.array(r.dense)) for r in found] + [f for f, _ in alone], target)


def with_scores(docs: DataFrame, classifier: Classifier, column: str = "toxicity") -> DataFrame:
    """``docs`` with a score from 0 to 1 for its ``text``; null text is the empty text."""
    sent = docs.sparkSession.sparkContext.broadcast(classifier)

    @F.arrow_udf("double")
    def run(text: pa.Array) -> pa.Array:
        model = sent.value
        return pa.array([model.score(t or "") for t in text.to_pylist()], pa.float64())

    return docs.withColumn(column, run(F.col("text")))


def score(
    docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, threshold: float = 0.7, documents: int = TRAIN_DOCUMENTS
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs(doc_id, text)``.

    Rows with a null or repeated ``doc_id`` are scored one by one, other columns are ignored, null text is the empty
    text; without labels the fixed insults decide.
    """
    scored = with_scores(only(docs, doc_id="doc_id", text="text"), train(docs, labels, folds, held_out, documents), "score")
    return scored.select(
        "doc_id",
        (fold("doc_id", folds) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
