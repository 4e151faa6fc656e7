"""Quality by positive-unlabelled learning.

Trusted positives are documents whose quality label is 1; the unlabelled set is all web text outside the held-out fold.  A linear
model of text-shape features minimises the non-negative unbiased risk

    prior * E_pos[l(g)] + max(0, E_unl[l(-g)] - prior * E_pos[l(-g)])

with the logistic loss, by Newton steps: Spark sums loss, gradient and curvature over the features of all unlabelled
texts, which are stored once, and the driver sees one vector of sums.  The positives are a bounded sample of the labelled rows.

The class prior comes from the ratio of the two densities, a model of the same kind: a histogram of its scores over all unlabelled texts tells
which share of them lies where the upper half of the positives does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import only, staged, texts
from llm.learning import fold, labelled, sample, sigmoid
from llm.shape import SPACES, repeated_words

# Trusted positives; the unlabelled side has no bound.
TRAIN_DOCUMENTS = 4000
BINS = 4096  # of the histogram of ratio scores
STEPS = (1.0, 0.5, 0.25, 0.1, 0.03, 0.0)
PUNCTUATION = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
N_FEATURES = len(PUNCTUATION) + 14


def shape_features(text: str) -> np.ndarray:
    """Square roots of shares that don't depend on the text's length or language."""
    raw = text.encode()
    out = np.zeros(N_FEATURES)
    words = raw.split()
    n = len(words)
    if not n:
        out[-1] = 1.0
        return out
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / len(raw)
    lines = [x for x in raw.split(b"\n") if x.strip(SPACES)]
    kinds = len(set(words))
    capitals = sum(1 for w in words if len(w) > 1 and w.isupper()) / n
    rest = [
        counts[0x41:0x5B].sum(), counts[0x30:0x3A].sum(), counts[0x80:].sum(), capitals,
        repeated_words(words) / n, 1 - len(set(lines)) / len(lines), 1 - kinds / n, min(1.0, raw.count(b" | ") / n),
        min(1.0, (len(raw) / n) / 40), min(1.0, len(lines) / n), float(n < 5), float(n < 20), float(n < 50), 0.0,
    ]
    out[:] = np.sqrt(np.concatenate([counts[PUNCTUATION], rest]))
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias)


Measure = Callable[[np.ndarray], np.ndarray]


class Rows:
    """Feature vectors in memory, of which sums are taken; the same as ``Stored`` on a small scale."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x

    def total(self, measure: Measure) -> np.ndarray:
        return measure(self.x)


class Stored:
    """Feature vectors of a stored table ``x binary``; every sum is one pass of Spark tasks over all of them."""

    def __init__(self, rows: DataFrame) -> None:
        self.rows = rows

    def total(self, measure: Measure) -> np.ndarray:
        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _row(sum(measure(_vectors(b)) for b in batches if b.num_rows))

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _row(sum(np.frombuffer(v, float) for b in batches for v in b.column(1).to_pylist()))

        parts = self.rows.select("x").mapInArrow(summed, "part int, s binary")
        # The driver gets at most 16 vectors, however many tasks there are; their order is the tasks', so that a repeat gives equal sums.
        ordered = parts.repartition(16, "part").sortWithinPartitions("part")
        found = sorted(ordered.mapInArrow(added, "part int, s binary").collect())
        return sum((np.frombuffer(r.s, float) for r in found), measure(np.empty((0, N_FEATURES))))


def _row(total) -> Iterator[pa.RecordBatch]:
    if not np.isscalar(total):
        part = pa.array([TaskContext.get().partitionId()], pa.int32())
        yield pa.RecordBatch.from_arrays([part, pa.array([np.asarray(total, float).tobytes()], pa.binary())], names=["part", "s"])


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    data = np.frombuffer(b"".join(batch.column(batch.schema.get_field_index("x")).to_pylist()), "<f4")
    return data.reshape(-1, N_FEATURES).astype(float)


def standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features with a constant column."""
    return np.hstack([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))])


def losses(x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logistic losses ``l(g)`` and ``l(-g)`` of each row."""
    g = np.clip(x @ w, -40, 40)
    return np.logaddexp(0, -g), np.logaddexp(0, g)


def slopes(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Count, gradient and curvature, flat, of the summed ``l(-g)``."""
    p = sigmoid(x @ w)
    return np.concatenate([[len(x)], x.T @ p, ((x * (p * (1 - p))[:, None]).T @ x).ravel()])


def nn_risk(pos: np.ndarray, unl_negative: float, w: np.ndarray, prior: float) -> tuple[float, float]:
    """The non-negative risk and its second part before it is cut at 0; ``unl_negative`` is ``E_unl[l(-g)]``."""
    good, bad = losses(pos, w)
    negative = unl_negative - prior * bad.mean()
    return prior * good.mean() + max(0.0, negative), negative


def _newton(pos: np.ndarray, unl, values: Callable, gradient: Callable, ridge: float, rounds: int, size: int) -> np.ndarray:
    """Minimise ``values`` by Newton steps; each takes one pass for the curvature and one that tries all step lengths."""
    w, prepared = np.zeros(size), unl.prepared
    for _ in range(rounds):
        found = unl.total(lambda x, w=w: slopes(prepared(x), w))
        n, g_unl, curve = found[0], found[1 : size + 1] / found[0], found[size + 1 :].reshape(size, size) / found[0]
        g, curve = gradient(w, g_unl, curve)
        step = np.linalg.solve(curve + ridge * np.eye(size), -(g + ridge * np.append(w[:-1], 0.0)))
        tries = [w + t * step for t in STEPS]
        means = unl.total(lambda x, tries=tries: np.array([losses(prepared(x), v)[1].sum() for v in tries])) / n
        cost = [values(v, m) + ridge / 2 * float(v[:-1] @ v[:-1]) for v, m in zip(tries, means, strict=True)]
        best = int(np.argmin(cost))
        if STEPS[best] == 0.0 or cost[-1] - cost[best] < 1e-7:
            break
        w = tries[best]
    return w


class _Prepared:
    """Unlabelled rows whose features are standardised where they are."""

    def __init__(self, rows, mean: np.ndarray, scale: np.ndarray) -> None:
        self.total, self.prepared = rows.total, lambda x: standard(x, mean, scale)


def density_ratio(pos: np.ndarray, unl, ridge: float = 1e-3, rounds: int = 8) -> np.ndarray:
    """Weights of ``log(p_pos / p_unl)``, both sides counted alike."""

    def values(w: np.ndarray, negative: float) -> float:
        return losses(pos, w)[0].mean() + negative

    def gradient(w: np.ndarray, g: np.ndarray, curve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = sigmoid(pos @ w)
        return g + pos.T @ (p - 1) / len(pos), curve + (pos * (p * (1 - p))[:, None]).T @ pos / len(pos)

    return _newton(pos, unl, values, gradient, ridge, rounds, pos.shape[1])


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """The share of positives among rows in memory."""
    mean, scale = np.zeros(pos.shape[1]), np.ones(pos.shape[1])
    return _prior(standard(pos, mean, scale), _Prepared(Rows(unl), mean, scale))


def _prior(pos: np.ndarray, unl) -> float:
    """The share of positives among the unlabelled rows.

    Above the positives' median ratio there is hardly a negative, so twice the unlabelled share that lies there is the prior.
    """
    w = density_ratio(pos, unl)
    edges, prepared = np.linspace(-40, 40, BINS + 1), unl.prepared
    count = unl.total(lambda x: np.histogram(np.clip(prepared(x) @ w, -40, 40), edges)[0].astype(float))
    half = int(np.searchsorted(edges, np.median(np.clip(pos @ w, -40, 40)), side="right")) - 1  # the bin that holds it
    own = np.histogram(np.clip(pos @ w, -40, 40), edges)[0]
    share = own[half:].sum() / max(1, own.sum())
    return float(np.clip(count[half:].sum() / max(1.0, count.sum()) / max(share, 1e-9), 0.05, 0.98))


def fit(pos: np.ndarray, unl, prior: float | None = None, ridge: float = 0.03, rounds: int = 6) -> Model:
    """Minimise the non-negative risk of ``pos`` and of the unlabelled rows that ``unl`` sums over.

    With the logistic loss ``l(g) - l(-g) = -g``, so the risk before its cut is convex, and its curvature is that of the unlabelled
    rows.  A step whose second part falls below 0 is valued by the cut risk, so shorter steps are taken there.
    """
    unl = Rows(unl) if isinstance(unl, np.ndarray) else unl
    sums = unl.total(lambda x: np.concatenate([[len(x)], x.sum(axis=0), (x**2).sum(axis=0)]))
    every = sums + np.concatenate([[len(pos)], pos.sum(axis=0), (pos**2).sum(axis=0)])
    size = pos.shape[1]
    mean = every[1 : size + 1] / every[0]
    scale = np.sqrt(np.maximum(every[size + 1 :] / every[0] - mean**2, 0)) + 1e-3
    p, u = standard(pos, mean, scale), _Prepared(unl, mean, scale)
    prior = _prior(p, u) if prior is None else prior

    def values(w: np.ndarray, negative: float) -> float:
        return nn_risk(p, negative, w, prior)[0]

    def gradient(w: np.ndarray, g: np.ndarray, curve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return g - prior * p.mean(axis=0), curve

    w = _newton(p, u, values, gradient, ridge, rounds, size + 1)
    return Model(mean, scale, w[:-1], float(w[-1]), prior)


def with_features(docs: DataFrame) -> DataFrame:
    """``doc_id, x`` for each row, stored: the features of a text are made once, for learning and for its score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [shape_features(t).astype("<f4").tobytes() for t in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(data, pa.binary())], names=["doc_id", "x"])

    return staged(only(docs, doc_id="doc_id", text="text").mapInArrow(run, "doc_id long, x binary"), "quality-features")


def train(features: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, documents: int = TRAIN_DOCUMENTS) -> Model:
    """Fit on at most ``documents`` trusted positives and on all rows of ``features`` outside the held-out fold.

    The positives' labels are the only labels read.  Without positives every score is 0.5.
    """
    known = labelled(labels, "quality").filter(fold("doc_id", folds) != held_out)
    chosen = sample(known.filter("label = 1").select("doc_id"), documents)
    found = features.join(F.broadcast(chosen), "doc_id").select("doc_id", "x").collect()
    found.sort(key=lambda r: (r.doc_id, r.x))
    pos = np.array([np.frombuffer(r.x, "<f4") for r in found], dtype=float).reshape(-1, N_FEATURES)
    others = features.filter(fold("doc_id", folds) != held_out)
    if not len(pos):
        zero = np.zeros(N_FEATURES)
        return Model(zero, zero + 1, zero, 0.0, 0.5)
    return fit(pos, Stored(others))


def score(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.3, documents: int = TRAIN_DOCUMENTS
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs(doc_id, text)``.

    Null text is scored as the empty text.  Rows with a null or repeated ``doc_id`` are scored one by one;
    other columns are ignored.
    """
    features = with_features(docs)
    sent = docs.sparkSession.sparkContext.broadcast(train(features, labels, folds, held_out, documents))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            scores = model.scores(_vectors(batch))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(scores)], names=["doc_id", "score"])

    scored = features.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        (fold("doc_id", folds) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
