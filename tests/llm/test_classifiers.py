"""Held-out accuracy of the two classifiers, and their edge cases."""

from __future__ import annotations

import random

import numpy as np
import pytest

from llm import pu_quality, weak_toxicity
from llm.common import table
from llm.learning import fold
from llm_fixtures import awkward, empty, labels, tuned  # noqa: F401

SF = "/root/testdata/sf0.01"


def accuracy(scored, labels, column):
    rows = scored.filter("held_out").join(labels.filter(f"{column} IS NOT NULL"), "doc_id").collect()
    return np.mean([r.predicted == r[column] for r in rows]), len(rows)


def test_quality_on_held_out_rows(tuned):
    labels = table(tuned, SF, "labels")
    right, n = accuracy(pu_quality.score(table(tuned, SF, "documents"), labels), labels, "quality")
    assert n > 50 and right > 0.93


def test_toxicity_on_held_out_rows(tuned):
    labels = table(tuned, SF, "labels")
    right, n = accuracy(weak_toxicity.score(table(tuned, SF, "documents"), labels), labels, "toxic")
    assert n > 80 and right > 0.93


def test_held_out_labels_are_never_read(tuned):
    labels = table(tuned, SF, "labels")
    docs = table(tuned, SF, "documents")
    for module, folds, held, column in ((pu_quality, 5, 0, "quality"), (weak_toxicity, 3, 1, "toxic")):
        turned = labels.selectExpr("doc_id", f"CASE WHEN crc32(cast(cast(doc_id as string) as binary)) % {folds} = {held} THEN 1 - {column} ELSE {column} END AS {column}")
        a, b = (sorted((r.doc_id, r.score) for r in module.score(docs, x).collect()) for x in (labels, turned))
        assert a == b


def test_prior_is_estimated():
    rng = np.random.default_rng(12)
    pos = rng.normal(2, 1, (3000, 3))
    unl = np.vstack([rng.normal(2, 1, (2100, 3)), rng.normal(-2, 1, (900, 3))])
    assert abs(pu_quality.estimate_prior(pos, unl) - 0.7) < 0.08


def test_risk_separates_without_negatives():
    rng = np.random.default_rng(13)
    pos = rng.normal(1.5, 1, (2000, 3))
    unl = np.vstack([rng.normal(1.5, 1, (1000, 3)), rng.normal(-1.5, 1, (1000, 3))])
    model = pu_quality.fit(pos, unl, prior=0.5)
    assert (model.scores(rng.normal(1.5, 1, (500, 3))) > 0.5).mean() > 0.95
    assert (model.scores(rng.normal(-1.5, 1, (500, 3))) < 0.5).mean() > 0.95


def test_risk_and_its_slopes_against_enumeration():
    """The risk row by row, and gradient and curvature by differences of it."""
    rng = np.random.default_rng(14)
    pos, unl = (np.hstack([rng.normal(size=(n, 3)), np.ones((n, 1))]) for n in (7, 11))
    for w in rng.normal(size=(20, 4)) * 3:
        loss = lambda g: np.log(1 + np.exp(-g))
        good, bad = ([loss(sign * float(x @ w)) for x in pos] for sign in (1, -1))
        rest = [loss(-float(x @ w)) for x in unl]
        assert np.allclose(pu_quality.losses(pos, w), (good, bad))
        negative = sum(rest) / 11 - 0.6 * sum(bad) / 7
        risk = 0.6 * sum(good) / 7 + max(0, negative)
        assert np.allclose(pu_quality.nn_risk(pos, sum(rest) / 11, w, 0.6), (risk, negative))
        found = pu_quality.slopes(unl, w)
        total = lambda v: pu_quality.losses(unl, v)[1].sum()
        eye = np.eye(4) * 1e-4
        gradient = [(total(w + e) - total(w - e)) / 2e-4 for e in eye]
        curve = [[(total(w + a + b) - total(w + a - b) - total(w - a + b) + total(w - a - b)) / 4e-8 for a in eye] for b in eye]
        assert found[0] == 11 and np.allclose(found[1:5], gradient, atol=1e-5) and np.allclose(found[5:].reshape(4, 4), curve, atol=1e-3)


def test_every_unlabelled_row_counts(tuned):
    """Sums over a stored table equal those in memory, and a row outside the fold changes them."""
    rng = np.random.default_rng(15)
    x = rng.normal(size=(1300, pu_quality.N_FEATURES)).astype("<f4")
    rows = tuned.createDataFrame([(bytes(v.tobytes()),) for v in x], "x binary").repartition(7)
    measure = lambda y: pu_quality.slopes(y, np.full(y.shape[1], 0.1))
    assert np.allclose(pu_quality.Stored(rows).total(measure), pu_quality.Rows(x.astype(float)).total(measure))
    docs = [(k, "alpha beta gamma delta. " * 30 + f"word{k}") for k in range(200)] + [(1000 + k, "zz 99 | ## " * (k % 7 + 1)) for k in range(200)]
    labels = tuned.createDataFrame([(k, 1, None) for k in range(0, 200, 3)], "doc_id long, quality int, toxic int")
    train = lambda d: pu_quality.train(pu_quality.with_features(tuned.createDataFrame(d, "doc_id long, text string")), labels)
    few, many = train(docs[:320]), train(docs)
    assert many.prior < few.prior, (few.prior, many.prior)


def test_label_model_finds_accuracies_without_labels():
    rng = np.random.default_rng(14)
    y = rng.random(6000) < 0.3
    votes = np.zeros((6000, 6), dtype=int)
    for j, (hit, false) in enumerate([(0.9, 0.02), (0.7, 0.05), (0.6, 0.01), (0.8, 0.1), (0.0, 0.0)]):
        votes[:, j] = rng.random(6000) < np.where(y, hit, false)
    votes[:, 4] = -1 * (rng.random(6000) < np.where(y, 0.1, 0.9))
    votes[:, 5] = votes[:, 0]  # a copy, which must not count twice
    model = weak_toxicity.LabelModel.fit(votes)
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.95
    assert abs(np.exp(model.log_rates[1, 0, 2]) - 0.9) < 0.05
    assert model.share[5] < 0.7 and model.share[0] < 0.7


def test_planted_words_are_mined(tuned):
    rng = random.Random(15)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    vocabulary = [word() for _ in range(300)]
    slurs = ["zorkan", "zorkel", "zorkim", "blavvo"]
    rows, marks = [], []
    for k in range(600):
        text = [rng.choice(vocabulary) for _ in range(60)]
        toxic = k % 6 == 0
        if toxic:
            for s in rng.sample(slurs, 2):
                text.insert(rng.randint(0, 60), s)
        rows.append((k, " ".join(text)))
        marks.append((k, int(toxic)))
    rows.append((600, " ".join([vocabulary[0]] * 40 + ["zorkun"])))
    docs = tuned.createDataFrame(rows, "doc_id long, text string")
    labels = tuned.createDataFrame(marks, "doc_id long, toxic int")
    found = {r.doc_id: r.predicted for r in weak_toxicity.score(docs, labels).collect()}
    assert all(found[k] == m for k, m in marks) and found[600] == 1


@pytest.mark.parametrize("module", [pu_quality, weak_toxicity])
def test_awkward_and_empty(module, awkward, empty, labels):
    found = module.score(awkward, labels).collect()
    assert len(found) == awkward.count()
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in found)
    assert module.score(empty, labels).count() == 0
    assert module.score(awkward, labels.limit(0)).count() == awkward.count()


def test_fold_is_the_crc_of_the_id(tuned):
    import zlib

    rows = tuned.range(50).select("id", fold("id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in rows)
