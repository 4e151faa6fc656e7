"""Line labels: Viterbi and training against brute force, base counts against plain Python."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np

from llm import line_crf
from llm.line_crf import N_FEATURES, LineCrf
from llm.shape import base_counts
from llm_fixtures import awkward, empty, labels, tuned  # noqa: F401

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_counts(text):
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {k for i, g in enumerate(grams) if grams.count(g) > 1 for k in (i, i + 1, i + 2)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(inside)


def test_base_counts():
    rng = random.Random(8)
    parts = ["a", "b", "é", "\u00a0", " ", " ", "\n", "\x0b", "\x1c", "#", "<>", "\u2028", "\x85"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        assert base_counts(text) == plain_counts(text), repr(text)


def random_crf(rng):
    return LineCrf(rng.normal(size=(N_FEATURES, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))


def path_score(crf, x, labels):
    s = x @ crf.emit
    moves = sum(crf.move[a, b] for a, b in itertools.pairwise(labels))
    return crf.first[labels[0]] + sum(s[i, y] for i, y in enumerate(labels)) + moves


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(9)
    for n in range(1, 8):
        crf, x = random_crf(rng), rng.normal(size=(n, N_FEATURES))
        paths = list(itertools.product((0, 1), repeat=n))
        assert tuple(crf.decode(x)) == max(paths, key=lambda p: path_score(crf, x, p))


def test_expected_counts_sum_over_all_paths():
    rng = np.random.default_rng(10)
    crf, x = random_crf(rng), rng.normal(size=(1, 4, N_FEATURES))
    on = np.array([[True, True, True, False]])
    paths = list(itertools.product((0, 1), repeat=3))
    p = np.exp([path_score(crf, x[0, :3], q) for q in paths])
    p /= p.sum()
    moves = np.zeros((2, 2))
    for w, q in zip(p, paths, strict=True):
        for a, b in itertools.pairwise(q):
            moves[a, b] += w
    found = crf._expected(x, on, on[:, 1:] & on[:, :-1])
    assert np.allclose(found[2 * N_FEATURES : 2 * N_FEATURES + 4].reshape(2, 2), moves)


def corpus(tuned):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
    rows, marks = [], []
    for k in range(240):
        good = [" ".join(word() for _ in range(rng.randint(6, 14))).capitalize() + "." for _ in range(12)]
        junk = [" | ".join(word() for _ in range(8)) + " ***" for _ in range(12)]
        lines = junk if k % 3 == 0 else good if k % 3 == 1 else good[:9] + junk[:1] + good[9:]
        rows.append((k, "\n".join(lines)))
        marks.append((k, int(k % 3 != 0)))
    return tuned.createDataFrame(rows, "doc_id long, text string"), tuned.createDataFrame(marks, "doc_id long, quality int")


def test_content_stays_and_boilerplate_goes(tuned):
    docs, labels = corpus(tuned)
    found = {r.doc_id: r for r in line_crf.judge(docs, labels).collect()}
    assert all(found[k].kept == (k % 3 != 0) for k in found)
    assert all(len(found[k].boilerplate_lines) == 12 * (k % 3 == 0) for k in found if k % 3 != 2)


def test_awkward(awkward, labels):
    found = line_crf.judge(awkward, labels).collect()
    rows = awkward.select("doc_id", "text").collect()
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found if r.doc_id != 6]
    want = [(r.doc_id, *plain_counts(r.text or "")) for r in rows if r.doc_id != 6]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(r.base_failed and not r.kept for r in found if r.n_words < 50)


def test_empty_tables(empty, awkward, labels):
    assert line_crf.judge(empty, labels).count() == 0
    assert line_crf.judge(awkward, labels.limit(0)).filter("kept").count() == 1  # the long text


def test_training_sees_every_line(tuned, monkeypatch):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
    texts = ["\n".join(" ".join(word() for _ in range(5)) for _ in range(n)) + "\nmenu | home | help" * 4 for n in (3, 50, 200, 90)]
    seen = []
    monkeypatch.setattr(LineCrf, "fit", classmethod(lambda cls, chains, marks: seen.extend(zip(chains, marks, strict=True))))
    docs = tuned.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    line_crf.train(docs, tuned.createDataFrame([(k, 0) for k in range(4)], "doc_id long, quality int"))
    for text, (chain, marks) in zip(texts, seen, strict=True):
        want = line_crf.line_features(line_crf.lines_of(text)).astype("<f4")
        assert chain.shape == want.shape and (chain == want).all()
        assert marks[-4:].all()  # the bars at the end of the text


def test_blocks_of_chains_fit_as_one(monkeypatch):
    rng = np.random.default_rng(13)
    chains = [rng.random((n, N_FEATURES)) for n in (1, 2, 3, 9, 30, 31, 70, 150)]
    marks = [(c[:, 1] > 0.5).astype(np.int64) for c in chains]
    many = LineCrf.fit(chains, marks, steps=20)
    monkeypatch.setattr(LineCrf, "_by_length", staticmethod(lambda chains: [list(range(len(chains)))]))
    one = LineCrf.fit(chains, marks, steps=20)
    assert np.allclose(many.emit, one.emit) and np.allclose(many.move, one.move) and np.allclose(many.first, one.first)
