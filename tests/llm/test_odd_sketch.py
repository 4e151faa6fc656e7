"""Near-duplicate classes against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from llm import odd_sketch
from llm.odd_sketch import Sketch
from llm_fixtures import awkward, empty, tuned  # noqa: F401

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)} | dict.fromkeys("\t\n\x0b\x0c\r", " "))


def set_of(text):
    words = [w for w in (text or "").translate(LOWER).split(" ") if w]
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def brute(rows):
    sets = [set_of(t) for _, t in rows]
    n = len(rows)
    name = list(range(n))

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                name[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    own = [least.get(find(i)) if sets[i] else rows[i][0] for i in range(n)]
    return sorted(repr((rows[i][0], len(sets[i]), own[i], rows[i][0] == own[i])) for i in range(n))


def corpus():
    rng = random.Random(19)
    words = [f"W{i}" for i in range(2000)]
    rows, bases = [], [[rng.choice(words) for _ in range(rng.randint(60, 150))] for _ in range(8)]
    for k in range(300):
        text = list(rng.choice(bases)) if k % 2 else [rng.choice(words) for _ in range(rng.randint(0, 80))]
        if k % 2:
            for _ in range(rng.randint(0, 6)):
                text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((k, " ".join(text)))
    return rows + [(700, None), (701, ""), (702, "a b"), (703, "A b"), (704, "a  b\n"), (705, "a"), (706, " \n"), (None, "a"), (703, "A b")]


def found(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted(repr(tuple(r)) for r in odd_sketch.classes(docs, **options).collect())


@pytest.mark.parametrize(("block", "block_bytes"), [(2048, odd_sketch.BLOCK_BYTES), (5, odd_sketch.BLOCK_BYTES), (2048, 3000)])
def test_classes(tuned, block, block_bytes):
    rows = corpus()
    assert found(tuned, rows, block=block, block_bytes=block_bytes) == brute(rows)


def test_a_chain_of_copies_is_one_class(tuned):
    """Each text is linked with its neighbours only, so no leader meets all of them."""
    rng = random.Random(4)
    text, rows = [f"w{rng.random()}" for _ in range(120)], []
    for k in range(60):
        rows.append((k, " ".join(text)))
        text[rng.randrange(len(text))] = f"x{k}"
        text[rng.randrange(len(text))] = f"y{k}"
    want = brute(rows)
    assert found(tuned, rows) == want and len({eval(r)[2] for r in want}) < 10


def test_links_across_components_that_the_stars_leave(tuned, monkeypatch):
    """Without stars, the pairs of step 5 alone connect the classes."""
    rows = corpus()
    monkeypatch.setattr(odd_sketch, "_stars", lambda shared, nodes, sketch: shared.selectExpr("node AS a", "node AS b").limit(0))
    assert found(tuned, rows, block=7) == brute(rows)


def pair(rng, size, similarity):
    """Two sorted sets of hashes of about this size and similarity."""
    both = round(2 * size * similarity / (1 + similarity))
    every = np.unique(rng.integers(0, 1 << 64, 2 * size - both, dtype=np.uint64))
    rng.shuffle(every)
    half = (len(every) - both) // 2
    return np.sort(every[: both + half]), np.sort(np.concatenate([every[:both], every[both + half :]]))


@pytest.mark.parametrize("size", [5, 40, 300, 3000])
def test_sketches_tell_high_similarities(size):
    """No pair at the threshold is lost; of those well below it few are taken for candidates, where sets are large enough to tell."""
    sketch, rng = Sketch(), np.random.default_rng(5)

    def share(similarity):
        hits = 0
        for _ in range(200):
            a, b = pair(rng, size, similarity)
            near, _ = sketch.near(np.array([len(a)]), sketch.fold(a).view(np.uint64)[None], np.array([len(b)]), sketch.fold(b).view(np.uint64)[None])
            hits += int(near[0])
        return hits / 200

    assert share(0.82 if size > 5 else 0.9) == 1
    assert share(0.5) < (0.05 if size >= 300 else 0.7)
    if size == 300:
        assert share(0.7) < 0.5 and share(0.65) < 0.05


def test_bands_miss_next_to_nothing():
    assert (1 - 0.8**odd_sketch.ROWS) ** odd_sketch.BANDS < 4e-6


def test_awkward_and_empty(awkward, empty):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert sorted(repr(tuple(r)) for r in odd_sketch.classes(awkward).collect()) == brute(rows)
    assert odd_sketch.classes(empty).count() == 0
