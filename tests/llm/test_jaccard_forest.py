"""The similarity join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from llm import jaccard_forest
from llm.components import components
from llm.jaccard_forest import Forest, exact_links, shingles
from llm_fixtures import awkward, empty, tuned  # noqa: F401


def corpus():
    rng = random.Random(19)
    words = [f"w{i}" for i in range(2000)]
    rows, bases = [], [[rng.choice(words) for _ in range(rng.randint(60, 150))] for _ in range(8)]
    for k in range(160):
        text = list(rng.choice(bases)) if k % 2 else [rng.choice(words) for _ in range(rng.randint(0, 80))]
        if k % 2:
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((k, " ".join(text)))
    return rows + [(200, None), (201, ""), (202, "a b"), (203, "a b"), (204, "a  b\n"), (205, "a")]


def all_pairs(rows, threshold=0.8):
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := (t or "").split()) else frozenset() for _, t in rows]
    n = len(rows)
    links = [[i != j and (sets[i] == sets[j] or len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])) for j in range(n)] for i in range(n)]
    name = list(range(n))
    for _ in range(n):
        new = [min([name[i], *(name[j] for j in range(n) if links[i][j])]) for i in range(n)]
        if new == name:
            break
        name = new
    return {rows[i][0]: (rows[name[i]][0], sum(links[i]), len({sets[j] for j in range(n) if links[i][j]} - {sets[i]})) for i in range(n)}


@pytest.mark.parametrize("block", [2048, 3])
def test_links_and_classes(tuned, block):
    rows = corpus()
    docs = tuned.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = jaccard_forest.join(docs, block=block, block_bytes=jaccard_forest.BLOCK_BYTES if block > 3 else 2000)
    assert {r.doc_id: (r.class_id, r.n_links, r.n_text_links) for r in found.collect()} == all_pairs(rows)


def test_one_row_of_each_class_stays(tuned):
    rows = corpus()
    docs = tuned.createDataFrame([(*r, 1) for r in rows + rows[:9]], "doc_id long, text string, extra int")
    kept = jaccard_forest.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c, _, _ in all_pairs(rows).values()})


def test_prefixes_are_shortened_where_it_costs_least():
    forest = Forest()
    assert forest.least == 5 and Forest(recall=0.99).least == 6
    with pytest.raises(ValueError):
        Forest(trees=1).least  # noqa: B018
    cheap = {7, 11, 20}
    pairs = {(t, d): 0 if t in cheap else 100 * (7 - d) + t for t in range(21) for d in (5, 6)}
    depths = forest.depths(pairs)
    assert forest.expected(depths) >= forest.recall > forest.expected([6] * 21)
    assert all(depths[t] == 5 for t in cheap) and set(depths) == {5, 6}
    last = max(t for t in range(21) if depths[t] == 5 and t not in cheap)
    longer = [6 if t == last else d for t, d in enumerate(depths)]
    assert forest.expected(longer) < forest.recall  # none is shortened without need
    assert depths == forest.depths({k: v * 3 for k, v in pairs.items()}) == Forest().depths(pairs)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_neighbours_in_sorted_tries(tuned, partitions):
    """Every two paths with a common prefix of the least depth are kept, wherever ranges are cut."""
    rng = random.Random(23)
    forest = Forest(trees=3, depth=6, recall=0.6)
    assert forest.least == 5
    word = lambda: rng.randrange(2)
    rows = [(k.to_bytes(2, "big"), [np.array([word() for _ in range(6)], ">u4").tobytes() for _ in range(3)]) for k in range(25)]
    rows += [(b"only", [np.array([9, t, 9, 9, 9, 9], ">u4").tobytes() for t in range(3)]), (b"none", [])]
    own = tuned.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    own.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    nodes = own.createDataFrame(rows, "node binary, paths array<binary>")
    kept = {(r.tree, bytes(r.path), bytes(r.node)) for r in jaccard_forest._neighbours(nodes, forest).collect()}
    every = {(t, p, n) for n, paths in rows for t, p in enumerate(paths)}
    needed = {x for x in every if any(y != x and y[0] == x[0] and y[1][:20] == x[1][:20] for y in every)}
    assert needed <= kept <= every
    if partitions == 1:
        assert len(kept - needed) <= 2


def test_recall_of_candidates_at_the_threshold(tuned):
    """Pairs at a similarity just above the threshold, a thousand of them, all far from one another."""
    rng = random.Random(24)
    rows, n = [], 100
    for k in range(1000):
        text = [f"w{k}x{i}" for i in range(n + 4)]
        rows.append((2 * k, " ".join(text)))
        rows.append((2 * k + 1, " ".join([*text[:-11], *(f"v{k}x{i}" for i in range(11))])))  # 89 of 111 shingles
    rng.shuffle(rows)
    found = jaccard_forest.join(tuned.createDataFrame(rows, "doc_id long, text string").repartition(8))
    linked = sum(r.n_links for r in found.collect()) / 2000
    assert linked >= 0.998


def test_exact_links():
    rng = random.Random(20)
    sets = [np.unique(np.array(rng.sample(range(40), rng.randint(1, 40)), dtype=np.uint64)) for _ in range(60)]
    found = {(i, j) for i, js in exact_links(sets, 0.6) for j in js.tolist()}
    own = [set(s.tolist()) for s in sets]
    assert found == {(i, j) for i in range(60) for j in range(i + 1, 60) if len(own[i] & own[j]) >= 0.6 * len(own[i] | own[j])}


def test_exact_links_in_parts():
    """A bound on the matrix changes nothing."""
    rng = random.Random(22)
    sets = [np.unique(np.array(rng.sample(range(3000), rng.randint(400, 2500)), dtype=np.uint64)) for _ in range(20)]
    blocks = np.array([k % 3 for k in range(20)])
    for own in (None, blocks):
        whole = [(i, js.tolist()) for i, js in exact_links(sets, 0.3, own)]
        assert [(i, js.tolist()) for i, js in exact_links(sets, 0.3, own, matrix_bytes=20 * 16)] == whole and any(js for _, js in whole)


def test_columns_of_any_name_come_through(tuned):
    docs = tuned.createDataFrame([(k, f"a b c d e f g{k // 2}", k) for k in range(6)], "doc_id long, text string, __row1 long").withColumn("__m2", jaccard_forest.F.lit(7))
    kept = jaccard_forest.representatives(docs)
    assert sorted(tuple(r) for r in kept.collect()) == [(k, f"a b c d e f g{k // 2}", k, 7) for k in (0, 2, 4)]


def test_shingles():
    assert len(shingles(b"")) == 0 and len(shingles(b"a b")) == 1 and len(shingles(b"a b c d e f")) == 2
    assert (shingles(b"a b c d e a b c d e") == shingles(b"a b c d e a b c d e a b c d e")).all()


def test_awkward_and_empty(awkward, empty):
    found = jaccard_forest.join(awkward).collect()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append((r.class_id, r.n_links))
    assert by_id[1] == [(1, 2), (1, 2)] and by_id[2] == [(1, 2)]
    assert by_id[3] == by_id[4] == by_id[5] == [(3, 3)]
    assert sorted(by_id[None], key=str) == [(3, 3), (None, 0)]
    assert len(found) == awkward.count()
    assert jaccard_forest.representatives(awkward).columns == awkward.columns
    assert jaccard_forest.representatives(awkward).count() == 7
    assert jaccard_forest.join(empty).count() == 0 == jaccard_forest.representatives(empty).count()


def test_components(tuned):
    rng = random.Random(21)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(None, 5), (7, 7)]
    name = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}
    for _ in range(100):
        for a, b in edges:
            if a in name and b in name:
                name[a] = name[b] = min(name[a], name[b])
    found = components(tuned.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == name
    assert components(tuned.createDataFrame([], "a long, b long")).count() == 0
