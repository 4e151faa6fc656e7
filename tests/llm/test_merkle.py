"""The hash trees and proofs against trees built in memory."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from llm import merkle, sweeps
from llm_fixtures import DOCS, awkward, empty, tuned  # noqa: F401


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def steps(levels, k):
    out = []
    for level in levels[:-1]:
        out.append((k ^ 1 < k, level[k ^ 1]) if k ^ 1 < len(level) else None)
        k >>= 1
    return out


def brute(rows):
    """Rows ``(doc_id, source, lang, n_chars, text)`` to the query's columns."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    built = {g: tree([leaf_of(r) for r in groups[g]]) for g in order}
    top = tree([built[g][-1][0] for g in order])
    out = []
    for place, g in enumerate(order):
        for k, r in enumerate(groups[g]):
            way, own = steps(built[g], k) + steps(top, place), list(r)
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                own[3] += 1
            fold = leaf_of(own)
            for s in way:
                fold = h(fold) if s is None else h(s[1], fold) if s[0] else h(fold, s[1])
            proof = h(*[s[1] for s in way if s])
            out.append((r[0], leaf_of(r), built[g][-1][0], top[-1][0], proof, fold, fold == top[-1][0]))
    return sorted(map(repr, out))


def rows_of(docs):
    return [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def found(docs, levels):
    return sorted(repr(tuple(r)) for r in merkle.verify_documents(docs, levels).collect())


@pytest.mark.parametrize("levels", [1, 2, 13])
def test_trees_of_every_size(tuned, levels):
    rows = [(100 * g + k, f"text {k}", f"g{g}", "s", k) for g in range(1, 12) for k in range(g)]
    rows += [(5000 + k, "é" * k, None, None, None if k % 3 else k) for k in range(37)]
    docs = tuned.createDataFrame(rows, DOCS).repartition(5)
    assert found(docs, levels) == brute(rows_of(docs))


def test_one_leaf_is_its_own_root(tuned):
    docs = tuned.createDataFrame([(1, "a", "en", "s", 1)], DOCS)
    row = merkle.verify_documents(docs).first()
    assert row.leaf == row.subroot == row.root == leaf_of((1, "s", "en", 1, "a")) and row.proof_sha256 == h() and row.verified


def test_awkward_rows(awkward, empty):
    assert found(awkward, 2) == brute(rows_of(awkward))
    assert merkle.verify_documents(empty).count() == 0
    assert merkle.verify_documents(empty).columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_only_what_was_changed_fails(tuned):
    rows = [(k, f"t{k}", "en" if k % 2 else "fr", "s", k) for k in range(300)]
    got = merkle.verify_documents(tuned.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id for r in got if not r.verified} == {k for k in range(300) if zlib.crc32(str(k).encode()) % 7 == 0}


def test_a_wrong_sibling_fails(tuned):
    leaves = tuned.createDataFrame([(k, "t", h(str(k)), None) for k in range(6)], "key long, tree string, leaf string, tampered string")
    proofs = merkle.manifest(leaves, levels=1)
    assert proofs.filter(merkle.folded(F.col("leaf")) == F.col("root")).count() == 6
    spoilt = proofs.withColumn("steps", F.transform("steps", lambda s: F.struct(s["left"].alias("left"), F.reverse(s["digest"]).alias("digest"))))
    assert spoilt.filter(merkle.folded(F.col("leaf")) == F.col("root")).count() == 0


def test_places_are_gapless_in_hot_groups(tuned):
    rows = [(None if k % 7 == 0 else "hot" if k % 3 else f"g{k % 11}", k * 7919 % 1000, k) for k in range(3000)]
    df = tuned.createDataFrame(rows, "g string, o long, k long").repartition(7)
    got = sweeps.numbered(df, "g", ["o", "k"], "places").collect()
    want = {}
    for g, o, k in rows:
        want.setdefault(g, []).append((o, k))
    assert {(r.g, r.o, r.k): r.pos for r in got} == {(g, *x): i for g, every in want.items() for i, x in enumerate(sorted(every))}
