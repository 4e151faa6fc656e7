"""Contaminated words against a search for every window."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from llm import decontaminate
from llm_fixtures import awkward, empty, tuned  # noqa: F401

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13):
    out = {}
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item_id, item in items:
            w = words(item)
            size = min(window, len(w))
            cuts = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
            for i in range(len(own) - size + 1 if w else 0):
                if tuple(own[i : i + size]) in cuts:
                    hit |= set(range(i, i + size))
                    found.add(item_id)
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out[doc_id] = (len(own), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(own))
    return out


def corpus():
    rng = random.Random(22)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "ÀB", "x-y", "1.5"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.choice([1, 2, 5, 12, 13, 14, 30, 60]))) for k in range(12)] + [(100, None), (101, "...")]
    docs = []
    for k in range(80):
        body = text(rng.randint(0, 200)).split(" ")
        if k % 3:
            item = rng.choice(items)[1] or ""
            cut = item.split(" ")[rng.randint(0, 5) :]
            at = rng.randint(0, len(body))
            body[at:at] = cut if k % 2 else [c.upper() + "," for c in cut]
        docs.append((k, " ".join(body)))
    return docs + [(900, None), (901, ""), (902, "w1"), (903, "w1 " * 3000)], items


@pytest.mark.parametrize("bits", [decontaminate.BITS, 64])
def test_hits(tuned, bits):
    """A bitmap that lets every shingle through gives the same hits."""
    docs, items = corpus()
    d = tuned.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = tuned.createDataFrame(items, "item_id long, text string")
    found = decontaminate.digests(decontaminate.contamination(d, i, bits=bits)).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found}
    assert got == brute(docs, items)


def test_windows_are_found_by_their_rarest_shingle(tuned):
    docs, items = corpus()
    d = tuned.createDataFrame(docs, "doc_id long, text string")
    cut = decontaminate.windows(tuned.createDataFrame(items, "item_id long, text string"))
    count = {}
    for _, text in docs:
        own = words(text)
        for size in (1, 2, 3):
            for i in range(len(own) - size + 1):
                count[tuple(own[i : i + size])] = count.get(tuple(own[i : i + size]), 0) + 1
    got = {r.window: r.place for r in decontaminate.prefixes(cut, d).collect()}
    for window in {r.window for r in cut.collect()}:
        own = window.split(" ")
        size = min(3, len(own))
        n = [count.get(tuple(own[i : i + size]), 0) for i in range(len(own) - size + 1)]
        assert got.get(window) == (n.index(min(n)) if min(n) else None)


def test_bitmap_lets_every_wanted_shingle_through(tuned):
    rng = random.Random(25)
    keys = [(rng.getrandbits(64) - (1 << 63), 1 + k % 3) for k in range(2000)]
    for bits in (64, 1 << 16):
        wanted = decontaminate.Wanted.of(tuned.createDataFrame(keys, "key long, size int"), bits)
        assert wanted.has(np.array([k for k, _ in keys], dtype=np.int64)).all() and wanted.sizes == [1, 2, 3]
    other = np.array([rng.getrandbits(64) - (1 << 63) for _ in range(2000)], dtype=np.int64)
    assert wanted.has(other).mean() < 0.1


def test_awkward_and_empty(awkward, empty, tuned):
    items = tuned.createDataFrame([(1, "a b c"), (None, "only"), (2, None)], "item_id long, text string")
    found = decontaminate.contamination(awkward, items)
    assert set(awkward.columns) <= set(found.columns) and found.count() == awkward.count()
    digests = {r.doc_id: r for r in decontaminate.digests(found.filter("doc_id IS NOT NULL")).collect()}
    assert digests[1].n_hit == 3 and digests[1].contaminated and digests[3].n_words == 0
    assert decontaminate.contamination(empty, items).count() == 0
    clean = decontaminate.digests(decontaminate.contamination(awkward, items.limit(0))).collect()
    assert len(clean) == awkward.count() and not any(r.contaminated for r in clean)
