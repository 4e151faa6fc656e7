"""Packing: exact fills against brute force, and pieces against the documents."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest

from llm import packing
from llm.packing import Packer, fill
from test_token_ids import expected
from llm_fixtures import awkward, empty, tuned  # noqa: F401


def best(counts, capacity):
    """The closest sum that takes the longest length once, by trying all multisets."""
    longest = max(counts)
    ways = itertools.product(*[range(n + 1) for n in counts.values()])
    sums = (sum(k * length for k, length in zip(w, counts, strict=True)) for w in ways if dict(zip(counts, w, strict=True))[longest])
    return max(s for s in sums if s <= capacity)


def test_fill_is_the_closest_multiset():
    rng = random.Random(4)
    for _ in range(300):
        capacity = rng.randint(8, 40)
        counts = {rng.randint(1, capacity): rng.randint(1, 4) for _ in range(rng.randint(1, 4))}
        used = fill(counts, capacity)
        assert all(used[length] <= counts[length] for length in used)
        assert sum(length * n for length, n in used.items()) == best(counts, capacity)


@pytest.mark.parametrize("waiting", [1, 7, 10_000])
def test_sequences_are_full_or_powers_of_two(waiting):
    rng = random.Random(6)
    packer = Packer(32, waiting)
    docs = [np.arange(rng.randint(1, 100), dtype=np.uint32) for _ in range(200)]
    for k, ids in enumerate(docs):
        packer.add(k, ids)
    packer.finish()
    check_pieces(packer.rows, {k: [ids.tolist()] for k, ids in enumerate(docs)}, 32)


def check_pieces(rows, docs, capacity):
    sequences, pieces = {}, {}
    for doc_id, start, length, crc, doc_tokens, sequence, offset in rows:
        sequences.setdefault(sequence, []).append((offset, length))
        pieces.setdefault(doc_id, []).append((start, length, crc, doc_tokens))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        total = sum(n for _, n in parts)
        assert total <= capacity and total & (total - 1) == 0
    assert pieces.keys() == docs.keys()
    for doc_id, copies in docs.items():
        found = []
        for ids in copies:
            assert any(t == len(ids) for *_, t in pieces[doc_id])
            found += [(s, n, c) for s, n, c, t in pieces[doc_id] if t == len(ids)]
            for s, n, c, t in pieces[doc_id]:
                if t == len(ids):
                    assert c == zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())
        assert sum(n for _, n, *_ in pieces[doc_id]) == sum(map(len, copies))


def test_documents(awkward):
    rows = awkward.select("doc_id", "text").collect()
    docs: dict = {}
    for r, ids in zip(rows, expected([r.text for r in rows], 0), strict=True):
        docs.setdefault(r.doc_id, []).append(ids)
    found = [tuple(r) for r in packing.pack_documents(awkward, with_ids=False).collect()]
    check_pieces(found, docs, 1024)


def test_ids_come_with_the_pieces(awkward):
    for r in packing.pack_documents(awkward.filter("doc_id = 6")).collect():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length


def test_empty_table(empty):
    assert packing.pack_documents(empty).count() == 0
