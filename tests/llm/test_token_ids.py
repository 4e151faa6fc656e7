"""Token files against the library's own ids, and random access."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from llm import token_ids
from llm.common import new_dir
from llm.tokens import Encoder, vocabulary_path
from llm_fixtures import awkward, empty, tuned  # noqa: F401


def odd_texts(n=400):
    rng = random.Random(1)
    parts = [*"ab,.!' \n\t1é²½_$", "  ", "word", "Straße", "中", " ", "\x1c", "\x85", "\u200b", "<|endoftext|>"]
    fixed = ["", " ", "  a", "a ", "a\n b", "it's a dog's", "a.b c,, d!? 12.5", "'s 't 'll", "\n\n x", "ᲀ a"]
    return fixed + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("remembered", [20, 10**6])
def test_encoder_equals_the_library(remembered):
    own = Encoder(vocabulary_path(), remembered)
    texts = odd_texts()
    found = [ids for i in range(0, len(texts), 50) for ids in own.encode(texts[i : i + 50])]
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 32])
def test_packed_bits_round_trip(bits):
    ids = np.random.default_rng(2).integers(0, 1 << bits, 1003, dtype=np.uint64).astype(np.uint32)
    data = token_ids.pack(ids, bits)
    assert len(data) == -(-1003 * bits // 8)
    assert (token_ids.unpack(data, bits, 1003) == ids).all()


def test_bits_are_the_fewest():
    assert [token_ids.bits_for(n) for n in (1, 2, 3, 256, 257, 50_257)] == [1, 1, 2, 8, 9, 16]


@pytest.mark.parametrize(("bits", "block"), [(16, 64), (17, 10), (5, 8)])
def test_random_access(tmp_path, bits, block):
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 1 << bits, n, dtype=np.uint32) for n in (0, 1, 63, 64, 200, 0, 5)]
    with open(tmp_path / "f", "wb") as out:
        shard = token_ids.ShardWriter(out, bits, block)
        for k, ids in enumerate(docs):
            shard.add(None if k == 3 else k, ids)
        shard.close()
    reader = token_ids.ShardReader(str(tmp_path / "f"))
    for k in (4, 0, 6, 2, 3):
        assert (reader.document(k) == docs[k]).all()
    every = np.concatenate(docs)
    assert (reader.range(50, 140) == every[50:140]).all()
    assert [d for d, _, _ in reader.each()] == [0, 1, 2, None, 4, 5, 6]


def expected(rows, end):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    return [[*library.encode(t or "", add_special_tokens=False).ids, end] for t in rows]


def test_round_trip(awkward):
    found = token_ids.round_trip(awkward).collect()
    rows = awkward.select("doc_id", "text").collect()
    assert len(found) == len(rows)
    ordered = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((r.doc_id for r in rows), key=lambda d: (d is not None, d))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:], strict=False)) and ordered[0].start == 0
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    want = sorted(((r.doc_id, len(ids), crc(ids)) for r, ids in zip(rows, expected([r.text for r in rows], 2), strict=True)), key=str)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in found), key=str) == want


def test_files_hold_ascending_ids(awkward, tuned):
    files = token_ids.write_token_ids(awkward.repartition(3), new_dir(tuned, "test"))
    ids = [d for f in files for d, _, _ in token_ids.ShardReader(f["path"]).each()]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))


def test_empty_table(empty):
    assert token_ids.round_trip(empty).count() == 0
