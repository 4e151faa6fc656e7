"""Suffix sorting against sorted(), and removed bytes against all substrings."""

from __future__ import annotations

import collections
import hashlib
import os
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from llm import queries, suffix_dedup
from llm.suffix_sort import blind_trie, deep_shallow
from llm_fixtures import awkward, empty, tuned  # noqa: F401


@pytest.mark.parametrize("shallow", [0, 8, 64])
def test_sorting(shallow):
    rng = random.Random(16)
    for _ in range(400):
        base = bytes(rng.choice(b"ab") for _ in range(200))
        strings = []
        for _ in range(rng.randint(1, 12)):
            s = bytearray(base[: rng.choice([0, 3, 10, 80, 200])])
            if s and rng.random() < 0.6:
                s[rng.randrange(len(s))] = rng.choice(b"abc")
            strings.append(bytes(s))
        common = lambda o: [0] + [len(os.path.commonprefix([strings[a], strings[b]])) for a, b in zip(o, o[1:], strict=False)]  # noqa: B023, E731
        for order, prefix in (deep_shallow(strings, shallow), blind_trie(strings, list(range(len(strings))))):
            assert [strings[k] for k in order] == sorted(strings) and prefix == common(order)


def test_equal_strings_hold_equal_anchors():
    rng = random.Random(17)
    shared = bytes(rng.choice(b"abcdefgh ") for _ in range(400))
    for left in (0, 1, 500, 999):
        text = bytes(rng.choice(b"abcd") for _ in range(left)) + shared + b"tail" * 200
        where, hashes = suffix_dedup.anchors(text, part=300)
        inside = {(p - left, h) for p, h in zip(where.tolist(), hashes.tolist(), strict=True) if left <= p <= left + 336}
        alone = set(zip(*(x.tolist() for x in suffix_dedup.anchors(shared)), strict=True))
        assert alone and alone <= inside
        assert (where == suffix_dedup.anchors(text)[0]).all()


def brute(texts, length=400):
    count = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        cover = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                cover[i] += 1
                cover[i + length] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rng = random.Random(18)
    words = [f"w{i}" for i in range(50)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(100, 300))) for _ in range(6)]
    rows = []
    for k in range(150):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 120)))
        kind = rng.random()
        if kind < 0.5:
            p, a = rng.choice(passages), rng.randint(0, 60)
            text = text[:50] + p[a : a + rng.randint(380, 900)] + text[50:]
        elif kind < 0.6:
            text = "ab" * rng.randint(100, 600)
        elif kind < 0.65:
            text = "é" * rng.randint(190, 400)
        elif kind < 0.7 and rows:
            text = rng.choice(rows)[1]
        elif kind < 0.73:
            text = None
        rows.append((k, text))
    return rows


@pytest.mark.parametrize("group_max", [50_000, 2])
def test_removed_bytes(tuned, group_max):
    rows = corpus()
    docs = tuned.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted(suffix_dedup.deduplicate(docs, group_max=group_max).collect(), key=lambda r: r.doc_id)
    assert [(r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in found] == brute([(t or "").encode() for _, t in rows])
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


def test_awkward(awkward):
    found = suffix_dedup.deduplicate(awkward).collect()
    rows = awkward.select("doc_id", "text").filter("doc_id IS DISTINCT FROM 6").collect()
    want = sorted(zip([r.doc_id for r in rows], brute([(r.text or "").encode() for r in rows]), strict=True), key=str)
    got = sorted(((r.doc_id, (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256)) for r in found if r.doc_id != 6), key=str)
    assert got == want


def test_cut_texts_keep_rows_and_columns(awkward):
    cut = suffix_dedup.cut_texts(awkward)
    assert cut.columns == awkward.columns and cut.count() == awkward.count()
    by_id = {r.doc_id: r.text for r in cut.filter("doc_id IS NOT NULL").collect()}
    assert by_id[8] == "" and by_id[9] == "" and by_id[3] is None and by_id[2] == "a b c d e f g"


def test_empty_table(empty):
    assert suffix_dedup.deduplicate(empty).count() == 0


def brute_passages(texts, words=51, length=400):
    """Words left where no run of so many words, and no ``length`` bytes with fewer of them, starts elsewhere too."""
    split = [list(suffix_dedup.WORD.finditer(t)) for t in texts]
    runs = collections.Counter(tuple(m[0] for m in s[i : i + words]) for s in split for i in range(len(s) - words + 1))
    strings = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t, s in zip(texts, split, strict=True):
        gone = [False] * len(t)
        for i in range(len(s) - words + 1):
            if runs[tuple(m[0] for m in s[i : i + words])] > 1:
                a, b = s[i].start(), s[i + words - 1].end()
                gone[a:b] = [True] * (b - a)
        for i in range(len(t) - length + 1):
            own = t[i : i + length]
            if strings[own] > 1 and len(re.findall(rb"(?<=[ \n])[^ \n]+(?=[ \n])", own)) < words:
                gone[i : i + length] = [True] * length
        out.append(bytes(b for b, g in zip(t, gone, strict=True) if not g).split())
    return out


def test_pipeline_cuts_51_words_under_400_bytes(tuned):
    rng = random.Random(19)
    unlike = lambda: " ".join(f"{rng.getrandbits(40):x}" for _ in range(30))
    passage = [f"p{k}" for k in range(51)]
    assert len(" ".join(passage)) < 400
    heads, tails = [unlike() for _ in range(4)], [unlike() for _ in range(4)]
    middles = [" ".join(passage), "\n".join(passage), " ".join(passage[:50]).replace("p", "q"), " ".join(passage[:50]).replace("p", "q")]
    rows = [(k, f"{a} {m} {b}", 0) for k, (a, m, b) in enumerate(zip(heads, middles, tails, strict=True))]
    cut = corpus_pipeline.repeated_passages(tuned, tuned.createDataFrame(rows, "doc_id long, text string, n_chars long"), "").collect()
    want = [f"{a} {'' if k < 2 else m} {b}" for k, (a, m, b) in enumerate(zip(heads, middles, tails, strict=True))]
    assert [(r.text, r.n_chars) for r in sorted(cut)] == [(t, len(t)) for t in want]


@pytest.mark.parametrize("group_max", [50_000, 2])
def test_passages_against_all_runs(tuned, group_max):
    rng = random.Random(20)
    words = [f"w{i}" for i in range(40)] + ["long" * 30]
    passages = [" ".join(rng.choice(words[:40]) for _ in range(rng.randint(60, 140))) for _ in range(5)]
    rows = []
    for k in range(120):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))
        p, kind = rng.choice(passages).split(), rng.random()
        a, n = rng.randint(0, 10), rng.randint(45, 80)
        if kind < 0.6:
            text = f"{text[:40]} {' '.join(p[a : a + n])} {text[40:]}"
        elif kind < 0.7:
            text = "one two " + "".join(f"{k}x" for k in range(rng.randint(150, 300))) + " three"
        rows.append((k, text))
    cut = suffix_dedup.cut_passages(tuned.createDataFrame(rows, "doc_id long, text string").repartition(5), group_max=group_max)
    found = [r.text.encode().split() for r in sorted(cut.collect())]
    raw = [t.encode() for _, t in rows]
    want = brute_passages(raw)
    assert any(len(w) < len(t.split()) for w, t in zip(want, raw, strict=True))
    same = sum(f == w for f, w in zip(found, want, strict=True))
    assert same == len(rows)


def test_passages_keep_rows_and_columns(awkward, empty):
    cut = suffix_dedup.cut_passages(awkward)
    assert cut.columns == awkward.columns and cut.count() == awkward.count()
    by_id = {r.doc_id: r.text for r in cut.filter("doc_id IS NOT NULL").collect()}
    assert by_id[8] == "" and by_id[9] == "" and by_id[3] is None and by_id[2] == "a b c d e f g"
    assert suffix_dedup.cut_passages(empty).count() == 0


def test_extra_columns_come_through(tuned):
    words = " ".join(f"word{k}" for k in range(60))
    docs = tuned.createDataFrame([(k, f"begin{k} {words} end{k}", k) for k in range(3)], "doc_id long, text string, __cut long").withColumn("__own1", suffix_dedup.F.lit("x"))
    for cut in (suffix_dedup.cut_passages(docs), suffix_dedup.cut_texts(docs, length=80)):
        assert cut.columns == docs.columns
        assert all((r["__cut"], r["__own1"]) == (r.doc_id, "x") and "word30" not in r.text for r in cut.collect())


def brute_covered(texts, words=51, length=400):
    """Maximal runs of bytes in strings of ``length`` bytes or ``words`` whole words that start elsewhere too."""
    split = [[m.span() for m in suffix_dedup.WORD.finditer(t)] for t in texts]
    windows = [[(s[i][0], s[i + words - 1][1]) for i in range(len(s) - words + 1)] for s in split]
    runs = collections.Counter(t[a:b] for t, w in zip(texts, windows, strict=True) for a, b in w)
    strings = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t, own in zip(texts, windows, strict=True):
        gone = bytearray(len(t) + 2)
        for a, b in [(a, b) for a, b in own if runs[t[a:b]] > 1] + [(i, i + length) for i in range(len(t) - length + 1) if strings[t[i : i + length]] > 1]:
            gone[a + 1 : b + 1] = b"\1" * (b - a)
        edges = [k for k in range(len(t) + 1) if gone[k] != gone[k + 1]]
        out.append(list(zip(edges[::2], edges[1::2], strict=True)))
    return out


def test_op7_tells_passages_of_51_words_under_400_bytes(tuned, tmp_path):
    rng = random.Random(21)
    unlike = lambda: " ".join(f"{rng.getrandbits(40):x}" for _ in range(60))
    passage = " ".join(f"p{k}" for k in range(51))
    shorter = " ".join(f"q{k}" for k in range(50))
    texts = [f"{unlike()} {m} {unlike()}" for m in (passage, passage, shorter, shorter, "", "")] + [passage, f"{passage}x {unlike()}", None]
    tuned.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(queries.QUERIES["op7_suffix_dedup"](tuned, str(tmp_path)).collect(), key=lambda r: r.doc_id)
    assert [r.n_passage_bytes for r in found] == [len(passage)] * 2 + [0] * 4 + [len(passage), 0, 0]
    assert [r.n_removed for r in found] == [0] * 9 and [r.text for r in found] == [t or "" for t in texts]


@pytest.mark.parametrize("group_max", [50_000, 2])
def test_passages_against_all_strings(tuned, group_max):
    rng = random.Random(22)
    words = [f"w{i}" for i in range(40)] + ["long" * 30, "é" * 9]
    passages = [" ".join(rng.choice(words[:40]) for _ in range(rng.randint(60, 140))) for _ in range(5)]
    rows = []
    for k in range(150):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))
        p, kind = rng.choice(passages), rng.random()
        if kind < 0.5:
            a, n = rng.randint(0, 10), rng.randint(45, 80)
            text = f"{text[:40]} {' '.join(p.split()[a : a + n])}{rng.choice([' ', '', chr(10)])}{text[40:]}"
        elif kind < 0.6:
            text = text[:40] + p[rng.randint(0, 30) :][: rng.randint(150, 450)] + text[40:]
        elif kind < 0.65:
            text = " ".join(["a", "b"] * rng.randint(20, 120))
        elif kind < 0.75:
            text = rng.choice(["", " "]) + " ".join(passages[0].split()[:55]) + rng.choice(["", "\n"])
        rows.append((k, text))
    docs = tuned.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted(suffix_dedup.deduplicate(docs, group_max=group_max).collect(), key=lambda r: r.doc_id)
    raw = [t.encode() for _, t in rows]
    want = brute_covered(raw)
    assert [[tuple(s) for s in r.passages] for r in found] == want
    assert [(r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in found] == brute(raw)
    assert sum(bool(w) and not r.n_removed for r, w in zip(found, want, strict=True)) > 10


def test_windows_give_equal_anchors_in_any_part():
    rng = random.Random(23)
    run = " ".join(f"{rng.getrandbits(12):x}" for _ in range(51))
    for left in ("", "x " * 30, "y" * 700 + " "):
        text = f"{left}{run} {'z' * 500}".encode()
        whole = suffix_dedup.anchors(text, words=51)
        for part in (100, 301):
            assert all((a == b).all() for a, b in zip(suffix_dedup.anchors(text, part=part, words=51), whole, strict=True))
        alone = {(p + len(left), h) for p, h in zip(*(x.tolist() for x in suffix_dedup.anchors(run.encode(), words=51)), strict=True)}
        assert alone and alone <= set(zip(*(x.tolist() for x in whole), strict=True))
