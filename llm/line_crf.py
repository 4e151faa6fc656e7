"""Line labelling by a linear-chain conditional random field; content share decides retention.

Each line with a word is a position of the chain, labelled content or boilerplate.  The weights are trained here by
maximum likelihood on a bounded sample: lines of documents whose quality label is 1 count as
content, lines of the others as boilerplate where they show any sign of it.  Viterbi decoding then labels every line of
every document, and a document stays if enough of its words lie in content lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import only, texts
from llm.learning import Adam, labelled, sample, with_texts
from llm.shape import SPACES, SYMBOLS, base_counts

CONTENT, BOILERPLATE = 0, 1
# Labelled documents that the weights are fitted on.
TRAIN_DOCUMENTS = 4000
# Padded lines of the chains that are fitted in step.
BLOCK_LINES = 1 << 16
MIN_CONTENT = 0.5

LETTERS_UP = bytes(range(0x41, 0x5B))
DIGITS = bytes(range(0x30, 0x3A))
N_FEATURES = 16


def line_features(lines: list[bytes]) -> np.ndarray:
    """A row of bounded features for each line, its repeats within the text among them."""
    out = np.zeros((len(lines), N_FEATURES))
    seen: dict[bytes, int] = {}
    for line in lines:
        seen[line] = seen.get(line, 0) + 1
    for i, line in enumerate(lines):
        size, words = len(line), line.split()
        n = len(words)
        symbols = (size - len(line.translate(None, SYMBOLS))) / size
        upper = (size - len(line.translate(None, LETTERS_UP))) / size
        digits = (size - len(line.translate(None, DIGITS))) / size
        unlike = 1 - len(set(words)) / n
        out[i] = (
            1.0,
            min(1.0, symbols * 5),
            symbols > 0.04,
            min(1.0, upper * 2),
            upper > 0.3,
            min(1.0, digits * 3),
            min(1.0, line.count(b" | ") / n * 2),
            min(1.0, line.count(b"!!") / n),
            unlike,
            unlike > 0.6,
            seen[line] > 1,
            seen[line] > 3,
            n < 3,
            n > 8,
            line.endswith((b".", b"!", b"?", b":", b'"')),
            min(1.0, size / n / 20),
        )
    return out


def signs(features: np.ndarray) -> np.ndarray:
    """Lines that show a sign of boilerplate: symbols, capitals, bars, exclamations or repeats."""
    return (features[:, [2, 4, 9, 10]] > 0).any(axis=1) | (features[:, 6] > 0.2) | (features[:, 7] > 0.2)


class LineCrf:
    """Weights of two labels: ``emit`` by feature, ``move`` between neighbours, ``first`` at the start."""

    def __init__(self, emit: np.ndarray, move: np.ndarray, first: np.ndarray) -> None:
        self.emit, self.move, self.first = emit, move, first

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The likeliest labels of a chain (Viterbi)."""
        n = len(features)
        if not n:
            return np.empty(0, np.int8)
        score = (features @ self.emit).tolist()
        (m00, m01), (m10, m11) = self.move.tolist()
        a, b = score[0][0] + self.first[0], score[0][1] + self.first[1]
        back = []
        for s0, s1 in score[1:]:
            stay_a, stay_b = a + m00 >= b + m10, b + m11 >= a + m01
            back.append((0 if stay_a else 1, 1 if stay_b else 0))
            a, b = (a + m00 if stay_a else b + m10) + s0, (b + m11 if stay_b else a + m01) + s1
        labels = np.empty(n, np.int8)
        label = 0 if a >= b else 1
        for k in range(n - 1, -1, -1):
            labels[k] = label
            if k:
                label = back[k - 1][label]
        return labels

    @classmethod
    def fit(cls, chains: list[np.ndarray], labels: list[np.ndarray], steps: int = 150, ridge: float = 1e-3) -> "LineCrf":
        """Maximum likelihood with a ridge, chains of like length in step with one another."""
        if not chains:
            return cls(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), np.zeros(2))
        blocks = [cls._block([chains[k] for k in own], [labels[k] for k in own]) for own in cls._by_length(chains)]
        total = sum(on.sum() for _, on, _, _ in blocks)
        wanted = sum(w for _, _, _, w in blocks)
        weights = np.zeros(N_FEATURES * 2 + 6)
        adam = Adam(len(weights), 0.1)
        for _ in range(steps):
            crf = cls(*cls._split(weights))
            expected = sum(crf._expected(x, on, pair) for x, on, pair, _ in blocks)
            weights = adam.step(weights, (expected - wanted) / total + ridge * weights)
        return cls(*cls._split(weights))

    @staticmethod
    def _by_length(chains: list[np.ndarray]) -> Iterator[list[int]]:
        """Chains of like length together: at most twice as long as the shortest, and ``BLOCK_LINES`` when padded."""
        own: list[int] = []
        for k in sorted(range(len(chains)), key=lambda k: len(chains[k])):
            size = len(chains[k])
            if own and (size > 2 * len(chains[own[0]]) or size * (len(own) + 1) > BLOCK_LINES):
                yield own
                own = []
            own.append(k)
        yield own

    @staticmethod
    def _block(chains: list[np.ndarray], labels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Padded features, places in use, neighbours in use, and the counts that the labels give."""
        n, longest = len(chains), max(map(len, chains))
        x = np.zeros((n, longest, N_FEATURES))
        y = np.zeros((n, longest), dtype=np.int64)
        on = np.zeros((n, longest), dtype=bool)
        for k, (c, t) in enumerate(zip(chains, labels, strict=True)):
            x[k, : len(c)], y[k, : len(c)], on[k, : len(c)] = c, t, True
        truth = np.eye(2)[y] * on[..., None]
        pair = on[:, 1:] & on[:, :-1]
        moves = np.zeros((2, 2))
        np.add.at(moves, (y[:, :-1][pair], y[:, 1:][pair]), 1)
        return x, on, pair, np.concatenate([np.einsum("nlf,nls->fs", x, truth).ravel(), moves.ravel(), truth[:, 0].sum(axis=0)])

    @staticmethod
    def _split(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        e = N_FEATURES * 2
        return w[:e].reshape(N_FEATURES, 2), w[e : e + 4].reshape(2, 2), w[e + 4 :]

    def _expected(self, x: np.ndarray, on: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """Expected feature, move and start counts by the forward-backward recursions."""
        n, longest, _ = x.shape
        score = x @ self.emit
        ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = score[:, 0] + self.first
        for t in range(1, longest):
            grown = np.logaddexp(ahead[:, t - 1, 0, None] + self.move[0], ahead[:, t - 1, 1, None] + self.move[1]) + score[:, t]
            ahead[:, t] = np.where(on[:, t, None], grown, ahead[:, t - 1])
        norm = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        for t in range(longest - 2, -1, -1):
            later = score[:, t + 1] + behind[:, t + 1]
            grown = np.logaddexp(self.move[:, 0] + later[:, 0, None], self.move[:, 1] + later[:, 1, None])
            behind[:, t] = np.where(on[:, t + 1, None], grown, 0)
        own = np.exp(ahead + behind - norm[:, None, None]) * on[..., None]
        joint = ahead[:, :-1, :, None] + self.move + (score + behind)[:, 1:, None, :] - norm[:, None, None, None]
        moves = (np.exp(np.minimum(joint, 0)) * pair[..., None, None]).sum(axis=(0, 1))
        return np.concatenate([np.einsum("nlf,nls->fs", x, own).ravel(), moves.ravel(), own[:, 0].sum(axis=0)])


def lines_of(text: str) -> list[bytes]:
    return [line for line in text.encode().split(b"\n") if line.strip(SPACES)]


def train(docs: DataFrame, labels: DataFrame, documents: int = TRAIN_DOCUMENTS) -> LineCrf:
    """Fit on all lines of each of ``documents`` labelled documents; without labels all weights are 0."""
    rows = with_texts(docs, sample(labelled(labels, "quality"), documents))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(d, n, line_features(lines_of(t)).astype("<f4").tobytes())
                   for d, n, t in zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(), texts(batch, "text"), strict=True)]
            if out:
                ids, ns, data = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int32()), pa.array(data, pa.binary())], names=["doc_id", "label", "x"])

    found = rows.select(F.col("doc_id").cast("long"), "label", "text").mapInArrow(features, "doc_id long, label int, x binary").collect()
    chains, marks = [], []
    for r in sorted(found, key=lambda r: (r.doc_id, r.x)):
        x = np.frombuffer(r.x, "<f4").reshape(-1, N_FEATURES).astype(float)
        if len(x):
            chains.append(x)
            marks.append((signs(x) & (r.label == 0)).astype(np.int64))
    return LineCrf.fit(chains, marks)


FILTERED = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
    ("content_share", pa.float64()), ("boilerplate_lines", pa.list_(pa.int64())),
])


def judge(docs: DataFrame, labels: DataFrame, min_content: float = MIN_CONTENT, documents: int = TRAIN_DOCUMENTS) -> DataFrame:
    """A row for each row of ``docs(doc_id, text)``: base counts, content share, boilerplate lines and the verdict.

    ``boilerplate_lines`` numbers the lines that have a word from 0.  Null text is the empty text: no words, base failed,
    not kept.  Rows with a null or repeated ``doc_id`` are judged one by one; other columns are ignored;
    with no labels at all every line counts as content.
    """
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, documents))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = sent.value
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch, "text"), strict=True):
                n_words, chars, symbols, repeats, again = base_counts(text)
                failed = n_words < 50 or 100 * again > 50 * n_words
                lines = lines_of(text)
                marks = crf.decode(line_features(lines))
                sizes = np.array([len(x.split()) for x in lines])
                share = float(sizes[marks == CONTENT].sum() / n_words) if n_words else 0.0
                kept = not failed and share >= min_content
                rows.append((doc_id, n_words, chars, symbols, repeats, again, failed, kept, share, np.flatnonzero(marks).tolist()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), FILTERED, strict=True)], schema=FILTERED)

    ddl = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, content_share double, boilerplate_lines array<long>"
    )
    return only(docs, doc_id="doc_id", text="text").mapInArrow(run, ddl)
