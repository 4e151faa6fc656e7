"""Token ids of whole texts, with repeated words encoded once.

The byte-level pattern never lets a pre-token reach across a space that stands between two characters that aren't white
space: a new pre-token begins at that space.  Texts are therefore split at their spaces, each distinct word is
encoded once by the library, and its ids are reused.  A text with a space anywhere else is encoded as it stands.

Most new words are Latin letters and a few marks; letters are one pre-token and marks another.  Such
words skip the pattern: they go to the library already written in the byte-level alphabet.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

# Distinct words that one worker remembers; beyond it the memory starts afresh.
REMEMBERED = 800_000
DEFAULT_VOCABULARY = "byte_bpe_50k.json"
MARKS = ".,;:!?"
LATIN = "ɐ"
JOINED = 256
_ENCODERS: dict[str, "Encoder"] = {}


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return name if os.path.isabs(name) else public_tokenizers.path(name)


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others are moved above 255 in order."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(moved)}


class Words(dict):
    """Numbers of the words met so far; a new word gets the next number and waits to be encoded."""

    def __init__(self) -> None:
        self.waiting: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.waiting.append(word)
        return number


def gather(pool: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` that begin and are as long as stated, one after the other."""
    stop = np.cumsum(length)
    return pool[np.repeat(begin - (stop - length), length) + np.arange(int(stop[-1]) if len(stop) else 0)]


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of some lists, and the lists' lengths."""
    length = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype=np.uint32, count=int(length.sum())), length


class Encoder:
    """Ids by the tokenizers library, for a batch of texts at a time."""

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.alphabet = byte_alphabet()
        self.space = self.alphabet[0x20]
        self.words_only = Tokenizer.from_file(path)
        self.words_only.pre_tokenizer = pre_tokenizers.Split(self.space, "merged_with_next")
        self.begins = np.zeros(self.vocabulary_size, dtype=bool)
        for token, number in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.begins[number] = token.startswith(self.space)
        self.remembered = remembered
        self.forget()

    def forget(self) -> None:
        """Start afresh without any word."""
        self.words = Words()
        self.pool = np.empty(1 << 16, dtype=np.uint32)
        self.used = 0
        # By word: where its ids lie in the pool, and whether its spaces stand otherwise than assumed.
        self.begin, self.length = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64)
        self.odd = np.zeros(1 << 12, dtype=bool)
        self.marks: dict[str, int] = {}

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _letters(self, bases: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of Latin letters, each with a space before it, and their lengths."""
        joined = [" " + " ".join(bases[i : i + JOINED]) for i in range(0, len(bases), JOINED)]
        written = [t.encode().decode("latin-1").translate(self.alphabet) for t in joined]
        ids, _ = flat([e.ids for e in self.words_only.encode_batch_fast(written, add_special_tokens=False)])
        return ids, np.diff(np.append(np.flatnonzero(self.begins[ids]), len(ids)))

    def _keep(self, ids: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Append ids to the pool; where each stretch begins."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        begin = self.used + np.cumsum(length) - length
        self.used += len(ids)
        return begin

    def _set(self, numbers: list[int], ids: np.ndarray, length: np.ndarray) -> None:
        at = np.array(numbers, dtype=np.int64)
        self.begin[at], self.length[at] = self._keep(ids, length), length

    def _learn(self) -> None:
        """Encode the words that wait."""
        words, number = self.words, len(self.words) - len(self.words.waiting)
        bare, bare_at, plain, plain_at, marked_at, of, mark_of, odd = [], [], [], [], [], [], [], []
        marks = self.marks
        for w in words.waiting:  # grows where a marked word's bare word is new
            base = w.rstrip(MARKS)
            if base.isalpha() and (base.isascii() or max(base) < LATIN):
                if base == w:
                    bare.append(w)
                    bare_at.append(number)
                else:
                    marked_at.append(number)
                    of.append(words[base])
                    mark_of.append(marks.setdefault(w[len(base) :], len(marks)))
            else:  # a text's first word carries a space in its key, all others lack it
                if not w or w[-1].isspace() or (w[0].isspace() and (w[0] != " " or w[1:2].isspace())):
                    odd.append(number)
                plain.append(w[1:] if w[:1] == " " else " " + w)
                plain_at.append(number)
            number += 1
        words.waiting = []
        while number > len(self.begin):
            self.begin, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.length))
            self.odd = np.concatenate([self.odd, np.zeros_like(self.odd)])
        self.odd[odd] = True
        if bare:
            self._set(bare_at, *self._letters(bare))
        if plain:
            self._set(plain_at, *flat(self._plain(plain)))
        if marked_at:
            ids, length = flat(self._plain(list(marks)))
            begin = self._keep(ids, length)
            both = np.stack([self.begin[of], begin[mark_of]], axis=1), np.stack([self.length[of], length[mark_of]], axis=1)
            self._set(marked_at, gather(self.pool, both[0].ravel(), both[1].ravel()), both[1].sum(axis=1))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts."""
        if len(self.words) > self.remembered:
            self.forget()
        every: list[str] = []
        ends = []
        for text in texts:
            words = text.split(" ")
            words[0] = " " + words[0]
            every += words
            ends.append(len(every))
        which = np.fromiter(map(self.words.__getitem__, every), dtype=np.int64, count=len(every))
        if self.words.waiting:
            self._learn()
        length = self.length[which]
        ids = gather(self.pool, self.begin[which], length)
        edge = np.concatenate([[0], np.cumsum(length)])[np.array([0, *ends], dtype=np.int64)]
        out = [ids[a:b] for a, b in zip(edge.tolist(), edge[1:].tolist(), strict=False)]
        strange = self.odd[which]
        if strange.any():  # only texts in which some space isn't between two other characters
            first = np.array([0, *ends[:-1]], dtype=np.int64)
            strange = [k for k, n in enumerate(np.add.reduceat(strange, first)) if n]
            for k, own in zip(strange, self._plain([texts[k] for k in strange]), strict=True):
                out[k] = np.array(own, dtype=np.uint32)
        return out


def encoder(vocabulary: str = DEFAULT_VOCABULARY, remembered: int = REMEMBERED) -> Encoder:
    """This worker's encoder for a vocabulary file.

    A word takes about 250 bytes while it is remembered: 200 MB for the default, 50 MB and 7 % more time for 200,000 words.
    """
    path = vocabulary_path(vocabulary)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, remembered)
    if _ENCODERS[path].remembered != remembered:
        _ENCODERS[path].remembered = remembered
    return _ENCODERS[path]


def drop_encoders() -> None:
    """Give up this worker's encoders, with 60 MB each besides the words; loading one takes a third of a second."""
    _ENCODERS.clear()
