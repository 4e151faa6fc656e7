"""Counts that describe the shape of a text: words, symbols, repeated lines and repeated windows."""

from __future__ import annotations

import numpy as np

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words inside windows that the text holds twice or more, the first of them included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
    key = ids[:n].copy()
    for k in range(1, window):
        if len(seen) > 1 << 20:  # keep the product within 64 bits
            _, key = np.unique(key, return_inverse=True)
        key = key * len(seen) + ids[k : n + k]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words), dtype=bool)
    for k in range(window):
        cover[k : n + k] |= twice
    return int(cover.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    raw = text.encode()
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, SPACES))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen, repeats = set(), 0
    for line in raw.split(b"\n"):
        if line.strip(SPACES):
            if line in seen:
                repeats += 1
            seen.add(line)
    return len(words), len(text) - spaces, symbols, repeats, repeated_words(words)
