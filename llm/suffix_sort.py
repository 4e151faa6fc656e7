"""Deep-shallow sorting of byte strings with the common prefixes of neighbours.

Multikey quicksort orders the strings to a shallow depth, eight bytes at a time; strings that
still agree there go into a blind trie, which keeps only the places where its strings branch.
"""

from __future__ import annotations

STEP = 8
SHALLOW = 64


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    differ = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return n - (differ.bit_length() + 7) // 8


class _Branch:
    """A place where strings of the trie differ: children by the byte there, -1 for a string's end."""

    __slots__ = ("at", "children")

    def __init__(self, at: int) -> None:
        self.at, self.children = at, {}


def _byte(s: bytes, at: int) -> int:
    return s[at] if at < len(s) else -1


def blind_trie(strings: list[bytes], which: list[int]) -> tuple[list[int], list[int]]:
    """Order of ``which`` and the common prefix of each with the one before it (0 for the first).

    A string goes down by its bytes at the branching places only, is compared once with the string
    it arrives at, and is hung in where they part.  Equal strings share a leaf.
    """
    root: _Branch | list[int] = [which[0]]
    for k in which[1:]:
        s = strings[k]
        node = root
        while isinstance(node, _Branch):
            node = node.children.get(_byte(s, node.at)) or next(iter(node.children.values()))
        met = strings[node[0]]
        shared = common(s, met)
        if shared == len(s) == len(met):
            node.append(k)
            continue
        above, node = None, root
        while isinstance(node, _Branch) and node.at < shared:
            above, node = node, node.children[_byte(s, node.at)]
        if isinstance(node, _Branch) and node.at == shared:
            node.children[_byte(s, shared)] = [k]
            continue
        branch = _Branch(shared)
        branch.children = {_byte(met, shared): node, _byte(s, shared): [k]}
        if above is None:
            root = branch
        else:
            above.children[_byte(s, above.at)] = branch
    order, prefix = [], []
    stack: list[tuple[_Branch | list[int], int]] = [(root, 0)]
    while stack:
        node, before = stack.pop()
        if isinstance(node, _Branch):
            keys = sorted(node.children, reverse=True)
            stack += [(node.children[c], before if c == keys[-1] else node.at) for c in keys]
        else:
            order += node
            prefix += [before] + [len(strings[node[0]])] * (len(node) - 1)
    return order, prefix


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Sorted order of ``strings`` and each one's common prefix with the one before it (0 for the first)."""
    order: list[int] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) == 1:
            order += group
        elif depth >= shallow:
            order += blind_trie(strings, group)[0]
        else:
            keys = {k: strings[k][depth : depth + STEP] for k in group}
            pivot = keys[group[len(group) // 2]]
            low = [k for k in group if keys[k] < pivot]
            same = [k for k in group if keys[k] == pivot]
            high = [k for k in group if keys[k] > pivot]
            if len(pivot) < STEP:  # these strings end here and are equal
                stack += [(g, depth) for g in (high,) if g] + [([k], depth) for k in reversed(same)] + [(g, depth) for g in (low,) if g]
            else:
                stack += [(high, depth)] * bool(high) + [(same, depth + STEP)] + [(low, depth)] * bool(low)
    prefix = [0] + [common(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)]
    return order, prefix
