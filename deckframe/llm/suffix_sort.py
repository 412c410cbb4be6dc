"""Deep-shallow suffix sorting of many groups at once.

The shallow part is a multikey sort: all groups are ordered by a few symbols of
``SYMBOL`` bytes, and only strings that still share their group go on to the
next symbol.  Groups that agree beyond ``SHALLOW`` symbols are the deep part:
each is ordered by a blind trie, which looks at one byte for each branching
point on the way down and compares a string with one leaf only.
"""

from __future__ import annotations

import numpy as np

SYMBOL = 7
SHALLOW = 3
_BITS = 9  # a byte plus one; nought stands for the end of the string


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the longest common prefix, at least ``known``."""
    low, high, step = known, min(len(a), len(b)), 16
    while low < high and a[low:low + step] == b[low:low + step]:
        low, step = min(low + step, high), 2 * step
    high = min(high, low + step)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class _Node:
    __slots__ = ("depth", "below", "leaf")

    def __init__(self, depth: int, leaf: int):
        self.depth, self.below, self.leaf = depth, {}, leaf


class BlindTrie:
    """Strings by branching depths; ``leaf`` of a node names any string below it."""

    def __init__(self, texts: list[bytes], known: int):
        self.texts, self.known = texts, known
        self.same: dict[int, list[int]] = {}
        self.root = None

    def _byte(self, i: int, depth: int) -> int:
        t = self.texts[i]
        return t[depth] if depth < len(t) else -1

    def add(self, i: int) -> None:
        if self.root is None:
            self.root = self._leaf(i)
            return
        node, path = self.root, []
        while node.below:
            path.append(node)
            down = node.below.get(self._byte(i, node.depth))
            if down is None:
                break
            node = down
        rep = node.leaf
        shared = common_prefix(self.texts[i], self.texts[rep], self.known)
        if not node.below and shared == len(self.texts[i]) == len(self.texts[rep]):
            self.same[rep].append(i)
            return
        above, spot = None, self.root
        for step in [*path, node]:
            if step.depth < 0 or step.depth >= shared:
                spot = step
                break
            above, spot = step, None
        if spot is None or (spot.below and spot.depth == shared):
            (spot or above).below[self._byte(i, shared)] = self._leaf(i)
            return
        fork = _Node(shared, spot.leaf)
        fork.below = {self._byte(spot.leaf, shared): spot, self._byte(i, shared): self._leaf(i)}
        if above is None:
            self.root = fork
        else:
            above.below[self._byte(i, above.depth)] = fork

    def _leaf(self, i: int) -> _Node:
        self.same[i] = [i]
        return _Node(-1, i)

    def ordered(self) -> list[tuple[int, int]]:
        """(string, bytes in common with the one before) in order."""
        out: list[tuple[int, int]] = []
        stack = [(self.root, self.known)]
        while stack:
            node, shared = stack.pop()
            if not node.below:
                for k, i in enumerate(self.same[node.leaf]):
                    out.append((i, shared if not k else len(self.texts[i])))
                continue
            kids = sorted(node.below.items())
            for k in range(len(kids) - 1, -1, -1):
                stack.append((kids[k][1], node.depth if k else shared))
        return out


def _symbols(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at), np.int64)
    for k in range(SYMBOL):
        out = (out << _BITS) | codes[at + k]
    return out


def deep_shallow(texts: list[bytes], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``texts`` by group and bytes, and for each place how many bytes
    a text shares with the one before it (-1 where a group begins; texts that
    are equal share their length or more)."""
    n = len(texts)
    pad = b"\0" * (SYMBOL * (SHALLOW + 1))
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.zeros(n, np.int64)
    np.cumsum(sizes[:-1] + len(pad), out=starts[1:])
    raw = np.frombuffer(b"".join(t + pad for t in texts), np.uint8)
    codes = raw.astype(np.int16) + 1
    for k in range(len(pad)):
        codes[starts + sizes + k] = 0
    codes = codes.astype(np.int64)
    order = np.argsort(groups, kind="stable")
    label = groups[order].astype(np.int64)
    fresh = np.ones(n, bool)
    fresh[1:] = label[1:] != label[:-1]
    shared = np.where(fresh, -1, 0)
    for level in range(SHALLOW):
        run = np.cumsum(fresh)
        tied = np.bincount(run)[run] > 1
        if not tied.any():
            return order, shared
        spots = np.flatnonzero(tied)
        sym = _symbols(codes, starts[order[spots]] + level * SYMBOL)
        within = np.lexsort((sym, run[spots]))
        order[spots] = order[spots][within]
        sym = sym[within]
        apart = np.zeros(len(spots), bool)
        apart[1:] = (run[spots][1:] == run[spots][:-1]) & (sym[1:] != sym[:-1])
        differs = sym[1:] ^ sym[:-1]
        alike = np.zeros(len(spots), np.int64)
        for k in range(SYMBOL):
            alike[1:] += (differs >> (_BITS * (SYMBOL - 1 - k))) == 0
        cut = spots[apart]
        shared[cut] = level * SYMBOL + alike[apart]
        fresh[cut] = True
    bounds = np.append(np.flatnonzero(fresh), n)
    known = SHALLOW * SYMBOL
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            own = order[a:b].tolist()
            trie = BlindTrie(texts, min(known, min(len(texts[i]) for i in own)))
            for i in own:
                trie.add(i)
            placed = trie.ordered()
            order[a:b] = [i for i, _ in placed]
            shared[a + 1:b] = [s for _, s in placed[1:]]
    return order, shared
