"""Deep-shallow sorting of byte strings of bounded depth.

Shallow: multikey quicksort on eight-byte symbols down to ``shallow`` bytes; a round parts
every open group at once into less, equal and greater at its pivot, and equal ones go on to
the next symbol. Deep: strings that still agree are ordered by blind tries, which
compare branching symbols only and look at one whole string an insertion.
"""

from __future__ import annotations

import numpy as np


class BlindTrie:
    """A Patricia trie on bytes: nodes keep the depth at which their strings first differ."""

    __slots__ = ("root", "strings")

    def __init__(self, strings: list[bytes]) -> None:
        self.strings = strings
        self.root: list | None = None

    # A node is [depth, {byte or -1 at the end: child}], a leaf a list of equal strings' indexes.
    def insert(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [-1, [i]]
            return
        path, node = [], self.root
        while node[0] >= 0:  # blind: follow branching bytes only
            path.append(node)
            child = node[1].get(s[node[0]] if node[0] < len(s) else -1)
            node = child if child is not None else next(iter(node[1].values()))
        leaf = self.strings[node[1][0]]
        d = _lcp(s, leaf)
        if d == len(s) == len(leaf):
            node[1].append(i)
            return
        # The true place: above the first node that branches deeper than the common prefix.
        parent, at = None, self.root
        while at[0] >= 0 and at[0] < d:
            parent, at = at, at[1][s[at[0]] if at[0] < len(s) else -1]
        new = [-1, [i]]
        key = s[d] if d < len(s) else -1
        if at[0] == d:
            at[1][key] = new
            return
        other = leaf[d] if d < len(leaf) else -1
        branch = [d, {key: new, other: at}]
        if parent is None:
            self.root = branch
        else:
            parent[1][s[parent[0]] if parent[0] < len(s) else -1] = branch

    def ordered(self) -> list[int]:
        out, todo = [], [self.root] if self.root else []
        while todo:
            node = todo.pop()
            if node[0] < 0:
                out.extend(node[1])
            else:
                todo.extend(node[1][k] for k in sorted(node[1], reverse=True))
        return out


def _lcp(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] agrees, a[:hi] doesn't
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid)
    return lo


def deep_shallow(matrix: np.ndarray, lengths: np.ndarray, group: np.ndarray, shallow: int = 40) -> np.ndarray:
    """The order of rows by (group, bytes, length). matrix: zero-padded rows of a multiple of
    eight bytes; rows of equal bytes and length keep their input order."""
    n, width = matrix.shape
    words = matrix.view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    starts = np.r_[True, group[order][1:] != group[order][:-1]] if n else np.empty(0, bool)
    depth, most = np.zeros(n, np.int64), min(shallow, width) // 8
    while n:
        first = np.flatnonzero(starts)
        size = np.diff(np.r_[first, n])
        open_ = (size > 1) & (depth[first] < most)
        if not open_.any():
            break
        ids = np.cumsum(starts) - 1
        at = np.flatnonzero(open_[ids])
        g = ids[at]
        middle = first + size // 2
        pivot = words[order[middle], np.minimum(depth[first], max(most - 1, 0))]
        symbol = words[order[at], depth[at]]
        side = (symbol > pivot[g]).astype(np.int8) - (symbol < pivot[g])
        inner = np.lexsort((side, g))
        order[at], side = order[at][inner], side[inner]
        depth[at] += side == 0
        starts[at] |= np.r_[True, (side[1:] != side[:-1]) | (g[1:] != g[:-1])]
    edges = np.r_[np.flatnonzero(starts), n]
    sizes = np.diff(edges)
    for a, size in zip(edges[:-1][sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        rows = order[a : a + size]
        if size == 2 and (matrix[rows[0]] == matrix[rows[1]]).all() and lengths[rows[0]] == lengths[rows[1]]:
            continue
        strings = [matrix[r, : lengths[r]].tobytes() for r in rows]
        trie = BlindTrie(strings)
        for i in range(size):
            trie.insert(i)
        order[a : a + size] = rows[trie.ordered()]
    return order


def neighbour_lcp(matrix: np.ndarray, lengths: np.ndarray, group: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The common prefix of each row in order with the one before it; 0 across groups."""
    n = len(order)
    out = np.zeros(n, np.int64)
    for a in range(1, n, 65536):
        b = min(n, a + 65536)
        left, right = order[a - 1 : b - 1], order[a:b]
        differ = matrix[left] != matrix[right]
        lcp = np.where(differ.any(1), differ.argmax(1), matrix.shape[1])
        lcp = np.minimum(lcp, np.minimum(lengths[left], lengths[right]))
        out[a:b] = np.where(group[left] == group[right], lcp, 0)
    return out
