"""Signature trees: nodes hold OR-combined token bitmaps and size ranges; two trees are traversed together.

For sets x and y, every shared token sets a shared bit, and tokens of one set that share a bit number at most |x| - bits(x):
|x & y| <= bits(X & Y) + min(|x| - bits(x), |y| - bits(y)). With OR-combined bitmaps and the largest surplus below a node the
same bound holds for all pairs below two nodes; a pair of nodes whose bound misses the least overlap required goes unopened.
Bitmaps are as wide as their sets need; two are compared at the smaller width, to which the wider one folds.
"""

from __future__ import annotations

import numpy as np

from .shingle_sets import folded

LEAF, FAN = 16, 4


class SignatureTree:
    """Rows (label, size, bitmap) under a hierarchy of nodes; rows are in order of size, so widths never fall."""

    def __init__(self, labels: np.ndarray, sizes: np.ndarray, bitmaps: list[np.ndarray]) -> None:
        self.labels, self.sizes, self.bitmaps = labels, sizes, bitmaps
        level = [(s, min(s + LEAF, len(sizes)), ()) for s in range(0, len(sizes), LEAF)]
        while len(level) > 1:
            level = [(level[k][0], level[min(k + FAN, len(level)) - 1][1], tuple(level[k : k + FAN])) for k in range(0, len(level), FAN)]
        self.root = level[0]
        self._rows: dict[tuple[int, int, int], tuple] = {}
        self._nodes: dict[tuple[int, int, int], tuple] = {}
        self._one: dict[tuple[int, int], object] = {}

    def width(self, node: tuple) -> int:
        return len(self.bitmaps[node[0]])

    def label(self, node: tuple):
        """The label of all rows below, or None."""
        key = node[:2]
        if key not in self._one:
            own = self.labels[key[0] : key[1]]
            self._one[key] = own[0] if (own == own[0]).all() else None
        return self._one[key]

    def rows(self, node: tuple, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Bitmaps of a leaf's rows at a width, and their surplus."""
        key = (node[0], node[1], words)
        if key not in self._rows:
            bits = np.stack([folded(b, words) for b in self.bitmaps[node[0] : node[1]]])
            self._rows[key] = bits, self.sizes[node[0] : node[1]] - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        return self._rows[key]

    def combined(self, node: tuple, words: int) -> tuple[np.ndarray, int]:
        """OR of all bitmaps below a node at a width, and the largest surplus."""
        key = (node[0], node[1], words)
        if key not in self._nodes:
            if node[2]:
                parts = [self.combined(x, words) for x in node[2]]
                self._nodes[key] = np.bitwise_or.reduce([p for p, _ in parts]), max(s for _, s in parts)
            else:
                bits, surplus = self.rows(node, words)
                self._nodes[key] = np.bitwise_or.reduce(bits), int(surplus.max())
        return self._nodes[key]


def _possible(a: SignatureTree, x: tuple, b: SignatureTree, y: tuple, percent: int) -> bool:
    one, other = a.label(x), b.label(y)
    low_a, high_a, low_b, high_b = (int(v) for v in (a.sizes[x[0]], a.sizes[x[1] - 1], b.sizes[y[0]], b.sizes[y[1] - 1]))
    if one is not None and one == other or high_a * 100 < low_b * percent or high_b * 100 < low_a * percent:
        return False
    words = min(a.width(x), b.width(y))
    (bits_a, more_a), (bits_b, more_b) = a.combined(x, words), b.combined(y, words)
    most = min(int(np.bitwise_count(bits_a & bits_b).sum()) + min(more_a, more_b), high_a, high_b)
    return most * (100 + percent) >= (low_a + low_b) * percent


def possible_pairs(a: SignatureTree, b: SignatureTree, percent: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with different labels that the bound leaves open. a may be b: then each pair comes once."""
    out, stack = [], [(a.root, b.root)]
    while stack:
        x, y = stack.pop()
        if a is b and x[0] > y[0] or not _possible(a, x, b, y, percent):
            continue
        if x[2] or y[2]:
            stack += [(p, q) for p in x[2] or (x,) for q in y[2] or (y,)]
            continue
        words = min(a.width(x), b.width(y))
        (bits_a, more_a), (bits_b, more_b) = a.rows(x, words), b.rows(y, words)
        most = np.bitwise_count(bits_a[:, None, :] & bits_b[None, :, :]).sum(axis=2).astype(np.int64) + np.minimum(more_a[:, None], more_b[None, :])
        n, m = a.sizes[x[0] : x[1]][:, None], b.sizes[y[0] : y[1]][None, :]
        ok = (a.labels[x[0] : x[1]][:, None] != b.labels[y[0] : y[1]][None, :]) & (most * (100 + percent) >= (n + m) * percent) & (n * 100 >= m * percent) & (m * 100 >= n * percent)
        p, q = np.nonzero(ok)
        p, q = p + x[0], q + y[0]
        if a is b:
            p, q = p[p < q], q[p < q]
        if len(p):
            out.append((p, q))
    return out
