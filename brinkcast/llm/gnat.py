"""Nearest entry of a list of integer vectors, by a geometric near-neighbour access tree.

A node keeps some of its entries as split points, chosen far apart; every other
entry belongs to the nearest of them.  For each split point ``i`` and child ``j`` the
node stores the smallest and largest distance between ``i`` and the entries of
``j``.  A query measures its distance ``d`` to the split points; with ``r`` the
distance to the best entry so far, child ``j`` holds nothing better nor equal if for
any ``i`` its range ends before ``d - r`` or begins after ``d + r``.

Squared distances are whole numbers and decide alone: ties go to the lower entry.
Roots are only used to discard, with every rounding taken to the safe side.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

#: Most split points of a node, most entries of a leaf.
DEGREE, LEAF = 16, 16
#: Whole numbers are exact in a double up to here.
EXACT = 2**53


@dataclass
class Node:
    splits: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    children: tuple["Node | None", ...] = ()


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x, np.inf)


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x, -np.inf)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-numbered rows (doubles below the limit that ``check_size`` sets)."""
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)


def check_size(vectors: np.ndarray) -> None:
    """Refuse components so large that squared distances are no longer exact."""
    if vectors.size and 4 * vectors.shape[1] * int(max(abs(int(vectors.max())), abs(int(vectors.min())))) ** 2 >= EXACT:
        raise ValueError("components are too large for exact squared distances")


class Gnat:
    """Tree over ``entries`` (rows of whole numbers)."""

    def __init__(self, entries: np.ndarray, degree: int = DEGREE, leaf: int = LEAF):
        check_size(entries)
        self.entries = entries.astype(np.float64)
        self.degree, self.leaf = degree, leaf
        self.measured = 0  # distances computed by searches
        self.root = self._node(np.arange(len(entries)))

    def _node(self, members: np.ndarray) -> Node:
        points = self.entries[members]
        if len(members) <= self.leaf:
            return Node(members)
        chosen, gap = [0], squared_distances(points, points[:1])[:, 0]
        while len(chosen) < min(self.degree, math.isqrt(len(members)) + 1) and gap.max() > 0:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, squared_distances(points, points[chosen[-1:]])[:, 0])
        if len(chosen) == 1:  # all entries are equal
            return Node(members)
        chosen = np.sort(chosen)
        rest = np.setdiff1d(np.arange(len(members)), chosen)
        far = squared_distances(points[chosen], points[rest])
        owner = far.argmin(axis=0)
        root = np.sqrt(far)
        low, high = (np.full((len(chosen), len(chosen)), v) for v in (np.inf, -np.inf))
        children: list[Node | None] = []
        for j in range(len(chosen)):
            mine = owner == j
            children.append(self._node(members[rest[mine]]) if mine.any() else None)
            if mine.any():
                low[:, j], high[:, j] = _down(root[:, mine].min(axis=1)), _up(root[:, mine].max(axis=1))
        return Node(members[chosen], low, high, tuple(children))

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry number and squared distance for each row of ``queries``."""
        check_size(queries)
        q = queries.astype(np.float64)
        entry = np.full(len(q), len(self.entries), np.int64)
        best = np.full(len(q), np.inf)
        if len(q):
            self._visit(self.root, q, np.arange(len(q)), entry, best)
        return entry, best.astype(np.int64)

    def _visit(self, node: Node, q: np.ndarray, rows: np.ndarray, entry: np.ndarray, best: np.ndarray) -> None:
        d2 = squared_distances(q[rows], self.entries[node.splits])
        self.measured += d2.size
        near = d2.argmin(axis=1)  # split points are in ascending order: the lower entry on ties
        found, index = d2[np.arange(len(rows)), near], node.splits[near]
        better = (found < best[rows]) | ((found == best[rows]) & (index < entry[rows]))
        best[rows[better]], entry[rows[better]] = found[better], index[better]
        if not node.children:
            return
        for j, child in enumerate(node.children):  # the nearest child first: it shrinks the radius
            if child is not None and (near == j).any():
                self._visit(child, q, rows[near == j], entry, best)
        root = np.sqrt(d2)
        most, least = _up(root), _down(root)
        for j, child in enumerate(node.children):
            if child is None:
                continue
            r = _up(np.sqrt(best[rows]))[:, None]
            beyond = (node.low[:, j] > _up(most + r)) | (node.high[:, j] < _down(least - r))
            left = ~beyond.any(axis=1) & (near != j)
            if left.any():
                self._visit(child, q, rows[left], entry, best)
