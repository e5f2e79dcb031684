"""Balanced trees over whole-number points, and a walk over pairs of nodes that assigns points to their nearest entries.

A tree halves its points at the median of the widest side of their box, level by level; its nodes are numbered 1 for the
root and 2k, 2k + 1 for the children of k. A node covers a range of the tree's order of points, so it needs no list of
its own: the ranges follow from the number of points alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np

FAR = np.iinfo(np.int64).max


@cache
def ranges(n: int, depth: int) -> np.ndarray:
    """First and last place (exclusive) of each node's range; node 0 is unused."""
    cut = np.zeros((2 << depth, 2), np.int64)
    cut[1] = (0, n)
    for node in range(1, 1 << depth):
        low, high = cut[node]
        middle = (low + high + 1) // 2
        cut[2 * node], cut[2 * node + 1] = (low, middle), (middle, high)
    return cut


def depth_for(n: int, leaf: int) -> int:
    depth = 0
    while n > leaf << depth:
        depth += 1
    return depth


@dataclass(frozen=True)
class Tree:
    """``order`` of the points, boxes ``low`` and ``high`` of the nodes, and ``sums`` of the points before each leaf."""

    order: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray

    @property
    def depth(self) -> int:
        return len(self.low).bit_length() - 2

    def sum_of(self, nodes: np.ndarray) -> np.ndarray:
        """Sums over the points of nodes."""
        level = np.frexp(nodes)[1] - 1
        shift = self.depth - level
        first = (nodes << shift) - (1 << self.depth)
        return self.sums[first + (1 << shift)] - self.sums[first]


def build(points: np.ndarray, leaf: int) -> Tree:
    """A tree over the rows of ``points`` with at most ``leaf`` points in a leaf. Empty nodes have an inside-out box."""
    n, width = points.shape
    depth = depth_for(n, leaf)
    cut, order = ranges(n, depth), np.arange(n)
    low, high = np.full((2 << depth, width), FAR), np.full((2 << depth, width), -FAR)
    for node in range(1, 2 << depth):
        first, last = cut[node]
        if first == last:
            continue
        inside = points[order[first:last]]
        low[node], high[node] = inside.min(axis=0), inside.max(axis=0)
        if node < 1 << depth:
            side = inside[:, np.argmax(high[node] - low[node])]
            middle = cut[2 * node][1] - first
            if 0 < middle < last - first:
                order[first:last] = order[first:last][np.argpartition(side, middle)]
    before = np.zeros((n + 1, width), np.int64)
    np.cumsum(points[order], axis=0, out=before[1:])
    return Tree(order, low, high, before[np.append(cut[1 << depth :, 0], n)])


def _bounds(a: Tree, i: np.ndarray, b: Tree, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance that a point of node ``i`` can have from one of node ``j``."""
    below, above = b.low[j] - a.high[i], a.low[i] - b.high[j]
    gap = np.maximum(np.maximum(below, above), 0)
    reach = np.maximum(b.high[j] - a.low[i], a.high[i] - b.low[j])
    return (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)


def _spread(tree: Tree) -> np.ndarray:
    side = np.where(tree.low <= tree.high, tree.high - tree.low, 0)
    return (side * side).sum(axis=1)


@dataclass(frozen=True)
class Assignment:
    """``nodes`` whose points all go to the entries ``whole``; places (in the tree's order) of the others and theirs."""

    nodes: np.ndarray
    whole: np.ndarray
    places: np.ndarray
    single: np.ndarray


def assign(points: np.ndarray, tree: Tree, entries: np.ndarray, entry_tree: Tree) -> Assignment:
    """The nearest entry of every point; equal distances go to the entry with the lower index.

    ``points`` are in the tree's order, ``entry_tree`` has leaves of one entry. A pair of nodes is dropped when its least
    distance is above the greatest of another pair of the same points: none of its entries can then be nearest, nor
    equally near. A node with one entry left is assigned as a whole. The wider node of a pair is opened first. Leaves
    with several entries left are decided by the distances of their points.
    """
    n_leaf, e_leaf = 1 << tree.depth, 1 << entry_tree.depth
    cut = ranges(len(points), tree.depth)
    wide, e_wide = _spread(tree), _spread(entry_tree)
    i, j = np.array([1]), np.array([1])
    nodes, whole, open_nodes, open_entries = [], [], [], []
    while len(i):
        least, most = _bounds(tree, i, entry_tree, j)
        first = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
        group = np.cumsum(np.append(False, i[1:] != i[:-1]))
        keep = least <= np.minimum.reduceat(most, first)[group]
        i, j = i[keep], j[keep]
        start = np.append(True, i[1:] != i[:-1])
        first, group = np.flatnonzero(start), np.cumsum(start) - 1
        size, inner = np.diff(np.append(first, len(i))), j < e_leaf
        done = ((size == 1) & ~inner[first])[group]
        nodes.append(i[done])
        whole.append(j[done])
        widest = np.maximum.reduceat(np.where(inner, e_wide[j], -1), first)[group]
        at_leaf = i >= n_leaf
        stuck = ~done & at_leaf & (widest < 0)
        open_nodes.append(i[stuck])
        open_entries.append(j[stuck])
        halve = ~done & ~at_leaf & (wide[i] >= widest)
        split = ~done & ~stuck & ~halve
        parts = [
            (2 * i[halve], j[halve]), (2 * i[halve] + 1, j[halve]), (i[split & ~inner], j[split & ~inner]),
            (i[split & inner], 2 * j[split & inner]), (i[split & inner], 2 * j[split & inner] + 1),
        ]
        i, j = (np.concatenate(x) for x in zip(*parts))
        filled = (tree.low[i, 0] <= tree.high[i, 0]) & (entry_tree.low[j, 0] <= entry_tree.high[j, 0])
        i, j = i[filled], j[filled]
        by_node = np.argsort(i, kind="stable")
        i, j = i[by_node], j[by_node]
    slots = ranges(len(entries), entry_tree.depth)[:, 0]
    entry_of = lambda leaves: entry_tree.order[slots[leaves]]
    whole_nodes, left, left_entries = np.concatenate(nodes), np.concatenate(open_nodes), entry_of(np.concatenate(open_entries))
    places, single = _by_distance(points, cut, left, left_entries, entries)
    return Assignment(whole_nodes, entry_of(np.concatenate(whole)), places, single)


def _by_distance(
    points: np.ndarray, cut: np.ndarray, leaves: np.ndarray, candidates: np.ndarray, entries: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places in the leaves, and the nearest of each leaf's candidates."""
    distinct, row = np.unique(leaves, return_inverse=True)
    allowed = np.zeros((len(distinct), len(entries)), bool)
    allowed[row, candidates] = True
    length = cut[distinct, 1] - cut[distinct, 0]
    leaf = np.repeat(np.arange(len(distinct)), length)
    places = np.arange(len(leaf)) - np.repeat(np.cumsum(length) - length, length) + np.repeat(cut[distinct, 0], length)
    distance = squared_distances(points[places], entries)
    distance[~allowed[leaf]] = FAR
    return places, distance.argmin(axis=1)


def squared_distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Whole squared distances, a row for each point."""
    found = np.zeros((len(points), len(entries)), np.int64)
    for k in range(points.shape[1]):
        apart = points[:, k, None] - entries[None, :, k]
        found += apart * apart
    return found
