"""A K²-tree over a block of a count matrix, and the joint traversal of two of them that prices row pairs.

A K²-tree cuts a square into K x K quadrants, marks with one bit which of them hold anything, and cuts the marked
ones again, down to leaves. A quadrant without a bit is all zero and isn't stored.
"""

from __future__ import annotations

import numpy as np

K = 2
LEAF = 8
# Leaf pairs that are priced at once: LEAF ** 3 differences each.
LEAF_PAIRS = 4096


class K2Tree:
    """Cells at (row, column) with a value; any other cell of a row has the row's value in ``zero``."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, zero: np.ndarray, height: int):
        self.zero, self.height = zero, height
        across, down = columns // LEAF, rows // LEAF
        codes = np.zeros(len(rows), np.int64)
        for level in range(height):  # the quadrant digits from the top to the leaf
            step = K ** (height - 1 - level)
            codes = codes * K * K + (down // step % K) * K + across // step % K
        nodes, place = np.unique(codes, return_inverse=True)
        # All-zero leaves of the row blocks follow the stored ones, so that a pair can name them by number.
        blocks = -(-len(zero) // LEAF)
        by_row = np.zeros(blocks * LEAF, np.int64)
        by_row[: len(zero)] = zero
        empty = np.repeat(by_row.reshape(blocks, LEAF, 1), LEAF, axis=2)
        first = np.zeros(len(nodes), np.int64)
        first[place] = down
        self.leaves = np.concatenate([empty[first], empty])
        self.n_leaves = len(nodes)
        self.leaves[place, rows % LEAF, columns % LEAF] = values
        self.bits: list[np.ndarray] = []
        self.ranks: list[np.ndarray] = []
        for _ in range(height):
            parents = np.unique(nodes // (K * K))
            bits = np.zeros(len(parents) * K * K, bool)
            bits[np.searchsorted(parents, nodes // (K * K)) * K * K + nodes % (K * K)] = True
            self.bits.insert(0, bits)
            self.ranks.insert(0, np.cumsum(bits) - 1)
            nodes = parents
        self.is_empty = len(rows) == 0

    def child(self, level: int, node: np.ndarray, down: np.ndarray, across: np.ndarray) -> np.ndarray:
        """The numbers of the nodes' quadrants among the next level's nodes; -1 for an all-zero one."""
        found = np.full(np.broadcast_shapes(node.shape, down.shape, across.shape), -1)
        if self.is_empty:
            return found
        at = node * K * K + down * K + across
        real = (node >= 0) & self.bits[level][np.maximum(at, 0)]
        return np.where(real, self.ranks[level][np.maximum(at, 0)], -1)


def height_of(n_rows: int, n_columns: int) -> int:
    height = 0
    while LEAF * K**height < max(n_rows, n_columns):
        height += 1
    return height


def pair_distances(one: K2Tree, two: K2Tree, n_columns: int) -> np.ndarray:
    """For each row of ``one`` and of ``two``: the sum over all columns of the values' absolute differences.

    Both trees are walked together, a row block of each and a column block at a time. Where both quadrants are all
    zero, the walk ends: the difference of the two rows' zero values, times the columns, is added at the end. Else
    it goes on to the leaves.
    """
    height = one.height
    node = start = np.zeros(1, np.int64)
    a, b = (np.where(t.is_empty, -1, node) for t in (one, two))
    rows_a, rows_b, columns = start, start, start
    side = LEAF * K**height
    sums = np.zeros((len(one.leaves) - one.n_leaves, LEAF, len(two.leaves) - two.n_leaves, LEAF), np.int64)
    zeros = np.zeros((sums.shape[0], sums.shape[2]), np.int64)  # all-zero columns of each pair of row blocks
    i, j, k = (d.reshape(1, -1) for d in np.indices((K, K, K)))

    def leave(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, at: np.ndarray, width: int) -> None:
        """Ends the walk in quadrants of ``width`` rows and columns: counts their columns for the leaf rows."""
        n = np.clip(n_columns - at * width, 0, width)
        span = width // LEAF
        for da in range(span):
            for db in range(span):
                ra, rb = at_a * span + da, at_b * span + db
                inside = (ra < zeros.shape[0]) & (rb < zeros.shape[1])
                np.add.at(zeros, (ra[inside], rb[inside]), n[inside])

    for level in range(height):
        side //= K
        grown = [np.repeat(x[:, None], K**3, 1) for x in (a, b, rows_a, rows_b, columns)]
        a = one.child(level, grown[0], i, k).ravel()
        b = two.child(level, grown[1], j, k).ravel()
        rows_a, rows_b, columns = ((x * K + d).ravel() for x, d in zip(grown[2:], (i, j, k)))
        real = (rows_a * side < len(one.zero)) & (rows_b * side < len(two.zero)) & (columns * side < n_columns)
        zero = real & (a < 0) & (b < 0)
        leave(a[zero], b[zero], rows_a[zero], rows_b[zero], columns[zero], side)
        on = real & ~zero
        a, b, rows_a, rows_b, columns = (x[on] for x in (a, b, rows_a, rows_b, columns))
    for begin in range(0, len(a), LEAF_PAIRS):
        part = slice(begin, begin + LEAF_PAIRS)
        at_a, at_b = rows_a[part], rows_b[part]
        left = one.leaves[np.where(a[part] < 0, one.n_leaves + at_a, a[part])]
        right = two.leaves[np.where(b[part] < 0, two.n_leaves + at_b, b[part])]
        np.add.at(sums, (at_a, slice(None), at_b), np.abs(left[:, :, None, :] - right[:, None, :, :]).sum(-1))
        # Columns beyond the last one were priced as zero cells of both rows.
        np.add.at(zeros, (at_a, at_b), np.minimum(n_columns - columns[part] * LEAF - LEAF, 0))
    sums = sums.reshape(sums.shape[0] * LEAF, -1)[: len(one.zero), : len(two.zero)]
    apart = np.abs(one.zero[:, None] - two.zero[None, :])
    return sums + np.repeat(np.repeat(zeros, LEAF, 0), LEAF, 1)[: len(one.zero), : len(two.zero)] * apart
