"""A forest of random-projection trees over vectors of one length, as plain arrays.

The forest is fitted on a bounded sample and has a bounded size, so it can be broadcast. All trees have the same depth;
node k of a tree has children 2k + 1 and 2k + 2, and a vector goes right if its projection reaches the threshold.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    depth: int
    planes: np.ndarray  # trees x inner nodes x dimensions
    cuts: np.ndarray  # trees x inner nodes

    @property
    def leaves(self) -> int:
        return 1 << self.depth


def _two_centres(points: np.ndarray, random: np.random.Generator, rounds: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Two points drawn at random, moved to the means of the points nearer to each."""
    a, b = points[random.choice(len(points), 2, replace=False)]
    for _ in range(rounds):
        nearer = points @ (a - b) >= (a @ a - b @ b) / 2
        if nearer.all() or not nearer.any():
            break
        a, b = points[nearer].mean(axis=0), points[~nearer].mean(axis=0)
    return a, b


def fit(sample: np.ndarray, trees: int, depth: int, seed: int) -> Forest:
    """Every node is cut across the line between two centres of a random part of its points: half-way where each side
    keeps a sixth of them, else at the median. A node of equal or too few points is cut along a random line."""
    random = np.random.default_rng(seed)
    n, dims = sample.shape
    inner = (1 << depth) - 1
    planes = np.zeros((trees, inner, dims), dtype=np.float32)
    cuts = np.zeros((trees, inner), dtype=np.float32)
    for t in range(trees):
        at = np.zeros(n, dtype=np.int64)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            line, cut = random.standard_normal(dims), None
            if len(rows) >= 2:
                a, b = _two_centres(sample[random.choice(rows, min(len(rows), 64), replace=False)], random)
                if np.linalg.norm(a - b) > 1e-9:
                    line, cut = a - b, (a @ a - b @ b) / 2
            length = np.linalg.norm(line)
            planes[t, node] = line / length
            if len(rows):
                along = sample[rows] @ planes[t, node]
                cuts[t, node] = np.median(along) if cut is None else cut / length
                share = (along >= cuts[t, node]).mean()
                if not 1 / 6 <= share <= 5 / 6:
                    cuts[t, node] = np.median(along)
                at[rows] = 2 * node + 1 + (along >= cuts[t, node])
    return Forest(depth, planes, cuts)


def leaf_numbers(forest: Forest, vectors: np.ndarray) -> np.ndarray:
    """The leaf of each vector in each tree: vectors x trees, numbered from 0 across the forest."""
    n, trees = len(vectors), len(forest.planes)
    out = np.empty((n, trees), dtype=np.int64)
    for t in range(trees):
        at = np.zeros(n, dtype=np.int64)
        for _ in range(forest.depth):
            along = np.einsum("ij,ij->i", vectors, forest.planes[t, at])
            at = 2 * at + 1 + (along >= forest.cuts[t, at])
        out[:, t] = t * forest.leaves + at - (forest.leaves - 1)
    return out


def nearest_leaves(forest: Forest, queries: np.ndarray, visits: int) -> np.ndarray:
    """The ``visits`` leaves that one priority queue over all trees reaches first, for each query.

    The queue is ordered by the widest gap on the wrong side of a cut on the way down: 0 along each tree's own path.
    """
    trees, inner, dims = forest.planes.shape
    visits = min(visits, trees * forest.leaves)
    out = np.empty((len(queries), visits), dtype=np.int64)
    for begin in range(0, len(queries), 256):
        part = queries[begin : begin + 256]
        gaps = (part @ forest.planes.reshape(-1, dims).T).reshape(len(part), trees, inner) - forest.cuts
        for row in range(len(part)):
            gap = gaps[row].tolist()
            queue = [(0.0, t, 0) for t in range(trees)]
            found = 0
            while found < visits:
                wrong, t, node = heapq.heappop(queue)
                while node < inner:
                    g = gap[t][node]
                    right = g >= 0
                    heapq.heappush(queue, (max(wrong, abs(g)), t, 2 * node + 2 - right))
                    node = 2 * node + 1 + right
                out[begin + row, found] = t * forest.leaves + node - inner
                found += 1
    return out
