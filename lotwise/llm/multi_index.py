"""Inverted multi-index: two codebooks, one for each half of a vector, whose product is the grid of cells.

Codebooks are fitted on a bounded sample; every row gets its cell. A query visits cells by rising sum of the
squared distances of its halves to the centroids (multi-sequence traversal with a heap).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from lotwise.llm.rows import hash_sample

#: Rows the codebooks are fitted on, at most: those of the smallest id hashes.
SAMPLE_ROWS = 16384
ROWS_PER_CELL = 16
CODES = (2, 256)


def usable(vector: Column) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def main_size(rows: DataFrame, vector: str = "vector") -> int:
    """The commonest number of components, the smaller of equals; vectors of other sizes take no part."""
    sizes = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return sizes[0]["d"] if sizes else 0


def sample(rows: DataFrame, *by: str, n: int = SAMPLE_ROWS) -> np.ndarray:
    """Matrix of at most ``n`` vectors, those of the smallest hash of the given columns."""
    taken = hash_sample(rows.select("vector", *by), n, *by).select("vector").collect()
    return np.array([r["vector"] for r in taken], dtype=np.float64)


def matrix(column, size: int) -> np.ndarray:
    """Rows of an Arrow column of equal lists."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, size)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1)[None], 0)


def _codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's centroids from spread-out starts, the same on every run."""
    x = np.unique(x, axis=0)
    if len(x) <= k:
        return x
    rng = np.random.default_rng(7)
    picked = [int(rng.integers(len(x)))]
    near = _squared(x, x[picked])[:, 0]
    for _ in range(k - 1):
        total = near.sum()
        picked.append(int(rng.choice(len(x), p=near / total)) if total > 0 else int(rng.integers(len(x))))
        near = np.minimum(near, _squared(x, x[picked[-1:]])[:, 0])
    centroids = x[picked].copy()
    for _ in range(rounds):
        owner = _squared(x, centroids).argmin(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, x)
        n = np.bincount(owner, minlength=k)
        centroids[n > 0] = sums[n > 0] / n[n > 0, None]
    return centroids


@dataclass
class MultiIndex:
    first: np.ndarray
    second: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, rows: int) -> MultiIndex:
        """Codes grow with the root of the rows, so that a cell of an even table holds about 16 of them."""
        k = int(np.clip(2 ** round(np.log2(max(rows / ROWS_PER_CELL, 1)) / 2), *CODES))
        half = x.shape[1] // 2
        return MultiIndex(_codebook(x[:, :half], k), _codebook(x[:, half:], k))

    @property
    def size(self) -> int:
        return self.first.shape[1] + self.second.shape[1]

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return _squared(x[:, :half], self.first), _squared(x[:, half:], self.second)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.distances(x)
        return a.argmin(1), b.argmin(1)


def traverse(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cells by rising a[i] + b[j]: a pair enters the heap when both that come before it have left."""
    by_a, by_b = np.argsort(a, kind="stable").tolist(), np.argsort(b, kind="stable").tolist()
    a, b = a[by_a].tolist(), b[by_b].tolist()
    heap = [(a[0] + b[0], 0, 0)]
    reached = [0] * len(a)  # how many of the row's cells have left the heap
    while heap:
        _, i, j = heapq.heappop(heap)
        reached[i] = j + 1
        yield by_a[i], by_b[j]
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < len(b) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
