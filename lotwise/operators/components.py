"""Principal components of sparse vectors by a randomised range finder."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

#: Bytes of the slots x directions matrix that every task holds; the default takes 800,000 slots in 20 directions.
MOST_BYTES = 128_000_000


@dataclass
class Components:
    """``axes`` holds one unit column per component, ``variances`` the variance along each (divisor: rows - 1)."""

    mean: np.ndarray
    axes: np.ndarray
    variances: np.ndarray
    total_variance: float

    @property
    def shares(self) -> np.ndarray:
        return self.variances / self.total_variance if self.total_variance else np.zeros_like(self.variances)

    def transform(self, df: DataFrame, keep: list[str], column: str = "features", out: str = "components") -> DataFrame:
        """``keep`` and the centred rows along the axes; no shuffle. A NULL vector gives NULL."""
        return _projected(df.select(*keep, column), keep, column, out, self.mean, self.axes)


def _entries(column: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value) of the stored entries, and the rows that have a vector."""
    present = np.flatnonzero(~np.asarray(column.is_null()))
    dense = np.asarray(column.field("type").fill_null(0)) == 1
    values, indices = column.field("values"), column.field("indices")
    lengths = np.asarray(values.value_lengths().fill_null(0))
    lengths = np.where(np.asarray(column.is_null()), 0, lengths)
    rows = np.repeat(np.arange(len(column)), lengths)
    offsets = np.asarray(values.offsets)[:-1]
    first = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    v = np.asarray(values.values)[np.repeat(offsets, lengths) + place]
    slots = place.copy()
    sparse = ~dense[rows]
    if sparse.any():
        starts = np.asarray(indices.offsets)[:-1]
        slots[sparse] = np.asarray(indices.values)[(np.repeat(starts, lengths) + place)[sparse]]
    return rows, slots, v, present


def _added(place: np.ndarray, weights: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Weighted rows of ``values``, added up by place; a column at a time, which is many times faster than ``add.at``."""
    # without entries the counts are whole numbers
    return np.stack([np.bincount(place, weights * values[:, j], size) for j in range(values.shape[1])], axis=1, dtype=float)


def _along(column: pa.StructArray, mean: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Centred rows times the axes, from the stored entries alone; NaN stands for its slot's mean."""
    rows, slots, v, present = _entries(column)
    v = np.where(np.isnan(v), mean[slots], v)
    y = _added(rows, v, axes[slots], len(column))
    y[present] -= mean @ axes
    return y, rows, slots, v, present


def _slot_sums(df: DataFrame, column: str, size: int, width: int, add) -> np.ndarray:
    """Sum over all rows of a slots x ``width`` matrix; tasks add up their own before the shuffle by slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((size, width))
        for batch in batches:
            add(sums, batch.column(0))
        used = np.flatnonzero(sums.any(axis=1))
        yield pa.record_batch([pa.array(used, pa.int64()), *[pa.array(sums[used, j]) for j in range(width)]],
                              names=["slot", *[f"s{j}" for j in range(width)]])

    names = [f"s{j}" for j in range(width)]
    cells = df.select(column).mapInArrow(run, "slot long, " + ", ".join(f"{n} double" for n in names))
    out = np.zeros((size, width))
    for r in cells.groupBy("slot").agg(*[F.sum(n).alias(n) for n in names]).collect():
        out[r["slot"]] = [r[n] for n in names]
    return out


def _means(df: DataFrame, column: str, size: int) -> tuple[np.ndarray, float, int]:
    """Mean of each slot over its numbers, summed variance of all slots, and the rows with a vector."""

    def add(sums: np.ndarray, vectors: pa.StructArray) -> None:
        _, slots, v, present = _entries(vectors)
        gap = np.isnan(v)
        sums[:size, 0] += np.bincount(slots, np.where(gap, 0.0, v), size)
        sums[:size, 1] += np.bincount(slots, gap, size)
        sums[:size, 2] += np.bincount(slots, np.where(gap, 0.0, v * v), size)
        sums[size, 0] += len(present)

    sums = _slot_sums(df, column, size + 1, 3, add)
    n = int(sums[size, 0])
    if n < 2:
        raise ValueError("components need two rows with a vector")
    known = n - sums[:size, 1]
    mean = np.divide(sums[:size, 0], known, out=np.zeros(size), where=known > 0)
    squares = sums[:size, 2] - known * mean ** 2
    return mean, float(np.maximum(squares, 0).sum() / (n - 1)), n


def _folded(r: np.ndarray | None, y: np.ndarray) -> np.ndarray:
    """The triangle of the rows seen so far and these."""
    return np.linalg.qr(y if r is None else np.vstack([r, y]), mode="r")


def _triangle(df: DataFrame, column: str, mean: np.ndarray, axes: np.ndarray, groups: int = 64) -> np.ndarray:
    """R of the tall QR of (centred rows x axes): a triangle per task, then per group of tasks, then one."""
    width = axes.shape[1]

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            y, _, _, _, present = _along(batch.column(0), mean, axes)
            if len(present):
                r = _folded(r, y[present])
        if r is not None:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.ravel()], pa.list_(pa.float64()))], names=["task", "r"])

    def per_group(table: pa.Table) -> pa.Table:
        r = None
        for cells in table.column("r").to_pylist():
            r = _folded(r, np.reshape(cells, (-1, width)))
        return pa.table({"r": pa.array([r.ravel()], pa.list_(pa.float64()))})

    tasks = df.select(column).mapInArrow(per_task, "task long, r array<double>")
    r = None
    for row in tasks.groupBy((F.col("task") % groups).alias("g")).applyInArrow(lambda t: per_group(t), "r array<double>").collect():
        r = _folded(r, np.reshape(row["r"], (-1, width)))
    return r


def _projected(df: DataFrame, keep: list[str], column: str, out: str, mean: np.ndarray, axes: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(len(keep))
            y = _along(vectors, mean, axes)[0]
            cells = pa.FixedSizeListArray.from_arrays(pa.array(y.ravel()), axes.shape[1]).cast(pa.list_(pa.float64()))
            absent = vectors.is_null()
            if absent.true_count:
                cells = pa.array([None if a else c for a, c in zip(absent.to_pylist(), cells.to_pylist())], pa.list_(pa.float64()))
            yield pa.record_batch([*batch.columns[:len(keep)], cells], names=[*keep, out])

    return df.mapInArrow(run, df.select(*keep).schema.add(out, ArrayType(DoubleType())))


def fit_components(df: DataFrame, k: int, size: int, column: str = "features", extra: int = 10, settled: float = 1e-9,
                   most_passes: int = 30, seed: int = 42) -> Components:
    """The ``k`` first principal components of vectors with ``size`` slots.

    Random directions, ``extra`` of them more than asked for, are multiplied by the cross products of the centred
    rows, pass by pass, until the ``k`` variances change by less than ``settled`` of the first one (or after
    ``most_passes``). The last pass is a tall QR, so the variances come from the rows, not from their squares.
    Driver and tasks hold slots x directions, never slots x slots; rows stay sparse. Axes are signed so that
    their largest entry is positive. NaN stands for the mean of its slot, rows without a vector don't count;
    equal variances have any axes of their plane. Fewer than two rows, or a matrix of directions above
    ``MOST_BYTES``, raise.
    """
    width = min(k + extra, size)
    if not 0 < k <= size:
        raise ValueError(f"{k} components of {size} slots")
    if size * width * 8 > MOST_BYTES:
        raise ValueError(f"{size} slots in {width} directions are more than a task should hold")
    mean, total, n = _means(df, column, size)

    def times_cross_products(axes: np.ndarray) -> np.ndarray:
        def add(sums: np.ndarray, vectors: pa.StructArray) -> None:
            y, rows, slots, v, present = _along(vectors, mean, axes)
            sums[:size] += _added(slots, v, y[rows], size)
            sums[size] += y[present].sum(axis=0)

        sums = _slot_sums(df, column, size + 1, width, add)
        return sums[:size] - np.outer(mean, sums[size])

    axes = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, width)))[0]
    before = np.zeros(k)
    for _ in range(most_passes):
        axes, stretch, _ = np.linalg.svd(times_cross_products(axes), full_matrices=False)
        now = stretch[:k] / (n - 1)
        done = np.abs(now - before).max() <= settled * max(now[0], np.finfo(float).tiny)
        before = now
        if done:
            break
    _, stretch, turn = np.linalg.svd(_triangle(df, column, mean, axes))
    stretch = np.concatenate([stretch, np.zeros(width - len(stretch))])
    found = (axes @ turn.T)[:, :k]
    sign = np.sign(found[np.abs(found).argmax(axis=0), np.arange(k)])
    return Components(mean, found * np.where(sign == 0, 1.0, sign), stretch[:k] ** 2 / (n - 1), total)
