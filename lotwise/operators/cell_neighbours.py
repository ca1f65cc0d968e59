"""Search among many wide sparse vectors: cells around centres, visited nearest first, exact distances behind a bound.

A point lies in one cell, that of its nearest centre, and cells that lie side by side make a part of bounded size.
A query travels once to each part that it has cells in, not once a cell. Its home part, where its nearest cell is,
gives an upper bound for the k-th distance; elsewhere only points are measured whose distance along a hundred
directions, with what is left over as one more, doesn't exceed that bound. So distances are exact, and what is
found is all that the visited cells hold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotwise.operators.components import MOST_BYTES, _entries, _slot_sums, fit_components
from lotwise.operators.neighbours import DIGITS
from lotwise.sources.scratch import materialize

#: Directions of the bound, and how many of them place the centres.
DIRECTIONS, PLACING = 96, 24
#: Sampled points per centre, and passes that move the centres to the mean of theirs.
SAMPLED, PASSES = 32, 4
#: Points of a part: as many as give each core four parts, between these.
LEAST_POINTS, MOST_POINTS = 4_096, 65_536
#: Numbers of a matrix that a task holds at a time.
MOST_CELLS = 4_000_000


@dataclass
class Cells:
    """Directions, centres along the first of them, and how many cells a query visits."""

    mean: np.ndarray
    axes: np.ndarray  # slots x directions
    centres: np.ndarray  # cells x the first directions
    probes: int = 1
    recall: float = 0.0

    def reduced(self, vectors: pa.StructArray) -> np.ndarray:
        """Rows along the directions and, last, the length of what is left: distances between these are never too long."""
        rows, slots, v, _ = _entries(vectors)
        n, width = len(vectors), self.axes.shape[1]
        axes, shift = self.axes.astype(np.float32), self.mean @ self.axes
        out = np.zeros((n, width + 1), dtype=np.float32)
        lengths = np.bincount(rows, minlength=n)
        ends = np.cumsum(lengths)
        for a in range(0, n, 2048):
            b = min(a + 2048, n)
            filled = a + np.flatnonzero(lengths[a:b])
            if len(filled):
                first, last = ends[a] - lengths[a], ends[b - 1]
                terms = axes[slots[first:last]] * v[first:last, None].astype(np.float32)
                out[filled, :width] = np.add.reduceat(terms, ends[filled] - lengths[filled] - first, axis=0)
        out[:, :width] -= shift
        mean = self.mean[slots]
        squares = np.bincount(rows, (v - mean) ** 2 - mean ** 2, n) + (self.mean ** 2).sum()
        out[:, width] = np.sqrt(np.maximum(squares - (out[:, :width].astype(float) ** 2).sum(axis=1), 0))
        return out

    def nearest(self, y: np.ndarray, probes: int = 1) -> np.ndarray:
        """The nearest ``probes`` cells of each row, the nearest first."""
        probes = min(probes, len(self.centres))
        out = np.empty((len(y), probes), dtype=np.int64)
        lengths = (self.centres ** 2).sum(axis=1)
        step = max(1, MOST_CELLS // len(self.centres))
        for a in range(0, len(y), step):
            far = lengths - 2 * y[a:a + step, :self.centres.shape[1]] @ self.centres.T
            if probes == 1:
                out[a:a + step, 0] = far.argmin(axis=1)
                continue
            near = np.argpartition(far, probes - 1, axis=1)[:, :probes] if probes < far.shape[1] else np.indices(far.shape)[1]
            out[a:a + step] = np.take_along_axis(near, np.argsort(np.take_along_axis(far, near, axis=1), axis=1, kind="stable"), axis=1)
        return out


def fit_cells(points: DataFrame, size: int, count: int, sample: int, seed: int) -> Cells:
    """Directions from ``sample`` points; the centres, four times the root of the points, from 32 points each."""
    some = materialize(points.select("v").orderBy(F.xxhash64("v", F.lit(seed)), "v").limit(sample), "cell-directions")
    axes = fit_components(some, max(1, min(size, DIRECTIONS, MOST_BYTES // (8 * size) - 10)), size, column="v", settled=1e-2, most_passes=5)
    out = Cells(axes.mean, axes.axes, np.zeros((1, min(PLACING, axes.axes.shape[1])), dtype=np.float32))
    width, cells = out.centres.shape[1], math.ceil(4 * math.sqrt(count))
    share = F.pmod(F.xxhash64("v", F.lit(seed + 1)), F.lit(1 << 20)) < math.ceil(SAMPLED * cells / count * (1 << 20))

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = np.ascontiguousarray(out.reduced(batch.column(0))[:, :width])
            offsets = pa.array(np.arange(len(y) + 1, dtype=np.int32) * width)
            yield pa.record_batch([pa.ListArray.from_arrays(offsets, pa.array(y.ravel()))], names=["y"])

    drawn = materialize(points.where(share).select("v").mapInArrow(along, "y array<float>"), "cell-sample")
    start = drawn.orderBy(F.xxhash64("y", F.lit(seed)), "y").limit(cells).toArrow().column("y").combine_chunks()
    out.centres = _rows_of(start, width)
    for _ in range(PASSES):
        moved = Cells(out.mean, out.axes, out.centres)

        def add(sums: np.ndarray, column: pa.ListArray) -> None:
            y = _rows_of(column, width)
            at = moved.nearest(y)[:, 0]
            for j in range(width):
                sums[:, j] += np.bincount(at, y[:, j], len(sums))
            sums[:, width] += np.bincount(at, minlength=len(sums))

        sums = _slot_sums(drawn, "y", len(out.centres), width + 1, add)
        held = sums[:, width:]
        out.centres = np.where(held > 0, sums[:, :width] / np.maximum(held, 1), out.centres).astype(np.float32)
    return out


def _rows_of(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(column), width)


@dataclass
class Parts:
    """Where points and queries meet. A cell's points are dealt to ``shares`` parts from ``first`` on, by their number;
    a part's queries to ``copies`` tasks from ``task`` on, each of which gets all points of the part."""

    first: np.ndarray  # per cell
    shares: np.ndarray
    task: np.ndarray  # per part
    copies: np.ndarray


def deal(centres: np.ndarray, held: np.ndarray, asked: np.ndarray, most: int) -> Parts:
    """Cells halved along their widest direction until a side holds ``most`` points; a crowded cell is dealt alone.

    ``held`` and ``asked`` are points and visits of each cell. A part with several times the usual work is copied.
    """
    first, shares, parts = np.zeros(len(centres), dtype=np.int64), np.ones(len(centres), dtype=np.int64), 0
    work: list[float] = []
    todo = [np.arange(len(centres))]
    while todo:
        cells = todo.pop()
        if held[cells].sum() > most and len(cells) > 1:
            along = centres[cells]
            order = cells[np.argsort(along[:, np.argmax(along.var(axis=0))], kind="stable")]
            below = np.cumsum(held[order])
            cut = int(np.clip(np.searchsorted(below, below[-1] / 2) + 1, 1, len(order) - 1))
            todo += [order[:cut], order[cut:]]
            continue
        n = max(1, math.ceil(held[cells].sum() / most))
        first[cells], shares[cells] = parts, n
        parts += n
        work += [float((held[cells] * asked[cells]).sum()) / n] * n
    usual = max(sum(work) / len(work), 1.0)
    copies = np.array([max(1, math.ceil(w / (4 * usual))) for w in work], dtype=np.int64)
    return Parts(first, shares, np.cumsum(copies) - copies, copies)


class _Held:
    """The points of a part, by cell."""

    def __init__(self, cells: Cells, batches: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(batches).combine_chunks()
        column = lambda name: table.column(name).chunk(0)
        cell = column("cells").flatten().to_numpy()
        order = np.argsort(cell, kind="stable")
        vectors = column("v").take(pa.array(order))
        self.cell, self.n, self.s = cell[order], column("n").to_numpy()[order], column("s").to_numpy()[order]
        rows, self.slots, self.values, _ = _entries(vectors)
        self.lengths = np.bincount(rows, minlength=len(order))
        self.start = np.cumsum(self.lengths) - self.lengths
        self.y = cells.reduced(vectors)
        self.squares = (self.y ** 2).sum(axis=1)
        self.cells = cells

    def search(self, batch: pa.RecordBatch, k: int, home: bool) -> pa.RecordBatch:
        """(qid, dist, n, s, bound): the smallest distances of each query, until k rows are found."""
        vectors, visits = batch.column("v"), batch.column("cells")
        size, n = len(self.cells.mean), len(batch)
        entries = _entries(vectors)[:3]
        y = self.cells.reduced(vectors)
        squares = (y ** 2).sum(axis=1)
        visited = visits.flatten().to_numpy()
        asker = np.repeat(np.arange(n), visits.value_lengths().to_numpy())
        bound = np.full(n, np.inf) if home else batch.column("bound").to_numpy(zero_copy_only=False).astype(float)
        spare = 1e-5 * (squares + (self.squares.max() if len(self.squares) else 0)) + 1e-9
        exact = lambda q, p: self._distances(entries, size, n, q, p)
        if home:  # the likely ones of the nearest cell give a first bound
            lead = np.flatnonzero(np.diff(asker, prepend=-1))
            q, p = self._candidates(y, squares, asker[lead], visited[lead], k + 8)
            levels = self._levels(q, p, exact(q, p), k)
            bound = self._bounds(levels, n, k)
        q, p, dist = [], [], []
        for a_q, a_p in self._survivors(y, squares, asker, visited, bound ** 2 * (1 + 1e-5) + spare):
            d = exact(a_q, a_p)
            near = d <= bound[a_q]
            q.append(a_q[near]), p.append(a_p[near]), dist.append(d[near])
        levels = self._levels(*(np.concatenate(c) if c else np.zeros(0, t) for c, t in ((q, int), (p, int), (dist, float))), k)
        bound = np.minimum(bound, self._bounds(levels, n, k))
        qid = batch.column("qid").to_numpy()
        return pa.record_batch([pa.array(qid[levels[0]]), pa.array(levels[1]), pa.array(levels[2]), pa.array(levels[3]), pa.array(bound[levels[0]])],
                               names=["qid", "dist", "n", "s", "bound"])

    def _by_cell(self, asker: np.ndarray, visited: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
        """Queries of each cell, few at a time, and where its points begin and end."""
        order = np.argsort(visited, kind="stable")
        edges = np.flatnonzero(np.diff(visited[order], prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:]):
            low, high = np.searchsorted(self.cell, visited[order[a]]), np.searchsorted(self.cell, visited[order[a]], "right")
            if low < high:
                step = max(1, MOST_CELLS // (high - low))
                for c in range(a, b, step):
                    yield asker[order[c:min(c + step, b)]], int(low), int(high)

    def _gaps(self, y: np.ndarray, squares: np.ndarray, q: np.ndarray, low: int, high: int) -> np.ndarray:
        return squares[q, None] + self.squares[low:high] - 2 * (y[q] @ self.y[low:high].T)

    def _candidates(self, y, squares, asker, visited, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``most`` likely points of each visit."""
        q, p = [np.zeros(0, int)], [np.zeros(0, int)]
        for at, low, high in self._by_cell(asker, visited):
            gaps = self._gaps(y, squares, at, low, high)
            width = min(most, high - low)
            near = np.argpartition(gaps, width - 1, axis=1)[:, :width]
            q.append(np.repeat(at, width)), p.append(low + near.ravel())
        return np.concatenate(q), np.concatenate(p)

    def _survivors(self, y, squares, asker, visited, limit) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Points that may lie within the limits of the queries, some hundred thousand pairs at a time."""
        q, p, held = [], [], 0
        for at, low, high in self._by_cell(asker, visited):
            i, j = np.nonzero(self._gaps(y, squares, at, low, high) <= limit[at, None])
            q.append(at[i]), p.append(low + j)
            held += len(i)
            if held > MOST_CELLS // 16:
                yield np.concatenate(q), np.concatenate(p)
                q, p, held = [], [], 0
        if held:
            yield np.concatenate(q), np.concatenate(p)

    def _distances(self, entries: tuple, size: int, n: int, q: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Exact distance of each pair, from the stored entries; equal vectors have 0."""
        rows, slots, v = entries
        own = np.bincount(rows, v * v, n)
        out = np.empty(len(q))
        order = np.argsort(q, kind="stable")
        step = max(1, MOST_CELLS // size)
        ends = np.searchsorted(q[order], np.arange(0, n + step, step))
        for block, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
            first = block * step
            dense = None
            for c in range(a, b, MOST_CELLS // 64):
                if dense is None:
                    inside = slice(*np.searchsorted(rows, (first, first + step)))
                    dense = np.zeros((min(step, n - first), size))
                    dense[rows[inside] - first, slots[inside]] = v[inside]
                pairs = order[c:min(c + MOST_CELLS // 64, b)]
                points = p[pairs]
                lengths = self.lengths[points]
                pair = np.repeat(np.arange(len(pairs)), lengths)
                at = np.arange(len(pair)) + np.repeat(self.start[points] - (np.cumsum(lengths) - lengths), lengths)
                there = dense.ravel().take((q[pairs] - first)[pair] * size + self.slots[at])
                both = np.bincount(pair, (self.values[at] - there) ** 2, len(pairs))
                # slots that only the query has
                rest = np.maximum(own[q[pairs]] - np.bincount(pair, there * there, len(pairs)), 0)
                out[pairs] = np.sqrt(both + rest)
        return np.round(out, DIGITS)

    def _levels(self, q: np.ndarray, p: np.ndarray, dist: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """(query, distance, rows, sum) with equal distances as one, as far as the k-th row."""
        order = np.lexsort((p, dist, q))
        q, p, dist = q[order], p[order], dist[order]
        new = np.flatnonzero((np.diff(q, prepend=-1) != 0) | (np.diff(dist, prepend=-1) != 0))
        if not len(new):
            return q, dist, np.zeros(0, np.int64), np.zeros(0)
        rows, total = np.add.reduceat(self.n[p], new), np.add.reduceat(self.s[p], new)
        q, dist = q[new], dist[new]
        before = np.cumsum(rows) - rows
        lead = np.flatnonzero(np.diff(q, prepend=-1))
        before -= np.repeat(before[lead], np.diff(np.append(lead, len(q))))
        kept = before < k
        return q[kept], dist[kept], rows[kept], total[kept]

    @staticmethod
    def _bounds(levels: tuple[np.ndarray, ...], n: int, k: int) -> np.ndarray:
        """Distance of the k-th row of each query, infinite where fewer were found."""
        q, dist, rows, _ = levels
        out = np.zeros(n)
        out[q] = dist  # the last one holds
        out[np.bincount(q, rows, n) < k] = np.inf
        return out


_MET = "task int, kind int, qid long, n long, s double, bound double, cells array<int>"
_FOUND = "qid long, dist double, n long, s double, bound double"


def _met(names: list[str], columns: list, vectors: pa.StructArray) -> pa.RecordBatch:
    return pa.record_batch([*columns, vectors], names=[*names, "v"])


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _point_rows(held: DataFrame, parts: Parts, names: list[str], schema) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pid, cell = batch.column(0).to_numpy(), batch.column(3).to_numpy()
            part = parts.first[cell] + pid % parts.shares[cell]
            copies = parts.copies[part]
            row = np.repeat(np.arange(len(pid)), copies)
            task = parts.task[part][row] + np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
            taken = batch.take(pa.array(row))
            yield _met(names, [pa.array(task, pa.int32()), pa.array(np.zeros(len(row), np.int32)), taken.column(0), taken.column(1), taken.column(2),
                               pa.nulls(len(row), pa.float64()), _lists(cell[row], np.ones(len(row), int))], taken.column(4))

    return held.select("pid", "n", "s", "cell", "v").mapInArrow(run, schema)


def _query_rows(asked: DataFrame, parts: Parts, home: bool, names: list[str], schema) -> DataFrame:
    """A row for each query and part: the home part's alone, or all others'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            qid, lengths = batch.column(0).to_numpy(), batch.column(1).value_lengths().to_numpy()
            visited, asker = batch.column(1).flatten().to_numpy(), np.repeat(np.arange(len(qid)), lengths)
            nearest = visited[np.cumsum(lengths) - lengths]
            keep = (parts.first[visited] == parts.first[nearest][asker]) == home
            visited, asker = visited[keep], asker[keep]
            # a crowded cell's points lie in several parts
            shares = parts.shares[visited]
            part = np.repeat(parts.first[visited], shares) + np.arange(shares.sum()) - np.repeat(np.cumsum(shares) - shares, shares)
            visited, asker = np.repeat(visited, shares), np.repeat(asker, shares)
            order = np.lexsort((part, asker))  # stable: the nearest cell stays first
            visited, asker, part = visited[order], asker[order], part[order]
            lead = np.flatnonzero((np.diff(asker, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0))
            row, of = asker[lead], part[lead]
            task = parts.task[of] + qid[row] % parts.copies[of]
            taken = batch.take(pa.array(row))
            none = lambda kind: pa.nulls(len(row), kind)
            yield _met(names, [pa.array(task, pa.int32()), pa.array(np.ones(len(row), np.int32)), taken.column(0), none(pa.int64()), none(pa.float64()),
                               taken.column(2), _lists(visited, np.diff(np.append(lead, len(asker))))], taken.column(3))

    return asked.select("qid", "cells", "bound", "v").mapInArrow(run, schema)


def _meet(points: DataFrame, queries: DataFrame, cells: Cells, tasks: int, k: int, home: bool) -> DataFrame:
    """Distances found by the queries of each task, which reads its points first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept, index = -1, [], None
        for batch in batches:
            task, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero(np.diff(task * 2 + kind, prepend=-1, append=-1))
            for a, b in zip(edges[:-1], edges[1:]):
                if task[a] != now:
                    now, kept, index = task[a], [], None
                if not kind[a]:
                    kept.append(batch.slice(a, b - a))
                elif kept or index:
                    if index is None:
                        index, kept = _Held(cells, kept), []
                    yield index.search(batch.slice(a, b - a), k, home)

    both = points.unionByName(queries).repartition(tasks, "task").sortWithinPartitions("task", "kind")
    return both.mapInArrow(run, _FOUND)


def visit_cells(points: DataFrame, asked: DataFrame, cells: Cells, k: int) -> DataFrame:
    """(qid, dist, n, s) of the smallest distances that each query finds in its cells, written once.

    ``points`` has pid, n, s and v, ``asked`` qid and v.
    """
    vector = points.select("v").schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = cells.nearest(cells.reduced(batch.column(3)))[:, 0]
            yield pa.record_batch([*batch.columns[:3], pa.array(cell, pa.int32()), batch.column(3)], names=["pid", "n", "s", "cell", "v"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = cells.nearest(cells.reduced(batch.column(1)), cells.probes)
            yield pa.record_batch([batch.column(0), _lists(near.ravel(), np.full(len(near), near.shape[1])), batch.column(1)], names=["qid", "cells", "v"])

    placed_schema = points.select("pid", "n", "s", F.lit(0).alias("cell"), "v").schema
    held = materialize(points.select("pid", "n", "s", "v").mapInArrow(place, placed_schema), "cell-points")
    asked_schema = asked.select("qid", F.array(F.lit(0)).alias("cells"), "v").schema
    visits = materialize(asked.select("qid", "v").mapInArrow(visit, asked_schema), "cell-queries")

    def counted(column: DataFrame) -> np.ndarray:
        out = np.zeros(len(cells.centres), dtype=np.int64)
        for r in column.groupBy("cell").count().collect():  # a row per cell
            out[r["cell"]] = r["count"]
        return out

    n_held, n_asked = counted(held.select("cell")), counted(visits.select(F.explode("cells").alias("cell")))
    cores = points.sparkSession.sparkContext.defaultParallelism
    parts = deal(cells.centres, n_held, n_asked, min(max(int(n_held.sum()) // (4 * cores), LEAST_POINTS), MOST_POINTS))
    schema = points.sparkSession.createDataFrame([], _MET).schema.add(vector["v"])
    names, tasks = schema.names[:-1], int(parts.copies.sum())
    found = None
    for home in (True, False):
        if home:
            queries = visits.withColumn("bound", F.lit(None).cast("double"))
        else:
            # the home part's k-th distance goes along
            bounds = found.groupBy("qid").agg(F.min("bound").alias("bound"))
            queries = visits.join(bounds, "qid", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
        met = _meet(_point_rows(held, parts, names, schema), _query_rows(queries, parts, home, names, schema), cells, tasks, k, home)
        met = materialize(met, "cell-found")
        found = met if found is None else found.unionByName(met)
    return found.select("qid", "dist", "n", "s")
