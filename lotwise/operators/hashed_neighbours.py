"""Approximate k-nearest-neighbour regression on wide sparse vectors: projected hash tables with several probes.

Equal vectors collapse to one point. Each table cuts a few directions of large variance at the quantiles of a
sample; a point lies in one cell of each table, and a query visits the cells next to it, nearest first. How many is
measured: trial queries are searched exactly, and the probes reach the wanted recall on them. Tables get more
directions as points grow, so a cell holds about as many at any size. Crowded cells are dealt in blocks on both
sides, distances are exact, on the whole vectors.

Each visit of a cell carries the query's vector, and neighbours lie the wider the more directions a table has. So
above ``GRID_POINTS`` points the tables give way to cells around centres (``cell_neighbours.py``), of which fewer
points must be visited for the same recall, and which a query reaches by parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lotwise.operators.cell_neighbours import Cells, fit_cells, visit_cells
from lotwise.operators.components import _along, _entries, fit_components
from lotwise.operators.neighbours import DIGITS, nearest_mean
from lotwise.sources.scratch import materialize

BINS = 4
#: Distinct points up to which the tables are used.
GRID_POINTS = 2 ** 16


@dataclass
class Tables:
    """Directions of all tables side by side, and the inner cuts of each."""

    mean: np.ndarray
    axes: np.ndarray
    cuts: np.ndarray  # tables x directions x (BINS - 1)
    probes: int = 1
    recall: float = 0.0

    def along(self, vectors: pa.StructArray) -> np.ndarray:
        """Rows x tables x directions."""
        return _along(vectors, self.mean, self.axes)[0].reshape(len(vectors), *self.cuts.shape[:2])

    def cells(self, y: np.ndarray) -> np.ndarray:
        """Cell of each row in each table."""
        bins = (y[..., None] >= self.cuts[None]).sum(axis=-1)
        return bins @ (BINS ** np.arange(self.cuts.shape[1]))

    def visits(self, y: np.ndarray, probes: int) -> list[np.ndarray]:
        """Per table the ``probes`` nearest cells of each row, by the distance to them along the directions."""
        out = []
        for table, cuts in enumerate(self.cuts):
            low = np.concatenate([np.full((len(cuts), 1), -np.inf), cuts], axis=1)
            high = np.concatenate([cuts, np.full((len(cuts), 1), np.inf)], axis=1)
            step = max(1, 500_000 // (probes * BINS))  # rows whose cells are compared at a time
            found = []
            for a in range(0, len(y), step):
                v = y[a:a + step, table, :, None]
                found.append(_nearest_of_rows(np.maximum(np.maximum(low - v, v - high), 0.0) ** 2, probes))
            out.append(np.concatenate(found) if found else np.zeros((0, 0), dtype=np.int64))
        return out


def _nearest_of_rows(gap: np.ndarray, probes: int) -> np.ndarray:
    """Cells of each row's grid by the sum of their gaps (rows x directions x bins), smallest first, equal ones by
    their steps along the sorted bins. A direction at a time: only the ``probes`` best beginnings go on."""
    n, directions, _ = gap.shape
    order = np.argsort(gap, axis=2, kind="stable")
    ranked = np.take_along_axis(gap, order, axis=2)
    total, cell = np.zeros((n, 1)), np.zeros((n, 1), dtype=np.int64)
    for d in range(directions):
        width = total.shape[1] * BINS
        total = (total[:, :, None] + ranked[:, d, None, :]).reshape(n, width)
        cell = (cell[:, :, None] + order[:, d, None, :] * BINS ** d).reshape(n, width)
        if width > probes:
            limit = np.partition(total, probes - 1, axis=1)[:, probes - 1:probes]
            below, equal = total < limit, total == limit
            equal &= np.cumsum(equal, axis=1) <= probes - below.sum(axis=1, keepdims=True)
            kept = below | equal
            total, cell = total[kept].reshape(n, probes), cell[kept].reshape(n, probes)
    return np.take_along_axis(cell, np.argsort(total, axis=1, kind="stable"), axis=1)


def _nearest_cells(gap: np.ndarray, probes: int) -> list[int]:
    return _nearest_of_rows(gap[None], probes)[0].tolist()


def _dense(vectors: pa.StructArray, used: np.ndarray) -> np.ndarray:
    rows, slots, v, _ = _entries(vectors)
    out = np.zeros((len(vectors), len(used)))
    out[rows, np.searchsorted(used, slots)] = v
    return out


def _closest(queries: pa.StructArray, points: pa.StructArray, k: int, cells: int = 4_000_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, distance) of the k nearest points of each query; products choose, differences measure."""
    used = np.union1d(_entries(queries)[1], _entries(points)[1])
    step = max(1, cells // max(1, len(used)))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a in range(0, len(queries), step):
        q = _dense(queries.slice(a, step), used)
        for b in range(0, len(points), step):
            p = _dense(points.slice(b, step), used)
            width = min(k + 8, len(p))
            for c in range(0, len(q), max(1, cells // len(p))):
                part = q[c:c + max(1, cells // len(p))]
                rough = (p * p).sum(axis=1)[None] - 2 * part @ p.T
                near = np.argpartition(rough, width - 1, axis=1)[:, :width]
                for i, row in enumerate(near):
                    dist = np.round(np.sqrt(((p[row] - part[i]) ** 2).sum(axis=1)), DIGITS)
                    best = np.lexsort((row, dist))[:k]
                    found.append((np.full(len(best), a + c + i), b + row[best], dist[best]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate(part) for part in zip(*found))


def _struct(table: pa.Table, name: str = "v") -> pa.StructArray:
    column = table.column(name).combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _true_neighbours(points: DataFrame, trials: pa.StructArray, k: int) -> DataFrame:
    """The k nearest points of each trial query among all: k of each task, of each of 64 parts of those, of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            q, p, dist = _closest(trials, batch.column(0), k)
            new = pa.table({"q": pa.array(q, pa.int32()), "dist": dist, "v": batch.column(0).take(pa.array(p))})
            both = new if kept is None else pa.concat_tables([kept, new])
            rank = pd.DataFrame({"q": both["q"].to_numpy(), "dist": both["dist"].to_numpy()}).sort_values(["q", "dist"], kind="stable")
            kept = both.take(pa.array(rank.groupby("q").head(k).index))
        if kept is not None:
            yield from kept.combine_chunks().to_batches()

    schema = points.select(F.lit(0).alias("q"), F.lit(0.0).alias("dist"), "v").schema
    near = points.select("v").mapInArrow(run, schema)
    entry = F.struct("dist", F.xxhash64("v").alias("h"), "v")
    first = F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("best")
    parts = near.groupBy("q", F.pmod(F.xxhash64("v"), F.lit(64)).alias("part")).agg(first).select("q", F.inline("best"))
    return parts.groupBy("q").agg(first).select("q", F.inline("best"))


def _trial(points: DataFrame, queries: DataFrame, k: int, trials: int, seed: int) -> tuple[pa.StructArray, pa.StructArray, np.ndarray]:
    """Trial queries, their true neighbours and the query of each: ``trials`` queries and k points of each at most."""
    asked = _struct(queries.select("v").orderBy(F.xxhash64("v", F.lit(seed)), "v").limit(trials).toArrow())
    true = _true_neighbours(points, asked, k).toArrow()
    return asked, _struct(true), true["q"].to_numpy()


def _fitted_cells(points: DataFrame, queries: DataFrame, size: int, count: int, k: int, recall: float, sample: int, trials: int, seed: int) -> Cells:
    """Cells around centres; as many are visited as reach the recall on the trials, all of them if need be."""
    out = fit_cells(points, size, count, sample, seed)
    asked, true, q = _trial(points, queries, k, trials, seed)
    if len(q):
        at = out.nearest(out.reduced(true))
        ranks = (out.nearest(out.reduced(asked), len(out.centres))[q] == at).argmax(axis=1)
        reached = np.cumsum(np.bincount(ranks, minlength=len(out.centres))) / len(ranks)
        out.probes = int(min(np.searchsorted(reached, recall) + 1, len(out.centres)))
        out.recall = float(reached[out.probes - 1])
    return out


def _fit(points: DataFrame, queries: DataFrame, size: int, count: int, k: int, recall: float, tables: int, cell: int,
         sample: int, trials: int, most: int, seed: int) -> Tables:
    by_hash = F.xxhash64("v", F.lit(seed))
    some = materialize(points.select("v").orderBy(by_hash, "v").limit(sample), "hash-sample")
    m = max(1, math.ceil(math.log(max(count / cell, 2), BINS)))
    axes = fit_components(some, min(size, 2 * m + 4), size, column="v", settled=1e-2, most_passes=5) if count > 1 else None
    if axes is None:
        return Tables(np.zeros(size), np.zeros((size, 1)), np.zeros((1, 1, BINS - 1)), 1, 1.0)
    m = min(m, axes.axes.shape[1])
    rng = np.random.default_rng(seed)
    turns = [np.linalg.qr(rng.standard_normal((axes.axes.shape[1],) * 2))[0][:, :m] for _ in range(tables)]
    out = Tables(axes.mean, np.hstack([axes.axes @ t for t in turns]), np.zeros((tables, m, BINS - 1)))
    column = _struct(some.toArrow())
    out.cuts = np.moveaxis(np.quantile(out.along(column), np.arange(1, BINS) / BINS, axis=0), 0, -1)
    asked, true, q = _trial(points, queries, k, trials, seed)
    if not len(q):
        return out
    at = out.cells(out.along(true))
    visits = out.visits(out.along(asked), most)
    hits = [visited[q] == at[:, t, None] for t, visited in enumerate(visits)]
    ranks = np.min([np.where(hit.any(axis=1), hit.argmax(axis=1), most) for hit in hits], axis=0)
    steps = [p for p in range(1, most + 1) if (ranks < p).mean() >= recall]
    out.probes = steps[0] if steps else most
    out.recall = float((ranks < out.probes).mean())
    return out


def _placed(df: DataFrame, tables: Tables, keep: list[str], probes: int | None) -> DataFrame:
    """A row per table with its cell, or per visit with ``probes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = tables.along(batch.column(len(keep)))
            if probes is None:
                row, table = (i.ravel() for i in np.indices((len(y), len(tables.cuts))))
                cell = tables.cells(y).ravel()
            else:
                visits = np.stack(tables.visits(y, probes), axis=1)
                row, table = (i.ravel() for i in np.indices(visits.shape)[:2])
                cell = visits.ravel()
            taken = batch.take(pa.array(row))
            yield pa.record_batch([*taken.columns, pa.array(table, pa.int32()), pa.array(cell, pa.int64())], names=[*keep, "v", "t", "cell"])

    schema = df.select(*keep, "v", F.lit(0).alias("t"), F.lit(0).cast("long").alias("cell")).schema
    return df.select(*keep, "v").mapInArrow(run, schema)


def _blocks(df: DataFrame, block: int, name: str) -> DataFrame:
    return df.groupBy("t", "cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(name))


def _block_of(key: str, blocks: str) -> Column:
    return F.pmod(F.xxhash64(key), F.col(blocks)).cast("int")


def _visit_tables(points: DataFrame, asked: DataFrame, fit: Tables, k: int, block: int) -> DataFrame:
    """(qid, dist, n, s) of the k nearest points that each query finds in each block of its cells."""
    held = materialize(_placed(points, fit, ["pid", "n", "s"], None), "hash-held")
    visits = materialize(_placed(asked, fit, ["qid"], fit.probes), "hash-visits")
    # cells that hold points and are visited; both sides in blocks that meet one by one
    cells = materialize(_blocks(held, block, "p_blocks").join(_blocks(visits, block, "q_blocks"), ["t", "cell"]), "hash-cells")
    left = visits.join(cells, ["t", "cell"]).select("qid", "v", "t", "cell", _block_of("qid", "q_blocks").alias("qb"),
                                                     F.explode(F.sequence(F.lit(0), F.col("p_blocks") - 1)).alias("pb"))
    right = held.join(cells, ["t", "cell"]).select("pid", "n", "s", "v", "t", "cell", _block_of("pid", "p_blocks").alias("pb"),
                                                   F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("qb"))

    def search(q: pa.Table, p: pa.Table) -> pa.Table:
        if len(q) and len(p):
            at, near, dist = _closest(_struct(q), _struct(p), k)
        else:
            at, near, dist = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        taken = p.select(["pid", "n", "s"]).take(pa.array(near))
        return pa.table([q.column("qid").take(pa.array(at)), *taken.columns, pa.array(dist)], names=["qid", "pid", "n", "s", "dist"])

    meet = ["t", "cell", "qb", "pb"]
    found = left.groupBy(*meet).cogroup(right.groupBy(*meet)).applyInArrow(
        lambda q, p: search(q, p), "qid long, pid long, n long, s double, dist double")
    # a point may be found in several tables
    once = found.groupBy("qid", "pid").agg(*[F.first(c).alias(c) for c in ("n", "s", "dist")])
    return once.select("qid", "dist", "n", "s")


def knn_hashed(train: DataFrame, queries: DataFrame, size: int, target: str, key: str, k: int = 5, features: str = "features",
               out: str = "predicted", recall: float = 0.97, tables: int = 4, cell: int = 512, block: int = 4096,
               sample: int = 8192, trials: int = 128, most: int = 256, seed: int = 42) -> tuple[DataFrame, Tables | Cells]:
    """(key, prediction, found) of each query, and the tables with the recall measured on the trials.

    The prediction is the mean target of the k nearest points found; equal distances share what weight is left.
    ``found`` is the number of points behind it, NULL predictions have none (no point near the query, or no
    training rows). Directions and cuts come from ``sample`` points, probes (``most`` at most) from ``trials``
    queries searched among all points; every point is placed in all ``tables``, or above ``GRID_POINTS`` distinct
    points in one cell, of which as many are visited as the recall needs. Training rows without a target or
    vector don't count, queries without a vector find nothing, repeated keys have a row each. NaN in a vector isn't
    allowed.
    """
    vector = F.unwrap_udt(F.col(features)).alias("v")
    points = train.where(F.col(target).isNotNull() & F.col(features).isNotNull()).select(vector, F.col(target).cast("double").alias("y"))
    points = points.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"))
    points = materialize(points.withColumn("pid", F.monotonically_increasing_id()), "hash-points")
    rows = queries.select(F.col(key), vector)
    asked = materialize(rows.where("v IS NOT NULL").select("v").distinct().withColumn("qid", F.monotonically_increasing_id()), "hash-queries")
    count = points.count()
    if count > GRID_POINTS:
        fit = _fitted_cells(points, asked, size, count, k, recall, sample, trials, seed)
        found = visit_cells(points, asked, fit, k)
    else:
        fit = _fit(points, asked, size, count, k, recall, tables, cell, sample, trials, most, seed)
        found = _visit_tables(points, asked, fit, k, block)
    levels = found.groupBy("qid", "dist").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    means = levels.groupBy("qid").agg(nearest_mean(k).alias(out), F.least(F.sum("n"), F.lit(k)).cast("long").alias("found"))
    by_vector = asked.join(means, "qid").select(F.col("v").alias("_v"), out, "found")
    both = rows.join(by_vector, F.col("v") == F.col("_v"), "left")
    return both.select(key, out, F.coalesce("found", F.lit(0)).alias("found")), fit
