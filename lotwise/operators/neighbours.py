"""Exact k-nearest-neighbour regression by space partitioning.

Equal points collapse to one row first, so copies cost nothing. A grid over the first columns, cut at
approximate quantiles, splits the rest into cells; its boxes are few and known to every task. Round one
searches one cell per query and yields a radius; round two searches only the cells whose box reaches
into that radius. A crowded cell is salted into blocks on both sides, each block is searched by itself
and the block results merge, so no task holds more than one block of points and queries, and a query
and a point meet only inside a block. Equal distances share the remaining weight evenly, which makes
the result independent of order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lotwise.sources.scratch import materialize

GRID_COLUMNS = 3
#: Distances that agree to so many digits are equal.
DIGITS = 9
_SLACK = 1e-9  # keeps a box that touches the radius in spite of rounding


@dataclass
class Boxes:
    cell: np.ndarray    # cell number
    rows: np.ndarray    # distinct points
    weight: np.ndarray  # points with copies
    low: np.ndarray
    high: np.ndarray

    def nearest(self, x: np.ndarray) -> np.ndarray:
        gap = np.maximum(np.maximum(self.low[None] - x[:, None], x[:, None] - self.high[None]), 0.0)
        return np.sqrt((gap * gap).sum(-1))

    def farthest(self, x: np.ndarray) -> np.ndarray:
        gap = np.maximum(np.abs(x[:, None] - self.low[None]), np.abs(x[:, None] - self.high[None]))
        return np.sqrt((gap * gap).sum(-1))


def _cell(features: list[str], bounds: list[list[float]]) -> Column:
    out = F.lit(0)
    for name, cuts in zip(features, bounds):
        if cuts:
            out = out * (len(cuts) + 1) + F.size(F.filter(F.lit(cuts), lambda b: b <= F.col(name)))
    return out.cast("int")


def _grid(points: DataFrame, features: list[str], rows: int, block: int) -> list[list[float]]:
    used = features[:GRID_COLUMNS]
    bins = min(64, math.ceil((rows / block) ** (1 / len(used))))
    if bins < 2:
        return [[] for _ in used]
    probs = [i / bins for i in range(1, bins)]
    row = points.agg(*[F.percentile_approx(c, probs, 10_000).alias(c) for c in used]).first()
    return [sorted(set(row[c])) for c in used]


def _boxes(points: DataFrame, features: list[str]) -> Boxes:
    aggs = [f(c).alias(f"{n}_{c}") for n, f in (("lo", F.min), ("hi", F.max)) for c in features]
    # one row per grid cell
    pdf = points.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("weight"), *aggs).orderBy("cell").toPandas()
    return Boxes(pdf["cell"].to_numpy(), pdf["rows"].to_numpy(), pdf["weight"].to_numpy(),
                 pdf[[f"lo_{c}" for c in features]].to_numpy(float), pdf[[f"hi_{c}" for c in features]].to_numpy(float))


def _parts(pdf: pd.DataFrame, boxes: Boxes) -> Iterator[pd.DataFrame]:
    """Slices small enough for a query-by-box matrix."""
    step = max(1, 2_000_000 // max(1, len(boxes.cell)))
    for at in range(0, len(pdf), step):
        yield pdf.iloc[at:at + step].reset_index(drop=True)


def _first_cells(boxes: Boxes, k: int):
    """Per query the box with at least k points that is surely closest; else any box, the radius is then open."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enough = boxes.weight >= k
        for pdf in batches:
            for part in _parts(pdf, boxes):
                far = boxes.farthest(np.stack(part["x"].to_numpy()))
                far = np.where(enough[None], far, np.inf) if enough.any() else far
                yield pd.DataFrame({"x": part["x"], "cell": boxes.cell[far.argmin(1)]})
    return run


def _other_cells(boxes: Boxes):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in _parts(pdf, boxes):
                near = boxes.nearest(np.stack(part["x"].to_numpy()))
                reach = near <= part["radius"].to_numpy(float)[:, None] * (1 + _SLACK) + _SLACK
                reach &= boxes.cell[None] != part["cell"].to_numpy()[:, None]
                q, b = np.nonzero(reach)
                yield pd.DataFrame({"x": part["x"].iloc[q].reset_index(drop=True), "cell": boxes.cell[b]})
    return run


def _search(features: list[str], k: int):
    """Within one block: per query the smallest distances with their point count and target sum, k points in all."""
    def run(queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"x": [], "dist": [], "n": [], "s": []}
        if len(queries) and len(points):
            p = points[features].to_numpy(float)
            n, s = points["n"].to_numpy(), points["s"].to_numpy(float)
            step = max(1, 4_000_000 // len(p))
            xs = np.stack(queries["x"].to_numpy())
            for at in range(0, len(xs), step):
                chunk = xs[at:at + step]
                dist = np.zeros((len(chunk), len(p)))
                for j in range(p.shape[1]):
                    dist += (chunk[:, j, None] - p[None, :, j]) ** 2
                dist = np.round(np.sqrt(dist), DIGITS)
                width = min(k, len(p))
                limit = np.partition(dist, width - 1, axis=1)[:, width - 1]
                for i, row in enumerate(dist):
                    near = np.nonzero(row <= limit[i])[0]
                    value, group = np.unique(row[near], return_inverse=True)
                    count, total = np.bincount(group, n[near]), np.bincount(group, s[near])
                    keep = np.cumsum(count) - count < k
                    size = int(keep.sum())
                    out["x"] += [chunk[i]] * size
                    out["dist"] += value[keep].tolist()
                    out["n"] += count[keep].astype(int).tolist()
                    out["s"] += total[keep].tolist()
        types = {"dist": "float64", "n": "int64", "s": "float64"}
        return pd.DataFrame({"x": pd.Series([v.tolist() for v in out["x"]], dtype=object), **{c: pd.Series(out[c], dtype=t) for c, t in types.items()}})
    return run


def _blocks(size: dict[int, int], block: int) -> Column:
    """Number of blocks of a row's cell; cells of one block are not listed."""
    many = {c: math.ceil(n / block) for c, n in size.items() if n > block}
    if not many:
        return F.lit(1)
    table = F.create_map(*[F.lit(v) for pair in many.items() for v in pair])
    return F.coalesce(table[F.col("cell")], F.lit(1))


def _search_all(wanted: DataFrame, points: DataFrame, boxes: Boxes, features: list[str], k: int, block: int) -> DataFrame:
    """Search every (query, cell) pair; both sides are salted to blocks and meet on (cell, block, block)."""
    asked = {r["cell"]: r["count"] for r in wanted.groupBy("cell").count().collect()}  # one row per cell
    held = dict(zip(boxes.cell.tolist(), boxes.rows.tolist()))
    q_blocks, p_blocks = _blocks(asked, block), _blocks(held, block)
    queries = wanted.select("x", "cell", F.pmod(F.xxhash64("x"), q_blocks).cast("int").alias("qb"),
                            F.explode(F.sequence(F.lit(0), p_blocks - 1)).alias("pb"))
    sides = points.select(*features, "n", "s", "cell", F.pmod(F.xxhash64(*features), p_blocks).cast("int").alias("pb"),
                          F.explode(F.sequence(F.lit(0), q_blocks - 1)).alias("qb"))
    keys = ["cell", "qb", "pb"]
    return queries.groupBy(*keys).cogroup(sides.groupBy(*keys)).applyInPandas(
        _search(features, k), "x array<double>, dist double, n long, s double")


def nearest_mean(k: int) -> Column:
    """Over rows (dist, n, s), one for each distance of a query: mean of the first k points, the last distance in part."""
    ranked = F.array_sort(F.collect_list(F.struct("dist", "n", "s")))
    start = F.struct(F.lit(0).cast("bigint").alias("c"), F.lit(0.0).alias("t"))
    return F.aggregate(
        ranked, start,
        lambda acc, e: F.struct(
            F.least(acc["c"] + e["n"], F.lit(k).cast("bigint")).alias("c"),
            (acc["t"] + F.least(e["n"], F.lit(k) - acc["c"]) * e["s"] / e["n"]).alias("t")),
        lambda acc: F.try_divide(acc["t"], acc["c"]))


def knn_predict(train: DataFrame, queries: DataFrame, features: list[str], target: str, k: int = 5, out: str = "predicted",
                block: int = 20_000) -> DataFrame:
    """Mean target of the k nearest training rows (Euclidean, on columns already scaled and filled)."""
    x = F.array(*[F.col(c).cast("double") for c in features])
    cast = [F.col(c).cast("double").alias(c) for c in features]
    points = materialize(train.where(F.col(target).isNotNull()).select(*cast, target).groupBy(*features).agg(
        F.count(F.lit(1)).alias("n"), F.sum(target).alias("s")), "knn-points")
    bounds = _grid(points, features, points.count(), block)
    points = points.withColumn("cell", _cell(features, bounds))
    boxes = _boxes(points, features)
    asked = queries.select(x.alias("x")).distinct()
    first = materialize(asked.mapInPandas(_first_cells(boxes, k), "x array<double>, cell int"), "knn-first")
    found = materialize(_search_all(first, points, boxes, features, k, block), "knn-found")
    # the radius: distance of the k-th point found so far, open while there are fewer than k
    nearest = F.array_sort(F.collect_list(F.struct("dist", "n")))
    radius = F.aggregate(
        nearest, F.struct(F.lit(0).cast("bigint").alias("c"), F.lit(float("inf")).alias("r")),
        lambda acc, e: F.struct((acc["c"] + e["n"]).alias("c"),
                                F.when((acc["c"] < k) & (acc["c"] + e["n"] >= k), e["dist"]).otherwise(acc["r"]).alias("r")),
        lambda acc: acc["r"])
    radii = found.groupBy("x").agg(radius.alias("radius")).join(first, "x")
    more = materialize(radii.mapInPandas(_other_cells(boxes), "x array<double>, cell int"), "knn-more")
    rest = _search_all(more, points, boxes, features, k, block)
    both = found.unionByName(rest).groupBy("x", "dist").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    table = both.groupBy(F.col("x").alias("_x")).agg(nearest_mean(k).alias(out))
    return queries.withColumn("_q", x).join(table, F.col("_q") == F.col("_x"), "left").drop("_q", "_x")


def knn_fill(df: DataFrame, column: str, features: list[str], k: int = 5, block: int = 20_000) -> DataFrame:
    """Fill NULLs of a column with the mean of the k nearest rows that have it."""
    known, unknown = df.where(F.col(column).isNotNull()), df.where(F.col(column).isNull())
    filled = knn_predict(known, unknown, features, column, k, "_filled", block)
    return known.unionByName(filled.withColumn(column, F.col("_filled")).drop("_filled"))
