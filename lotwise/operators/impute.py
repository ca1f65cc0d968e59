"""Chained imputation: each column with gaps is regressed on all others, round after round.

Columns are standardised and gaps start at the mean. What a gap holds after any number of rounds is then a
linear function of the row's known values, the same for all rows with the same gaps. So one aggregate (cross
products for each pattern of gaps) is all the data the rounds need; they run on small matrices.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from lotwise.operators.gram import grams

#: Patterns are at most 2 to the number of columns with gaps; 12 such columns always fit.
MOST_PATTERNS = 4096


def _value(name: str) -> Column:
    return F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(None).cast("double"))


@dataclass
class ChainedImputer:
    """Fitted rounds: ``steps`` are (column number, weights over the constant and all columns) in order."""

    columns: list[str]
    means: np.ndarray
    scales: np.ndarray
    steps: list[tuple[int, np.ndarray]] = field(default_factory=list)
    rounds: int = 0
    change: float = 0.0

    def _z(self) -> list[Column]:
        return [(_value(c) - float(m)) / float(s) for c, m, s in zip(self.columns, self.means, self.scales)]

    def _pattern(self) -> Column:
        bits = [F.when(_value(c).isNull(), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, c in enumerate(self.columns)]
        return sum(bits[1:], bits[0])

    def maps(self, patterns: list[int]) -> np.ndarray:
        """For each pattern the linear map from (1, known values with 0 in the gaps) to the filled row."""
        d = len(self.columns) + 1
        out = np.repeat(np.eye(d)[None], len(patterns), axis=0)
        gaps = np.array([[p >> k & 1 for k in range(d - 1)] for p in patterns], dtype=bool).reshape(len(patterns), d - 1)
        for j, weights in self.steps:
            out[gaps[:, j], j + 1] = np.einsum("i,pik->pk", weights, out[gaps[:, j]])
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the gaps of the columns filled; rows, their order of columns and known values stay.

        A column that had no gaps in fitting gets its mean. NaN is a gap. A column without any known value in
        fitting stays 0.
        """
        pattern = self._pattern()
        patterns = sorted(r[0] for r in df.select(pattern.alias("p")).distinct().limit(MOST_PATTERNS + 1).collect())
        if len(patterns) > MOST_PATTERNS:
            raise ValueError(f"more than {MOST_PATTERNS} patterns of gaps: impute at most 12 columns with gaps at a time")
        maps = self.maps(patterns)
        table = df.sparkSession.createDataFrame([(int(p), m[1:].tolist()) for p, m in zip(patterns, maps)], "_pattern long, _maps array<array<double>>")
        z = F.array(F.lit(1.0), *[F.coalesce(v, F.lit(0.0)) for v in self._z()])
        rows = df.withColumns({"_gaps": pattern, "_z": z}).join(F.broadcast(table), F.col("_gaps") == F.col("_pattern"))
        filled = {}
        for k, (c, m, s) in enumerate(zip(self.columns, self.means, self.scales)):
            value = F.aggregate(F.zip_with(F.col("_maps")[k], F.col("_z"), lambda w, v: w * v), F.lit(0.0), lambda a, v: a + v)
            filled[c] = F.coalesce(_value(c), value * float(s) + float(m))
        return rows.select(*[filled[c].alias(c) if c in filled else F.col(f"`{c}`") for c in df.columns])


def fit_chained(df: DataFrame, columns: list[str], rounds: int = 30, tolerance: float = 1e-4) -> ChainedImputer:
    """Fits until no weight of any pattern's map moves by more than ``tolerance``, for ``rounds`` at most.

    A round goes through the columns with gaps by rising number of gaps and regresses each, on the rows that
    have it, on all others as they are filled by then (least squares, constant included).
    """
    stats = df.agg(*[a for k, c in enumerate(columns) for a in (
        F.avg(_value(c)).alias(f"m{k}"), F.stddev_pop(_value(c)).alias(f"s{k}"), F.count_if(_value(c).isNull()).alias(f"n{k}"))]).first()
    means = np.array([stats[f"m{k}"] or 0.0 for k in range(len(columns))])
    scales = np.array([stats[f"s{k}"] or 1.0 for k in range(len(columns))])
    model = ChainedImputer(list(columns), means, scales)
    gaps = [stats[f"n{k}"] or 0 for k in range(len(columns))]
    order = sorted((k for k, n in enumerate(gaps) if n), key=lambda k: (gaps[k], k))
    if not order:
        return model
    by_pattern = grams(df, model._z(), model._pattern())
    if len(by_pattern) > MOST_PATTERNS:
        raise ValueError(f"{len(by_pattern)} patterns of gaps, more than {MOST_PATTERNS}: impute at most 12 columns with gaps at a time")
    patterns = sorted(by_pattern)
    sums = np.stack([by_pattern[p] for p in patterns])
    d = len(columns) + 1
    maps = np.repeat(np.eye(d)[None], len(patterns), axis=0)
    missing = np.array([[p >> k & 1 for k in range(d - 1)] for p in patterns], dtype=bool)
    for model.rounds in range(1, rounds + 1):
        before = maps.copy()
        for j in order:
            known = ~missing[:, j]
            total = np.einsum("pik,pkl,pjl->ij", maps[known], sums[known], maps[known], optimize=True) if known.any() else np.zeros((d, d))
            others = [i for i in range(d) if i != j + 1]
            weights = np.zeros(d)
            weights[others] = np.linalg.pinv(total[np.ix_(others, others)], rcond=1e-10, hermitian=True) @ total[others, j + 1]
            model.steps.append((j, weights))
            maps[~known, j + 1] = np.einsum("i,pik->pk", weights, maps[~known])
        model.change = float(np.abs(maps - before).max())
        if model.change <= tolerance:
            break
    return model


def chained_impute(df: DataFrame, columns: list[str], rounds: int = 30, tolerance: float = 1e-4, train: DataFrame | None = None) -> DataFrame:
    """Fills the gaps of ``columns`` from each other, fitted on ``train`` (or on ``df``)."""
    return fit_chained(df if train is None else train, columns, rounds, tolerance).transform(df)
