"""Ablation by refit: what a linear model loses when it is fitted without one of its inputs.

The cross products of the training part hold all these fits. Sweeping every input in gives the full fit;
sweeping one out again gives the fit without it, with no further pass over the rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from lotwise.operators.gram import grams


def sweep(a: np.ndarray, k: int) -> np.ndarray:
    """The sweep operator on pivot ``k``; a second sweep of the same pivot (with the other sign) undoes it."""
    pivot = a[k, k]
    row, column = a[k].copy(), a[:, k].copy()
    out = a - np.outer(column, row) / pivot
    out[k] = row / pivot
    out[:, k] = column / pivot
    out[k, k] = -1.0 / pivot
    return out


def unsweep(a: np.ndarray, k: int) -> np.ndarray:
    pivot = a[k, k]
    row, column = a[k].copy(), a[:, k].copy()
    out = a - np.outer(column, row) / pivot
    out[k] = -row / pivot
    out[:, k] = -column / pivot
    out[k, k] = -1.0 / pivot
    return out


def refits(train: np.ndarray) -> list[np.ndarray]:
    """Weights (constant, inputs) of the full fit and of the fit without each input, from [1, x, y] cross products.

    An input that others determine (its pivot vanishes) has weight 0, until one of these is left out.
    """
    d = len(train) - 1
    scale = np.sqrt(np.maximum(np.diag(train), 1e-300))
    a = train / np.outer(scale, scale)
    used = []
    for k in range(d):
        if a[k, k] > 1e-10:
            a = sweep(a, k)
            used.append(k)

    def weights(m: np.ndarray, kept: list[int]) -> np.ndarray:
        out = np.zeros(d)
        out[kept] = m[kept, d]
        return out * scale[d] / scale[:d]

    out = [weights(a, used)]
    for k in range(1, d):
        if k not in used:
            out.append(out[0])
            continue
        m, kept = unsweep(a, k), [u for u in used if u != k]
        for spare in set(range(d)) - set(used):
            if m[spare, spare] > 1e-10:
                m = sweep(m, spare)
                kept.append(spare)
        out.append(weights(m, kept))
    return out


def ablation(train: DataFrame, test: DataFrame, features: list[str], target: str) -> DataFrame:
    """(feature, r2, rmse, r2_without, rmse_without, r2_loss, rmse_growth) on ``test``, the largest loss first.

    Two aggregates, one for each part; rows with a NULL or NaN among the inputs or the target take no part.
    """
    columns = [*features, target]

    def cross(df: DataFrame) -> np.ndarray:
        whole = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
        return grams(whole, [F.col(c) for c in columns]).get(0, np.zeros((len(columns) + 1,) * 2))

    fits, seen = refits(cross(train)), cross(test)
    n, y = seen[0, 0], len(columns)
    total = seen[y, y] - seen[0, y] ** 2 / n if n else 0.0

    def quality(w: np.ndarray) -> tuple[float | None, float | None]:
        if not n:
            return None, None
        v = np.append(w, -1.0)
        error = max(float(v @ seen @ v), 0.0)
        return (float(1 - error / total) if total > 0 else None), float(np.sqrt(error / n))

    r2, rmse = quality(fits[0])
    rows = []
    for f, w in zip(features, fits[1:]):
        one, two = quality(w)
        rows.append((f, r2, rmse, one, two, None if one is None or r2 is None else r2 - one, None if two is None else two - rmse))
    schema = "feature string, r2 double, rmse double, r2_without double, rmse_without double, r2_loss double, rmse_growth double"
    return train.sparkSession.createDataFrame(rows, schema).orderBy(F.desc("r2_loss"), "feature")
