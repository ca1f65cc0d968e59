import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.operators.neighbours import knn_fill, knn_predict


def brute(points, target, query, k):
    d = np.zeros(len(points))
    for j in range(points.shape[1]):
        d += (query[j] - points[:, j]) ** 2
    d = np.sqrt(d)
    left, total = min(k, len(d)), 0.0
    size = left
    for v in np.unique(d):
        at = target[d == v]
        use = min(left, len(at))
        total += use * at.mean()
        left -= use
        if not left:
            break
    return total / size


@pytest.mark.parametrize("block,k", [(10**6, 5), (20, 5), (20, 1), (7, 60)])
def test_equals_brute_force(spark, block, k):
    rng = np.random.default_rng(1)
    p = np.vstack([rng.normal(0, 1, (150, 3)), np.repeat([[0.5, 0.5, 0.5]], 100, 0), rng.normal(8, 0.1, (50, 3)), np.round(rng.normal(0, 2, (100, 3)))])
    y = rng.normal(0, 1, len(p))
    q = np.vstack([rng.normal(0, 3, (40, 3)), np.repeat([[0.5, 0.5, 0.4]], 60, 0), p[:10], [[100.0, -50.0, 3.0]]])
    train = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(p, y)], "a double, b double, c double, y double")
    asked = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(q)], "id int, a double, b double, c double")
    out = knn_predict(train, asked, ["a", "b", "c"], "y", k, block=block)
    got = {r["id"]: r["predicted"] for r in out.collect()}
    assert len(got) == len(q)
    for i, row in enumerate(q):
        assert got[i] == pytest.approx(brute(p, y, row, k), rel=1e-9, abs=1e-12)


def test_fill(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 3.0), (10.0, 9.0), (0.5, None)], "a double, v double")
    out = knn_fill(df, "v", ["a"], k=2).where(F.col("a") == 0.5).first()
    assert out["v"] == 2.0
