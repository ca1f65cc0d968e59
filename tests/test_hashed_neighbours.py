import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lotwise.operators.hashed_neighbours import _nearest_cells, _nearest_of_rows, knn_hashed
from tests.test_neighbours import brute



def wide(n, seed, d=60):
    """Points on a few words and numbers, some of them copies."""
    rng = np.random.default_rng(seed)
    x = np.zeros((n, d))
    x[:, :4] = rng.normal(size=(n, 1)) * [2, 1, 1, 0.5] + 0.3 * rng.normal(size=(n, 4))
    for first in (4, 24, 44):
        x[np.arange(n), first + np.minimum(rng.geometric(0.3, n), 15)] = 1
    x[n // 2:n // 2 + n // 6] = x[n // 2]
    return x


def vectors(spark, x, y=None):
    sparse = [Vectors.sparse(len(r), [(int(j), float(r[j])) for j in np.flatnonzero(r)]) for r in x]
    if y is None:
        return spark.createDataFrame([(i, v) for i, v in enumerate(sparse)], ["id", "features"])
    return spark.createDataFrame([(i, v, float(t)) for i, (v, t) in enumerate(zip(sparse, y))], ["id", "features", "y"])


def test_cells_come_nearest_first():
    rng = np.random.default_rng(2)
    gap = rng.random((3, 4))
    gap[np.arange(3), [1, 0, 3]] = 0
    total = {sum(int(b) * 4 ** d for d, b in enumerate(at)): sum(gap[d, b] for d, b in enumerate(at)) for at in np.ndindex(4, 4, 4)}
    found = _nearest_cells(gap, 64)
    assert sorted(found) == sorted(total)
    assert [total[c] for c in found] == pytest.approx(sorted(total.values()))
    assert _nearest_cells(gap, 7) == found[:7]


def test_all_cells_give_the_exact_mean(spark):
    """With a recall of one and every cell visited the result is brute force's; crowded cells are dealt in blocks."""
    x, q = wide(300, 1), np.vstack([wide(40, 2), wide(300, 1)[:20]])
    y = np.random.default_rng(3).normal(size=len(x))
    out, fit = knn_hashed(vectors(spark, x, y), vectors(spark, q), 60, "y", "id", recall=1.01, cell=20, block=7, most=64)
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == len(q) and fit.probes == 64
    for i, row in enumerate(q):
        assert got[i]["predicted"] == pytest.approx(brute(x, y, row, 5), rel=1e-7) and got[i]["found"] == 5


def test_recall_against_brute_force(spark):
    x, q = wide(6000, 4), wide(200, 5)
    y = x[:, 0] + np.random.default_rng(6).normal(size=len(x)) * 0.1
    out, fit = knn_hashed(vectors(spark, x, y), vectors(spark, q), 60, "y", "id", cell=128)
    got = np.array([r["predicted"] for r in out.orderBy("id").collect()])
    want = np.array([brute(x, y, row, 5) for row in q])
    assert fit.recall >= 0.97 and fit.probes < 4 ** fit.cuts.shape[1]
    assert (np.abs(got - want) < 1e-7).mean() >= 0.85  # all five neighbours the same
    assert np.abs(got - want).mean() < 0.02


def test_nulls_repeats_and_empty_tables(spark):
    x = wide(50, 7)
    y = np.arange(50.0)
    train = vectors(spark, x, y)
    train = train.unionByName(train.where("id < 3").withColumn("y", F.lit(None).cast("double"))).unionByName(train.limit(1).withColumn("features", F.lit(None).cast(train.schema["features"].dataType)))
    asked = vectors(spark, x[:4])
    asked = asked.unionByName(asked.where("id = 1")).unionByName(asked.where("id = 0").withColumn("features", F.lit(None).cast(asked.schema["features"].dataType)))
    out, _ = knn_hashed(train, asked, 60, "y", "id", k=1, recall=1.01)
    got = sorted((r["id"], r["predicted"] is None, r["found"]) for r in out.collect())
    assert got == [(0, False, 1), (0, True, 0), (1, False, 1), (1, False, 1), (2, False, 1), (3, False, 1)]
    assert knn_hashed(train, asked.limit(0), 60, "y", "id")[0].count() == 0
    none = knn_hashed(train.limit(0), asked, 60, "y", "id")[0].collect()
    assert len(none) == 6 and all(r["predicted"] is None and r["found"] == 0 for r in none)


def test_cells_of_many_rows_at_once():
    """Rows of a batch get the cells that each gets alone, equal sums in the order of their steps."""
    rng = np.random.default_rng(9)
    gap = np.round(rng.random((50, 5, 4)), 1)
    gap[:, :, 1] = 0
    found = _nearest_of_rows(gap, 40)
    assert found.shape == (50, 40)
    for one, cells in zip(gap, found.tolist()):
        order = np.argsort(one, axis=1, kind="stable")
        steps = sorted(np.ndindex(*[4] * 5), key=lambda at: (sum(one[d, order[d, b]] for d, b in enumerate(at)), at))
        assert cells == [sum(int(order[d, b]) * 4 ** d for d, b in enumerate(at)) for at in steps[:40]]
    assert _nearest_of_rows(gap[:0], 3).shape == (0, 3)
