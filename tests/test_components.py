import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from lotwise.operators.components import fit_components
from lotwise.operators.training import prepare
from lotwise.plans.common import builder


def exact(x, k):
    """(mean, axes, variances) from the dense rows."""
    mean = np.nanmean(x, axis=0)
    z = np.where(np.isnan(x), 0, x - mean)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    return mean, vt[:k].T, s[:k] ** 2 / (len(x) - 1), (z ** 2).sum() / (len(x) - 1)


def frame(spark, x, parts=3, dense=lambda k: k % 4 == 0):
    vector = lambda r: Vectors.sparse(len(r), [(int(j), float(r[j])) for j in np.flatnonzero(r)])
    rows = [(k, Vectors.dense(r) if dense(k) else vector(r)) for k, r in enumerate(x)]
    return spark.createDataFrame(rows, ["id", "features"]).repartition(parts)


def some_rows(n=400, d=30, seed=3):
    rng = np.random.default_rng(seed)
    x = (rng.random((n, d)) < 0.15) * rng.normal(size=(n, d)) + 0.0
    x[:, :4] += rng.normal(size=(n, 1)) * [5, 3, 0, -4] + [100, 0, 2, 0]
    x[:, 5] += 3 * rng.normal(size=n)
    return x


@pytest.mark.parametrize("parts", [1, 7])
def test_equals_the_dense_decomposition(spark, parts):
    x = some_rows()
    mean, axes, variances, total = exact(x, 3)
    got = fit_components(frame(spark, x, parts), 3, x.shape[1])
    assert np.allclose(got.mean, mean) and got.total_variance == pytest.approx(total)
    assert np.allclose(got.variances, variances, rtol=1e-7)
    assert np.allclose(np.abs(got.axes.T @ axes), np.eye(3), atol=1e-4)
    assert np.allclose(got.axes.T @ got.axes, np.eye(3), atol=1e-10)
    assert (got.axes[np.abs(got.axes).argmax(axis=0), range(3)] > 0).all()


def test_rows_along_the_axes(spark):
    x = some_rows(50)
    df = frame(spark, x)
    got = fit_components(df, 2, x.shape[1])
    rows = {r["id"]: r["components"] for r in got.transform(df, ["id"]).collect()}
    want = (x - got.mean) @ got.axes
    assert len(rows) == 50 and all(np.allclose(rows[k], want[k]) for k in rows)


def test_gaps_absent_vectors_and_repeated_rows(spark):
    x = some_rows(60, 6)
    x[::7, 1] = np.nan
    x[5:15] = x[5]
    df = frame(spark, x).unionByName(spark.createDataFrame([(100, None)], frame(spark, x).schema))
    mean, axes, variances, total = exact(x, 2)
    got = fit_components(df, 2, 6)
    assert np.allclose(got.mean, mean) and np.allclose(got.variances, variances) and got.total_variance == pytest.approx(total)
    rows = {r["id"]: r["components"] for r in got.transform(df, ["id"]).collect()}
    assert rows[100] is None and len(rows) == 61


def test_fewer_directions_than_asked(spark):
    flat = np.outer(np.arange(5.0), [1, 2, 0, 0])
    got = fit_components(frame(spark, flat), 3, 4)
    assert np.allclose(got.variances, [12.5, 0, 0], atol=1e-9) and np.allclose(got.shares, [1, 0, 0])
    same = fit_components(frame(spark, np.ones((4, 3))), 2, 3)
    assert np.allclose(same.variances, 0) and np.allclose(same.shares, 0)


def test_too_few_rows_and_wrong_sizes_raise(spark):
    df = frame(spark, np.ones((3, 2)))
    with pytest.raises(ValueError, match="two rows"):
        fit_components(df.limit(0), 1, 2)
    with pytest.raises(ValueError, match="components of"):
        fit_components(df, 3, 2)
    with pytest.raises(ValueError, match="task should hold"):
        fit_components(df, 1, 10**7)


def test_all_nine_text_columns(spark, raw):
    """The encoded listings, all slots, against numpy on the dense matrix."""
    d = prepare(raw, builder())
    x = np.array([r["features"].toArray() for r in d.train.select("features").collect()])
    got = fit_components(d.train, 4, len(d.encoder.names))
    _, axes, variances, total = exact(x, 4)
    assert x.shape[1] == len(d.encoder.names) > 50
    assert got.total_variance == pytest.approx(total) and np.allclose(got.variances, variances, rtol=1e-6)
    assert np.linalg.norm(axes - got.axes @ (got.axes.T @ axes)) < 1e-3
