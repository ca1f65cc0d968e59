import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lotwise.operators.ablation import ablation, refits, sweep, unsweep
from lotwise.operators.gram import grams
from lotwise.operators.impute import chained_impute, fit_chained


def frame(spark, x, names, extra="id long"):
    rows = [(k, *[None if np.isnan(v) else float(v) for v in r]) for k, r in enumerate(x)]
    return spark.createDataFrame(rows, f"{extra}, " + ", ".join(f"{n} double" for n in names))


def some_gaps(n=600, seed=1):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=n)
    x = np.column_stack([a, 3 * a + 0.1 * rng.normal(size=n), rng.normal(size=n), a - 2 + 0.5 * rng.normal(size=n)])
    x[:, 2] += 0.3 * x[:, 1]
    full = x.copy()
    for k, share in ((1, 0.3), (2, 0.1), (3, 0.5)):
        x[rng.random(n) < share, k] = np.nan
    return x, full


def by_rows(x, rounds):
    """Chained regressions over the rows themselves."""
    mean, scale = np.nanmean(x, axis=0), np.nanstd(x, axis=0)
    z, gaps = (x - mean) / scale, np.isnan(x)
    z[gaps] = 0
    for _ in range(rounds):
        for j in sorted((k for k in range(x.shape[1]) if gaps[:, k].any()), key=lambda k: (gaps[:, k].sum(), k)):
            others = np.column_stack([np.ones(len(z)), np.delete(z, j, axis=1)])
            beta = np.linalg.lstsq(others[~gaps[:, j]], z[~gaps[:, j], j], rcond=None)[0]
            z[gaps[:, j], j] = others[gaps[:, j]] @ beta
    return z * scale + mean


def test_cross_products(spark):
    x, _ = some_gaps(200)
    df = frame(spark, x, "abcd").repartition(5).withColumn("k", F.col("id") % 3)
    z = np.column_stack([np.ones(200), np.nan_to_num(x)])
    got = grams(df, [F.col(c) for c in "abcd"], F.col("k"))
    assert sorted(got) == [0, 1, 2]
    for k in range(3):
        assert np.allclose(got[k], z[k::3].T @ z[k::3])
    assert np.allclose(grams(df, [F.col("a")])[0], z[:, :2].T @ z[:, :2]) and grams(df.limit(0), [F.col("a")]) == {}


@pytest.mark.parametrize("rounds", [1, 4])
def test_chained_like_rows(spark, rounds):
    x, full = some_gaps()
    df = frame(spark, x, "abcd")
    rows = chained_impute(df, list("abcd"), rounds=rounds, tolerance=0.0).orderBy("id").collect()
    got = np.array([tuple(r)[1:] for r in rows])
    assert np.allclose(got, by_rows(x, rounds), atol=1e-8)
    assert len(rows) == len(x) and (got[~np.isnan(x)] == x[~np.isnan(x)]).all()


def test_chained_settles_and_beats_the_mean(spark):
    x, full = some_gaps(seed=5)
    df = frame(spark, x, "abcd")
    model = fit_chained(df, list("abcd"))
    assert model.change <= 1e-4 and model.rounds < 30
    got = np.array([tuple(r)[1:] for r in model.transform(df).orderBy("id").collect()])
    gap = np.isnan(x[:, 1])
    assert np.abs(got - full)[gap, 1].mean() < 0.3 * np.abs(np.nanmean(x[:, 1]) - full[gap, 1]).mean()


def test_chained_on_other_rows_and_odd_input(spark):
    x, _ = some_gaps(seed=7)
    df = frame(spark, x, "abcd")
    model = fit_chained(df, list("abcd"))
    new = spark.createDataFrame([(1, None, None, None, None, "x"), (2, None, 1.0, float("nan"), 2.0, "y"), (2, None, 1.0, float("nan"), 2.0, "y")],
                                "id long, a double, b double, c double, d double, `_maps` string")
    rows = model.transform(new.withColumnRenamed("_maps", "note")).collect()
    assert len(rows) == 3 and rows[1] == rows[2] and all(v is not None for r in rows for v in r)
    assert rows[0].a == pytest.approx(np.nanmean(x[:, 0]))
    none = spark.createDataFrame([(1, None), (2, None)], "id long, a double")
    assert [r.a for r in chained_impute(none, ["a"]).collect()] == [0.0, 0.0]
    whole = frame(spark, np.ones((3, 1)), "a")
    assert [r.a for r in chained_impute(whole, ["a"]).collect()] == [1.0] * 3
    assert chained_impute(none.limit(0), ["a"]).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.integers(2, 6), st.integers(0, 10**6))
def test_refits_are_separate_fits(d, seed):
    rng = np.random.default_rng(seed)
    x = np.column_stack([np.ones(40), rng.normal(size=(40, d)) * rng.uniform(0.1, 100, d) + rng.normal(size=d)])
    y = x @ rng.normal(size=d + 1) + rng.normal(size=40)
    z = np.column_stack([x, y])
    fits = refits(z.T @ z)
    for k, w in enumerate(fits):
        kept = [i for i in range(d + 1) if i != k or k == 0]
        want = np.zeros(d + 1)
        want[kept] = np.linalg.lstsq(x[:, kept], y, rcond=None)[0]
        assert np.allclose(x @ w, x @ want, atol=1e-6 * np.abs(y).max())


def test_sweep_and_back():
    a = np.cov(np.random.default_rng(1).normal(size=(4, 50)))
    assert np.allclose(unsweep(sweep(a, 2), 2), a)
    b = a
    for k in range(4):
        b = sweep(b, k)
    assert np.allclose(-b, np.linalg.inv(a))


def test_ablation_on_rows(spark):
    x, full = some_gaps(seed=9)
    y = full[:, 0] * 2 + full[:, 2] + 0.1 * np.random.default_rng(2).normal(size=len(full))
    df = frame(spark, np.column_stack([full, full[:, 0], y]), ["a", "b", "c", "d", "twin", "y"])
    train, test = df.where("id < 400"), df.where("id >= 400")
    got = {r.feature: r for r in ablation(train, test, ["a", "b", "c", "d"], "y").collect()}
    z, t = np.column_stack([np.ones(400), full[:400]]), np.column_stack([np.ones(200), full[400:]])
    for k, f in enumerate("abcd", 1):
        kept = [i for i in range(5) if i != k]
        error = y[400:] - t[:, kept] @ np.linalg.lstsq(z[:, kept], y[:400], rcond=None)[0]
        assert got[f].rmse_without == pytest.approx(np.sqrt((error**2).mean()))
        assert got[f].r2_without == pytest.approx(1 - (error**2).sum() / ((y[400:] - y[400:].mean()) ** 2).sum())
    twins = ablation(train, test, ["a", "twin", "c"], "y").collect()
    assert all(abs(r.r2_loss) < 1e-9 for r in twins if r.feature != "c")
    empty = ablation(train, test.limit(0), ["a"], "y").first()
    assert empty.r2 is None and empty.r2_loss is None
