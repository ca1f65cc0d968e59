import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.operators.quantiles import exact_quantiles, medians, quantile_table

PROBS = [0.0, 0.1, 0.5, 0.999, 1.0]


def skewed(spark, n=5000, seed=3):
    """A third of the rows share one value and one group; signs, tiny and huge values, NULLs."""
    rng = np.random.default_rng(seed)
    v = np.concatenate([np.full(n // 3, 42.0), rng.normal(0, 1e-3, n // 3), rng.lognormal(10, 3, n - 2 * (n // 3)) * rng.choice([-1, 1], n - 2 * (n // 3))])
    g = np.array(["hot"] * (n // 2) + [f"g{i % 7}" for i in range(n - n // 2)], dtype=object)
    g[::97] = None
    rows = [(i, gg, None if i % 31 == 0 else float(x)) for i, (gg, x) in enumerate(zip(g, v))]
    return rows, spark.createDataFrame(rows, "id long, g string, v double")


@pytest.mark.parametrize("size", [50, 5000, 40000])
def test_equals_numpy_overall(spark, size):
    rows, df = skewed(spark, size)
    values = np.array([r[2] for r in rows if r[2] is not None])
    got = quantile_table(df, {"v": F.col("v"), "w": -F.col("v")}, PROBS)
    assert got["v"] == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-12, abs=1e-15)
    assert got["w"] == pytest.approx(np.quantile(-values, PROBS).tolist(), rel=1e-12, abs=1e-15)


@pytest.mark.parametrize("size", [50, 5000, 40000])
def test_equals_numpy_per_group(spark, size):
    rows, df = skewed(spark, size)
    got = {(r["g"], r["prob"]): r["value"] for r in exact_quantiles(df, {"v": F.col("v")}, PROBS, by=("g",)).collect()}
    for g in {r[1] for r in rows}:
        values = [r[2] for r in rows if r[1] == g and r[2] is not None]
        found = [got[(g, p)] for p in PROBS]
        if values:
            assert found == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-12, abs=1e-15)
        else:
            assert found == [None] * len(PROBS)


def test_all_null_and_single(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert medians(df, {"v": F.col("v")}) == {"v": None}
    one = spark.createDataFrame([(7.5,)], "v double")
    assert medians(one, {"v": F.col("v")}) == {"v": 7.5}


def test_nan_empty_groups_and_tiny_values(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", 1.0), ("a", nan), ("a", 3.0), ("a", None), ("b", None), ("b", nan), (None, 5e-7), (None, 3e-9), (None, -2e-8), ("c", inf), ("c", inf), ("c", -inf)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["prob"]): r["value"] for r in exact_quantiles(df, {"v": F.col("v")}, [0.5, 1.0], by=("g",)).collect()}
    assert got == {("a", 0.5): 2.0, ("a", 1.0): 3.0, ("b", 0.5): None, ("b", 1.0): None, (None, 0.5): 3e-9, (None, 1.0): 5e-7, ("c", 0.5): inf, ("c", 1.0): inf}
    assert exact_quantiles(df.limit(0), {"v": F.col("v")}, [0.5], by=("g",)).count() == 0


def test_many_tiny_distinct_values(spark):
    df = spark.range(60_000).select((F.col("id") * 1e-12).alias("v"))
    got = quantile_table(df, {"v": F.col("v")}, [0.25, 0.5, 0.9])["v"]
    assert got == pytest.approx([14999.75e-12, 29999.5e-12, 53999.1e-12], rel=1e-12)
