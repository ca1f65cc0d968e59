import numpy as np
import pandas as pd
import pytest

from lotwise.operators.ranks import average_ranks, rank_correlations


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(3)
    x = rng.normal(size=700)
    return pd.DataFrame({"a": x, "b": np.round(x**3 + rng.normal(size=700)), "c": rng.integers(0, 4, 700).astype(float), "flat": 2.0})


def frame(spark, values):
    rows = [(i, *[None if v is None or (np.isnan(v) and i % 2) else float(v) for v in r]) for i, r in enumerate(values.itertuples(index=False))]
    return spark.createDataFrame(rows, "listing_id long, " + ", ".join(f"{c} double" for c in values.columns)).repartition(6)


def test_average_ranks(spark, values):
    values = values.copy()
    values.loc[::9, "b"] = np.nan
    got = average_ranks(frame(spark, values), ["a", "b", "c"], "listing_id").toPandas().pivot(index="key", columns="name", values="rank")
    want = values.rank()
    for c in "abc":
        known = want[c].dropna()
        assert got[c].dropna().sort_index().to_numpy() == pytest.approx(known.to_numpy())


def test_all_pairs(spark, values):
    got = {(r.column_a, r.column_b): (r.rows, r.spearman) for r in rank_correlations(frame(spark, values), list(values.columns)).collect()}
    assert len(got) == 6
    for (a, b), (n, r) in got.items():
        assert n == 700 and (r is None if "flat" in (a, b) else r == pytest.approx(values[a].rank().corr(values[b].rank())))


def test_gaps_are_left_out_of_a_pair(spark, values):
    values = values[["a", "b"]].copy()
    values.loc[::5, "b"] = np.nan
    (row,) = rank_correlations(frame(spark, values), ["a", "b"]).collect()
    ranks = values.rank().dropna()
    assert row.rows == len(ranks) and row.spearman == pytest.approx(ranks["a"].corr(ranks["b"]))


def test_empty_table(spark, values):
    (row,) = rank_correlations(frame(spark, values).limit(0), ["a", "b"]).collect()
    assert (row.rows, row.spearman) == (0, None)
