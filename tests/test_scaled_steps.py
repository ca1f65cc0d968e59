"""Steps that queries share do no more work than their columns need."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.operators import quantiles, ranks
from lotwise.operators.features import FeatureBuilder
from lotwise.plans import load
from lotwise.session import compile_methods


@pytest.fixture
def plain_session(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "65535")
    yield spark
    spark.conf.set(name, before)


def test_wide_projections_are_compiled_in_any_session(plain_session, raw):
    stats = FeatureBuilder(2025).fit(raw, rows=1)
    plain_session.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    stats.transform(raw)
    assert plain_session.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_a_smaller_limit_stays(plain_session):
    plain_session.conf.set("spark.sql.codegen.hugeMethodLimit", "4000")
    compile_methods(plain_session)
    assert plain_session.conf.get("spark.sql.codegen.hugeMethodLimit") == "4000"


def test_only_named_medians(raw):
    whole, some = FeatureBuilder(2025).fit(raw, names=False), FeatureBuilder(2025).fit(raw, numbers=["price", "year"], names=False)
    assert set(some.medians) == {"price", "year"}
    assert some.medians == {n: whole.medians[n] for n in some.medians}


def test_values_far_from_the_brackets_are_not_fanned_out(spark):
    df = spark.range(50_000).select(F.col("id").cast("double").alias("a"), F.when(F.col("id") % 2 == 0, F.col("id") * -2.0).alias("b"))
    wide = df.select(F.col("a").alias("v0"), F.col("b").alias("v1"))
    brackets = spark.createDataFrame([("a", 0.5, 100.0, 110.0), ("b", 0.5, -40.0, -30.0)], "name string, prob double, low double, high double")
    near = quantiles._near(wide, {"a": "v0", "b": "v1"}, brackets)
    assert near.where("name = 'a'").count() == 111 and near.where("name = 'a' and v is not null").count() == 11
    assert near.where("v is null and name = 'b'").count() == 25_000 - 11
    assert quantiles.medians(df, {"a": F.col("a"), "b": F.col("b"), "none": F.lit(None)}) == {"a": 24999.5, "b": -49998.0, "none": None}
    assert quantiles.exact_quantiles(df.limit(0), {"a": F.col("a")}, [0.5]).count() == 0


@pytest.mark.parametrize("few", [0, 30, 10_000])
def test_ranks_sent_or_shuffled_are_the_same(spark, monkeypatch, few):
    rng = np.random.default_rng(5)
    rows = [(int(i) if i % 50 else None, float(a), float(b) if i % 7 else None, float("nan") if i % 11 == 0 else float(c))
            for i, (a, b, c) in enumerate(zip(rng.integers(0, 20, 400), rng.normal(0, 1, 400), rng.integers(0, 60, 400) - 30))]
    rows.append(rows[3])
    df = spark.createDataFrame(rows, "listing_id long, a double, b double, c double")
    monkeypatch.setattr(ranks, "FEW", few)
    held = df.select(F.col("listing_id").alias("key"), *[ranks._known(c).alias(f"v{i}") for i, c in enumerate("abc")])
    wide = {r["key"]: [r["r0"], r["r1"], r["r2"]] for r in ranks._wide_ranks(held, 3).collect()}
    expected = {}
    for r in ranks.average_ranks(df, ["a", "b", "c"], "listing_id").collect():
        own = expected.setdefault(r["key"], [None] * 3)
        at = "abc".index(r["name"])
        own[at] = max(own[at] or 0.0, r["rank"])
    assert wide == expected


def test_rows_with_few_values_are_not_shuffled_by_value(spark, monkeypatch):
    df = spark.range(200).select(F.col("id").alias("key"), (F.col("id") % 5).cast("double").alias("v0"), F.col("id").cast("double").alias("v1"))
    monkeypatch.setattr(ranks, "FEW", 10)
    plan = ranks._wide_ranks(df, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 1 and plan.count("Join") == 2


def test_slot_variances_read_written_features(spark, sf_dir):
    assert any("train-features" in f for f in load()["low_variance_slots"].run(spark, sf_dir).inputFiles())
