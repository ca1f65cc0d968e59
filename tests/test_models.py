import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lotwise.operators import encode as E, evaluate as V, explain as X, registry as R, stacking, training as T
from lotwise.operators.split import fold, sample_rows, train_test
from lotwise.plans.common import builder


@pytest.fixture(scope="module")
def data(raw):
    return T.prepare(raw, builder(), text=["fuel_type_cleaned", "make_name_cleaned", "condition_clean"])


def test_split_is_disjoint_and_complete(spark):
    df = spark.range(20000).withColumnRenamed("id", "listing_id")
    train, test = train_test(df)
    assert train.count() + test.count() == 20000 and train.join(test, "listing_id").count() == 0
    assert train.count() == 15950  # 79.75 percent
    sizes = [r["count"] for r in train.groupBy(fold(F.col("listing_id"))).count().collect()]
    assert len(sizes) == 5 and min(sizes) > 2900
    a, b = sample_rows(df, 100), sample_rows(df.repartition(7), 100)
    assert {r[0] for r in a.collect()} == {r[0] for r in b.collect()} and a.count() == 100


def test_encoder(spark):
    train = spark.createDataFrame([(1, None, 2.0, "b"), (2, 10.0, 4.0, "a"), (3, 20.0, 6.0, None)],
                                  "listing_id int, annual_insurance double, car_age double, fuel_type_cleaned string")
    enc = E.fit_preprocessor(train, ["car_age", "annual_insurance"], ["fuel_type_cleaned"])
    assert enc.names == ["num_insurance__annual_insurance", "num_main__car_age", "cat__fuel_type_cleaned_a",
                         "cat__fuel_type_cleaned_b", "cat__fuel_type_cleaned_missing_value_runtime"]
    test = spark.createDataFrame([(9, None, 4.0, "zzz")], train.schema)
    assert enc.transform(test, ["listing_id"]).select(vector_to_array("features")).first()[0] == [0.0, 0.0, 0.0, 0.0, 0.0]
    rows = np.array([r[0] for r in enc.transform(train, []).select(vector_to_array("features")).collect()])
    assert rows[:, 0].std() == pytest.approx(1) and rows[:, 1].std() == pytest.approx(1) and abs(rows.mean(0)[:2]).max() < 1e-12
    with pytest.raises(ValueError):
        E.select_slots(enc.transform(train, []), enc.names, ["cat__nothing"])
    assert E.strip_prefix("num_main__car_age") == "car_age" and E.strip_prefix("car_age") == "car_age"


def test_target_encoding_leaves_own_fold_out(spark):
    rows = [(0, "a", 0, 1.0), (1, "a", 1, 3.0), (2, "b", 0, 10.0), (3, None, 1, 4.0)]
    df = spark.createDataFrame(rows, "listing_id int, c string, fold int, y double")
    got = {r["listing_id"]: r["c_encoded"] for r in E.target_encoding(df, "c", "y", F.col("fold"), smooth=0.0).collect()}
    assert got == {0: 3.0, 1: 1.0, 2: 3.5, 3: 5.5}  # b and NULL are in one fold only: mean of the other folds


def test_regression_fill(spark):
    df = spark.createDataFrame([(float(i), None if i % 4 == 0 else 2.0 * i + 1) for i in range(40)], "x double, y double")
    out = E.regression_fill(df, "y", ["x"]).collect()
    assert all(r["y"] == pytest.approx(2 * r["x"] + 1) for r in out)
    out = E.regression_fill(df, "y", ["x"], floor=True).collect()
    assert all(r["y"] == pytest.approx(max(2 * r["x"] + 1, 3.0)) for r in out)


def test_metrics(spark):
    df = spark.createDataFrame([(100.0, 110.0), (200.0, 180.0), (0.0, 5.0)], "actual double, predicted double")
    m = V.metrics(df).first()
    a, p = np.array([100, 200, 0.0]), np.array([110, 180, 5.0])
    assert m["mae"] == pytest.approx(abs(a - p).mean()) and m["rmse"] == pytest.approx(math.sqrt(((a - p) ** 2).mean()))
    assert m["r2"] == pytest.approx(1 - ((a - p) ** 2).sum() / ((a - a.mean()) ** 2).sum())
    assert m["mape_nonzero"] == pytest.approx(10.0) and m["mean_ape"] == pytest.approx(10.0)


def test_log_grid(spark):
    grid = spark.range(1).select(V.log_grid(-2, 2, 5)).first()[0]
    assert grid == pytest.approx([0.01, 0.1, 1.0, 10.0, 100.0])


def test_bootstrap_weights(spark):
    w = spark.range(2000).select(F.explode(F.sequence(F.lit(1), F.lit(50))).alias("r"), "id")
    s = w.select(V.poisson_weight(F.col("id"), F.col("r").cast("bigint")).alias("w")).agg(F.avg("w"), F.var_pop("w")).first()
    assert s[0] == pytest.approx(1, abs=0.02) and s[1] == pytest.approx(1, abs=0.03)


def test_range_check(spark):
    expected = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 2.0), ("c", None, 2.0), ("d", 1.0, 2.0)], "case_id string, min_price double, max_price double")
    predicted = spark.createDataFrame([("a", 2.0), ("b", 2.1), ("c", 1.0)], "case_id string, predicted_price double")
    checked = V.range_check(predicted, expected)
    assert {r["case_id"]: r["status"] for r in checked.collect()} == {"a": "PASSED", "b": "FAILED", "c": "CHECK MANUALLY", "d": "ERROR"}
    assert V.all_passed(checked).first()["all_passed"] is False
    assert V.all_passed(checked.where("case_id in ('a', 'c')")).first()["all_passed"] is True


def test_selection_keeps_at_least_the_median(spark, data):
    model = T.learner("forest", numTrees=5, maxDepth=4).fit(data.train)
    table = T.importances(spark, model, data.encoder.names)
    kept = T.select_by_median(table)
    values = np.array([r["importance"] for r in table.collect()])
    assert kept.count() == (values >= np.median(values)).sum()
    assert values.sum() == pytest.approx(1.0)


def test_stack_is_out_of_fold(spark, data):
    learners = {"linear": T.learner("linear"), "tree": T.learner("tree", maxDepth=3)}
    oof = stacking.out_of_fold(data.train, learners)
    assert oof.count() == data.train.count() and oof.select("listing_id").distinct().count() == oof.count()
    # the prediction of a fold equals that of a model fitted without it
    by_hand = T.learner("linear").fit(data.train.where("fold <> 2")).transform(data.train.where("fold = 2"))
    both = oof.where("fold = 2").join(by_hand.select("listing_id", "prediction"), "listing_id")
    assert both.where("abs(p_linear - prediction) > 1e-6").count() == 0
    stack = stacking.fit_stack(data.train, learners, oof=oof)
    out = stack.transform(data.test).first()
    w = stack.meta.coefficients
    assert out["prediction"] == pytest.approx(w[0] * out["p_linear"] + w[1] * out["p_tree"] + stack.meta.intercept)


def test_shapley_adds_up(data):
    model = PipelineModel([*data.encoder.pipeline.stages, T.learner("tree", maxDepth=4).fit(data.train)])
    names = ["car_age", "mileage_num", "horse_power_num", "fuel_type_cleaned", "make_name_cleaned", "condition_clean"]
    rest = [c for c in data.encoder.scale if c not in names]
    fixed = data.test.select("listing_id", *names, *[F.lit(0.0).alias(c) for c in rest])
    # the sum must be the prediction minus the mean prediction of the background, one value for all
    out = X.shapley(fixed, [*names, *rest], model.transform, explained=5, background=100)
    total = {r[0]: r[1] for r in out.groupBy("listing_id").agg(F.sum("contribution")).collect()}
    ground = sample_rows(fixed, 100, seed=7)
    base = model.transform(ground).agg(F.avg("prediction")).first()[0]
    assert all(r["base"] == pytest.approx(base, abs=1e-6) for r in out.select("base").collect())
    rows = {r["listing_id"]: r["prediction"] for r in model.transform(fixed.where(F.col("listing_id").isin(list(total)))).collect()}
    assert len(total) == 5
    for k, t in total.items():
        assert t == pytest.approx(rows[k] - base, abs=1e-6)


def test_donor_is_a_permutation(spark):
    df = spark.range(1000).select(F.col("id").alias("listing_id"), (F.col("id") * 10).alias("v"))
    out = X.with_donor(df, ["v"], rows_per_bucket=100).collect()
    assert sorted(r["d_v"] for r in out) == [i * 10 for i in range(1000)]
    assert all(r["d_v"] != r["v"] for r in out)


def test_permutation_importance_ranks_the_used_feature(spark):
    df = spark.range(500).select(F.col("id").alias("listing_id"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    df = df.withColumn("y", F.col("a") * 3)
    out = X.permutation_importance(df, ["a", "b"], lambda d: d.withColumn("prediction", F.col("a") * 3), "y").collect()
    assert out[0]["feature"] == "a" and out[0]["r2_loss"] > 0.5 and out[1]["r2_loss"] == pytest.approx(0)


def test_elimination_and_collinearity(data, raw):
    rounds = T.eliminate(data.train, data.encoder.names, numTrees=3, maxDepth=3, least=5)
    assert [r[0] for r in rounds] == sorted({r[0] for r in rounds}, reverse=True) and rounds[-1][0] == 5
    corr = T.correlation_matrix(data.train, ["car_age", "car_age_squared", "torque_num", "horse_power_num"])
    vif = T.inflation(corr, ["car_age", "car_age_squared", "torque_num", "horse_power_num"])
    assert min(vif.values()) >= 0.999
    assert T.collinear(np.array([[1, 0.99, 0], [0.99, 1, 0], [0, 0, 1]]), ["a", "b", "c"]) == ["b"]


def test_registry(spark, data, tmp_path):
    path = str(tmp_path / "registry")
    test = data.test.drop("features")
    model = PipelineModel([*data.encoder.pipeline.stages, T.learner("linear").fit(data.train)])
    names = [*data.encoder.scale, *data.encoder.labels]
    for version in ("20250101_000000", "20250202_000000"):
        R.register(spark, path, "m", model, names, data.encoder.names, {"r2": 0.5}, version=version)
    R.register(spark, path, "other", model, names, data.encoder.names, {}, version="20260101_000000", inverse="exp")
    assert R.find(spark, path, "m").version == "20250202_000000"
    assert R.find(spark, path, "m", "20250101_000000").metrics == {"r2": 0.5}
    with pytest.raises(LookupError):
        R.find(spark, path, "nobody")
    a = R.score(test, R.find(spark, path, "m"), ["listing_id"]).orderBy("listing_id").collect()
    b = R.score(test, R.find(spark, path, "other"), ["listing_id"]).orderBy("listing_id").collect()
    assert [y["predicted_price"] - x["predicted_price"] for x, y in zip(a, b)] == pytest.approx([1.0] * len(a), rel=1e-6)
    with pytest.raises(ValueError, match="car_age"):
        R.score(test.drop("car_age"), R.find(spark, path, "m"), ["listing_id"])
    # an absent insurance column is filled
    assert R.score(test.drop("annual_insurance"), R.find(spark, path, "m"), ["listing_id"]).count() == len(a)


def test_prepared_tables(spark, data, tmp_path):
    from lotwise.sources.files import read_latest, read_names

    stamp = T.write_prepared(data, str(tmp_path), "20250101_000000")
    assert read_latest(spark, f"{tmp_path}/x_train").count() == data.train.count()
    assert read_latest(spark, f"{tmp_path}/y_test").columns == ["listing_id", "price_log"]
    assert read_names(spark, f"{tmp_path}/names/{stamp}") == data.encoder.names
    assert PipelineModel.load(f"{tmp_path}/encoder/{stamp}").transform(data.test.drop("features")).count() == data.test.count()


def test_the_test_part_is_written_when_asked_for(raw, monkeypatch):
    written = []
    monkeypatch.setattr(T, "materialize", lambda df, label, write=T.materialize: written.append(label) or write(df, label))
    d = T.prepare(raw, builder(), numeric=["car_age"], text=["fuel_type_cleaned"])
    assert written == ["train-features", "train-vectors"]
    assert d.test.columns == d.train.columns[:d.train.columns.index("fold")] + ["features"] and d.test is d.test
    assert written[2:] == ["test-vectors"] and d.train.count() + d.test.count() == raw.count()


def _meeting(monkeypatch, most):
    """Trees whose fits wait for ``most`` others: one after the other they would break the barrier."""
    import threading

    from lotwise.operators import sparse_trees

    barrier, fit = threading.Barrier(most), sparse_trees.SparseTree._fit
    monkeypatch.setattr(sparse_trees.SparseTree, "_fit", lambda self, df: (barrier.wait(60), fit(self, df))[1])


def test_folds_of_a_stack_are_fitted_side_by_side(data, monkeypatch):
    _meeting(monkeypatch, T.FOLDS)
    oof = stacking.out_of_fold(data.train, {"tree": T.learner("tree", maxDepth=2)})
    monkeypatch.undo()
    assert oof.count() == data.train.count()
    # the models keep their folds
    alone = T.learner("tree", maxDepth=2).fit(data.train.where("fold <> 3")).transform(data.train.where("fold = 3"))
    both = oof.where("fold = 3").join(alone.select("listing_id", "prediction"), "listing_id")
    assert both.count() and both.where("abs(p_tree - prediction) > 1e-9").count() == 0


def test_folds_of_an_elimination_are_fitted_side_by_side(data, monkeypatch):
    names = data.encoder.names
    _meeting(monkeypatch, T.FOLDS)
    (slots, r2, keep), = T.eliminate(data.train, names, "tree", least=len(names), maxDepth=2)
    monkeypatch.undo()
    alone = [T.quality(T.learner("tree", maxDepth=2).fit(data.train.where(F.col("fold") != f)).transform(data.train.where(F.col("fold") == f)))["r2"]
             for f in range(T.FOLDS)]
    assert slots == len(names) == len(keep) and r2 == pytest.approx(np.mean(alone))


def test_folds_of_a_search_are_fitted_side_by_side(data, monkeypatch):
    """The errors and the best model are those of Spark's cross-validation, which takes one fold after the other."""
    import threading

    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator

    ours, kept = T.learner("tree", maxDepth=2), data.train.select("fold", "features", T.TARGET)
    barrier, fit, begun = threading.Barrier(T.FOLDS), type(ours)._fit, []
    monkeypatch.setattr(type(ours), "_fit", lambda self, df: (begun.append(df), len(begun) > T.FOLDS or barrier.wait(60), fit(self, df))[2])
    found = T.search(kept, ours, {"minInstancesPerNode": [1]})
    monkeypatch.undo()
    ev = RegressionEvaluator(labelCol=T.TARGET, predictionCol="prediction", metricName="rmse")
    want = CrossValidator(estimator=ours, estimatorParamMaps=found.getEstimatorParamMaps(), evaluator=ev, foldCol="fold", numFolds=T.FOLDS).fit(kept)
    assert found.avgMetrics == pytest.approx(want.avgMetrics) and found.stdMetrics == pytest.approx(want.stdMetrics)
    assert found.bestModel.toDebugString.split("\n")[1:] == want.bestModel.toDebugString.split("\n")[1:]
