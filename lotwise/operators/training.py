"""Training data, learners, cross-validation, search and feature selection."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VarianceThresholdSelector
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.operators.encode import Preprocessor, fit_preprocessor
from lotwise.operators.features import TARGET, FeatureBuilder, FeatureStats
from lotwise.operators.sparse_trees import SparseBoosting, SparseForest, SparseTree
from lotwise.operators.split import fold, train_test
from lotwise.sources.files import write_names, write_stage
from lotwise.sources.scratch import materialize

FOLDS = 5
SEED = 42
#: Fits that run side by side; the steps of one are too short to keep all cores busy.
AT_ONCE = 5


@dataclass
class TrainingData:
    """Features and vectors of both parts, written once, so that no learner recomputes them; the test part when it is asked for."""

    stats: FeatureStats
    encoder: Preprocessor
    train: DataFrame
    raw_test: DataFrame

    @cached_property
    def test(self) -> DataFrame:
        keep = [c for c in self.train.columns if c != "features"]
        return materialize(self.encoder.transform(self.stats.transform(self.raw_test), keep), "test-vectors")


def prepare(raw: DataFrame, builder: FeatureBuilder, numeric: list[str] | None = None, text: list[str] | None = None,
            key: str = "listing_id") -> TrainingData:
    """Split first, then fit features and encoder on the training part only."""
    raw_train, raw_test = train_test(raw, key)
    stats = builder.fit(raw_train)
    train = materialize(stats.transform(raw_train).withColumn("fold", fold(F.col(key), FOLDS)), "train-features")
    encoder = fit_preprocessor(train, numeric, text)
    return TrainingData(stats, encoder, materialize(encoder.transform(train, train.columns), "train-vectors"), raw_test)


def write_prepared(data: TrainingData, path: str, stamp: str | None = None, key: str = "listing_id") -> str:
    """The four tables (inputs and target of both parts), the fitted encoder and its slot names."""
    spark = data.train.sparkSession
    for name, part in (("train", data.train), ("test", data.test)):
        stamp = write_stage(part.select(key, "features"), f"{path}/x_{name}", stamp)
        write_stage(part.select(key, TARGET), f"{path}/y_{name}", stamp)
    data.encoder.pipeline.write().overwrite().save(f"{path}/encoder/{stamp}")
    write_names(spark, data.encoder.names, f"{path}/names/{stamp}")
    return stamp


def learner(name: str, features: str = "features", label: str = TARGET, **params) -> Estimator:
    common = dict(featuresCol=features, labelCol=label)
    if name == "linear":
        return LinearRegression(**common, **{"regParam": 1e-3, "solver": "auto", **params})
    if name == "ridge":
        return LinearRegression(**common, **{"regParam": 0.1, "elasticNetParam": 0.0, **params})
    if name == "tree":
        return SparseTree(**common, **{"maxDepth": 8, "seed": SEED, **params})
    if name == "forest":
        return SparseForest(**common, **{"numTrees": 20, "maxDepth": 8, "featureSubsetStrategy": "onethird", "seed": SEED, **params})
    if name == "boosting":
        return SparseBoosting(**common, **{"maxIter": 10, "maxDepth": 4, "stepSize": 0.3, "seed": SEED, **params})
    raise ValueError(f"unknown learner {name}")


def side_by_side(spark: SparkSession, jobs: list[Callable[[], object]], at_once: int = AT_ONCE) -> list:
    """Results of the jobs in their order, ``at_once`` of them running at a time; the first error is raised."""
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [r.result() for r in running]


def quality(predicted: DataFrame, label: str = TARGET) -> dict[str, float]:
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction")
    return {m: ev.evaluate(predicted, {ev.metricName: m}) for m in ("r2", "mae", "rmse")}


def baseline_table(spark: SparkSession, train: DataFrame, test: DataFrame, names: list[str]) -> DataFrame:
    """R2, MAE, RMSE and training seconds per learner, the best first."""
    rows = []
    for name in names:
        start = time.time()
        model = learner(name).fit(train)
        took = time.time() - start
        q = quality(model.transform(test))
        rows.append((name, q["r2"], q["mae"], q["rmse"], took))
    return spark.createDataFrame(rows, "model string, r2 double, mae double, rmse double, seconds double").orderBy(F.desc("r2"))


def fold_scores(spark: SparkSession, train: DataFrame, estimators: dict[str, Estimator], folds: int = FOLDS) -> DataFrame:
    """R2 per model and fold."""
    ev = RegressionEvaluator(labelCol=TARGET, predictionCol="prediction", metricName="r2")
    rows = []
    for name, est in estimators.items():
        for f in range(folds):
            model = est.fit(train.where(F.col("fold") != f))
            rows.append((name, f, ev.evaluate(model.transform(train.where(F.col("fold") == f)))))
    return spark.createDataFrame(rows, "model string, fold int, r2 double")


def score_summary(scores: DataFrame) -> DataFrame:
    return scores.groupBy("model").agg(
        F.avg("r2").alias("r2_mean"), F.stddev_pop("r2").alias("r2_std"), F.count(F.lit(1)).alias("folds")
    ).orderBy(F.desc("r2_mean"), "model")


def search(train: DataFrame, estimator: Estimator, grid: dict[str, list], tries: int | None = None,
           parallelism: int = AT_ONCE, seed: int = SEED) -> CrossValidatorModel:
    """Grid search by cross-validated RMSE, or a random search over ``tries`` points of the grid."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    points = builder.build()
    if tries is not None and tries < len(points):
        points = random.Random(seed).sample(points, tries)
    ev = RegressionEvaluator(labelCol=TARGET, predictionCol="prediction", metricName="rmse")
    # the folds come from the key hash, so every run compares the same rows
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=points, evaluator=ev, foldCol="fold",
                        numFolds=FOLDS, parallelism=parallelism, seed=seed)
    # fits of all folds run side by side; those of a fold share what they read
    fits = [estimator.fitMultiple(train.where(F.col("fold") != f), points) for f in range(FOLDS)]
    errors = np.zeros((FOLDS, len(points)))

    def fitted(f: int) -> None:
        i, model = next(fits[f])
        errors[f, i] = ev.evaluate(model.transform(train.where(F.col("fold") == f)))

    side_by_side(train.sparkSession, [partial(fitted, f) for _ in points for f in range(FOLDS)], parallelism)
    means = errors.mean(axis=0)
    best = estimator.fit(train, points[int(means.argmin())])
    return cv._copyValues(CrossValidatorModel(best, means.tolist(), stdMetrics=errors.std(axis=0).tolist()))


def search_table(spark: SparkSession, found: CrossValidatorModel) -> DataFrame:
    """Parameters and mean RMSE of each point tried, the best first."""
    rows = []
    for params, score, std in zip(found.getEstimatorParamMaps(), found.avgMetrics, found.stdMetrics):
        rows.append((", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda kv: kv[0].name)), float(score), float(std)))
    return spark.createDataFrame(rows, "params string, rmse_mean double, rmse_std double").orderBy("rmse_mean", "params")


def importances(spark: SparkSession, model: Model, names: list[str]) -> DataFrame:
    values = model.featureImportances.toArray()
    rows = [(i, n, float(v)) for i, (n, v) in enumerate(zip(names, values))]
    return spark.createDataFrame(rows, "idx int, name string, importance double")


def top_importances(table: DataFrame, n: int = 20) -> DataFrame:
    return table.orderBy(F.desc("importance"), "name").limit(n)


def select_by_median(table: DataFrame) -> DataFrame:
    """Slots with at least the median importance, in slot order. One row per slot, so the table is small."""
    middle = table.agg(F.median("importance")).first()[0]
    return table.where(F.col("importance") >= middle).orderBy("idx")


def coefficients(spark: SparkSession, model, names: list[str]) -> DataFrame:
    rows = [(i, n, float(b)) for i, (n, b) in enumerate(zip(names, model.coefficients.toArray()))]
    return spark.createDataFrame(rows, "idx int, name string, coefficient double")


def eliminate(train: DataFrame, names: list[str], estimator_name: str = "forest", drop_share: float = 0.5, least: int = 10,
              **params) -> list[tuple[int, float, list[int]]]:
    """Recursive elimination: fit on all folds but one, score by the one left out, for every fold; drop the
    least important share of the slots by their mean importance, repeat.

    Returns (slots, mean R2, slot numbers) per round. Each round slices the written vectors, so no plan grows.
    """
    from pyspark.ml.feature import VectorSlicer

    ev = RegressionEvaluator(labelCol=TARGET, predictionCol="prediction", metricName="r2")
    keep, rounds = list(range(len(names))), []
    while True:
        cut = VectorSlicer(inputCol="features", outputCol="kept", indices=keep).transform(train)
        cut = cut.select("fold", "kept", TARGET).persist()
        folds = sorted(r["fold"] for r in cut.select("fold").distinct().collect())

        def fitted(f: int) -> tuple[float, np.ndarray]:
            model = learner(estimator_name, features="kept", **params).fit(cut.where(F.col("fold") != f))
            return ev.evaluate(model.transform(cut.where(F.col("fold") == f))), model.featureImportances.toArray()

        found = side_by_side(train.sparkSession, [partial(fitted, f) for f in folds])
        cut.unpersist()
        scores, weights = [score for score, _ in found], np.zeros(len(keep))
        for _, own in found:
            weights += own
        rounds.append((len(keep), float(np.mean(scores)), keep))
        size = max(least, int(len(keep) * (1 - drop_share)))
        if size >= len(keep):
            return rounds
        order = np.argsort(-weights, kind="stable")[:size]
        keep = sorted(keep[i] for i in order)


def low_variance(df: DataFrame, names: list[str], threshold: float = 1e-3) -> list[str]:
    """Names of slots whose variance is not above the threshold."""
    model = VarianceThresholdSelector(featuresCol="features", outputCol="_kept", varianceThreshold=threshold).fit(df)
    kept = set(model.selectedFeatures)
    return [n for i, n in enumerate(names) if i not in kept]


def slot_variances(df: DataFrame, names: list[str]) -> DataFrame:
    one = df.agg(Summarizer.variance(F.col("features")).alias("v"))
    zipped = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("name"), vector_to_array("v").alias("variance"))
    return one.select(F.inline(zipped))


def correlation_matrix(df: DataFrame, columns: list[str]) -> np.ndarray:
    from pyspark.ml.feature import VectorAssembler

    vectors = VectorAssembler(inputCols=columns, outputCol="_v").transform(df.select(*columns))
    return Correlation.corr(vectors, "_v").first()[0].toArray()


def collinear(corr: np.ndarray, columns: list[str], limit: float = 0.95) -> list[str]:
    """Columns to drop so that no pair left correlates above the limit; the earlier one of a pair stays."""
    dropped: list[str] = []
    for j, name in enumerate(columns):
        if any(abs(corr[i, j]) > limit for i in range(j) if columns[i] not in dropped):
            dropped.append(name)
    return dropped


def inflation(corr: np.ndarray, columns: list[str]) -> dict[str, float]:
    """Variance inflation factor per column: the diagonal of the inverse correlation matrix."""
    return dict(zip(columns, np.diag(np.linalg.pinv(corr)).tolist()))
