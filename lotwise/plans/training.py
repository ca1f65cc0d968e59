"""Training, selection, stacking and explanation queries (checked by row counts and by invariants in tests)."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lotwise.operators import explain as X, models as M, neighbours as N, stacking, training as T
from lotwise.operators.components import fit_components
from lotwise.operators.encode import select_slots
from lotwise.operators.features import FEATURES, NUMERIC_FEATURES, TARGET
from lotwise.operators.hashed_neighbours import knn_hashed
from lotwise.plans import sqltext as S
from lotwise.plans.common import builder, feature_table
from lotwise.plans.registry import plan, rounded
from lotwise.operators.split import fold, train_test
from lotwise.sources.listings import written_listings
from lotwise.sources.scratch import materialize


_TRAIN_PART = f"WHERE {S.bucket('listing_id')} < 80"


def data(spark, sf_dir, **kw) -> T.TrainingData:
    return T.prepare(written_listings(spark, sf_dir), builder(), **kw)


def _wide_neighbours(d):
    return knn_hashed(d.train, d.test, len(d.encoder.names), TARGET, "listing_id")


@plan("baseline_learners")
def baseline_learners(spark, sf_dir):
    d = data(spark, sf_dir)
    learners = T.baseline_table(spark, d.train, d.test, ["linear", "tree", "forest", "boosting"])
    start = time.time()
    overall = d.train.agg(F.avg(TARGET)).first()[0]
    near = materialize(_wide_neighbours(d)[0], "neighbours").withColumn("prediction", F.coalesce("predicted", F.lit(overall)))
    took = time.time() - start
    q = T.quality(d.test.select("listing_id", TARGET).join(near, "listing_id"))
    return learners.unionByName(spark.createDataFrame([("neighbours", q["r2"], q["mae"], q["rmse"], took)], learners.schema)).orderBy(F.desc("r2"))


@plan("rf_importance")
def rf_importance(spark, sf_dir):
    d = data(spark, sf_dir)
    return T.top_importances(T.importances(spark, T.learner("forest").fit(d.train), d.encoder.names), 30)


@plan("median_selection")
def median_selection(spark, sf_dir):
    d = data(spark, sf_dir)
    table = T.importances(spark, T.learner("forest").fit(d.train), d.encoder.names)
    kept = T.select_by_median(table).select("name", F.lit(True).alias("kept"))
    return rounded(table.join(kept, "name", "left").select("name", "importance", F.coalesce("kept", F.lit(False)).alias("kept")))


@plan("cv_scores")
def cv_scores(spark, sf_dir):
    d = data(spark, sf_dir)
    names = d.encoder.names
    forest = T.learner("forest", features="selected", numTrees=10, maxDepth=6)
    first = T.learner("forest", numTrees=10, maxDepth=6).fit(d.train)
    kept = [r["name"] for r in T.select_by_median(T.importances(spark, first, names)).collect()]
    train = select_slots(d.train, names, kept)
    return T.score_summary(T.fold_scores(spark, train, {"forest": forest, "linear": T.learner("linear", features="selected")}))


@plan("hyper_search")
def hyper_search(spark, sf_dir):
    """A random search over a grid for each kind of tree model."""
    d = data(spark, sf_dir)
    grids = {"tree": ({"maxDepth": [4, 6, 8], "minInstancesPerNode": [1, 5], "maxBins": [16, 32]}, 3),
             "forest": ({"numTrees": [10, 20], "maxDepth": [4, 6]}, 2), "boosting": ({"maxIter": [5, 10], "maxDepth": [3, 4]}, 2)}
    tables = [T.search_table(spark, T.search(d.train, T.learner(name), grid, tries=tries)).withColumn("model", F.lit(name))
              for name, (grid, tries) in grids.items()]
    return reduce(lambda a, b: a.unionByName(b), tables)


@plan("linear_coefficients")
def linear_coefficients(spark, sf_dir):
    d = data(spark, sf_dir)
    return T.coefficients(spark, T.learner("linear").fit(d.train), d.encoder.names)


@plan("recursive_elimination")
def recursive_elimination(spark, sf_dir):
    d = data(spark, sf_dir)
    rounds = T.eliminate(d.train, d.encoder.names, numTrees=10, maxDepth=6)
    return spark.createDataFrame([(n, r2) for n, r2, _ in rounds], "slots int, r2 double")


def _components(df, size, k):
    """Rows along the first axes, and the variance along each."""
    fit = fit_components(df, k, size)
    along = fit.transform(df, ["listing_id"])
    return along.select("listing_id", *[F.round(F.col("components")[i], 4).alias(f"component_{i + 1}") for i in range(k)]), fit


@plan("principal_components")
def principal_components(spark, sf_dir):
    """All numeric slots and all slots of the nine text columns."""
    d = data(spark, sf_dir)
    return _components(d.train.select("listing_id", "features").unionByName(d.test.select("listing_id", "features")), len(d.encoder.names), 5)[0]


_PAIR = ["car_age", "mileage_log"]


# the eigenvectors of two columns have a closed form; the larger entry of an axis is positive
@plan("principal_pair", f"""WITH {S.FEATURES}, x AS (SELECT listing_id, car_age::DOUBLE AS x1, mileage_log AS x2 FROM features),
m AS (SELECT avg(x1) AS m1, avg(x2) AS m2, var_samp(x1) AS a, var_samp(x2) AS c, covar_samp(x1, x2) AS b FROM x),
l AS (SELECT *, (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS l1, (a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b) AS l2 FROM m),
u AS (SELECT *, b / sqrt(b * b + pow(l1 - a, 2)) AS u1, (l1 - a) / sqrt(b * b + pow(l1 - a, 2)) AS u2 FROM l),
s AS (SELECT *, CASE WHEN abs(u1) >= abs(u2) THEN sign(u1) ELSE sign(u2) END AS s1, CASE WHEN abs(u2) >= abs(u1) THEN sign(-u2) ELSE sign(u1) END AS s2 FROM u)
SELECT listing_id, round(s1 * (u1 * (x1 - m1) + u2 * (x2 - m2)), 4) AS component_1, round(s2 * (u1 * (x2 - m2) - u2 * (x1 - m1)), 4) AS component_2,
  round(l1, 6) AS variance_1, round(l2, 6) AS variance_2 FROM x CROSS JOIN s""")
def principal_pair(spark, sf_dir):
    df = feature_table(spark, sf_dir, names=False).select("listing_id", *_PAIR)
    vectors = materialize(VectorAssembler(inputCols=_PAIR, outputCol="features").transform(df).select("listing_id", "features"), "pairs")
    rows, fit = _components(vectors, len(_PAIR), len(_PAIR))
    return rounded(rows.select("*", *[F.lit(float(v)).alias(f"variance_{i + 1}") for i, v in enumerate(fit.variances)]))


_VAR = [c for c in NUMERIC_FEATURES if c != "annual_insurance"]
_INPUTS = _VAR


@plan("low_variance", f"WITH {S.FEATURES} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(var_pop({c}), 4) AS variance, var_pop({c}) <= 0.001 AS low FROM features" for c in _VAR))
def low_variance(spark, sf_dir):
    df = feature_table(spark, sf_dir).agg(*[F.var_pop(c).alias(c) for c in _VAR])
    out = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("variance")) for c in _VAR])))
    return rounded(out.withColumn("low", F.col("variance") <= 0.001), 4)


@plan("collinear_columns")
def collinear_columns(spark, sf_dir):
    df = feature_table(spark, sf_dir).select(*_INPUTS)
    corr = T.correlation_matrix(df, _INPUTS)
    dropped, vif = T.collinear(corr, _INPUTS), T.inflation(corr, _INPUTS)
    rows = [(c, round(vif[c], 6), c in dropped, vif[c] > 10) for c in _INPUTS]
    return spark.createDataFrame(rows, "column_name string, vif double, drop_by_correlation boolean, drop_by_vif boolean")


def _learners():
    return {"linear": T.learner("linear"), "forest": T.learner("forest", numTrees=10, maxDepth=6), "boosting": T.learner("boosting", maxIter=5)}


@plan("stacked_scores")
def stacked_scores(spark, sf_dir):
    d = data(spark, sf_dir)
    stack = stacking.fit_stack(d.train, _learners())
    out = stack.transform(d.test)
    return rounded(out.select("listing_id", TARGET, "p_linear", "p_forest", "p_boosting", "prediction"), 4)


# base predictions with a closed form; the penalty's effect on the stack is checked by the normal equations of two inputs
@plan("stack_penalties", f"""WITH {S.FEATURES}, t AS (SELECT *, {S.bucket('listing_id', 43, 5)} AS fold FROM features {_TRAIN_PART}),
oof AS (SELECT fold, price_log AS y, car_age::DOUBLE AS x1, engine_size_cc_log AS x2 FROM t),
parts AS (SELECT f, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) * count(*) AS s11, var_pop(x2) * count(*) AS s22, covar_pop(x1, x2) * count(*) AS s12,
  covar_pop(x1, y) * count(*) AS s1y, covar_pop(x2, y) * count(*) AS s2y FROM oof, (SELECT unnest(range(5)) AS f) WHERE fold <> f GROUP BY f),
grid AS (SELECT pow(10.0, e) AS penalty FROM (SELECT unnest(range(-6, 7)) AS e)),
fits AS (SELECT f, penalty, m1, m2, my, ((s22 + penalty) * s1y - s12 * s2y) / ((s11 + penalty) * (s22 + penalty) - s12 * s12) AS b1,
  ((s11 + penalty) * s2y - s12 * s1y) / ((s11 + penalty) * (s22 + penalty) - s12 * s12) AS b2 FROM parts CROSS JOIN grid)
SELECT round(penalty, 6) AS penalty, round(sqrt(avg(pow(y - my - b1 * (x1 - m1) - b2 * (x2 - m2), 2))), 6) AS rmse FROM oof JOIN fits ON fold = f GROUP BY penalty""")
def stack_penalties(spark, sf_dir):
    train, _ = train_test(feature_table(spark, sf_dir, names=False).select("listing_id", TARGET, "car_age", "engine_size_cc_log"))
    oof = train.select(TARGET, fold(F.col("listing_id")).alias("fold"), F.col("car_age").cast("double").alias("p_age"), F.col("engine_size_cc_log").alias("p_size"))
    rows = stacking.ridge_errors(oof, ["age", "size"], [10.0 ** e for e in range(-6, 7)])
    return rounded(spark.createDataFrame(rows, "penalty double, rmse double"))


def _forest(spark, sf_dir):
    d = data(spark, sf_dir)
    model = T.learner("forest", numTrees=10, maxDepth=6).fit(d.train)
    return d, PipelineModel([*d.encoder.pipeline.stages, model])


def _shares(spark, sf_dir):
    """Contributions of all features to a forest's predictions, written once for what is derived from them."""
    d, model = _forest(spark, sf_dir)
    return d, materialize(X.shapley(d.test, FEATURES, model.transform, background_df=d.train), "contributions")


@plan("shapley_sampled")
def shapley_sampled(spark, sf_dir):
    return rounded(_shares(spark, sf_dir)[1], 6)


@plan("shapley_importance")
def shapley_importance(spark, sf_dir):
    return rounded(M.global_importance(_shares(spark, sf_dir)[1]), 6)


@plan("shapley_dependence")
def shapley_dependence(spark, sf_dir):
    """Along each of the ten most important features: numbers by range, words by value."""
    d, shares = _shares(spark, sf_dir)
    top = [r["feature"] for r in M.global_importance(shares, 10).collect()]
    return rounded(M.dependence_table(shares, d.test, top), 6)


_WEIGHTS = {"car_age": -0.08, "mileage_log": -0.11, "engine_size_cc_log": 0.6, "horse_power_log": 0.35, "seats_num": 0.02}


# a linear scorer has exact shares: weight times distance from the background's mean
@plan("shapley_linear", f"""WITH {S.FEATURES},
explained AS (SELECT * FROM features WHERE {S.bucket('listing_id')} >= 80 ORDER BY {S.unit('listing_id')}, listing_id LIMIT 200),
background AS (SELECT * FROM features {_TRAIN_PART} ORDER BY {S.unit('listing_id', 7)}, listing_id LIMIT 100),
m AS (SELECT {", ".join(f"avg({c}) AS {c}" for c in _WEIGHTS)} FROM background),
base AS (SELECT 5 + {" + ".join(f"{w}::DOUBLE * {c}" for c, w in _WEIGHTS.items())} AS base FROM m)
{" UNION ALL ".join(f"SELECT listing_id, '{c}' AS feature, round({w}::DOUBLE * (e.{c} - m.{c}), 6) AS contribution, round(base, 6) AS base FROM explained e CROSS JOIN m CROSS JOIN base" for c, w in _WEIGHTS.items())}""")
def shapley_linear(spark, sf_dir):
    train, test = train_test(feature_table(spark, sf_dir, names=False).select("listing_id", *_WEIGHTS))
    line = sum((F.col(c) * w for c, w in _WEIGHTS.items()), F.lit(5.0))
    out = X.shapley(test, list(_WEIGHTS), lambda df: df.withColumn("prediction", line), background_df=train)
    return rounded(out)


@plan("permutation_importance")
def permutation_importance(spark, sf_dir):
    d, model = _forest(spark, sf_dir)
    return rounded(X.permutation_importance(d.test, FEATURES, model.transform, TARGET), 6)


_NEAR = ["car_age", "engine_size_cc_log", "horse_power_log"]


def _scaled_parts(spark, sf_dir):
    from lotwise.operators.encode import scale_stats, scaled
    from lotwise.operators.split import fold, train_test

    df = feature_table(spark, sf_dir).select("listing_id", TARGET, *_NEAR)
    train, test = train_test(df)
    stats = scale_stats(train, _NEAR, mean_filled=[])
    cut = lambda d: d.select("listing_id", TARGET, *[scaled(c, *stats[c], False).alias(c) for c in _NEAR])
    return cut(train), cut(test)


# each row of the test part against every row of the training part; equal distances share what weight is left
@plan("knn_price", f"""WITH {S.FEATURES}, train AS (SELECT * FROM features {_TRAIN_PART}),
s AS (SELECT {", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS d{i}" for i, c in enumerate(_NEAR))} FROM train),
z AS (SELECT listing_id, price_log, {S.bucket('listing_id')} < 80 AS seen, {", ".join(f"({c} - m{i}) / d{i} AS z{i}" for i, c in enumerate(_NEAR))} FROM features CROSS JOIN s),
points AS (SELECT {", ".join(f"z{i}" for i in range(len(_NEAR)))}, count(*) AS n, sum(price_log) AS s FROM z WHERE seen GROUP BY ALL),
asked AS (SELECT DISTINCT {", ".join(f"z{i}" for i in range(len(_NEAR)))} FROM z WHERE NOT seen),
far AS (SELECT {", ".join(f"q.z{i}" for i in range(len(_NEAR)))}, round(sqrt({" + ".join(f"pow(q.z{i} - p.z{i}, 2)" for i in range(len(_NEAR)))}), 9) AS d,
  sum(n) AS n, sum(s) AS s FROM asked q CROSS JOIN points p GROUP BY ALL),
taken AS (SELECT *, least(n, 5 - coalesce(sum(n) OVER (PARTITION BY {", ".join(f"z{i}" for i in range(len(_NEAR)))} ORDER BY d
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS w FROM far),
mean AS (SELECT {", ".join(f"z{i}" for i in range(len(_NEAR)))}, sum(w * s / n) / sum(w) AS predicted FROM taken WHERE w > 0 GROUP BY ALL)
SELECT listing_id, round(price_log, 6) AS price_log, round(predicted, 6) AS predicted FROM z JOIN mean USING ({", ".join(f"z{i}" for i in range(len(_NEAR)))}) WHERE NOT seen""")
def knn_price(spark, sf_dir):
    train, test = _scaled_parts(spark, sf_dir)
    out = N.knn_predict(train, test, _NEAR, TARGET, k=5)
    return rounded(out.select("listing_id", TARGET, "predicted"), 6)


@plan("knn_price_wide")
def knn_price_wide(spark, sf_dir):
    """All 26 features, words as slots; ``recall`` is that of the trial queries."""
    out, fit = _wide_neighbours(data(spark, sf_dir))
    return rounded(out.withColumn("recall", F.lit(fit.recall)), 6)
