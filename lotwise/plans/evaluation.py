"""Evaluation queries on closed-form predictors, so that SQL can check every number."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions.numbers import invert_log
from lotwise.operators import evaluate as E, models as M
from lotwise.operators.encode import target_encoding
from lotwise.operators.prices import segment
from lotwise.operators.profiling import null_profile
from lotwise.operators.quantiles import quantile_table
from lotwise.operators.split import fold, train_test
from lotwise.plans import sqltext as S
from lotwise.plans.common import feature_table
from lotwise.plans.registry import plan, rounded
from lotwise.sources.scratch import materialize

_CONTEXT = ["make_name_cleaned", "model_name_cleaned", "car_age", "mileage_num", "engine_size_cc_num"]
_B = S.bucket("listing_id")

# actual price and three predictions for the test part, all models fitted on the training part
_SCORED = f"""WITH {S.FEATURES},
train AS (SELECT * FROM features WHERE {_B} < 80), test AS (SELECT * FROM features WHERE {_B} >= 80),
line AS (SELECT regr_slope(price_log, car_age) AS b, regr_intercept(price_log, car_age) AS a, median(price_log) AS med, avg(price_log) AS mean FROM train),
by_make AS (SELECT make_name_cleaned AS g, avg(price_log) AS gm FROM train GROUP BY 1),
scored AS (SELECT test.*, exp(price_log) - 1 AS actual, exp(a + b * car_age) - 1 AS ols, exp(coalesce(gm, mean)) - 1 AS group_mean, exp(med) - 1 AS median
  FROM test CROSS JOIN line LEFT JOIN by_make ON g = make_name_cleaned)"""


def _parts(spark, sf_dir, *columns: str, names: bool = False):
    """Train and test part of the few columns a query needs, written once because models and metrics each read them."""
    df = feature_table(spark, sf_dir, names=names).select("listing_id", "price_log", *columns)
    return train_test(materialize(df, "parts"))


def _predict(train, test, model: str):
    """(key, context, actual, predicted) of one model on the test part."""
    if model == "ols":
        out = test.withColumn("p", M.line(M.line_fit(train, "car_age", "price_log"), "car_age"))
    elif model == "group_mean":
        out = M.group_mean(train, test, "make_name_cleaned", "price_log", "p")
    else:
        out = test.withColumn("p", M.median_predictor(train, "price_log"))
    return out.withColumn("actual", invert_log(F.col("price_log"))).withColumn("predicted", invert_log(F.col("p"))).drop("p")


def _metrics_sql(p: str, by: str = "") -> str:
    return (f"count(*) AS rows, round(avg(abs(actual - {p})), 2) AS mae, round(sqrt(avg(pow(actual - {p}, 2))), 2) AS rmse, "
            f"round(1 - sum(pow(actual - {p}, 2)) / (var_pop(actual) * count(*)), 6) AS r2, "
            f"round(avg(abs(actual - {p}) / actual * 100), 4) AS mean_ape, round(stddev_pop(abs(actual - {p}) / actual * 100), 4) AS std_ape, "
            f"round(avg(abs(actual - {p}) / actual) FILTER (WHERE actual <> 0) * 100, 4) AS mape_nonzero")


_DIGITS = dict(mae=2, rmse=2, r2=6)

for _name, _model in (("baseline_median", "median"), ("ols_metrics", "ols"), ("group_mean_metrics", "group_mean")):
    @plan(_name, f"{_SCORED} SELECT {_metrics_sql(_model)} FROM scored")
    def _metrics(spark, sf_dir, model=_model):
        needed = {"ols": ["car_age"], "group_mean": ["make_name_cleaned"]}.get(model, [])
        train, test = _parts(spark, sf_dir, *needed, names=model == "group_mean")
        return rounded(E.metrics(_predict(train, test, model)), 4, **_DIGITS)


@plan("error_percentiles", f"""{_SCORED}, e AS (SELECT abs(actual - group_mean) / actual * 100 AS ape FROM scored)
SELECT p AS prob, round(quantile_cont(ape, p), 4) AS ape FROM e, (VALUES (0.25::DOUBLE), (0.5), (0.75), (0.9), (0.95)) v(p) GROUP BY p"""
      .replace("SELECT p AS prob, round(quantile_cont(ape, p), 4) AS ape FROM e, (VALUES (0.25::DOUBLE), (0.5), (0.75), (0.9), (0.95)) v(p) GROUP BY p",
               " UNION ALL ".join(f"SELECT {p}::DOUBLE AS prob, round(quantile_cont(ape, {p}), 4) AS ape FROM e" for p in E.ERROR_PROBS)))
def error_percentiles(spark, sf_dir):
    train, test = _parts(spark, sf_dir, "make_name_cleaned", names=True)
    return rounded(E.error_percentiles(_predict(train, test, "group_mean")), 4)


@plan("residual_bins", f"""{_SCORED} SELECT CAST(floor((group_mean - actual) / actual * 100 / 10.0) AS INTEGER) AS bin, count(*) AS rows,
  round(avg(group_mean - actual), 2) AS mean_residual FROM scored GROUP BY 1""")
def residual_bins(spark, sf_dir):
    train, test = _parts(spark, sf_dir, "make_name_cleaned", names=True)
    return rounded(E.residual_bins(_predict(train, test, "group_mean")), 2)


@plan("residuals_by_price", f"""{_SCORED} SELECT floor(log10(actual) * 4) / 4 AS log10_from, count(*) AS rows, round(avg(actual), 2) AS mean_actual,
  round(avg(ols), 2) AS mean_predicted, round(avg(abs(actual - ols) / actual * 100), 2) AS mean_ape FROM scored GROUP BY 1""")
def residuals_by_price(spark, sf_dir):
    train, test = _parts(spark, sf_dir, "car_age")
    return rounded(E.residuals_by_price(_predict(train, test, "ols")), 2)


_SEGMENT = ("CASE WHEN price_log <= b1 THEN 'budget' WHEN price_log <= b2 THEN 'economy' WHEN price_log <= b3 THEN 'premium' ELSE 'luxury' END")


@plan("error_by_segment", f"""{_SCORED}, b AS (SELECT quantile_cont(price_log, 0.25) AS b1, quantile_cont(price_log, 0.5) AS b2, quantile_cont(price_log, 0.75) AS b3 FROM train),
x AS (SELECT scored.*, {_SEGMENT} AS segment FROM scored CROSS JOIN b)
SELECT segment, fuel_type_cleaned, {_metrics_sql('ols')} FROM x GROUP BY ROLLUP (segment, fuel_type_cleaned)""")
def error_by_segment(spark, sf_dir):
    train, test = _parts(spark, sf_dir, "car_age", "fuel_type_cleaned")
    bounds = quantile_table(train, {"p": F.col("price_log")}, [0.25, 0.5, 0.75])["p"]
    scored = _predict(train, test, "ols").withColumn("segment", segment(F.col("price_log"), bounds, ["budget", "economy", "premium", "luxury"]))
    return rounded(E.metrics(scored, by=["segment", "fuel_type_cleaned"], rollup=True), 4, **_DIGITS)


def _weight_sql() -> str:
    cuts = " ".join(f"WHEN x < {int(p * 2147483647)} THEN {i}" for i, p in enumerate(E.POISSON_1))
    return f"CASE {cuts} ELSE {len(E.POISSON_1)} END"


@plan("bootstrap_r2", f"""{_SCORED}, fan AS (
  SELECT actual AS a, pow(actual - ols, 2) AS e, r, (({S.unit('listing_id', E.KEY_SEED)} % 2147483647) * 48271 + r * 69621 + 12345) % 2147483647 AS x
  FROM scored CROSS JOIN (SELECT unnest(range(1, 1001)) AS r)),
h1 AS (SELECT a, e, r, (x * x + r) % 2147483647 AS x FROM fan), h2 AS (SELECT a, e, r, (x * 16807 + 7) % 2147483647 AS x FROM h1),
h3 AS (SELECT a, e, r, (x * x + 11) % 2147483647 AS x FROM h2), w AS (SELECT a, e, r, {_weight_sql()} AS w FROM h3),
s AS (SELECT r, 1 - sum(w * e) / (sum(w * a * a) - sum(w * a) * sum(w * a) / sum(w)) AS r2 FROM w GROUP BY r)
SELECT count(*) AS replicates, round(avg(r2), 5) AS r2_mean, round(quantile_cont(r2, 0.025), 5) AS r2_low, round(quantile_cont(r2, 0.975), 5) AS r2_high FROM s""")
def bootstrap_r2(spark, sf_dir):
    train, test = _parts(spark, sf_dir, "car_age")
    scored = _predict(train, test, "ols").select("listing_id", "actual", "predicted")
    return rounded(E.bootstrap_interval(scored, 1000), 5)


# expected price range per make from training rows, checked against the mean prediction on test rows
_CHECKED = f"""{_SCORED},
expected AS (SELECT make_name_cleaned AS case_id, CASE WHEN count(*) >= 20 THEN avg(exp(price_log) - 1) * 0.2 END AS min_price,
  CASE WHEN count(*) >= 20 THEN avg(exp(price_log) - 1) * 0.5 END AS max_price FROM train GROUP BY 1),
predicted AS (SELECT make_name_cleaned AS case_id, avg(group_mean) AS predicted_price FROM scored GROUP BY 1),
checked AS (SELECT case_id, min_price, max_price, predicted_price, CASE WHEN predicted_price IS NULL THEN 'ERROR' WHEN min_price IS NULL OR max_price IS NULL THEN 'CHECK MANUALLY'
       WHEN predicted_price BETWEEN min_price AND max_price THEN 'PASSED' ELSE 'FAILED' END AS status
FROM expected LEFT JOIN predicted USING (case_id))"""


@plan("golden_ranges", f"""{_CHECKED} SELECT case_id, round(min_price, 2) AS min_price, round(max_price, 2) AS max_price,
  round(predicted_price, 2) AS predicted_price, status FROM checked""")
def golden_ranges(spark, sf_dir):
    return rounded(_checked(spark, sf_dir), 2)


def _checked(spark, sf_dir):
    train, test = _parts(spark, sf_dir, "make_name_cleaned", names=True)
    enough = F.count(F.lit(1)) >= 20
    mean = F.avg(invert_log(F.col("price_log")))
    expected = train.groupBy(F.col("make_name_cleaned").alias("case_id")).agg(
        F.when(enough, mean * 0.2).alias("min_price"), F.when(enough, mean * 0.5).alias("max_price"))
    predicted = _predict(train, test, "group_mean").groupBy(F.col("make_name_cleaned").alias("case_id")).agg(
        F.avg("predicted").alias("predicted_price"))
    return E.range_check(predicted, expected)


@plan("golden_summary", f"""{_CHECKED} SELECT count(*) FILTER (WHERE status = 'PASSED') AS passed, count(*) FILTER (WHERE status = 'FAILED') AS failed,
  count(*) FILTER (WHERE status = 'ERROR') AS error, count(*) FILTER (WHERE status = 'CHECK MANUALLY') AS check_manually,
  bool_and(status NOT IN ('FAILED', 'ERROR')) AS all_passed FROM checked""")
def golden_summary(spark, sf_dir):
    return E.all_passed(_checked(spark, sf_dir))


def _compared(spark, sf_dir):
    # seven passes over the parts: the columns they need are written once
    needed = feature_table(spark, sf_dir).select("listing_id", "price_log", *_CONTEXT)
    train, test = train_test(materialize(needed, "compared"))
    base = test.select("listing_id", *_CONTEXT, invert_log(F.col("price_log")).alias("actual"))
    scored = {m: _predict(train, test, m) for m in ("ols", "group_mean", "median")}
    return E.compare_models(base, {**scored, "failed": None})


@plan("model_comparison", f"""{_SCORED} SELECT listing_id, {", ".join(c if c != "mileage_num" else c for c in _CONTEXT)}, round(actual, 5) AS actual,
  round(ols, 2) AS ols_prediction, round(group_mean, 2) AS group_mean_prediction, round(median, 2) AS median_prediction,
  CAST(NULL AS DOUBLE) AS failed_prediction FROM scored""")
def model_comparison(spark, sf_dir):
    return rounded(_compared(spark, sf_dir), 2, actual=5)


@plan("predictions_long", f"""{_SCORED}, x AS (SELECT listing_id, actual, ols AS ols_prediction, group_mean AS group_mean_prediction, median AS median_prediction FROM scored)
SELECT listing_id, 'actual' AS model, round(actual, 5) AS price FROM x UNION ALL SELECT listing_id, 'ols_prediction', round(ols_prediction, 5) FROM x
UNION ALL SELECT listing_id, 'group_mean_prediction', round(group_mean_prediction, 5) FROM x UNION ALL SELECT listing_id, 'median_prediction', round(median_prediction, 5) FROM x""")
def predictions_long(spark, sf_dir):
    return rounded(E.predictions_long(_compared(spark, sf_dir).drop("failed_prediction")), 5)


@plan("comparison_nulls", f"{_SCORED} SELECT 'ols_prediction' AS column_name, 'double' AS column_type, count(*) AS row_count, count(ols) AS non_null, "
                          "count(*) - count(ols) AS nulls, 0.0::DOUBLE AS null_pct FROM scored "
                          "UNION ALL SELECT 'failed_prediction', 'double', count(*), 0, count(*), 100.0 FROM scored")
def comparison_nulls(spark, sf_dir):
    return rounded(null_profile(_compared(spark, sf_dir).select("ols_prediction", "failed_prediction")))


# the compatible inverse ends one unit above the exact one
@plan("inverse_variants", f"""{_SCORED} SELECT listing_id, round(exp(price_log) - 1, 5) AS price, round(exp(price_log), 5) AS price_compatible FROM test""")
def inverse_variants(spark, sf_dir):
    _, test = _parts(spark, sf_dir)
    return rounded(test.select("listing_id", invert_log(F.col("price_log")).alias("price"),
                               invert_log(F.col("price_log"), "exp").alias("price_compatible")), 5)


@plan("linear_contributions", f"""{_SCORED}, m AS (SELECT avg(car_age) AS mean_age FROM train)
SELECT listing_id, 'car_age' AS feature, round(b * (car_age - mean_age), 6) AS contribution FROM test CROSS JOIN line CROSS JOIN m""")
def linear_contributions(spark, sf_dir):
    train, test = _parts(spark, sf_dir, "car_age")
    slope, _ = M.line_fit(train, "car_age", "price_log")
    mean = train.agg(F.avg("car_age")).first()[0]
    return rounded(M.linear_contributions(test, {"car_age": slope}, {"car_age": mean}))


_FOLD = S.bucket("listing_id", 43, 5)


# out-of-fold closed-form predictions feed a blend with weights from their cross-validation error
@plan("weighted_blend", f"""WITH {S.FEATURES}, t AS (SELECT *, {_FOLD} AS fold FROM features WHERE {_B} < 80),
fits AS (SELECT f, (SELECT regr_slope(price_log, car_age) FROM t WHERE fold <> f) AS b, (SELECT regr_intercept(price_log, car_age) FROM t WHERE fold <> f) AS a,
  (SELECT avg(price_log) FROM t WHERE fold <> f) AS mean FROM (SELECT unnest(range(5)) AS f)),
groups AS (SELECT f AS gf, make_name_cleaned AS g, avg(price_log) AS gm FROM t, (SELECT unnest(range(5)) AS f) WHERE fold <> f GROUP BY 1, 2),
oof AS (SELECT t.*, a + b * car_age AS ols, coalesce(gm, mean) AS group_mean FROM t JOIN fits ON fold = f LEFT JOIN groups ON gf = fold AND g = make_name_cleaned),
err AS (SELECT sqrt(avg(pow(price_log - ols, 2))) AS e1, sqrt(avg(pow(price_log - group_mean, 2))) AS e2 FROM oof)
SELECT listing_id, fold, round(ols, 6) AS ols, round(group_mean, 6) AS group_mean,
  round(ols * (1 / e1) / (1 / e1 + 1 / e2) + group_mean * (1 / e2) / (1 / e1 + 1 / e2), 6) AS blend FROM oof CROSS JOIN err""")
def weighted_blend(spark, sf_dir):
    train, _ = _parts(spark, sf_dir, "car_age", "make_name_cleaned", names=True)
    train = train.select("listing_id", "car_age", "make_name_cleaned", "price_log", fold(F.col("listing_id")).alias("fold"))
    fits = M.line_fits_out_of_fold(train, "car_age", "price_log", "fold", 5)
    oof = target_encoding(train, "make_name_cleaned", "price_log", F.col("fold"), smooth=0.0)
    oof = oof.select("listing_id", "fold", "price_log", F.col("make_name_cleaned_encoded").alias("group_mean"),
                     M.line_out_of_fold(fits, "car_age", "fold").alias("ols"))
    err = oof.agg(*[F.sqrt(F.avg(F.pow(F.col("price_log") - F.col(m), 2))).alias(m) for m in ("ols", "group_mean")]).first()
    blend = M.weighted_blend({m: F.col(m) for m in ("ols", "group_mean")}, err.asDict())
    return rounded(oof.select("listing_id", "fold", "ols", "group_mean", blend.alias("blend")))
