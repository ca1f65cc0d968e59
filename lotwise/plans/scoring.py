"""Request, registry and scoring queries."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from lotwise.functions.numbers import to_number
from lotwise.functions.vocabulary import REQUEST_DEFAULTS
from lotwise.operators import registry as R, requests as Q, training as T
from lotwise.operators.features import FEATURES
from lotwise.operators.profiling import null_profile
from lotwise.operators.split import train_test
from lotwise.operators.stacking import fit_stack
from lotwise.plans import sqltext as S
from lotwise.plans.common import feature_table
from lotwise.plans.registry import AS_OF_YEAR, plan, rounded
from lotwise.plans.training import data
from lotwise.sources.listings import listings
from lotwise.sources.scratch import new_path

_RAW = ["year_of_manufacture", "mileage", "engine_size_cc", "horse_power", "torque"]


def requests(spark, sf_dir):
    """Listings as scoring requests: numbers parsed, derived fields computed, nothing fitted."""
    df = listings(spark, sf_dir)
    df = df.select(
        "listing_id", *[to_number(F.col(c)).alias(c) for c in _RAW], F.col("acceleration").alias("acceleration_num"),
        F.col("seats").cast("double").alias("seats_num"), "annual_insurance",
        F.col("make_name").alias("make_name_cleaned"), F.col("model_name").alias("model_name_cleaned"),
        F.col("fuel_type").alias("fuel_type_cleaned"), F.col("transmission").alias("transmission_cleaned"))
    return Q.derive(df, AS_OF_YEAR)


_DERIVED = f"""raw AS (SELECT listing_id, {", ".join(f"{S.num(c)} AS {c}" for c in _RAW)}, acceleration AS acceleration_num,
  CAST(seats AS DOUBLE) AS seats_num, annual_insurance, make_name, model_name, fuel_type, transmission FROM listings),
d0 AS (SELECT *, {AS_OF_YEAR} - year_of_manufacture AS car_age, coalesce(mileage, 0) AS m, coalesce(engine_size_cc, 0) AS cc FROM raw),
derived AS (SELECT *, car_age * car_age AS car_age_squared, ln(1 + m) AS mileage_log, m / (car_age + 1e-6) AS mileage_per_year,
  CASE WHEN cc > 0 THEN ln(1 + cc) ELSE 0 END AS engine_size_cc_log, CASE WHEN horse_power > 0 THEN ln(1 + horse_power) END AS horse_power_log,
  CASE WHEN torque > 0 THEN ln(1 + torque) END AS torque_log, CASE WHEN cc > 0 THEN horse_power / (cc + 1e-6) END AS power_per_cc,
  CASE WHEN cc > 0 THEN m / (cc + 1e-6) END AS mileage_per_cc FROM d0)"""


@plan("request_derivation", f"""WITH {S.LISTINGS}, {_DERIVED} SELECT listing_id, round(car_age, 4) AS car_age, round(mileage_log, 6) AS mileage_log,
  round(mileage_per_year, 2) AS mileage_per_year, round(engine_size_cc_log, 6) AS engine_size_cc_log, round(horse_power_log, 6) AS horse_power_log,
  round(torque_log, 6) AS torque_log, round(power_per_cc, 6) AS power_per_cc, round(mileage_per_cc, 6) AS mileage_per_cc FROM derived""")
def request_derivation(spark, sf_dir):
    names = ["car_age", "mileage_log", "mileage_per_year", "engine_size_cc_log", "horse_power_log", "torque_log", "power_per_cc", "mileage_per_cc"]
    return rounded(requests(spark, sf_dir).select("listing_id", *names), 6, mileage_per_year=2, car_age=4)


_FILLS = ", ".join(f"CASE WHEN {c} IS NULL THEN '{n}' END" for n, c in (
    ("horse_power_num", "horse_power"), ("torque_num", "torque"), ("acceleration_num", "acceleration_num"), ("seats_num", "seats_num")))


@plan("request_features", f"""WITH {S.LISTINGS}, {_DERIVED},
f AS (SELECT *, coalesce(horse_power, 100) AS hp, coalesce(torque, 150) AS tq, concat_ws(',', {_FILLS}) AS filled FROM derived)
SELECT listing_id, filled, hp AS horse_power_num, tq AS torque_num, coalesce(acceleration_num, 12.0) AS acceleration_num, coalesce(seats_num, 5) AS seats_num,
  round(coalesce(horse_power_log, ln(1 + hp)), 6) AS horse_power_log, round(coalesce(torque_log, ln(1 + tq)), 6) AS torque_log,
  round(CASE WHEN cc <> 0 THEN hp / cc ELSE 0 END, 9) AS power_per_cc, round(CASE WHEN cc <> 0 THEN m / cc ELSE 0 END, 9) AS mileage_per_cc FROM f""")
def request_features(spark, sf_dir):
    out = Q.preprocess(requests(spark, sf_dir))
    names = [*REQUEST_DEFAULTS, "horse_power_log", "torque_log", "power_per_cc", "mileage_per_cc"]
    return rounded(out.select("listing_id", F.array_join("filled", ",").alias("filled"), *names), 6, power_per_cc=9, mileage_per_cc=9)


def _rule(name: str, expr: str, required: bool, low=None, high=None) -> list[str]:
    out = [f"CASE WHEN {expr} IS NULL THEN '{name}: required' END"] if required else []
    out += [f"CASE WHEN {expr} < {low} THEN '{name}: below {low}' END"] if low is not None else []
    return out + ([f"CASE WHEN {expr} > {high} THEN '{name}: above {high}' END"] if high is not None else [])


_SQL_NAMES = {"make_name_cleaned": "make_name", "model_name_cleaned": "model_name", "mileage_num": "m", "engine_size_cc_num": "cc",
              "fuel_type_cleaned": "fuel_type", "transmission_cleaned": "transmission", "horse_power_num": "horse_power", "torque_num": "torque"}
_ABSENT = {"drive_type_cleaned", "condition_clean", "usage_type_clean", "body_type_cleaned", "is_luxury_make", "make_model_cleaned"}
_RULES = [r for f in Q.CONTRACT if f.name not in _ABSENT for r in _rule(f.name, _SQL_NAMES.get(f.name, f.name), f.required, f.low, f.high)]


@plan("validate_requests", f"""WITH {S.LISTINGS}, {_DERIVED} SELECT listing_id, concat_ws('; ', {", ".join(_RULES)}) AS violations FROM derived""")
def validate_requests(spark, sf_dir):
    out = Q.validate(requests(spark, sf_dir))
    return out.select("listing_id", F.array_join("violations", "; ").alias("violations"))


# what a request's feature is in SQL; those that a listing has no field for stay empty
_AUDITED = {c: c for c in FEATURES} | {n: c for n, c in _SQL_NAMES.items()} | {c: "CAST(NULL AS VARCHAR)" for c in _ABSENT} | {
    "horse_power_num": "coalesce(horse_power, 100)", "torque_num": "coalesce(torque, 150)", "acceleration_num": "coalesce(acceleration_num, 12)",
    "seats_num": "coalesce(seats_num, 5)", "horse_power_log": "coalesce(horse_power_log, ln(1 + coalesce(horse_power, 100)))",
    "torque_log": "coalesce(torque_log, ln(1 + coalesce(torque, 150)))",
    "power_per_cc": "CASE WHEN cc = 0 THEN 0 ELSE coalesce(horse_power, 100) / cc END", "mileage_per_cc": "CASE WHEN cc = 0 THEN 0 ELSE m / cc END"}
_KINDS = {f.name: f.kind for f in Q.CONTRACT}


@plan("request_null_audit", f"WITH {S.LISTINGS}, {_DERIVED}, audited AS (SELECT {', '.join(f'{_AUDITED[c]} AS {c}' for c in FEATURES)} FROM derived) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{_KINDS[c]}' AS column_type, count(*) AS row_count, count({c}) AS non_null, count(*) - count({c}) AS nulls, "
    f"round((count(*) - count({c})) * 100.0 / count(*), 6)::DOUBLE AS null_pct FROM audited" for c in FEATURES))
def request_null_audit(spark, sf_dir):
    """All features of a request, defaults filled."""
    return rounded(null_profile(Q.preprocess(requests(spark, sf_dir)).select(*FEATURES)))


# one input column, so that the registered pipeline has a closed form in SQL
def registered_line(spark, sf_dir, path):
    df = feature_table(spark, sf_dir, names=False)
    train, _ = train_test(df.select("listing_id", "car_age", "price_log"))
    stages = [VectorAssembler(inputCols=["car_age"], outputCol="features"),
              LinearRegression(labelCol="price_log", solver="normal", standardization=False)]
    model = PipelineModel([stages[0], stages[1].fit(stages[0].transform(train))])
    R.register(spark, path, "line", model, ["car_age"], ["num_main__car_age"], {}, version="20250101_000000")
    return df


@plan("registry_scores", f"""WITH {S.FEATURES}, line AS (SELECT regr_slope(price_log, car_age) AS b, regr_intercept(price_log, car_age) AS a FROM features WHERE {S.bucket('listing_id')} < 80)
SELECT listing_id, round(exp(a + b * car_age) - 1, 1) AS predicted_price, 'now' AS scored_at, 'line:20250101_000000' AS model_version FROM features CROSS JOIN line""")
def registry_scores(spark, sf_dir):
    path = new_path(spark, "registry")
    df = registered_line(spark, sf_dir, path)
    return rounded(R.score(df, R.find(spark, path, "line"), ["listing_id"], scored_at="now"), 1)


@plan("stack_scores_from_registry")
def stack_scores_from_registry(spark, sf_dir):
    """Stack and single model from one registry, scored on all listings."""
    d = data(spark, sf_dir)
    learners = {"linear": T.learner("linear"), "forest": T.learner("forest", numTrees=10, maxDepth=6)}
    stack = fit_stack(d.train, learners)
    path = new_path(spark, "registry")
    enc = d.encoder
    names = [f for f in FEATURES if f in d.train.columns]
    quality = T.quality(stack.transform(d.test))
    R.register(spark, path, "stack", PipelineModel([*enc.pipeline.stages, *stack.stages()]), names, enc.names, quality)
    single = T.learner("linear").fit(d.train)
    R.register(spark, path, "linear", PipelineModel([*enc.pipeline.stages, single]), names, enc.names, {})
    df = d.stats.transform(listings(spark, sf_dir))
    a = R.score(df, R.find(spark, path, "stack"), ["listing_id"], "now").drop("model_version", "scored_at")
    b = R.score(df, R.find(spark, path, "linear"), ["listing_id"], "now").select("listing_id", F.col("predicted_price").alias("linear_price"))
    return rounded(a.join(b, "listing_id"), 1)


@plan("registry_metadata")
def registry_metadata(spark, sf_dir):
    path = new_path(spark, "registry")
    registered_line(spark, sf_dir, path)
    return R.metadata_json(spark, path)
