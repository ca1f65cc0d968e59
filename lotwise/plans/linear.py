"""Jobs on cross products: chained imputation and ablation by refit."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.operators.ablation import ablation
from lotwise.operators.features import NUMERIC_FEATURES, TARGET, FeatureOptions, numeric_inputs
from lotwise.operators.impute import chained_impute
from lotwise.operators.split import train_test
from lotwise.plans import sqltext as S
from lotwise.plans.common import feature_table
from lotwise.plans.profiles import _MEASURES, MEASURES
from lotwise.plans.registry import AS_OF_YEAR, plan, rounded
from lotwise.sources.listings import written_listings

_GAPS = [*MEASURES, "annual_insurance"]


def _filled(spark, sf_dir):
    raw = written_listings(spark, sf_dir)
    before = raw.select("listing_id", *[numeric_inputs(raw, FeatureOptions(AS_OF_YEAR))[m].alias(m) for m in MEASURES],
                        F.col("annual_insurance").cast("double").alias("annual_insurance"))
    return before, chained_impute(before, _GAPS)


@plan("chained_imputation")
def chained_imputation(spark, sf_dir):
    """All eight numeric inputs of the raw listings, gaps filled from each other."""
    return rounded(_filled(spark, sf_dir)[1], 4)


# what holds whatever the fill: rows, gaps filled, and the known values as they were
@plan("chained_imputation_kept", f"{_MEASURES} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS filled, round(avg({c}), 3) AS known_mean, count(*) - count({c}) AS changed "
    f"FROM {'listings' if c == 'annual_insurance' else 'numeric_inputs'}" for c in _GAPS))
def chained_imputation_kept(spark, sf_dir):
    before, after = _filled(spark, sf_dir)
    both = after.join(before.select("listing_id", *[F.col(c).alias(f"was_{c}") for c in _GAPS]), "listing_id")
    one = both.agg(*[a for c in _GAPS for a in (
        F.count(c).alias(f"n_{c}"), F.count_if(F.col(f"was_{c}").isNull() & F.col(c).isNotNull()).alias(f"f_{c}"),
        F.avg(F.when(F.col(f"was_{c}").isNotNull(), F.col(c))).alias(f"m_{c}"), F.count_if(~F.col(c).eqNullSafe(F.col(f"was_{c}"))).alias(f"d_{c}"))])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("rows"), F.col(f"f_{c}").alias("filled"),
                     F.col(f"m_{c}").alias("known_mean"), F.col(f"d_{c}").alias("changed")) for c in _GAPS]
    return rounded(one.select(F.inline(F.array(*rows))), 3)


_INPUTS = [c for c in NUMERIC_FEATURES if c != "annual_insurance"]


@plan("ablation_refit")
def ablation_refit(spark, sf_dir):
    """All numeric features; each row is a linear fit without one of them."""
    train, test = train_test(feature_table(spark, sf_dir).select("listing_id", TARGET, *_INPUTS))
    return rounded(ablation(train, test, _INPUTS, TARGET), 6)


_TWO = ["car_age", "engine_size_cc_log"]


# full fit of two inputs by its normal equations, the fits without one of them by regr_slope
@plan("ablation_refit_pair", f"""WITH {S.FEATURES}, split AS (SELECT price_log AS y, car_age::DOUBLE AS x1, engine_size_cc_log AS x2, {S.bucket('listing_id')} < 80 AS seen FROM features),
m AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) AS s11, var_pop(x2) AS s22, covar_pop(x1, x2) AS s12, covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y FROM split WHERE seen),
fits AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2, s1y / s11 AS c1, s2y / s22 AS c2 FROM m),
e AS (SELECT count(*) AS n, var_pop(y) AS v, sum(pow(y - my - b1 * (x1 - m1) - b2 * (x2 - m2), 2)) AS whole,
  sum(pow(y - my - c2 * (x2 - m2), 2)) AS no1, sum(pow(y - my - c1 * (x1 - m1), 2)) AS no2 FROM split CROSS JOIN fits WHERE NOT seen),
parts AS (SELECT 'car_age' AS feature, n, v, whole, no1 AS part FROM e UNION ALL SELECT 'engine_size_cc_log', n, v, whole, no2 FROM e)
SELECT feature, round(1 - whole / (n * v), 6) AS r2, round(sqrt(whole / n), 6) AS rmse, round(1 - part / (n * v), 6) AS r2_without, round(sqrt(part / n), 6) AS rmse_without,
  round((part - whole) / (n * v), 6) AS r2_loss, round(sqrt(part / n) - sqrt(whole / n), 6) AS rmse_growth FROM parts""")
def ablation_refit_pair(spark, sf_dir):
    train, test = train_test(feature_table(spark, sf_dir, numbers=["price", "year", "engine_size_cc"], names=False).select("listing_id", TARGET, *_TWO))
    return rounded(ablation(train, test, _TWO, TARGET), 6)
