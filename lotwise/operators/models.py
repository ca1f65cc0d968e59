"""Closed-form predictors: cheap baselines that any SQL engine can repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.operators.lookups import written_lookup
from lotwise.operators.quantiles import medians


def median_predictor(train: DataFrame, target: str) -> Column:
    return F.lit(medians(train, {"t": F.col(target)})["t"])


def line_fit(train: DataFrame, x: str, y: str) -> tuple[float, float]:
    """(slope, intercept) of the least-squares line, in one aggregate."""
    row = train.agg(F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a")).first()
    return row["b"], row["a"]


def line_fits_out_of_fold(train: DataFrame, x: str, y: str, fold: str, folds: int) -> dict[int, tuple[float, float]]:
    """Least-squares line per fold, fitted on the other folds; all of them in one aggregate."""
    def other(f: int, c: str) -> Column:
        return F.when(F.col(fold) != f, F.col(c))

    row = train.agg(*[a for f in range(folds) for a in (
        F.regr_slope(other(f, y), other(f, x)).alias(f"b{f}"), F.regr_intercept(other(f, y), other(f, x)).alias(f"a{f}"))]).first()
    return {f: (row[f"b{f}"], row[f"a{f}"]) for f in range(folds)}


def line_out_of_fold(fits: dict[int, tuple[float, float]], x: str, fold: str) -> Column:
    out = None
    for f, fit in fits.items():
        out = F.when(F.col(fold) == f, line(fit, x)) if out is None else out.when(F.col(fold) == f, line(fit, x))
    return out


def line(fit: tuple[float, float], x: str) -> Column:
    return F.lit(fit[0]) * F.col(x) + F.lit(fit[1])


def group_mean(train: DataFrame, test: DataFrame, by: str, target: str, out: str = "predicted") -> DataFrame:
    """Mean target of the row's group in training; the overall mean for groups not seen there."""
    sums = train.groupBy(F.col(by).alias("_g")).agg(F.sum(target).alias("_s"), F.count(target).alias("_n"))
    written, side = written_lookup(sums, "group-sums")
    overall = written.agg(F.try_divide(F.sum("_s"), F.sum("_n"))).first()[0]
    joined = test.join(side, F.col(by).eqNullSafe(F.col("_g")), "left")
    return joined.withColumn(out, F.coalesce(F.try_divide("_s", "_n"), F.lit(overall))).drop("_g", "_s", "_n")


def linear_contributions(df: DataFrame, coefficients: dict[str, float], means: dict[str, float], key: str = "listing_id") -> DataFrame:
    """Exact contribution of each input of a linear model: coefficient times distance from the mean."""
    entries = [F.struct(F.lit(c).alias("feature"), (F.lit(b) * (F.col(c) - F.lit(means[c]))).alias("contribution"))
               for c, b in coefficients.items()]
    return df.select(key, F.inline(F.array(*entries)))


def global_importance(contributions: DataFrame, top: int = 10) -> DataFrame:
    """Mean absolute contribution per feature, the largest first."""
    out = contributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))
    return out.orderBy(F.desc("importance"), "feature").limit(top)


def dependence(contributions: DataFrame, values: DataFrame, feature: str, bins: int = 20, key: str = "listing_id") -> DataFrame:
    """Mean contribution of one feature along its value range (equal-width bins)."""
    lo, hi = values.agg(F.min(feature), F.max(feature)).first()
    width = (float(hi) - float(lo)) / bins or 1.0
    pairs = contributions.where(F.col("feature") == feature).join(values.select(key, F.col(feature).cast("double").alias("v")), key)
    at = F.least(F.floor((F.col("v") - float(lo)) / width), F.lit(bins - 1)).cast("int")
    return pairs.groupBy(at.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg("v").alias("mean_value"), F.avg("contribution").alias("mean_contribution"))


def dependence_table(contributions: DataFrame, values: DataFrame, features: list[str], bins: int = 20, key: str = "listing_id") -> DataFrame:
    """(feature, value_from, value, rows, mean_contribution) along each feature: ranges of numbers, or single words."""
    kinds = dict(values.dtypes)
    words = [f for f in features if kinds[f] == "string"]
    numbers = [f for f in features if f not in words]
    bounds = values.agg(*[a for f in numbers for a in (F.min(f).cast("double").alias(f"lo_{f}"), F.max(f).cast("double").alias(f"hi_{f}"))]).first() if numbers else None
    entries = [F.struct(F.lit(f).alias("feature"), F.lit(None).cast("double").alias("value_from"), F.col(f).alias("value")) for f in words]
    for f in numbers:
        lo, hi = bounds[f"lo_{f}"], bounds[f"hi_{f}"]
        width = ((hi or 0.0) - (lo or 0.0)) / bins or 1.0
        at = F.least(F.floor((F.col(f) - F.lit(lo or 0.0)) / width), F.lit(bins - 1))
        entries.append(F.struct(F.lit(f).alias("feature"), (F.lit(lo or 0.0) + at * width).cast("double").alias("value_from"), F.lit(None).cast("string").alias("value")))
    long = values.select(F.col(key).alias("_key"), F.inline(F.array(*entries))).withColumnRenamed("feature", "_feature")
    pairs = contributions.join(long, (F.col(key) == F.col("_key")) & (F.col("feature") == F.col("_feature")))
    return pairs.groupBy("feature", "value_from", "value").agg(F.count(F.lit(1)).alias("rows"), F.avg("contribution").alias("mean_contribution"))


def weighted_blend(predictions: dict[str, Column], errors: dict[str, float]) -> Column:
    """Weighted average of predictions, weights from the inverse cross-validation error."""
    inverse = {n: 1.0 / errors[n] for n in predictions}
    total = sum(inverse.values())
    return sum((c * F.lit(inverse[n] / total) for n, c in predictions.items()), F.lit(0.0))
