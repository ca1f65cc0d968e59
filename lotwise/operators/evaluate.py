"""Model evaluation as aggregates over (actual, predicted) rows."""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions.numbers import hash_unit
from lotwise.operators.quantiles import exact_quantiles

ERROR_PROBS = [0.25, 0.5, 0.75, 0.9, 0.95]
_PRIME = 2147483647
#: Cumulative Poisson(1) probabilities of 0, 1, 2, ... draws, as far as the hash tells them from 1.
POISSON_1 = list(accumulate(math.exp(-1) / math.factorial(k) for k in range(13)))
KEY_SEED = 23
TASK_DRAWS = 50_000_000


def percent_error(actual: Column, predicted: Column) -> Column:
    return F.try_divide(F.abs(actual - predicted), actual) * 100


def _r2(actual: Column, predicted: Column, weight: Column | None = None) -> Column:
    """1 - SSE / SST, from sums around a weighted mean."""
    if weight is None:
        return 1 - F.try_divide(F.sum(F.pow(actual - predicted, 2)), F.var_pop(actual) * F.count(actual))
    w, wy, wyy = F.sum(weight), F.sum(weight * actual), F.sum(weight * actual * actual)
    return 1 - F.try_divide(F.sum(weight * F.pow(actual - predicted, 2)), wyy - wy * wy / w)


def metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted", by: list[str] | None = None,
            rollup: bool = False) -> DataFrame:
    """Rows, MAE, RMSE, R2, and percentage error: mean, population std, and the mean without actual = 0."""
    a, p = F.col(actual), F.col(predicted)
    ape = percent_error(a, p)
    aggs = [
        F.count(F.lit(1)).alias("rows"), F.avg(F.abs(a - p)).alias("mae"),
        F.sqrt(F.avg(F.pow(a - p, 2))).alias("rmse"), _r2(a, p).alias("r2"),
        F.avg(ape).alias("mean_ape"), F.stddev_pop(ape).alias("std_ape"),
        (F.avg(F.when(a != 0, F.abs((a - p) / F.when(a != 0, a)))) * 100).alias("mape_nonzero"),
    ]
    if not by:
        return df.agg(*aggs)
    return (df.rollup(*by) if rollup else df.groupBy(*by)).agg(*aggs)


def error_percentiles(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    ape = percent_error(F.col(actual), F.col(predicted))
    return exact_quantiles(df, {"ape": ape}, ERROR_PROBS).select("prob", F.col("value").alias("ape"))


def log_grid(low: float, high: float, points: int) -> Column:
    """Evenly spaced points on a log10 scale, as an array."""
    step = (high - low) / (points - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.pow(F.lit(10.0), F.lit(low) + i * step))


def residual_bins(df: DataFrame, width_pct: float = 10.0, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Histogram of the signed percentage error with the mean residual of each bin."""
    a, p = F.col(actual), F.col(predicted)
    signed = F.try_divide(p - a, a) * 100
    return (
        df.where(signed.isNotNull()).groupBy(F.floor(signed / width_pct).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"), F.avg(p - a).alias("mean_residual"))
    )


def residuals_by_price(df: DataFrame, per_decade: int = 4, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Actual against predicted in logarithmic price bands, with the percentage error of each band."""
    a, p = F.col(actual), F.col(predicted)
    band = F.floor(F.log10(a) * per_decade) / per_decade
    return df.where(a > 0).groupBy(band.alias("log10_from")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(a).alias("mean_actual"), F.avg(p).alias("mean_predicted"),
        F.avg(percent_error(a, p)).alias("mean_ape"))


def _row_number(key: Column) -> Column:
    return hash_unit(key, KEY_SEED) % _PRIME


def _draw(row: Column, replicate: Column) -> Column:
    """A number below the prime for (row, replicate), by whole-number arithmetic that any SQL engine repeats."""
    x = (row * 48271 + replicate * 69621 + 12345) % _PRIME
    x = (x * x + replicate) % _PRIME
    x = (x * 16807 + 7) % _PRIME
    return (x * x + 11) % _PRIME


def _draws_to_weight(x: Column) -> Column:
    weight = F.lit(len(POISSON_1))
    for draws in reversed(range(len(POISSON_1))):
        weight = F.when(x < int(POISSON_1[draws] * _PRIME), draws).otherwise(weight)
    return weight


def poisson_weight(key: Column, replicate: Column) -> Column:
    """Poisson(1) draw for (row, replicate)."""
    return _draws_to_weight(_draw(_row_number(key), replicate))


def bootstrap_r2(df: DataFrame, key: str = "listing_id", replicates: int = 1000,
                 actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """R2 of each Poisson resample. Rows fan out inside the task and collapse before the shuffle.

    The rows are dealt to tasks of about ``TASK_DRAWS`` draws each, whatever files they come from; a row's hash
    is worked out once, before it fans out.
    """
    a, p = F.col(actual), F.col(predicted)
    rows = df.select(_row_number(F.col(key)).alias("k"), a.alias("a"), F.pow(a - p, 2).alias("e"))
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() * replicates / TASK_DRAWS))
    fan = rows.repartition(tasks, "k").select("k", "a", "e", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate"))
    fan = fan.select("replicate", "a", "e", _draw(F.col("k"), F.col("replicate").cast("bigint")).alias("x"))
    fan = fan.select("replicate", "a", "e", _draws_to_weight(F.col("x")).alias("w"))
    sums = fan.where(F.col("w") > 0).groupBy("replicate").agg(
        F.sum("w").alias("n"), F.sum(F.col("w") * F.col("a")).alias("y"),
        F.sum(F.col("w") * F.col("a") * F.col("a")).alias("yy"), F.sum(F.col("w") * F.col("e")).alias("e"))
    return sums.select("replicate", (1 - F.try_divide(F.col("e"), F.col("yy") - F.col("y") * F.col("y") / F.col("n"))).alias("r2"))


def bootstrap_interval(df: DataFrame, replicates: int = 1000, level: float = 0.95, **kw) -> DataFrame:
    """Percentile interval over the replicates (a table as long as their number)."""
    tail = (1 - level) / 2
    return bootstrap_r2(df, replicates=replicates, **kw).agg(
        F.count("r2").alias("replicates"), F.avg("r2").alias("r2_mean"),
        F.percentile("r2", F.lit(tail)).alias("r2_low"), F.percentile("r2", F.lit(1 - tail)).alias("r2_high"))


def range_check(predictions: DataFrame, expected: DataFrame, key: str = "case_id") -> DataFrame:
    """PASSED or FAILED by price range; ERROR without a prediction; CHECK MANUALLY without a range."""
    p, low, high = F.col("predicted_price"), F.col("min_price"), F.col("max_price")
    status = (
        F.when(p.isNull(), "ERROR").when(low.isNull() | high.isNull(), "CHECK MANUALLY")
        .when((p >= low) & (p <= high), "PASSED").otherwise("FAILED")
    )
    return expected.join(predictions, key, "left").withColumn("status", status)


def all_passed(checked: DataFrame) -> DataFrame:
    """One row: counts per status and whether nothing failed."""
    return checked.agg(
        *[F.count_if(F.col("status") == s).alias(s.lower().replace(" ", "_")) for s in ("PASSED", "FAILED", "ERROR", "CHECK MANUALLY")],
        F.coalesce(F.bool_and(~F.col("status").isin("FAILED", "ERROR")), F.lit(True)).alias("all_passed"))


def compare_models(base: DataFrame, scored: dict[str, DataFrame | None], key: str = "listing_id") -> DataFrame:
    """Context and actual price with one prediction column per model; a model that failed gives NULLs."""
    out = base
    for name, df in scored.items():
        if df is None:
            out = out.withColumn(f"{name}_prediction", F.lit(None).cast("double"))
            continue
        side = df.select(F.col(key).alias("_k"), F.col("predicted").alias(f"{name}_prediction"))
        out = out.join(side, F.col(key) == F.col("_k"), "left").drop("_k")
    return out


def predictions_long(compared: DataFrame, key: str = "listing_id") -> DataFrame:
    """(key, model, price), the actual price as a model of its own."""
    cols = [c for c in compared.columns if c.endswith("_prediction") or c == "actual"]
    return compared.unpivot(key, cols, "model", "price")
