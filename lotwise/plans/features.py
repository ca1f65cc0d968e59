"""Feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.operators.features import NUMERIC_FEATURES, TARGET
from lotwise.plans import sqltext as S
from lotwise.plans.common import feature_table
from lotwise.plans.registry import plan, rounded

_DIGITS = {**S.NUMERIC_COLUMNS, "price_log": 6}


@plan("feature_table", f"WITH {S.FEATURES} SELECT listing_id, {S.NUMERIC_LIST}, {S.TEXT_LIST} FROM features")
def features(spark, sf_dir):
    return rounded(feature_table(spark, sf_dir), **_DIGITS)


@plan("numeric_features", f"WITH {S.LISTINGS}, {S.NUMERIC} SELECT listing_id, {S.NUMERIC_LIST} FROM numeric_features")
def numeric(spark, sf_dir):
    names = [f for f in NUMERIC_FEATURES if f != "is_luxury_make"]
    return rounded(feature_table(spark, sf_dir, names=False).select("listing_id", TARGET, *names), **_DIGITS)


@plan("price_by_fuel", f"""WITH {S.FEATURES}
SELECT fuel_type_cleaned, count(*) AS listings, round(median(price_log), 6) AS median_price_log,
  round(avg(price_log), 6) AS mean_price_log FROM features GROUP BY 1""")
def price_by_fuel(spark, sf_dir):
    from lotwise.operators.quantiles import exact_quantiles

    feats = feature_table(spark, sf_dir, names=False).select("fuel_type_cleaned", "price_log")
    counts = feats.groupBy("fuel_type_cleaned").agg(
        F.count(F.lit(1)).alias("listings"), F.avg("price_log").alias("mean_price_log"))
    mid = exact_quantiles(feats, {"price_log": F.col("price_log")}, [0.5], by=("fuel_type_cleaned",))
    mid = mid.select("fuel_type_cleaned", F.col("value").alias("median_price_log"))
    return rounded(counts.join(mid, "fuel_type_cleaned"))
