"""Profiling and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions.numbers import to_number
from lotwise.functions.text import strip_lower
from lotwise.operators import profiling as P, quality as Q
from lotwise.operators.categories import clean_categories
from lotwise.operators.features import FeatureOptions, numeric_inputs
from lotwise.operators.prices import currency
from lotwise.plans import sqltext as S
from lotwise.plans.common import feature_table
from lotwise.plans.registry import AS_OF_YEAR, plan, rounded
from lotwise.sources.listings import listings

RAW = ["listing_id", "price", "currency_code", "year_of_manufacture", "mileage", "mileage_unit", "engine_size_cc",
       "horse_power", "torque", "acceleration", "seats", "annual_insurance", "make_name", "model_name", "fuel_type",
       "transmission", "drive_type", "condition", "usage_type", "body_type", "source"]
TEXTS = ["make_name", "model_name", "fuel_type", "transmission", "drive_type", "condition", "usage_type", "body_type"]
MEASURES = ["price", "mileage", "engine_size_cc", "horse_power", "torque", "acceleration", "seats"]


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def measures(df):
    """Numeric forms of the measures, before any filling."""
    inputs = numeric_inputs(df, FeatureOptions(AS_OF_YEAR))
    return df.select("listing_id", "fuel_type", *[inputs[m].alias(m) for m in MEASURES])


_MEASURES = f"WITH {S.LISTINGS}, {S.NUMERIC}"

_TYPES = {"listing_id": "bigint", "price": "double", "acceleration": "double", "seats": "int", "annual_insurance": "double"}


@plan("profile_nulls", f"WITH {S.LISTINGS} " + _union([
    f"SELECT '{c}' AS column_name, '{_TYPES.get(c, 'string')}' AS column_type, count(*) AS row_count, "
    f"count({c}) AS non_null, count(*) - count({c}) AS nulls, "
    f"round((count(*) - count({c})) * 100.0 / count(*), 6)::DOUBLE AS null_pct FROM listings" for c in RAW]))
def profile_nulls(spark, sf_dir):
    return rounded(P.null_profile(listings(spark, sf_dir, with_source=True)))


@plan("profile_numeric", f"{_MEASURES} " + _union([
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
    f"round(min({c}), 4) AS min, round(max({c}), 4) AS max, round(quantile_cont({c}, 0.25), 3) AS p25, "
    f"round(quantile_cont({c}, 0.5), 3) AS p50, round(quantile_cont({c}, 0.75), 3) AS p75 FROM numeric_inputs"
    for c in MEASURES]))
def profile_numeric(spark, sf_dir):
    df = measures(listings(spark, sf_dir))
    return rounded(P.numeric_profile(df, {m: F.col(m) for m in MEASURES}), 4, p25=3, p50=3, p75=3)


def _counts(columns) -> str:
    return _union([f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS rows FROM listings GROUP BY 2"
                   for c in columns])


@plan("profile_categories", f"""WITH {S.LISTINGS}, counts AS ({_counts(TEXTS)}), known AS (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY rows DESC, value) AS place FROM counts WHERE value IS NOT NULL)
SELECT column_name, CAST(sum(rows) AS BIGINT) AS count, count(*) AS distinct_values,
  max(value) FILTER (WHERE place = 1) AS top, max(rows) FILTER (WHERE place = 1) AS freq FROM known GROUP BY 1""")
def profile_categories(spark, sf_dir):
    return P.category_profile(listings(spark, sf_dir), TEXTS)


@plan("profile_top_values", f"""WITH {S.LISTINGS}, counts AS ({_counts(TEXTS)})
SELECT column_name, value, rows, CAST(place AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY rows DESC, value NULLS FIRST) AS place FROM counts)
WHERE place <= 30""")
def profile_top_values(spark, sf_dir):
    return P.top_values(listings(spark, sf_dir), TEXTS, 30)


@plan("value_counts_currency", f"WITH {S.LISTINGS} SELECT currency_code AS value, count(*) AS rows FROM listings GROUP BY 1")
def value_counts_currency(spark, sf_dir):
    return P.value_counts(listings(spark, sf_dir), "currency_code")


@plan("sample_head", f"WITH {S.LISTINGS} SELECT listing_id, make_name, model_name, year_of_manufacture, price "
                     "FROM listings ORDER BY listing_id LIMIT 5")
def sample_head(spark, sf_dir):
    df = listings(spark, sf_dir).select("listing_id", "make_name", "model_name", "year_of_manufacture", "price")
    return P.head(df, "listing_id", 5)


_BINS = f"""{_MEASURES}, bounds AS (SELECT min(price) AS lo, max(price) AS hi, {{bins}} AS bins FROM numeric_inputs),
binned AS (SELECT least(CAST(floor((price - lo) / ((hi - lo) / bins)) AS INTEGER), CAST(bins AS INTEGER) - 1) AS bin
           FROM numeric_inputs CROSS JOIN bounds WHERE price IS NOT NULL)
SELECT bin, round(lo + bin * ((hi - lo) / bins), 2) AS bin_start, round(lo + (bin + 1) * ((hi - lo) / bins), 2) AS bin_end, rows
FROM (SELECT bin, count(*) AS rows FROM binned GROUP BY 1) CROSS JOIN bounds"""


@plan("price_histogram", _BINS.format(bins="50"))
def price_histogram(spark, sf_dir):
    df = measures(listings(spark, sf_dir))
    return rounded(P.histogram(df, F.col("price"), 50), 2)


@plan("price_histogram_auto", _BINS.format(
    bins="ceil((max(price) - min(price)) / least((max(price) - min(price)) / (log2(count(price)) + 1), "
         "2.0 * (quantile_cont(price, 0.75) - quantile_cont(price, 0.25)) / pow(count(price), 1.0 / 3)))"))
def price_histogram_auto(spark, sf_dir):
    df = measures(listings(spark, sf_dir))
    return rounded(P.histogram(df, F.col("price")), 2)


@plan("price_band_by_currency", f"""WITH {S.LISTINGS}
SELECT coalesce({S.txt('currency_code')}, 'ksh') AS "group", floor(log10(price) * 4) / 4 AS log10_from, count(*) AS rows,
  round(min(price), 2) AS low, round(max(price), 2) AS high FROM listings WHERE price > 0 GROUP BY 1, 2""")
def price_band_by_currency(spark, sf_dir):
    df = listings(spark, sf_dir)
    return rounded(P.bands_by_group(df, F.col("price"), currency(F.col("currency_code"))), 4)


@plan("skewness", f"{_MEASURES} " + _union([
    f"SELECT '{c}' AS column_name, round(skewness({c}), 5) AS skewness FROM numeric_inputs" for c in MEASURES]))
def skewness(spark, sf_dir):
    return rounded(P.skewness(measures(listings(spark, sf_dir)), {m: F.col(m) for m in MEASURES}), 5)


_CORR = ["price_log", "car_age", "mileage_log", "engine_size_cc_log", "horse_power_log", "torque_log", "acceleration_num", "seats_num"]


@plan("correlations", f"WITH {S.FEATURES} " + _union([
    f"SELECT '{a}' AS left_column, '{b}' AS right_column, round(corr({a}, {b}), 6) AS correlation FROM features"
    for i, a in enumerate(_CORR) for b in _CORR[i + 1:]]))
def correlations(spark, sf_dir):
    return rounded(P.correlations(feature_table(spark, sf_dir), {c: F.col(c) for c in _CORR}))


_BOX = """quart AS (SELECT {by} AS "group", quantile_cont(mileage, 0.25) AS q1, median(mileage) AS q2, quantile_cont(mileage, 0.75) AS q3
  FROM base WHERE mileage IS NOT NULL GROUP BY 1),
flagged AS (SELECT quart.*, mileage, mileage BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM base JOIN quart ON {by} IS NOT DISTINCT FROM "group" WHERE mileage IS NOT NULL)
SELECT "group", round(q1, 4) AS q1, round(q2, 4) AS q2, round(q3, 4) AS q3, count(*) AS rows,
  min(mileage) FILTER (WHERE inside) AS whisker_low, max(mileage) FILTER (WHERE inside) AS whisker_high,
  count(*) FILTER (WHERE NOT inside) AS outliers FROM flagged GROUP BY "group", q1, q2, q3"""


@plan("boxplot_by_fuel", f"{_MEASURES}, base AS (SELECT listing_id, {S.txt('fuel_type')} AS fuel, mileage "
                         f"FROM listings l JOIN (SELECT listing_id, mileage FROM numeric_inputs) n USING (listing_id)), "
                         .replace("mileage FROM listings", "n.mileage FROM listings")
      + _BOX.format(by="fuel"))
def boxplot_by_fuel(spark, sf_dir):
    df = measures(listings(spark, sf_dir))
    return rounded(P.box_summary(df, F.col("mileage"), strip_lower(F.col("fuel_type"))), 4)


@plan("boxplot_overall", f"{_MEASURES}, base AS (SELECT mileage FROM numeric_inputs), " + _BOX.format(by="'all'"))
def boxplot_overall(spark, sf_dir):
    return rounded(P.box_summary(measures(listings(spark, sf_dir)), F.col("mileage")), 4)


_KEYS = ["price_log", "car_age", "mileage_log", "fuel_type_cleaned", "make_name_cleaned", "model_name_cleaned", "make_model_cleaned"]


@plan("key_feature_report", f"WITH {S.FEATURES} " + _union([
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS nulls, count(DISTINCT {c}) AS distinct_values FROM features"
    for c in _KEYS]))
def key_feature_report(spark, sf_dir):
    return P.key_feature_report(feature_table(spark, sf_dir), _KEYS)


# ---- quality -------------------------------------------------------------------------------------

_YEAR = S.num("CASE WHEN year_of_manufacture <> 'n/a' THEN year_of_manufacture END")


@plan("quality_rules", f"""WITH {S.LISTINGS}, s AS (
  SELECT min(price) AS price_min, count(*) FILTER (WHERE year_of_manufacture <> 'n/a' AND y IS NULL) AS year_bad,
    min(y) AS year_min, max(y) AS year_max, count(*) FILTER (WHERE y BETWEEN 1 AND 1950) AS year_old,
    min(y) FILTER (WHERE y BETWEEN 1 AND 1950) AS year_old_min
  FROM (SELECT *, {_YEAR} AS y FROM listings)),
r AS (
  SELECT 'price_exists' AS rule, 'passed' AS status, CAST(NULL AS DOUBLE) AS observed FROM s
  UNION ALL SELECT 'price_numeric', 'passed', 0.0 FROM s
  UNION ALL SELECT 'price_positive', CASE WHEN price_min > 0 THEN 'passed' ELSE 'failed' END, price_min FROM s
  UNION ALL SELECT 'year_exists', 'passed', NULL FROM s
  UNION ALL SELECT 'year_numeric', CASE WHEN year_bad = 0 THEN 'passed' ELSE 'failed' END, year_bad FROM s
  UNION ALL SELECT 'year_min', CASE WHEN year_min > 1950 THEN 'passed' ELSE 'failed' END, year_min FROM s
  UNION ALL SELECT 'year_old_count', CASE WHEN year_min <> 0 THEN 'skipped' WHEN year_old = 0 THEN 'passed' ELSE 'warning' END, year_old FROM s
  UNION ALL SELECT 'year_old_min', CASE WHEN year_min <> 0 THEN 'skipped' WHEN year_old = 0 THEN 'passed' ELSE 'warning' END, year_old_min FROM s
  UNION ALL SELECT 'year_max', CASE WHEN year_max <= {AS_OF_YEAR} + 1 THEN 'passed' ELSE 'failed' END, year_max FROM s)
SELECT rule, status, round(observed, 4) AS observed FROM r
UNION ALL SELECT 'overall', CASE WHEN count(*) FILTER (WHERE status = 'failed') = 0 THEN 'passed' ELSE 'failed' END,
  CAST(count(*) FILTER (WHERE status = 'failed') AS DOUBLE) FROM r""")
def quality_rules(spark, sf_dir):
    return rounded(Q.rule_report(listings(spark, sf_dir), AS_OF_YEAR), 4)


def _share(c: str) -> str:
    missing = f"({c} IS NULL OR {c} IN ({S.words(S.V.NA_TOKENS)}))" if c != "price" else f"({c} IS NULL)"
    return (f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {missing}) * 100.0 / count(*) AS pct FROM listings")


@plan("quality_missing_share", f"""WITH {S.LISTINGS}, s AS ({_union([_share(c) for c in Q.CRITICAL])})
SELECT column_name, round(pct, 6)::DOUBLE AS missing_pct, CASE WHEN pct > 5 THEN 'exceeds' ELSE 'ok' END AS status FROM s""")
def quality_missing_share(spark, sf_dir):
    return rounded(Q.missing_share(listings(spark, sf_dir)))


_USAGES = S.V.FOREIGN_USED + S.V.KENYAN_USED


@plan("unmapped_values", f"""WITH {S.LISTINGS}, v AS (
  SELECT 'currency_code' AS column_name, {S.txt('currency_code')} AS value FROM listings
  UNION ALL SELECT 'usage_type', {S.cat('usage_type')} FROM listings)
SELECT column_name, value, count(*) AS rows FROM v WHERE value IS NOT NULL
  AND ((column_name = 'currency_code' AND value NOT IN ({S.words(S.V.SILENT_CODES)}))
    OR (column_name = 'usage_type' AND value NOT IN ({S.words(_USAGES)})))
GROUP BY 1, 2""")
def unmapped_values(spark, sf_dir):
    df = listings(spark, sf_dir)
    usage = clean_categories(df, ["usage_type"])
    return Q.unmapped_currencies(df).unionByName(Q.unmapped_values(usage, "usage_type", _USAGES))
