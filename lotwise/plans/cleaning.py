"""Cleaning, standardisation and category queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions import vocabulary as V
from lotwise.functions.text import money, parse_money
from lotwise.operators import categories as C, fills, prices
from lotwise.operators.features import FeatureOptions, numeric_inputs
from lotwise.operators.quantiles import medians, quantile_table
from lotwise.operators.split import train_test
from lotwise.plans import sqltext as S
from lotwise.plans.common import feature_table
from lotwise.plans.registry import AS_OF_YEAR, plan, rounded
from lotwise.sources.files import union_sources
from lotwise.sources.listings import listings
from lotwise.sources.tables import table


@plan("mode_fill", f"""WITH {S.LISTINGS},
m AS (SELECT (SELECT currency_code FROM listings WHERE currency_code IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS code,
  (SELECT mileage_unit FROM listings WHERE mileage_unit IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS unit)
SELECT listing_id, coalesce(currency_code, code) AS currency_code, coalesce(mileage_unit, unit) AS mileage_unit FROM listings CROSS JOIN m""")
def mode_fill(spark, sf_dir):
    df = listings(spark, sf_dir).select("listing_id", "currency_code", "mileage_unit")
    return fills.fill_mode(df, ["currency_code", "mileage_unit"])


@plan("remaining_currencies", f"""WITH {S.LISTINGS},
m AS (SELECT currency_code AS code FROM listings WHERE currency_code IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT coalesce(currency_code, (SELECT code FROM m)) AS value, count(*) AS rows FROM listings GROUP BY 1""")
def remaining_currencies(spark, sf_dir):
    df = fills.fill_mode(listings(spark, sf_dir).select("currency_code"), ["currency_code"])
    return fills.distinct_values_left(df, "currency_code")


@plan("drop_placeholder_rows", f"""WITH {S.LISTINGS} SELECT listing_id, make_name, model_name FROM listings
WHERE NOT coalesce(make_name = '{V.PLACEHOLDER_NAME}' AND model_name = '{V.PLACEHOLDER_NAME}', FALSE)""")
def drop_placeholder_rows(spark, sf_dir):
    return fills.drop_placeholder_rows(listings(spark, sf_dir).select("listing_id", "make_name", "model_name"))


@plan("price_standardized", f"""WITH {S.LISTINGS}, p AS (SELECT listing_id, coalesce({S.txt('currency_code')}, 'ksh') AS currency_code, {S.PRICE} AS price FROM listings)
SELECT listing_id, currency_code, round(coalesce(price, (SELECT median(price) FROM p)), 6) AS price,
  round(ln(1 + coalesce(price, (SELECT median(price) FROM p))), 6) AS price_log FROM p""")
def price_standardized(spark, sf_dir):
    df = listings(spark, sf_dir)
    code = prices.currency(F.col("currency_code"))
    value = prices.to_base_currency(F.col("price"), code)
    mid = medians(df, {"price": value})["price"]
    df = df.select("listing_id", code.alias("currency_code"), F.coalesce(value, F.lit(mid)).alias("price"))
    return rounded(df.withColumn("price_log", F.log1p("price")))


# a missing code read as a dollar price, and KES known as a code of its own
@plan("price_missing_as_usd", f"""WITH {S.LISTINGS}, c AS (SELECT listing_id, price, coalesce({S.txt('currency_code')}, 'usd') AS code FROM listings)
SELECT code, count(*) AS rows, round(avg(CASE WHEN code = 'usd' THEN (1179.11::DOUBLE + 1.0445::DOUBLE * price) * 130 ELSE price END), 2) AS mean_price
FROM c GROUP BY 1""")
def price_missing_as_usd(spark, sf_dir):
    df = listings(spark, sf_dir)
    code = prices.currency(F.col("currency_code"), missing="usd")
    rates = {**V.RATES, "kes": (0.0, 1.0, 1.0)}
    df = df.select(code.alias("code"), prices.to_base_currency(F.col("price"), code, rates).alias("price"))
    return rounded(df.groupBy("code").agg(F.count(F.lit(1)).alias("rows"), F.avg("price").alias("mean_price")), 2)


_CAPPED = ["engine_size_cc", "horse_power"]


@plan("winsorized", f"""WITH {S.LISTINGS}, {S.NUMERIC},
caps AS (SELECT quantile_cont(engine_size_cc, 0.999) AS cc, quantile_cont(horse_power, 0.999) AS hp FROM numeric_inputs)
SELECT listing_id, round(CASE WHEN engine_size_cc IS NOT NULL THEN least(engine_size_cc, cc) END, 4) AS engine_size_cc,
  round(CASE WHEN horse_power IS NOT NULL THEN least(horse_power, hp) END, 4) AS horse_power FROM numeric_inputs CROSS JOIN caps""")
def winsorized(spark, sf_dir):
    raw = listings(spark, sf_dir)
    inputs = {c: e for c, e in numeric_inputs(raw, FeatureOptions(AS_OF_YEAR)).items() if c in _CAPPED}
    caps = quantile_table(raw, inputs, [0.999])
    return rounded(raw.select("listing_id", *[fills.cap_at(e, caps[c][0]).alias(c) for c, e in inputs.items()]), 4)


SEGMENTS = ["budget", "economy", "premium", "luxury"]


@plan("price_segment", f"""WITH {S.FEATURES},
b AS (SELECT quantile_cont(price_log, 0.25) AS b1, quantile_cont(price_log, 0.5) AS b2, quantile_cont(price_log, 0.75) AS b3
  FROM features WHERE {S.bucket('listing_id')} < 80)
SELECT listing_id, CASE WHEN price_log <= b1 THEN 'budget' WHEN price_log <= b2 THEN 'economy' WHEN price_log <= b3 THEN 'premium' ELSE 'luxury' END AS price_segment
FROM features CROSS JOIN b""")
def price_segment(spark, sf_dir):
    """Quartile bounds come from the training part only; the label is for analysis, it leaks the target."""
    df = feature_table(spark, sf_dir, names=False).select("listing_id", "price_log")
    train, _ = train_test(df)
    bounds = quantile_table(train, {"p": F.col("price_log")}, [0.25, 0.5, 0.75])["p"]
    return df.select("listing_id", prices.segment(F.col("price_log"), bounds, SEGMENTS).alias("price_segment"))


@plan("interaction", f"""WITH {S.FEATURES} SELECT listing_id, round(engine_size_cc_num * horse_power_num, 4) AS engine_power FROM features""")
def interaction(spark, sf_dir):
    df = feature_table(spark, sf_dir, names=False)
    return rounded(df.select("listing_id", (F.col("engine_size_cc_num") * F.col("horse_power_num")).alias("engine_power")), 4)


@plan("money_text", f"""WITH {S.LISTINGS} SELECT listing_id,
  CASE WHEN price IS NULL THEN 'N/A' ELSE 'KES ' || format('{{:,}}', CAST(round_even(price, 0) AS BIGINT)) END AS price_text,
  CAST(round_even(price, 0) AS DOUBLE) AS parsed FROM listings""")
def money_text(spark, sf_dir):
    df = listings(spark, sf_dir).select("listing_id", money(F.col("price")).alias("price_text"))
    return df.withColumn("parsed", parse_money(F.col("price_text")))


# ---- categories ----------------------------------------------------------------------------------

_TEXT = f"WITH {S.LISTINGS}, {S.TEXT}"


@plan("text_clean", f"{_TEXT} SELECT * FROM cleaned")
def text_clean(spark, sf_dir):
    return C.clean_categories(listings(spark, sf_dir, with_source=True)).select("listing_id", *C.CATEGORY_COLUMNS)


@plan("vocab_mapped", f"{_TEXT} SELECT listing_id, fuel_type_cleaned, transmission_cleaned, drive_type_cleaned, body_type_cleaned FROM text_features")
def vocab_mapped(spark, sf_dir):
    df = C.clean_categories(listings(spark, sf_dir), list(V.VOCABULARY))
    df = C.map_by_table(df, C.vocabulary_table(spark), list(V.VOCABULARY))
    return df.select("listing_id", *[f"{c}_cleaned" for c in V.VOCABULARY])


@plan("binary_recodes", f"{_TEXT} SELECT condition_clean, usage_type_clean, count(*) AS rows FROM text_features GROUP BY 1, 2")
def binary_recodes(spark, sf_dir):
    df = C.clean_categories(listings(spark, sf_dir), ["condition", "usage_type"])
    return df.groupBy(C.condition_clean(F.col("condition")).alias("condition_clean"),
                      C.usage_clean(F.col("usage_type")).alias("usage_type_clean")).agg(F.count(F.lit(1)).alias("rows"))


def _rare(spark, sf_dir):
    from lotwise.plans.common import fitted

    raw, stats = fitted(spark, sf_dir, numbers=False)
    return stats.transform(raw)


@plan("rare_make_model", f"""{_TEXT} SELECT make_name_cleaned, model_name_cleaned, count(*) AS rows FROM text_features GROUP BY 1, 2""")
def rare_make_model(spark, sf_dir):
    return _rare(spark, sf_dir).groupBy("make_name_cleaned", "model_name_cleaned").agg(F.count(F.lit(1)).alias("rows"))


@plan("make_model_flags", f"{_TEXT} SELECT listing_id, is_luxury_make, make_model_cleaned FROM text_features")
def make_model_flags(spark, sf_dir):
    return _rare(spark, sf_dir).select("listing_id", "is_luxury_make", "make_model_cleaned")


@plan("rare_body_types", f"""{_TEXT}, kept AS (SELECT body_type_cleaned AS kept FROM text_features GROUP BY 1 HAVING count(*) >= 20)
SELECT coalesce(kept, 'other_body_type') AS body_type_cleaned, count(*) AS rows FROM text_features LEFT JOIN kept ON kept = body_type_cleaned GROUP BY 1""")
def rare_body_types(spark, sf_dir):
    df = C.clean_categories(listings(spark, sf_dir), ["body_type"])
    df = df.select(C.map_synonyms(F.col("body_type"), V.BODY).alias("body"))
    kept = C.kept_values(df, "body", 20)
    return C.group_rare(df, "body", kept, "other_body_type", "body_type_cleaned").groupBy("body_type_cleaned").agg(F.count(F.lit(1)).alias("rows"))


# generic grouping: a value with a count equal to the threshold is rare too; bench input with many keys
@plan("rare_parts", """WITH lim AS (SELECT greatest(10, CAST(floor(count(*) * 0.0005) AS BIGINT)) AS t FROM lineitem),
kept AS (SELECT l_partkey AS kept FROM lineitem GROUP BY 1 HAVING count(*) > (SELECT t FROM lim))
SELECT coalesce(CAST(kept AS VARCHAR), 'Other') AS part_grouped, count(*) AS rows, round(avg(l_quantity), 6) AS mean_quantity
FROM lineitem LEFT JOIN kept ON kept = l_partkey GROUP BY 1""")
def rare_parts(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("part"), "l_quantity")
    kept = C.kept_values(items, "part", C.rare_threshold(items.count(), 10, 0.0005), inclusive=True)
    out = C.group_rare(items, "part", kept, "Other", "part_grouped").groupBy("part_grouped")
    return rounded(out.agg(F.count(F.lit(1)).alias("rows"), F.avg("l_quantity").alias("mean_quantity")))


@plan("drive_collapsed", f"""{_TEXT} SELECT CASE WHEN drive_type_cleaned IN ({S.words(V.DRIVE_COLLAPSED)}) THEN '2wd' ELSE drive_type_cleaned END AS drive_type_cleaned,
  count(*) AS rows FROM text_features GROUP BY 1""")
def drive_collapsed(spark, sf_dir):
    df = C.clean_categories(listings(spark, sf_dir), ["drive_type"])
    drive = C.map_synonyms(C.map_synonyms(F.col("drive_type"), V.DRIVE), V.DRIVE_COLLAPSED)
    return df.groupBy(drive.alias("drive_type_cleaned")).agg(F.count(F.lit(1)).alias("rows"))


_ORIGIN = {"machinery": "Foreign Used", "household": "Kenyan Used"}


@plan("origin_and_rank", f"""{_TEXT}
SELECT CASE source WHEN 'machinery' THEN 'Foreign Used' WHEN 'household' THEN 'Kenyan Used' ELSE usage_type_clean END AS origin_type,
  CASE condition {" ".join(f"WHEN '{w}' THEN {r}::DOUBLE" for w, r in V.CONDITION_RANK.items())} END AS condition_rank, count(*) AS rows
FROM cleaned JOIN text_features USING (listing_id) GROUP BY 1, 2""")
def origin_and_rank(spark, sf_dir):
    df = C.clean_categories(listings(spark, sf_dir, with_source=True), ["source", "usage_type", "condition"])
    return df.groupBy(
        C.origin_type(F.col("source"), F.col("usage_type"), _ORIGIN).alias("origin_type"),
        C.condition_rank(F.col("condition")).alias("condition_rank"),
    ).agg(F.count(F.lit(1)).alias("rows"))


# two sources with different columns combined under one schema
@plan("union_sources", f"""WITH {S.LISTINGS}
SELECT listing_id, price, annual_insurance, 'orders' AS source_dataset FROM listings
UNION ALL SELECT l_orderkey, l_extendedprice, NULL, 'lineitem' FROM lineitem""")
def union_of_sources(spark, sf_dir):
    one = listings(spark, sf_dir).select("listing_id", "price", "annual_insurance")
    two = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("listing_id"), F.col("l_extendedprice").alias("price"))
    return union_sources({"orders": one, "lineitem": two})
