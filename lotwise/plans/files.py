"""Listing files, stage snapshots and column selections, written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.operators import fills
from lotwise.plans import sqltext as S
from lotwise.plans.common import feature_table
from lotwise.plans.registry import plan, rounded
from lotwise.sources import files
from lotwise.sources.listings import listings
from lotwise.sources.scratch import new_path


# commas, doubled quotes and line ends in a value, missing-value tokens, and names to clean
@plan("read_csv_listings", f"""WITH {S.LISTINGS} SELECT CAST(listing_id AS VARCHAR) AS listing_id,
  make_name || ', "' || model_name || '"' || chr(10) || fuel_type AS detail_text,
  CASE WHEN transmission <> 'N/A' THEN transmission END AS gear_box, currency_code FROM listings""")
def read_csv_listings(spark, sf_dir):
    df = listings(spark, sf_dir).select(
        F.col("listing_id").alias("Listing ID"), F.concat("make_name", F.lit(', "'), "model_name", F.lit('"\n'), "fuel_type").alias("Detail-Text"),
        F.col("transmission").alias("gear box"), F.col("currency_code").alias("currency_code()"))
    path = new_path(spark, "listings-csv")
    df.write.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return files.read_listings(spark, path)


# the newest of three snapshots, written out of order
@plan("latest_snapshot", f"WITH {S.LISTINGS} SELECT listing_id, make_name, price FROM listings WHERE listing_id % 3 <> 0")
def latest_snapshot(spark, sf_dir):
    df = listings(spark, sf_dir).select("listing_id", "make_name", "price")
    path = new_path(spark, "stage")
    for stamp, rows in (("20250101_000000", df), ("20250301_000000", df.where("listing_id % 3 <> 0")), ("20250201_000000", df.where("listing_id % 3 = 0"))):
        files.write_stage(rows, path, stamp)
    return files.read_latest(spark, path)


@plan("dropped_columns", f"WITH {S.LISTINGS} SELECT listing_id, annual_insurance FROM listings")
def dropped_columns(spark, sf_dir):
    return fills.drop_columns(listings(spark, sf_dir))


@plan("value_frequency_csv", f"""WITH {S.LISTINGS} SELECT condition, CAST(count(*) AS VARCHAR) AS "count" FROM listings GROUP BY 1""")
def value_frequency_csv(spark, sf_dir):
    path = new_path(spark, "frequency")
    files.write_value_counts(listings(spark, sf_dir), "condition", path)
    return spark.read.options(header=True, escape='"').csv(path)


@plan("target_column", f"WITH {S.FEATURES} SELECT listing_id, round(price_log, 6) AS price_log FROM features")
def target_column(spark, sf_dir):
    return rounded(fills.features_and_target(feature_table(spark, sf_dir, names=False))[1])


# a written list of names brings columns into its order; an absent column comes as NULL
@plan("ordered_by_name_list", f"""WITH {S.LISTINGS} SELECT seats, CAST(NULL AS DOUBLE) AS highway_consumption, listing_id, make_name FROM listings""")
def ordered_by_name_list(spark, sf_dir):
    df = listings(spark, sf_dir)
    path = new_path(spark, "names")
    files.write_names(spark, ["seats", "highway_consumption", "listing_id", "make_name"], path)
    names = files.read_names(spark, path)
    return fills.pick_ordered(fills.add_missing(df, {"highway_consumption": "double", "seats": "int"}), names)
