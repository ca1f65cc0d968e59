"""Profiles stored per snapshot as mergeable sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions.numbers import to_number
from lotwise.operators import sketches as K
from lotwise.plans import sqltext as S
from lotwise.plans.registry import plan, rounded
from lotwise.sources.listings import listings
from lotwise.sources.scratch import new_path

_NUMBERS = ["price", "acceleration", "seats", "annual_insurance", "horse_power_num", "torque_num"]
_TEXTS = ["make_name", "model_name", "fuel_type", "transmission", "drive_type", "condition", "usage_type", "body_type"]


def _stored(spark, sf_dir):
    """Listings with numbers read, and the profile of all snapshots from a store with one run per market segment."""
    raw = listings(spark, sf_dir, with_source=True)
    df = raw.withColumns({"horse_power_num": to_number(F.col("horse_power")), "torque_num": to_number(F.col("torque"))})
    path = new_path(spark, "sketches")
    K.save_sketches(K.sketch_profile(df, _NUMBERS + _TEXTS, F.coalesce("source", F.lit("none"))), path)
    return df, K.merge_sketches(K.read_sketches(spark, path))


@plan("sketch_profile")
def sketch_profile(spark, sf_dir):
    """What the stored sketches say of all listings: distinct values, quartiles, frequent values."""
    return rounded(K.report(_stored(spark, sf_dir)[1]), 6)


_COUNTS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({x}) AS nulls, count(DISTINCT {x}) AS distinct_values, true AS distinct_within, "
    f"{'true' if c in _NUMBERS else 'CAST(NULL AS BOOLEAN)'} AS ranks_within FROM listings"
    for c in _NUMBERS + _TEXTS for x in [S.num(c.removesuffix("_num")) if c.endswith("_num") else c])


# merged counts are exact; estimates have to be within their stated error of one exact pass
@plan("sketch_errors", f"WITH {S.LISTINGS} {_COUNTS}")
def sketch_errors(spark, sf_dir):
    df, merged = _stored(spark, sf_dir)
    return K.errors(df, _NUMBERS + _TEXTS, merged)
