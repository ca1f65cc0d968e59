"""Inputs shared by several registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotwise.operators.features import FeatureBuilder, FeatureStats
from lotwise.plans.registry import AS_OF_YEAR, LUXURY
from lotwise.sources.listings import written_listings


def builder() -> FeatureBuilder:
    return FeatureBuilder(AS_OF_YEAR, luxury_makes=LUXURY)


def fitted(spark: SparkSession, sf_dir: str, **parts: bool | list[str]) -> tuple[DataFrame, FeatureStats]:
    raw = written_listings(spark, sf_dir)
    return raw, builder().fit(raw, **parts)


def feature_table(spark: SparkSession, sf_dir: str, **parts: bool | list[str]) -> DataFrame:
    """Statistics over all rows, as the checking SQL has it; training code fits on its own part.

    ``numbers`` and ``names`` set to False leave out what the caller's columns don't need;
    ``numbers`` may also list the inputs whose medians they need.
    """
    raw, stats = fitted(spark, sf_dir, **parts)
    return stats.transform(raw)
