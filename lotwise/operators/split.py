"""Splits, folds and samples from a key hash: stable under any partitioning or retry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions.numbers import HASH_SEED, hash_bucket, hash_unit


def train_test(df: DataFrame, key: str = "listing_id", test_pct: int = 20, seed: int = HASH_SEED) -> tuple[DataFrame, DataFrame]:
    """About ``test_pct`` percent of the keys as test part."""
    part = hash_bucket(F.col(key), 100, seed)
    return df.where(part < 100 - test_pct), df.where(part >= 100 - test_pct)


def fold(key: Column, folds: int = 5, seed: int = HASH_SEED) -> Column:
    """Fold number 0..folds-1, independent of the train/test bucket of the same seed."""
    return hash_bucket(key, folds, seed + 1)


def sample_rows(df: DataFrame, n: int, key: str = "listing_id", seed: int = HASH_SEED) -> DataFrame:
    """Exactly n rows, or all if there are fewer, by smallest key hash."""
    return df.orderBy(hash_unit(F.col(key), seed), key).limit(n)
