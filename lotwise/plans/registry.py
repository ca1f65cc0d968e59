"""Name -> (Spark query, SQL text or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

AS_OF_YEAR = 2025
LUXURY = ["brand#1", "brand#2", "brand#3", "brand#4"]  # makes of the derived listings


@dataclass
class Plan:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


PLANS: dict[str, Plan] = {}


def plan(name: str, sql: str | None = None):
    def add(fn):
        if name in PLANS:
            raise ValueError(f"query {name} is registered twice")
        PLANS[name] = Plan(fn, sql)
        return fn
    return add


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Doubles rounded, because summation order differs between engines."""
    return df.select(*[
        F.round(c, special.get(c, digits)).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes
    ])
