"""Simple fills, drops and selections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions.vocabulary import PLACEHOLDER_NAME

# fixed values: columns that never reach the feature table
DROPPED = [
    "year_of_manufacture", "mileage", "engine_size_cc", "horse_power", "torque", "acceleration", "seats",
    "year_of_manufacture_num",
    "make_name", "model_name", "fuel_type", "transmission", "drive_type", "body_type", "source",
    "price", "condition", "usage_type", "source_specific_id", "additional_details_from_source",
    "currency_code", "mileage_unit", "unnamed:_0", "id", "exterior_color", "interior_color",
    "source_dataset", "location", "availability_status", "urban_consumption", "highway_consumption",
]


def mode_of(df: DataFrame, column: str):
    """Most frequent non-null value, the smallest on a tie; None for an all-null column."""
    best = (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column).first()
    )
    return None if best is None else best[column]


def modes_of(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """``mode_of`` several columns; text columns share one pass."""
    words = [c for c, t in df.dtypes if c in columns and t == "string"]
    out = {c: mode_of(df, c) for c in columns if c in df.columns and c not in words}
    if words:
        long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in words])))
        counts = long.where("value is not null").groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("name").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("best")).collect()  # one row per column
        out |= dict.fromkeys(words) | {r["name"]: r["best"]["value"] for r in best}
    return out


def fill_mode(df: DataFrame, columns: list[str]) -> DataFrame:
    modes = modes_of(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in modes.items() if m is not None})


def distinct_values_left(df: DataFrame, column: str) -> DataFrame:
    """The values a column still holds, one row each; more than one means the unit is mixed."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def drop_placeholder_rows(df: DataFrame, make: str = "make_name", model: str = "model_name") -> DataFrame:
    """Drop rows where both names are the placeholder; NULL names stay."""
    both = F.col(make).eqNullSafe(PLACEHOLDER_NAME) & F.col(model).eqNullSafe(PLACEHOLDER_NAME)
    return df.where(~both)


def drop_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.drop(*(DROPPED if columns is None else columns))


def features_and_target(df: DataFrame, target: str = "price_log", key: str = "listing_id") -> tuple[DataFrame, DataFrame]:
    return df.drop(target), df.select(key, target)


def feature_set(df: DataFrame, excluded: list[str]) -> list[str]:
    """Column names left after an exclusion list."""
    return [c for c in df.columns if c not in set(excluded)]


def pick_ordered(df: DataFrame, names: list[str]) -> DataFrame:
    """Exactly these columns in this order; raises with the list of the missing ones."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*names)


def add_missing(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Absent columns as NULL of the given type."""
    return df.withColumns({n: F.lit(None).cast(t) for n, t in types.items() if n not in df.columns})


def cap_at(value: Column, limit: float | None) -> Column:
    """Upper cap that keeps NULL."""
    return value if limit is None else F.when(value.isNotNull(), F.least(value, F.lit(limit)))
