"""Scoring requests: derivation, defaults, contract and row validation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions.numbers import EPS, exact_ratio
from lotwise.functions.text import strip
from lotwise.functions.vocabulary import REQUEST_DEFAULTS
from lotwise.operators.encode import PREFIXES
from lotwise.operators.features import FEATURES, NUMERIC_FEATURES, TEXT_FEATURES


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    required: bool
    low: float | None = None
    high: float | None = None


# fixed values: the request contract
CONTRACT = [
    Field("make_name_cleaned", "string", True),
    Field("model_name_cleaned", "string", True),
    Field("mileage_num", "double", True, 0),
    Field("engine_size_cc_num", "double", True, 0),
    Field("fuel_type_cleaned", "string", True),
    Field("transmission_cleaned", "string", True),
    Field("horse_power_num", "double", False, 0),
    Field("torque_num", "double", False, 0),
    Field("annual_insurance", "double", False, 0),
    Field("car_age", "double", True, 0),
    Field("car_age_squared", "double", True, 0),
    Field("mileage_log", "double", True),
    Field("mileage_per_year", "double", True, 0),
    Field("engine_size_cc_log", "double", True),
    Field("horse_power_log", "double", False),
    Field("torque_log", "double", False),
    Field("acceleration_num", "double", False, 0),
    Field("seats_num", "double", False, 0, 20),
    Field("drive_type_cleaned", "string", False),
    Field("condition_clean", "string", False),
    Field("usage_type_clean", "string", False),
    Field("body_type_cleaned", "string", False),
    Field("power_per_cc", "double", False, 0),
    Field("mileage_per_cc", "double", False, 0),
    Field("is_luxury_make", "int", False, 0, 1),
    Field("make_model_cleaned", "string", False),
]
# columns a batch scorer asks for; the insurance may be absent, it is filled
BATCH_REQUIRED = [f for f in NUMERIC_FEATURES if f != "annual_insurance"] + TEXT_FEATURES


def derive(df: DataFrame, as_of_year: int) -> DataFrame:
    """Derived request fields from numeric raw fields (year, mileage, engine size, power, torque).

    Missing mileage and engine size count as 0; logs and ratios that make no sense are NULL.
    """
    def number(name: str) -> Column:
        return F.col(name).cast("double")

    age = F.lit(float(as_of_year)) - number("year_of_manufacture")
    mileage = F.coalesce(number("mileage"), F.lit(0.0))
    cc = F.coalesce(number("engine_size_cc"), F.lit(0.0))
    hp, torque = number("horse_power"), number("torque")
    return df.withColumns({
        "car_age": age, "car_age_squared": age * age,
        "mileage_num": mileage, "mileage_log": F.log1p(mileage),
        "mileage_per_year": F.try_divide(mileage, age + EPS),
        "engine_size_cc_num": cc, "engine_size_cc_log": F.when(cc > 0, F.log1p(cc)).otherwise(0.0),
        "horse_power_num": hp, "horse_power_log": F.when(hp > 0, F.log1p(hp)),
        "torque_num": torque, "torque_log": F.when(torque > 0, F.log1p(torque)),
        "power_per_cc": F.when(cc > 0, hp / (cc + EPS)),
        "mileage_per_cc": F.when(cc > 0, mileage / (cc + EPS)),
    })


def add_optional(df: DataFrame) -> DataFrame:
    """Absent optional fields as NULL of their type."""
    return df.withColumns({f.name: F.lit(None).cast(f.kind) for f in CONTRACT if not f.required and f.name not in df.columns})


def fill_defaults(df: DataFrame) -> DataFrame:
    """Constants for missing power, torque, acceleration and seats; ``filled`` lists what was set."""
    marks = [F.when(F.col(c).isNull(), c) for c in REQUEST_DEFAULTS]
    df = df.withColumn("filled", F.filter(F.array(*marks), lambda m: m.isNotNull()))
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in REQUEST_DEFAULTS.items()})


def refresh(df: DataFrame, exact: bool = True) -> DataFrame:
    """Missing logs from their base; ratios from the filled inputs.

    ``exact`` divides without the training guard and gives 0 for a zero engine size.
    """
    hp, cc, mileage = F.col("horse_power_num"), F.col("engine_size_cc_num"), F.col("mileage_num")
    out = {
        "horse_power_log": F.coalesce("horse_power_log", F.log1p(hp)),
        "torque_log": F.coalesce("torque_log", F.log1p(F.col("torque_num"))),
    }
    if exact:
        out["power_per_cc"] = F.when(hp.isNull(), None).otherwise(F.coalesce(exact_ratio(hp, cc), F.col("power_per_cc")))
        out["mileage_per_cc"] = F.coalesce(exact_ratio(mileage, cc), F.col("mileage_per_cc"))
    else:
        out["power_per_cc"], out["mileage_per_cc"] = F.try_divide(hp, cc + EPS), F.try_divide(mileage, cc + EPS)
    return df.withColumns(out)


def preprocess(df: DataFrame, exact: bool = True) -> DataFrame:
    return refresh(fill_defaults(add_optional(df)), exact)


def validate(df: DataFrame, contract: list[Field] = CONTRACT) -> DataFrame:
    """Text stripped, and ``violations``: one text per broken rule, empty for a good row."""
    have = set(df.columns)
    df = df.withColumns({f.name: strip(F.col(f.name)) for f in contract if f.kind == "string" and f.name in have})
    checks: list[Column] = []
    for f in contract:
        if f.name not in have:
            if f.required:
                checks.append(F.lit(f"{f.name}: required"))
            continue
        c = F.col(f.name)
        if f.required:
            checks.append(F.when(c.isNull(), f"{f.name}: required"))
        if f.low is not None:
            checks.append(F.when(c < f.low, f"{f.name}: below {f.low:g}"))
        if f.high is not None:
            checks.append(F.when(c > f.high, f"{f.name}: above {f.high:g}"))
    return df.withColumn("violations", F.filter(F.array(*checks), lambda v: v.isNotNull()))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = F.size("violations") == 0
    return df.where(good).drop("violations"), df.where(~good)


def is_encoded(columns: list[str]) -> bool:
    """Already encoded input is known by its slot prefixes."""
    return any(c.startswith(tuple(PREFIXES[:3])) for c in columns)


def missing_inputs(columns: list[str], required: list[str] | None = None) -> list[str]:
    """Required columns that are absent, by the names an encoded or a raw input uses."""
    required = BATCH_REQUIRED if required is None else required
    if is_encoded(columns):
        wanted = [f"num_main__{f}" for f in required if f in NUMERIC_FEATURES]
        return [w for w in wanted if w not in columns]
    return [f for f in required if f not in columns]


def ordered(df: DataFrame, keep: list[str]) -> DataFrame:
    from lotwise.operators.fills import pick_ordered

    return pick_ordered(df, [*keep, *FEATURES])
