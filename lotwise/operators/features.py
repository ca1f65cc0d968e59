"""Feature table: fit the statistics once, then a pure projection.

``FeatureBuilder.fit`` runs three aggregate jobs (row count, medians, kept names). ``FeatureStats``
is a small record that batch scoring, streaming and training share; ``transform`` adds no action.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lotwise.functions import vocabulary as V
from lotwise.functions.numbers import per_year, ratio, to_number, zero_to_null
from lotwise.operators import categories as C
from lotwise.operators.prices import currency, to_base_currency
from lotwise.operators.quantiles import medians
from lotwise.session import compile_methods

TARGET = "price_log"
# fixed values: order of the feature columns
FEATURES = [
    "annual_insurance", "car_age", "car_age_squared", "mileage_num", "mileage_log", "mileage_per_year",
    "engine_size_cc_num", "engine_size_cc_log", "horse_power_num", "horse_power_log", "torque_num",
    "torque_log", "acceleration_num", "seats_num", "fuel_type_cleaned", "transmission_cleaned",
    "drive_type_cleaned", "condition_clean", "usage_type_clean", "body_type_cleaned",
    "make_name_cleaned", "model_name_cleaned", "power_per_cc", "mileage_per_cc", "is_luxury_make",
    "make_model_cleaned",
]
TEXT_FEATURES = [
    "fuel_type_cleaned", "transmission_cleaned", "drive_type_cleaned", "condition_clean", "usage_type_clean",
    "body_type_cleaned", "make_name_cleaned", "model_name_cleaned", "make_model_cleaned",
]
NUMERIC_FEATURES = [f for f in FEATURES if f not in TEXT_FEATURES]
NUMERIC_INPUTS = ["mileage", "engine_size_cc", "horse_power", "torque", "acceleration", "seats"]
OLDEST_YEAR = 1950


@dataclass
class FeatureOptions:
    as_of_year: int
    luxury_makes: list[str] = field(default_factory=lambda: list(V.LUXURY_MAKES))
    rates: dict = field(default_factory=lambda: dict(V.RATES))
    missing_currency: str = "ksh"
    vocabulary: dict = field(default_factory=lambda: dict(V.VOCABULARY))
    make_floor: int = 10
    make_share: float = 0.001
    model_floor: int = 5
    model_share: float = 0.0005
    eps: float = 1e-6
    median_method: str = "exact"


def _number(df: DataFrame, name: str) -> Column:
    return to_number(F.col(name), dict(df.dtypes)[name])


def numeric_inputs(df: DataFrame, opt: FeatureOptions) -> dict[str, Column]:
    """Numeric forms before filling, for the columns that are there."""
    out: dict[str, Column] = {}
    if {"price", "currency_code"} <= set(df.columns):
        out["price"] = to_base_currency(_number(df, "price"), currency(F.col("currency_code"), opt.missing_currency), opt.rates)
    elif "price" in df.columns:
        out["price"] = _number(df, "price")
    if "year_of_manufacture" in df.columns:
        out["year"] = zero_to_null(_number(df, "year_of_manufacture"))
    for name in NUMERIC_INPUTS:
        if name in df.columns:
            num = _number(df, name)
            out[name] = zero_to_null(num) if name == "engine_size_cc" else num
    return out


@dataclass
class FeatureStats:
    options: FeatureOptions
    rows: int
    medians: dict[str, float | None]
    kept_makes: list[str] | None
    kept_models: list[str] | None

    def transform(self, df: DataFrame, keep: list[str] = ("listing_id",), target: bool = True) -> DataFrame:
        """Key columns, the target (where a price is there) and the features that the input allows."""
        compile_methods(df.sparkSession)
        opt, have = self.options, set(df.columns)
        filled = {n: F.coalesce(c, F.lit(self.medians.get(n))) for n, c in numeric_inputs(df, opt).items()}
        text = {c: C.clean_category(F.col(c), None if c in C.KEEP_NULL else "unknown")
                for c in C.CATEGORY_COLUMNS if c in have and c != "source"}
        kept_cols = [c for c in keep if c in have]
        insurance = ["annual_insurance"] if "annual_insurance" in have else []
        base = df.select(
            *kept_cols, *[_number(df, c).alias(c) for c in insurance],
            *[c.alias(f"n_{n}") for n, c in filled.items()], *[c.alias(f"t_{n}") for n, c in text.items()],
        )
        if "make_name" in text:
            base = C.group_rare(base, "t_make_name", self.kept_makes, "other_make", "make_name_cleaned")
        if "model_name" in text:
            base = C.group_rare(base, "t_model_name", self.kept_models, "other_model", "model_name_cleaned")
        out = self._columns(set(filled), set(text), insurance)
        names = ([TARGET] if target and TARGET in out else []) + [f for f in FEATURES if f in out]
        # two steps, so that age and the filled inputs are computed once and then reused
        step = base.withColumn("car_age", out["car_age"]) if "car_age" in out else base
        return step.select(*kept_cols, *[(F.col(n) if n == "car_age" else out[n]).alias(n) for n in names])

    def _columns(self, nums: set[str], texts: set[str], insurance: list[str]) -> dict[str, Column]:
        opt = self.options
        n = {name: F.col(f"n_{name}") for name in nums}
        out: dict[str, Column] = {c: F.col(c) for c in insurance}
        if "price" in n:
            out[TARGET] = F.log1p(n["price"])
        if "year" in n:
            year = F.bround(n["year"], 0).cast("bigint")
            out["car_age"] = F.greatest(F.lit(opt.as_of_year) - year, F.lit(0)).cast("bigint")
            out["car_age_squared"] = F.col("car_age") * F.col("car_age")
        for name in ("mileage", "engine_size_cc", "horse_power", "torque"):
            if name in n:
                out[f"{name}_num"], out[f"{name}_log"] = n[name], F.log1p(n[name])
        if "acceleration" in n:
            out["acceleration_num"] = n["acceleration"]
        if "seats" in n:
            out["seats_num"] = F.bround(n["seats"], 0).cast("bigint")
        if {"mileage", "year"} <= nums:
            out["mileage_per_year"] = per_year(n["mileage"], F.col("car_age"))
        if {"horse_power", "engine_size_cc"} <= nums:
            out["power_per_cc"] = ratio(n["horse_power"], n["engine_size_cc"], opt.eps)
        if {"mileage", "engine_size_cc"} <= nums:
            out["mileage_per_cc"] = ratio(n["mileage"], n["engine_size_cc"], opt.eps)
        for name, mapping in opt.vocabulary.items():
            if name in texts:
                out[f"{name}_cleaned"] = C.map_synonyms(F.col(f"t_{name}"), mapping)
        if "condition" in texts:
            out["condition_clean"] = C.condition_clean(F.col("t_condition"))
        if "usage_type" in texts:
            out["usage_type_clean"] = C.usage_clean(F.col("t_usage_type"))
        if "make_name" in texts:
            out["make_name_cleaned"] = F.col("make_name_cleaned")
            out["is_luxury_make"] = C.is_member(F.col("make_name_cleaned"), opt.luxury_makes)
        if "model_name" in texts:
            out["model_name_cleaned"] = F.col("model_name_cleaned")
        if {"make_name", "model_name"} <= texts:
            out["make_model_cleaned"] = C.pair(F.col("make_name_cleaned"), F.col("model_name_cleaned"))
        return out

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "FeatureStats":
        d = json.loads(text)
        d["options"]["rates"] = {k: tuple(v) for k, v in d["options"]["rates"].items()}
        return FeatureStats(**{**d, "options": FeatureOptions(**d["options"])})

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "stats string").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FeatureStats":
        return FeatureStats.from_json(spark.read.parquet(path).first()["stats"])


class FeatureBuilder:
    def __init__(self, as_of_year: int, **options):
        self.options = FeatureOptions(as_of_year=as_of_year, **options)

    def fit(self, df: DataFrame, rows: int | None = None, numbers: bool | list[str] = True, names: bool = True) -> FeatureStats:
        """Medians (``numbers``, all or those named) and frequent makes and models (``names``); what isn't asked for isn't computed.

        Without medians missing numbers stay missing, without names all makes and models are rare.
        """
        compile_methods(df.sparkSession)
        opt = self.options
        if not names:
            rows = 0
        rows = df.count() if rows is None else rows
        inputs = numeric_inputs(df, opt) if numbers else {}
        if isinstance(numbers, list):
            inputs = {n: c for n, c in inputs.items() if n in numbers}
        if "year" in inputs:
            inputs["year"] = F.when(inputs["year"] > OLDEST_YEAR, inputs["year"])
        # two independent jobs over the same rows; they run side by side
        with ThreadPoolExecutor(1) as pool:
            kept_job = pool.submit(inheritable_thread_target(df.sparkSession)(self._kept), df if names else df.select(), rows)
            found = medians(df, inputs, method=opt.median_method) if inputs else {}
            kept = kept_job.result()
        if "year" in inputs and found["year"] is None:
            found["year"] = float(opt.as_of_year - 10)
        return FeatureStats(opt, rows, found, kept.get("make_name", []), kept.get("model_name", []))

    def _kept(self, df: DataFrame, rows: int) -> dict[str, list[str]]:
        """Frequent makes and models from one pass over both columns."""
        opt = self.options
        limits = {
            "make_name": C.rare_threshold(rows, opt.make_floor, opt.make_share),
            "model_name": C.rare_threshold(rows, opt.model_floor, opt.model_share),
        }
        limits = {c: t for c, t in limits.items() if c in df.columns}
        if not limits:
            return {}
        pairs = [F.struct(F.lit(c).alias("name"), C.clean_category(F.col(c)).alias("value")) for c in limits]
        enough = sum((F.when(F.col("name") == c, t).otherwise(0) for c, t in limits.items()), F.lit(0))
        counts = (
            df.select(F.inline(F.array(*pairs))).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= enough).select("name", "value")
        )
        out: dict[str, list[str]] = {c: [] for c in limits}
        for r in counts.collect():  # at most rows / threshold names per column
            out[r["name"]].append(r["value"])
        return {c: sorted(v) for c, v in out.items()}
