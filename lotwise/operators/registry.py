"""Model registry: one row per version next to the saved pipeline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.functions.numbers import invert_log
from lotwise.operators.requests import missing_inputs
from lotwise.sources.files import run_stamp

SCHEMA = ("model_name string, version string, model_type string, params map<string,string>, feature_names array<string>, "
          "slot_names array<string>, target string, inverse string, metrics map<string,double>, model_path string")


@dataclass
class Entry:
    model_name: str
    version: str
    model_type: str
    params: dict[str, str]
    feature_names: list[str]
    slot_names: list[str]
    target: str
    inverse: str
    metrics: dict[str, float]
    model_path: str


def params_as_text(model: PipelineModel) -> dict[str, str]:
    """Parameters of the last stage; anything that is not plain becomes text."""
    return {p.name: str(v) for p, v in model.stages[-1].extractParamMap().items()}


def register(spark: SparkSession, path: str, name: str, model: PipelineModel, feature_names: list[str], slot_names: list[str],
             metrics: dict[str, float], target: str = "price_log", inverse: str = "expm1", version: str | None = None) -> Entry:
    """Save the pipeline, then the entry row; a version without an entry row does not exist."""
    version = version or run_stamp()
    model_path = f"{path}/artefacts/{name}/{version}"
    model.write().overwrite().save(model_path)
    entry = Entry(name, version, type(model.stages[-1]).__name__, params_as_text(model), feature_names, slot_names, target,
                  inverse, {k: float(v) for k, v in metrics.items()}, model_path)
    row = tuple(getattr(entry, f) for f in Entry.__dataclass_fields__)
    spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/entries/name={name}/run_ts={version}")
    return entry


def entries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", f"{path}/entries").schema(
        SCHEMA + ", name string, run_ts string").parquet(f"{path}/entries")


def find(spark: SparkSession, path: str, name: str, version: str | None = None) -> Entry:
    """A version of a model, the newest if none is given."""
    rows = entries(spark, path).where(F.col("name") == name)
    if version is not None:
        rows = rows.where(F.col("run_ts") == version)
    row = rows.orderBy(F.desc("run_ts")).first()
    if row is None:
        raise LookupError(f"no entry for {name} {version or ''}".strip())
    return Entry(**{f: row[f] for f in Entry.__dataclass_fields__})


def metadata_json(spark: SparkSession, path: str) -> DataFrame:
    """Each entry as one JSON text."""
    df = entries(spark, path)
    return df.select("name", "run_ts", F.to_json(F.struct(*[c for c in df.columns if c not in ("name", "run_ts")])).alias("metadata"))


def score(df: DataFrame, entry: Entry, keep: list[str], scored_at: str | None = None) -> DataFrame:
    """Predicted price with time and version. Stops before any work if required columns are absent."""
    have = df.columns
    if "annual_insurance" in entry.feature_names and "annual_insurance" not in have:
        df = df.withColumn("annual_insurance", F.lit(None).cast("double"))
    missing = missing_inputs(df.columns, entry.feature_names)
    if missing:
        raise ValueError(f"missing required features: {missing}")
    out = PipelineModel.load(entry.model_path).transform(df)
    return out.select(
        *keep, invert_log(F.col("prediction"), entry.inverse).alias("predicted_price"),
        F.lit(scored_at or run_stamp()).alias("scored_at"), F.lit(f"{entry.model_name}:{entry.version}").alias("model_version"))
