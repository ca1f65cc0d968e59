"""Stream scoring: validate, preprocess, score, log; bad rows go to a quarantine table.

The steps are the batch functions. Each micro-batch writes folders named by its id in overwrite mode,
so a repeated batch replaces its own output and nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.operators import requests as Q
from lotwise.streaming.runner import run_batches


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, label: str = "scores",
                 exact: bool = True, checkpoint: str | None = None) -> str:
    """Scored rows under ``path/valid``, rejected rows with their violations under ``path/quarantine``."""
    checked = Q.validate(stream)

    def handle(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            valid, bad = Q.split_valid(batch)
            scored = score(Q.preprocess(valid, exact))
            scored.write.mode("overwrite").parquet(f"{path}/valid/batch={number}")
            bad.write.mode("overwrite").parquet(f"{path}/quarantine/batch={number}")
        finally:
            batch.unpersist()

    run_batches(checked, label, handle, checkpoint)
    return path


def read_scores(spark: SparkSession, path: str, part: str = "valid") -> DataFrame:
    return spark.read.option("basePath", f"{path}/{part}").parquet(f"{path}/{part}").drop("batch")


def prediction_log(scored: DataFrame, event_time: str, prediction: str = "predicted_price", error: str = "violations") -> DataFrame:
    """Log rows: request fields as JSON, prediction, error text, event time and its date."""
    have = scored.columns
    value = F.col(prediction).cast("double") if prediction in have else F.lit(None).cast("double")
    text = F.nullif(F.array_join(error, "; "), F.lit("")) if error in have else F.lit(None).cast("string")
    request = F.to_json(F.struct(*[c for c in have if c not in (prediction, error, event_time)]))
    return scored.select(request.alias("request"), value.alias("prediction"), text.alias("error"),
                         F.col(event_time).alias("event_time"), F.to_date(event_time).alias("log_date"))
