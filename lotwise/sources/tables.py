"""The given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str, batch_files: int = 64) -> DataFrame:
    """The same table as a file stream of ``batch_files`` files a batch at most.

    The bracket makes the path a pattern, so one file will do.
    """
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", batch_files).parquet(f"{sf_dir}/{name}.parque[t]")
