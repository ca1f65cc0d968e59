"""Feature-name tables and their comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def name_table(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(names)), "idx int, name string")


def align(a: DataFrame, b: DataFrame) -> DataFrame:
    """Names of both lists with their positions: same, moved, only_a or only_b."""
    left = a.select("name", F.col("idx").alias("idx_a"))
    right = b.select("name", F.col("idx").alias("idx_b"))
    status = (
        F.when(F.col("idx_b").isNull(), "only_a").when(F.col("idx_a").isNull(), "only_b")
        .when(F.col("idx_a") == F.col("idx_b"), "same").otherwise("moved")
    )
    return left.join(right, "name", "full").withColumn("status", status)
