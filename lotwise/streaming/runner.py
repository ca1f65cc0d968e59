"""Run a stream over everything that is there, then read its sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.sources.scratch import new_path


def with_event_time(df: DataFrame, name: str) -> DataFrame:
    """A time without zone read as UTC, because watermarks need an instant."""
    if dict(df.dtypes)[name] != "timestamp_ntz":
        return df
    return df.withColumn(name, F.concat(F.col(name).cast("string"), F.lit("Z")).cast("timestamp"))


def utc_day(instant: Column) -> Column:
    """Date text of an instant in UTC, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int")).cast("string")


def run_to_files(stream: DataFrame, label: str, path: str | None = None, partition_by: list[str] | None = None,
                 checkpoint: str | None = None) -> str:
    """Append-mode file sink (exactly once); returns its folder. Ends when the input is used up."""
    spark = stream.sparkSession
    path = path or new_path(spark, label)
    writer = stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("path", path).option("checkpointLocation", checkpoint or f"{path}-checkpoint").start().awaitTermination()
    return path


def run_updates(stream: DataFrame, label: str, checkpoint: str | None = None) -> DataFrame:
    """The newest state of every window, open ones too: each batch writes what it changed, and the last change counts.

    ``stream`` starts with the column that names a window. A repeated batch replaces its own folder.
    """
    spark, path = stream.sparkSession, new_path(stream.sparkSession, label)
    writer = stream.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", checkpoint or f"{path}-checkpoint")
    writer.foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}")).start().awaitTermination()
    window, *rest = stream.columns
    rows = spark.read.schema(stream.schema.add("batch", "long")).option("basePath", path).parquet(path)
    last = rows.groupBy(window).agg(F.max_by(F.struct(*rest), "batch").alias("last"))
    return last.select(window, *[F.col(f"last.{c}").alias(c) for c in rest])


def run_batches(stream: DataFrame, label: str, handle: Callable[[DataFrame, int], None], checkpoint: str | None = None) -> None:
    """Hand each micro-batch to ``handle``; a batch that is repeated after a failure has the same id."""
    checkpoint = checkpoint or new_path(stream.sparkSession, f"{label}-checkpoint")
    stream.writeStream.foreachBatch(handle).trigger(availableNow=True).option("checkpointLocation", checkpoint).start().awaitTermination()
