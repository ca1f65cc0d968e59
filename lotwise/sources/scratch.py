"""Shared folder for tables that cut lineage and for stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="lotwise-")
    return _local[app]


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/lotwise-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{_own_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def clear(spark: SparkSession) -> None:
    """Delete what this application wrote here. Frames that read it are of no use afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: short lineage that survives lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
