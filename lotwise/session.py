"""Spark session for local runs, tests and the bench. On a cluster the caller brings its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


#: Bytes of a generated method beyond which the JVM never compiles it but interprets every row.
COMPILED_BYTES = 8000


def compile_methods(spark: SparkSession) -> None:
    """Have Spark split wide generated code into methods that the JVM compiles, whatever the session came with."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > COMPILED_BYTES:
        spark.conf.set(name, str(COMPILED_BYTES))


def local_session(cpus: str | int | None = None, app: str = "lotwise", memory: str = "12g", events: str | None = None) -> SparkSession:
    """``events`` names a folder for Spark's event log."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    log = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{events}", "spark.eventLog.rolling.enabled": "false",
           "spark.eventLog.compress": "false"} if events else {}
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config(map=log)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", str(COMPILED_BYTES))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
