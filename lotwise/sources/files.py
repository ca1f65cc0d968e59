"""Readers and writers for listing files and stage outputs."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.functions.text import clean_name, na_to_null


def read_listings(spark: SparkSession, path: str, fmt: str = "csv", missing_ok: bool = False, one_line: bool = False) -> DataFrame | None:
    """Listing file with header, every CSV column as text, missing-value tokens as NULL.

    Quoted CSV values may hold commas, line ends and doubled quotes; the headers of all files must agree.
    ``one_line`` is for files known to have no line ends in values: they are split among tasks. A path that
    does not exist raises, or gives None with ``missing_ok``.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(header=True, inferSchema=False, quote='"', escape='"', multiLine=not one_line, enforceSchema=False)
    try:
        df = reader.load(path)
    except AnalysisException as e:
        if missing_ok and e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return clean_column_names(normalize_missing(df))


def normalize_missing(df: DataFrame) -> DataFrame:
    """Missing-value tokens in text columns and NaN in double columns become NULL."""
    def one(name: str, kind: str):
        c = F.col(f"`{name}`")
        if kind == "string":
            c = na_to_null(c)
        elif kind in ("double", "float"):
            c = F.nanvl(c, F.lit(None).cast(kind))
        return c.alias(name)
    return df.select(*[one(n, t) for n, t in df.dtypes])


def clean_column_names(df: DataFrame) -> DataFrame:
    names = [clean_name(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"column names collide after cleaning: {twice}")
    return df.toDF(*names)


def union_sources(sources: dict[str, DataFrame], tag: str = "source_dataset") -> DataFrame:
    """Sources with different columns under one schema, each row tagged with its origin."""
    out = None
    for name, df in sources.items():
        df = df.withColumn(tag, F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def run_stamp(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime("%Y%m%d_%H%M%S")


def write_stage(df: DataFrame, path: str, stamp: str | None = None, fmt: str = "parquet") -> str:
    """Append one snapshot of a stage under ``run_ts=<stamp>``; a re-run of the same stamp replaces it."""
    stamp = stamp or run_stamp()
    writer = df.write.mode("overwrite").option("header", True)
    writer.format(fmt).save(f"{path}/run_ts={stamp}")
    return stamp


def read_latest(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The newest snapshot of a stage. Its name comes from a listing of the files; only its folder is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/run_ts=*").inputFiles()
    newest = max(m[1] for m in (re.search(r"/run_ts=([^/]+)/", f) for f in files) if m)
    return spark.read.option("header", True).format(fmt).load(f"{path}/run_ts={newest}")


def write_names(spark: SparkSession, names: list[str], path: str) -> None:
    """Ordered feature names as a small (idx, name) table."""
    spark.createDataFrame(list(enumerate(names)), "idx int, name string").coalesce(1).write.mode("overwrite").parquet(path)


def read_names(spark: SparkSession, path: str) -> list[str]:
    rows = spark.read.parquet(path).orderBy("idx").collect()
    return [r["name"].strip() for r in rows if r["name"] and r["name"].strip()]


def write_table_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_value_counts(df: DataFrame, column: str, path: str) -> None:
    """(value, count) in descending order as CSV."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    write_table_csv(counts.orderBy(F.desc("count"), column), path)
