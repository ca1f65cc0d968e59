"""Mergeable column profiles: what a snapshot stores, so that many snapshots are profiled without their rows.

Per column: rows, NULLs, a distinct-count sketch, a quantile sketch of numbers and a sketch of frequent
values. A merge of stored rows stands for one pass over all the snapshots' rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

LOG_K = 12
#: Three standard errors of the distinct count with 2**LOG_K registers.
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LOG_K / 2)
QUANTILE_K = 400
#: Rank error of the quantile sketch, with room for several merges.
RANK_ERROR = 0.015
TOP_TRACKED = 1024
RUN = "run_ts"


def sketch_profile(df: DataFrame, columns: list[str], run: Column) -> DataFrame:
    """One row per (run_ts, column_name): rows, nulls, least, most and the three sketches.

    Numeric columns have quantiles, least and most; NaN counts as NULL. Values count as distinct
    and as frequent by their text, NULLs as neither.
    Sketches are filled in the map tasks, so the shuffle moves one row per task, run and column.
    """
    numeric = {c for c, t in df.dtypes if t in ("double", "float", "bigint", "int", "smallint", "tinyint") or t.startswith("decimal")}
    entries = []
    for c in columns:
        value = F.col(f"`{c}`").cast("double") if c in numeric else F.lit(None).cast("double")
        value = F.nanvl(value, F.lit(None).cast("double"))
        text = value.cast("string") if c in numeric else F.col(f"`{c}`").cast("string")
        entries.append(F.struct(F.lit(c).alias("column_name"), text.alias("text"), value.alias("value")))
    long = df.select(run.cast("string").alias(RUN), F.inline(F.array(*entries)))
    return long.groupBy(RUN, "column_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("text").isNull()).alias("nulls"), F.min("value").alias("least"), F.max("value").alias("most"),
        F.hll_sketch_agg("text", F.lit(LOG_K)).alias("distinct_sketch"), F.kll_sketch_agg_double("value", F.lit(QUANTILE_K)).alias("quantile_sketch"),
        F.expr(f"approx_top_k_accumulate(text, {TOP_TRACKED}) FILTER (WHERE text IS NOT NULL)").alias("top_sketch"))


def save_sketches(sketches: DataFrame, path: str) -> None:
    """Adds runs to a store; a run that is there already is written anew, so a repeated job counts once."""
    sketches.write.option("partitionOverwriteMode", "dynamic").partitionBy(RUN).mode("overwrite").parquet(path)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn(RUN, F.col(RUN).cast("string"))


def merge_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """The profile of all runs together, or of those that agree in ``by``; it can be merged further."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
        F.expr("approx_top_k_combine(top_sketch)").alias("top_sketch"))


def report(merged: DataFrame, probs: tuple[float, ...] = (0.25, 0.5, 0.75), top: int = 5) -> DataFrame:
    """Numbers in place of sketches: distinct values, quantiles (NULL for text) and the most frequent values."""
    values = [F.when(F.col("least").isNotNull(), F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(p))).alias(f"p{round(100 * p)}") for p in probs]
    return merged.select(*[c for c in merged.columns if not c.endswith("_sketch")], F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"),
                         *values, F.expr(f"approx_top_k_estimate(top_sketch, {top})").alias("top"))


def errors(df: DataFrame, columns: list[str], merged: DataFrame, probs: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Merged sketches beside one exact pass: whether the distinct count and every quantile's rank are within their error.

    The report has one row per column, so its quantiles go into the exact pass as constants.
    """
    found = {r["column_name"]: r for r in report(merged, probs, 1).collect()}
    aggs = []
    for i, c in enumerate(columns):
        r = found.get(c)
        v = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) if r is not None and r["least"] is not None else F.col(f"`{c}`")
        aggs += [F.count(v).alias(f"n{i}"), F.count_distinct(v).alias(f"d{i}")]
        for k, p in enumerate(probs):
            q = None if r is None else r[f"p{round(100 * p)}"]
            aggs += [F.lit(0).alias(f"b{i}_{k}"), F.lit(0).alias(f"u{i}_{k}")] if q is None else [
                F.count_if(v < q).alias(f"b{i}_{k}"), F.count_if(v <= q).alias(f"u{i}_{k}")]
    exact = df.agg(F.count(F.lit(1)).alias("rows"), *aggs).first()
    rows = []
    for i, c in enumerate(columns):
        r, n, d = found.get(c), exact[f"n{i}"], exact[f"d{i}"]
        if r is None:
            continue
        numeric = r["least"] is not None
        ranks = all(exact[f"b{i}_{k}"] - RANK_ERROR * n <= p * n <= exact[f"u{i}_{k}"] + RANK_ERROR * n for k, p in enumerate(probs)) if numeric else None
        rows.append((c, r["rows"], r["nulls"], d, abs(r["distinct_values"] - d) <= DISTINCT_ERROR * d + 1, ranks))
    return df.sparkSession.createDataFrame(rows, "column_name string, rows long, nulls long, distinct_values long, distinct_within boolean, ranks_within boolean")
