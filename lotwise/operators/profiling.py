"""Profiles: counts, distributions, top values, skewness, correlation, box summaries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.operators.lookups import written_lookup
from lotwise.operators.quantiles import exact_quantiles, quantile_table

QUARTILES = [0.25, 0.5, 0.75]


def _rows(wide: DataFrame, entries: list[Column]) -> DataFrame:
    return wide.select(F.inline(F.array(*entries)))


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, non-null and null count, null percent. One aggregate pass."""
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in df.columns])
    n = F.col("_n")
    return _rows(wide, [
        F.struct(
            F.lit(c).alias("column_name"), F.lit(t).alias("column_type"), n.alias("row_count"),
            F.col(c).alias("non_null"), (n - F.col(c)).alias("nulls"),
            F.coalesce(F.try_divide((n - F.col(c)) * 100.0, n), F.lit(0.0)).alias("null_pct"),
        ) for c, t in df.dtypes
    ])


def numeric_profile(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per numeric expression."""
    base = df.select(*[c.cast("double").alias(n) for n, c in columns.items()])
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = base.agg(*[f(n).alias(f"{n}__{s}") for n in columns for s, f in stats.items()])
    moments = _rows(wide, [
        F.struct(F.lit(n).alias("column_name"), *[F.col(f"{n}__{s}").alias(s) for s in stats]) for n in columns
    ])
    parts = exact_quantiles(base, {n: F.col(n) for n in columns}, QUARTILES)
    parts = parts.groupBy(F.col("name").alias("column_name")).agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"p{int(p * 100)}") for p in QUARTILES
    ])
    return moments.join(parts, "column_name", "left")


def _long_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, rows) for several columns in one pass; NULL is a value."""
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*entries))).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))


def category_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, distinct values, most frequent value (ties: smallest) and its frequency per column."""
    counts = _long_counts(df, columns)
    known = F.col("value").isNotNull()
    top = F.min(F.when(known, F.struct((-F.col("rows")).alias("neg"), F.col("value").alias("top"))))
    return counts.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(known, F.col("rows"))), F.lit(0)).alias("count"),
        F.count("value").alias("distinct_values"), top.alias("best"),
    ).select("column_name", "count", "distinct_values", F.col("best.top").alias("top"),
             (-F.col("best.neg")).alias("freq"))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Values with row counts, most frequent first; NULL is a value; ``top`` keeps the first n."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    ordered = counts.orderBy(F.desc("rows"), F.asc_nulls_first("value"))
    return ordered if top is None else ordered.limit(top)


def top_values(df: DataFrame, columns: list[str], n: int = 30) -> DataFrame:
    """The n most frequent values of each column with their rank (cut per task before the shuffle)."""
    w = Window.partitionBy("column_name").orderBy(F.desc("rows"), F.asc_nulls_first("value"))
    return _long_counts(df, columns).withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def auto_bins(df: DataFrame, value: Column) -> int:
    """Number of equal bins: the finer of the Sturges and the Freedman-Diaconis rule."""
    s = df.agg(F.count(value).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    if not s["n"] or s["lo"] == s["hi"]:
        return 1
    span = s["hi"] - s["lo"]
    width = span / (math.log2(s["n"]) + 1)
    q1, q3 = quantile_table(df, {"v": value}, [0.25, 0.75])["v"]
    if q3 > q1:
        width = min(width, 2.0 * (q3 - q1) / s["n"] ** (1 / 3))
    return math.ceil(span / width)


def histogram(df: DataFrame, value: Column, bins: int | None = None) -> DataFrame:
    """Row counts per equal-width bin over non-null values; empty input gives no rows."""
    value = value.cast("double")
    bins = auto_bins(df, value) if bins is None else bins
    lo, hi = df.agg(F.min(value), F.max(value)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_start double, bin_end double, rows bigint")
    width = (hi - lo) / bins or 1.0
    bin_no = F.least(F.floor((value - lo) / width), F.lit(bins - 1)).cast("int")
    counts = df.where(value.isNotNull()).groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select("bin", (lo + F.col("bin") * width).alias("bin_start"),
                         (lo + (F.col("bin") + 1) * width).alias("bin_end"), "rows")


def bands_by_group(df: DataFrame, value: Column, by: Column, per_decade: int = 4) -> DataFrame:
    """Counts per logarithmic band and group; two separate humps in one group hint at mixed units."""
    band = F.floor(F.log10(value) * per_decade) / per_decade
    return (
        df.where(value > 0)
        .groupBy(by.alias("group"), band.alias("log10_from"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min(value).alias("low"), F.max(value).alias("high"))
    )


def skewness(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Sample-adjusted skewness; Spark's own is the population form."""
    wide = df.agg(*[a for n, c in columns.items() for a in (
        F.count(c).alias(f"{n}__n"), F.skewness(c).alias(f"{n}__s"))])

    def adjusted(n: str) -> Column:
        size = F.col(f"{n}__n")
        return F.when(size > 2, F.col(f"{n}__s") * F.sqrt(size * (size - 1.0)) / F.greatest(size - 2.0, F.lit(1.0)))

    return _rows(wide, [F.struct(F.lit(n).alias("column_name"), adjusted(n).alias("skewness")) for n in columns])


def correlations(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Pearson correlation of each pair, over the rows where both are present; one aggregate pass."""
    names = list(columns)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    wide = df.select(*[c.cast("double").alias(n) for n, c in columns.items()]).agg(
        *[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    return _rows(wide, [
        F.struct(F.lit(a).alias("left_column"), F.lit(b).alias("right_column"), F.col(f"{a}__{b}").alias("correlation"))
        for a, b in pairs
    ])


def box_summary(df: DataFrame, value: Column, by: Column | None = None) -> DataFrame:
    """Quartiles, whiskers (last value within 1.5 IQR) and outlier count, overall or per group."""
    group = F.lit("all") if by is None else by
    base = df.select(group.alias("group"), value.cast("double").alias("v")).where(F.col("v").isNotNull())
    quart = exact_quantiles(base, {"v": F.col("v")}, QUARTILES, by=("group",))
    fences = quart.groupBy(F.col("group").alias("g")).agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"q{i + 1}") for i, p in enumerate(QUARTILES)
    ])
    _, side = written_lookup(fences, "fences")
    step = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("v") >= F.col("q1") - step) & (F.col("v") <= F.col("q3") + step)
    return (
        base.join(side, F.col("group").eqNullSafe(F.col("g")))
        .groupBy("group", "q1", "q2", "q3")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def key_feature_report(df: DataFrame, columns: list[str], approx: bool = False) -> DataFrame:
    """Null and distinct count per column; distinct exact, or approximate on request."""
    if approx:
        wide = df.agg(*[a for c in columns for a in (
            F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
            F.approx_count_distinct(c).cast("bigint").alias(f"{c}__distinct"))])
        return _rows(wide, [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__nulls").alias("nulls"),
                                     F.col(f"{c}__distinct").alias("distinct_values")) for c in columns])
    return _long_counts(df, columns).groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("rows"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("distinct_values"),
    )
