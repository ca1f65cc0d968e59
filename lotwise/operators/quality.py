"""Data-quality rules and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions.numbers import to_number
from lotwise.functions.text import na_to_null, strip_lower
from lotwise.functions.vocabulary import SILENT_CODES

CRITICAL = ["price", "make_name", "model_name", "year_of_manufacture"]
OLDEST_YEAR = 1950


def _known(df: DataFrame, name: str) -> tuple[Column, Column]:
    """The column with missing tokens as NULL, and its numeric form."""
    kind = dict(df.dtypes)[name]
    raw = na_to_null(F.col(name)) if kind == "string" else F.col(name)
    return raw, to_number(raw, kind)


def rule_report(df: DataFrame, as_of_year: int, price: str = "price", year: str = "year_of_manufacture") -> DataFrame:
    """One row per rule: status passed, failed, warning or skipped, and the number it rests on.

    The last row, ``overall``, fails if any rule fails. All rules come from one aggregate pass.
    """
    aggs = [F.lit(0).alias("_")]
    rules: list[tuple[str, Column, Column]] = []
    none, lit = F.lit(None).cast("double"), F.lit

    def status(ok: Column, bad: str = "failed") -> Column:
        return F.when(ok, "passed").otherwise(bad)

    def skipped_unless(cond: Column, then: Column) -> Column:
        return F.when(cond, then).otherwise("skipped")

    rules.append(("price_exists", lit("passed" if price in df.columns else "failed"), none))
    if price in df.columns:
        raw, num = _known(df, price)
        aggs += [F.count_if(raw.isNotNull() & num.isNull()).alias("price_bad"), F.min(num).alias("price_min")]
        ok, low = F.col("price_bad") == 0, F.col("price_min")
        rules += [
            ("price_numeric", status(ok), F.col("price_bad").cast("double")),
            ("price_positive", skipped_unless(ok & low.isNotNull(), status(low > 0)), low),
        ]
    rules.append(("year_exists", lit("passed" if year in df.columns else "warning"), none))
    if year in df.columns:
        raw, num = _known(df, year)
        old = (num > 0) & (num <= OLDEST_YEAR)
        aggs += [
            F.count_if(raw.isNotNull() & num.isNull()).alias("year_bad"),
            F.min(num).alias("year_min"), F.max(num).alias("year_max"),
            F.count_if(old).alias("year_old"), F.min(F.when(old, num)).alias("year_old_min"),
        ]
        ok, low, high = F.col("year_bad") == 0, F.col("year_min"), F.col("year_max")
        some = ok & low.isNotNull()
        rules += [
            ("year_numeric", status(ok), F.col("year_bad").cast("double")),
            ("year_min", skipped_unless(some, status(low > OLDEST_YEAR)), low),
            ("year_old_count", skipped_unless(some & (low == 0), status(F.col("year_old") == 0, "warning")),
             F.col("year_old").cast("double")),
            ("year_old_min", skipped_unless(some & (low == 0), status(F.col("year_old") == 0, "warning")),
             F.col("year_old_min")),
            ("year_max", skipped_unless(some, status(high <= as_of_year + 1)), high),
        ]
    failed = sum((F.when(s == "failed", 1).otherwise(0) for _, s, _ in rules), F.lit(0))
    rules.append(("overall", status(failed == 0), failed.cast("double")))
    return df.agg(*aggs).select(F.inline(F.array(*[
        F.struct(F.lit(r).alias("rule"), s.alias("status"), o.alias("observed")) for r, s, o in rules])))


def missing_share(df: DataFrame, columns: list[str] | None = None, limit_pct: float = 5.0) -> DataFrame:
    """Percent of missing values per critical column against a limit; an absent column is reported."""
    columns = CRITICAL if columns is None else columns
    have = [c for c in columns if c in df.columns]
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(_known(df, c)[0]).alias(c) for c in have])
    entries = []
    for c in columns:
        pct = F.try_divide((F.col("_n") - F.col(c)) * 100.0, F.col("_n")) if c in have else F.lit(None).cast("double")
        state = F.when(pct > limit_pct, "exceeds").otherwise("ok") if c in have else F.lit("absent")
        entries.append(F.struct(F.lit(c).alias("column_name"), pct.alias("missing_pct"), state.alias("status")))
    return wide.select(F.inline(F.array(*entries)))


def unmapped_values(df: DataFrame, column: str, known: list[str]) -> DataFrame:
    """Values no rule covers, with row counts."""
    value = strip_lower(F.col(column))
    return (
        df.select(value.alias("value")).where(F.col("value").isNotNull() & ~F.col("value").isin(known))
        .groupBy("value").agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(column).alias("column_name"), "value", "rows")
    )


def unmapped_currencies(df: DataFrame, known: list[str] | None = None) -> DataFrame:
    return unmapped_values(df, "currency_code", SILENT_CODES if known is None else known)
