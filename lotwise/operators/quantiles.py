"""Exact quantiles (linear interpolation, NULL and NaN ignored), the same way at every size.

A mergeable sketch brackets each wanted rank; one more pass counts the rows below the bracket and the
values inside it. Equal values collapse before the shuffle, and ranks are found on range partitions of the
counted values, so no task sees more than its part of a bracket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.sources.scratch import materialize

ACCURACY = 10_000
#: Distance of the bracket from the wanted rank, as a share of the rows: three times the sketch's error.
MARGIN = 3e-4
#: Below this many values the margin is under two ranks, and the bracket is everything.
WHOLE = 10_000


def exact_quantiles(
    df: DataFrame,
    columns: dict[str, Column],
    probs: list[float],
    by: tuple[str, ...] = (),
    method: str = "exact",
) -> DataFrame:
    """One row per (by..., name, prob) with its ``value``, NULL for a group without values.

    An empty table has no groups and no rows. ``method='approx'`` uses ``percentile_approx`` (a real data
    value, relative rank error 1e-4) and is opt-in.
    """
    if method == "approx":
        return _one_pass(df, columns, probs, by, lambda c: F.percentile_approx(c, probs, ACCURACY))
    group = [f"g_{k}" for k in range(len(by))] + ["name"]
    names = [F.col(c).alias(g) for c, g in zip(by, group)]
    around = [min(max(p + side, 0.0), 1.0) for p in probs for side in (-MARGIN, MARGIN)]
    known = [F.nanvl(c.cast("double"), F.lit(None).cast("double")) for c in columns.values()]
    if by:
        pairs = [F.struct(F.lit(n).alias("name"), v.alias("v")) for n, v in zip(columns, known)]
        long = df.select(*names, F.inline(F.array(*pairs)))
        stats = long.groupBy(*group).agg(*_sketch("v", around))
    else:
        wide = df.select(*[v.alias(f"v{i}") for i, v in enumerate(known)])
        sketches = wide.agg(F.count(F.lit(1)).alias("rows"), *[F.struct(*_sketch(f"v{i}", around)).alias(f"s{i}") for i in range(len(known))])
        entries = [F.struct(F.lit(n).alias("name"), *[F.col(f"s{i}.{f}").alias(f) for f in ("n", "least", "most", "q")]) for i, n in enumerate(columns)]
        stats = sketches.where("rows > 0").select(F.inline(F.array(*entries)))
    whole = F.col("n") < WHOLE
    entries = [F.struct(F.lit(float(p)).alias("prob"), (F.lit(float(p)) * (F.col("n") - 1)).alias("rank"),
                        F.when(whole | F.lit(p <= MARGIN), F.col("least")).otherwise(F.col("q")[2 * k]).alias("low"),
                        F.when(whole | F.lit(p >= 1 - MARGIN), F.col("most")).otherwise(F.col("q")[2 * k + 1]).alias("high"))
               for k, p in enumerate(probs)]
    brackets = materialize(stats.select(*group, F.inline(F.array(*entries))), "brackets")

    key = [*group, "prob"]
    if by:
        near = long.join(brackets.toDF(*[f"t_{c}" for c in brackets.columns]), _same(group) & (F.col("v") <= F.col("t_high")))
        near = near.select(*group, F.col("t_prob").alias("prob"), F.when(F.col("v") >= F.col("t_low"), F.col("v")).alias("v"))
    else:
        near = _near(wide, {n: f"v{i}" for i, n in enumerate(columns)}, brackets)
    counted = near.groupBy(*key, "v").agg(F.count(F.lit(1)).alias("c"))
    counted = materialize(counted, "counted")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(counted.repartitionByRange(parts, *key, "v").withColumn("part", F.spark_partition_id()), "counted")
    before = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy(*key, "part").agg(F.sum("c").alias("c")).withColumn("base", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    inside = Window.partitionBy(*key, "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.withColumn("upto", F.sum("c").over(inside)).join(bases.toDF(*[f"t_{c}" for c in bases.columns]), _same([*key, "part"]))
    ranked = ranked.select(*key, "v", (F.col("t_base") + F.col("upto")).alias("end"), (F.col("t_base") + F.col("upto") - F.col("c")).alias("start"))
    found = ranked.join(brackets.select(*key, "rank").toDF(*[f"t_{c}" for c in [*key, "rank"]]), _same(key))
    holds = lambda r: F.when((F.col("start") <= r) & (r < F.col("end")), F.col("v"))
    found = found.groupBy(*key).agg(F.max(holds(F.floor("t_rank"))).alias("low_value"), F.max(holds(F.ceil("t_rank"))).alias("high_value"))
    found = brackets.select(*key, "rank").join(found.toDF(*[f"t_{c}" for c in found.columns]), _same(key), "left")
    value = F.col("t_low_value") + (F.col("t_high_value") - F.col("t_low_value")) * (F.col("rank") - F.floor("rank"))
    # equal neighbours need no interpolation, which would turn infinities into NaN
    value = F.when(F.col("t_low_value") == F.col("t_high_value"), F.col("t_low_value")).otherwise(value)
    return found.select(*[F.col(g).alias(c) for c, g in zip(by, group)], "name", "prob", value.alias("value"))


def _sketch(value: str, around: list[float]) -> list[Column]:
    return [F.count(value).alias("n"), F.min(value).alias("least"), F.max(value).alias("most"),
            F.percentile_approx(value, around, ACCURACY).alias("q")]


def _near(wide: DataFrame, columns: dict[str, str], brackets: DataFrame) -> DataFrame:
    """(name, prob, v) of values up to a bracket's end, NULL for those below it. Brackets are one per column and prob."""
    entries = [
        F.when(F.col(columns[r["name"]]) <= r["high"], F.struct(
            F.lit(r["name"]).alias("name"), F.lit(r["prob"]).alias("prob"),
            F.when(F.col(columns[r["name"]]) >= r["low"], F.col(columns[r["name"]])).alias("v")))
        for r in brackets.where("high IS NOT NULL").collect()
    ]
    if not entries:
        return wide.limit(0).select(F.lit("").alias("name"), F.lit(0.0).alias("prob"), F.lit(None).cast("double").alias("v"))
    return wide.select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))


def _one_pass(df, columns, probs, by, agg) -> DataFrame:
    wide = df.groupBy(*by).agg(*[agg(c.cast("double")).alias(n) for n, c in columns.items()])
    entries = [
        F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("prob"), F.col(n)[i].alias("value"))
        for n in columns for i, p in enumerate(probs)
    ]
    return wide.select(*by, F.inline(F.array(*entries)))


def _same(keys: list[str]) -> Column:
    """Join condition between a frame and a renamed one; NULL keys match."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"t_{k}"))
    return cond


def quantile_table(df: DataFrame, columns: dict[str, Column], probs: list[float], **kw) -> dict[str, list[float | None]]:
    """Ungrouped quantiles as a small dictionary: ``len(columns) * len(probs)`` numbers."""
    found = {(r["name"], r["prob"]): r["value"] for r in exact_quantiles(df, columns, probs, **kw).collect()}
    return {n: [found.get((n, float(p))) for p in probs] for n in columns}


def medians(df: DataFrame, columns: dict[str, Column], **kw) -> dict[str, float | None]:
    return {n: v[0] for n, v in quantile_table(df, columns, [0.5], **kw).items()}
