"""Rank correlation: average ranks with ties, found on range partitions, and all pairs from one aggregate."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.operators.gram import grams
from lotwise.sources.scratch import materialize


#: Columns with up to so many distinct values have their ranks sent to the rows; rows are shuffled only for the others.
FEW = 10_000


def _known(name: str) -> Column:
    return F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(None).cast("double"))


def _value_ranks(long: DataFrame) -> DataFrame:
    """(name, v, rank) of each distinct value of a frame with (name, v)."""
    parts = int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = long.groupBy("name", "v").agg(F.count(F.lit(1)).alias("n"))
    placed = materialize(counted.repartitionByRange(parts, "name", "v").withColumn("part", F.spark_partition_id()), "ranked-values")
    sums = placed.groupBy("name", "part").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("name", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("name", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = placed.withColumn("upto", F.sum("n").over(inside)).join(bases, ["name", "part"])
    return ranks.select("name", "v", (F.col("base") + F.col("upto") - (F.col("n") - 1) / 2).alias("rank"))


def average_ranks(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """(key, name, rank) for every value that is known; equal values share the mean of their ranks.

    Equal values collapse before the shuffle. Distinct values are dealt by range, each part is ranked by itself
    and starts at the sum of the parts before it, so no task orders a whole column. NULL and NaN have no rank.
    """
    entries = [F.struct(F.lit(c).alias("name"), _known(c).alias("v")) for c in columns]
    long = df.select(F.col(f"`{key}`").alias("key"), F.inline(F.array(*entries))).where("v is not null")
    return long.join(_value_ranks(long), ["name", "v"]).select("key", "name", "rank")


def _wide_ranks(rows: DataFrame, size: int) -> DataFrame:
    """(key, r0, r1, ...) of rows with (key, v0, v1, ...): the largest rank by key and column."""
    long = lambda numbers: rows.select("key", F.inline(F.array(*[
        F.struct(F.lit(i).alias("name"), F.col(f"v{i}").alias("v")) for i in numbers]))).where("v is not null")
    ranks = materialize(_value_ranks(long(range(size))), "value-ranks")
    distinct = {r["name"]: r["n"] for r in ranks.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per column
    many = [i for i in range(size) if distinct.get(i, 0) > FEW]
    near = rows
    for i in range(size):
        if i not in many:
            held = ranks.where(F.col("name") == i).select(F.col("v").alias("_v"), F.col("rank").alias(f"r{i}"))
            near = near.join(F.broadcast(held), F.col(f"v{i}") == F.col("_v"), "left").drop("_v")
    none = F.lit(None).cast("double")
    out = near.select("key", *[(none if i in many else F.col(f"r{i}")).alias(f"r{i}") for i in range(size)])
    if many:
        far = long(many).join(ranks.where(F.col("name").isin(many)), ["name", "v"])
        out = out.unionByName(far.select("key", *[(F.when(F.col("name") == i, F.col("rank")) if i in many else none).alias(f"r{i}") for i in range(size)]))
    return out.groupBy("key").agg(*[F.max(f"r{i}").alias(f"r{i}") for i in range(size)])


def rank_correlations(df: DataFrame, columns: list[str], key: str = "listing_id") -> DataFrame:
    """(column_a, column_b, rows, spearman) of all pairs, over the rows where both are known; ``key`` names a row.

    Ranks are those among a column's known values. Without two different ranks on either side it is NULL.
    """
    rows = materialize(df.select(F.col(f"`{key}`").alias("key"), *[_known(c).alias(f"v{i}") for i, c in enumerate(columns)]), "rank-rows")
    total = max(rows.count(), 1)
    ranks = _wide_ranks(rows, len(columns))
    wide = ranks.select("key", *[(F.col(f"r{i}") / total - 0.5).alias(f"r{i}") for i in range(len(columns))])
    p = len(columns)
    r = [F.col(f"r{i}") for i in range(p)]
    known = [F.when(c.isNotNull(), 1.0) for c in r]
    cross = grams(wide, [*known, *r, *[c * c for c in r]]).get(0)
    rows = []
    for i in range(p):
        for j in range(i + 1, p):
            if cross is None:
                rows.append((columns[i], columns[j], 0, None))
                continue
            k, x, xx = 1, 1 + p, 1 + 2 * p
            n = cross[k + i, k + j]
            sx, sy = cross[x + i, k + j], cross[x + j, k + i]
            vx, vy = cross[xx + i, k + j] - sx * sx / n if n else 0.0, cross[xx + j, k + i] - sy * sy / n if n else 0.0
            # what rounding leaves of equal ranks is no variance
            vx, vy = vx if vx > 1e-12 * cross[xx + i, k + j] else 0.0, vy if vy > 1e-12 * cross[xx + j, k + i] else 0.0
            spread = math.sqrt(max(vx, 0.0) * max(vy, 0.0))
            rows.append((columns[i], columns[j], int(n), float((cross[x + i, x + j] - sx * sy / n) / spread) if spread > 1e-12 else None))
    return df.sparkSession.createDataFrame(rows, "column_a string, column_b string, rows long, spearman double")
