"""Model explanation by re-scoring hybrid rows in one distributed transform."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.functions.numbers import hash_unit
from lotwise.operators.split import sample_rows

Scorer = Callable[[DataFrame], DataFrame]  # adds a ``prediction`` column


def shapley(df: DataFrame, features: list[str], score: Scorer, explained: int = 200, background: int = 100,
            key: str = "listing_id", background_df: DataFrame | None = None) -> DataFrame:
    """Sampled Shapley values: (key, feature, contribution, base).

    Each explained row meets every background row once, with a feature order of its own. Walking the order,
    one feature after another changes from the background value to the row's own; the change of the
    prediction is that feature's share. Shares of a row add up to its prediction minus ``base``, the mean
    prediction of the background, which is the same for all rows. The two samples are fixed in number, so
    the work is too: explained * background * (features + 1) scored rows, dealt evenly to the tasks.
    """
    rows = sample_rows(df.select(key, *features), explained, key)
    ground = sample_rows((df if background_df is None else background_df).select(key, *features), background, key, seed=7)
    ground = ground.select(F.col(key).alias("draw"), *[F.col(f).alias(f"b_{f}") for f in features])
    ranked = F.array_sort(F.array(*[
        F.struct(F.md5(F.concat_ws(":", F.lit(f), F.col(key), F.col("draw")).cast("binary")).alias("h"), F.lit(f).alias("f"))
        for f in features]))
    # both samples are of fixed size, so all their pairs are too
    pairs = rows.join(F.broadcast(ground)).withColumn("order", F.transform(ranked, lambda s: s["f"]))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = pairs.repartition(parts, key, "draw").withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))
    mixed = [F.when(F.array_position("order", f) <= F.col("step"), F.col(f)).otherwise(F.col(f"b_{f}")).alias(f) for f in features]
    added = F.when(F.col("step") > 0, F.element_at("order", F.greatest(F.col("step"), F.lit(1))))
    scored = score(steps.select(key, "draw", "step", added.alias("feature"), *mixed)).select(key, "draw", "step", "feature", "prediction")
    walk = Window.partitionBy(key, "draw").orderBy("step")
    whole = walk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    change = scored.withColumns({"change": F.col("prediction") - F.lag("prediction").over(walk), "start": F.first("prediction").over(whole)})
    return change.where(F.col("step") > 0).groupBy(key, "feature").agg(F.avg("change").alias("contribution"), F.avg("start").alias("base"))


def with_donor(df: DataFrame, columns: list[str], key: str = "listing_id", rows_per_bucket: int = 50_000,
               rows: int | None = None, seed: int = 5) -> DataFrame:
    """Each row with the column values of another row (``d_<name>``): a random cyclic shift.

    The shift runs inside buckets of the key hash, so buckets are even whatever the data looks like and
    every value is used exactly once.
    """
    rows = df.count() if rows is None else rows
    buckets = max(1, rows // rows_per_bucket)
    base = df.withColumn("_h", hash_unit(F.col(key), seed)).withColumn("_b", F.col("_h") % buckets)
    ring = Window.partitionBy("_b").orderBy(F.hash(F.col("_h"), F.lit(seed)), key)
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    donor = F.struct(*[F.col(c) for c in columns])
    base = base.withColumn("_donor", F.coalesce(F.lead(donor).over(ring), F.first(donor).over(whole)))
    return base.select(*df.columns, *[F.col(f"_donor.{c}").alias(f"d_{c}") for c in columns])


def permutation_importance(df: DataFrame, features: list[str], score: Scorer, target: str, key: str = "listing_id") -> DataFrame:
    """Loss of R2 and growth of RMSE when one feature takes the values of other rows.

    All features are re-scored in one pass: a row fans out to one copy per feature plus the original.
    """
    donors = with_donor(df.select(key, target, *features), features, key)
    fanned = donors.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in ["", *features]])))
    mixed: list[Column] = [F.when(F.col("feature") == f, F.col(f"d_{f}")).otherwise(F.col(f)).alias(f) for f in features]
    scored = score(fanned.select(key, target, "feature", *mixed))
    error = F.pow(F.col(target) - F.col("prediction"), 2)
    stats = scored.groupBy("feature").agg(
        F.sqrt(F.avg(error)).alias("rmse"),
        (1 - F.try_divide(F.sum(error), F.var_pop(target) * F.count(target))).alias("r2"))
    # one row per feature
    base = stats.where(F.col("feature") == "").first()
    return stats.where(F.col("feature") != "").select(
        "feature", (F.lit(base["r2"]) - F.col("r2")).alias("r2_loss"), (F.col("rmse") - F.lit(base["rmse"])).alias("rmse_growth")
    ).orderBy(F.desc("r2_loss"), "feature")
