"""As-of join: each row with the latest row of another table that isn't later than itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

WIDTH = 90 * 86_400


def _seconds(c: Column) -> Column:
    return c.cast("timestamp").cast("long")


def asof_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, left_by: str, right_by: str,
              values: list[str], width: int = WIDTH) -> DataFrame:
    """``left`` with the ``values`` of the last ``right`` row of the same key at or before its time; NULLs if there is none.

    Times are dates or timestamps. Of several right rows of one key and time the one with the largest values
    counts. A NULL key or time matches nothing; every left row stays, repeated ones too. Columns of ``left`` must
    not be called as the values.

    Rows meet in windows of one key and ``width`` seconds, so a key that holds most of the rows is many windows.
    What a window starts with is the last value of the windows before it, worked out on one row per window.
    """
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    kept = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    mine = left.select(F.col(f"`{left_by}`").alias("key"), F.col(f"`{left_time}`").cast("timestamp").alias("at"), F.lit(1).alias("side"), kept.alias("row"))
    found = F.struct(*[F.col(f"`{v}`") for v in values])
    theirs = right.select(F.col(f"`{right_by}`").alias("key"), F.col(f"`{right_time}`").cast("timestamp").alias("at"), found.alias("found"))
    theirs = theirs.where("key is not null and at is not null").groupBy("key", "at").agg(F.max("found").alias("found")).withColumn("side", F.lit(0))
    meets = F.col("key").isNotNull() & F.col("at").isNotNull()
    both = mine.where(meets).unionByName(theirs, allowMissingColumns=True)
    both = both.withColumn("window", F.floor(_seconds(F.col("at")) / width))

    inside = Window.partitionBy("key", "window").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = both.withColumn("found", F.last("found", ignorenulls=True).over(inside)).where("side = 1")
    per = both.groupBy("key", "window").agg(F.max(F.when(F.col("side") == 0, F.struct("at", "found"))).alias("latest"))
    before = Window.partitionBy("key").orderBy("window").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("key", "window", F.last("latest", ignorenulls=True).over(before)["found"].alias("carried"))
    out = rows.join(per, ["key", "window"]).select("row", F.coalesce("found", "carried").alias("found"))
    alone = mine.where(~F.coalesce(meets, F.lit(False))).select("row", F.lit(None).cast(theirs.schema["found"].dataType).alias("found"))
    return out.unionByName(alone).select("row.*", *[F.col("found").getField(v).alias(v) for v in values])
