"""Windowed monitoring and drift of a prediction stream. State is one row per open window."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

SMALLEST_SHARE = 1e-4


def replays_dropped(stream: DataFrame, key: list[str], time: str, delay: str = "1 day") -> DataFrame:
    """Repeated request keys pass once, as long as they come within the delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def monitor(stream: DataFrame, time: str, value: str, low: float, high: float, width: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Count, mean, null share and out-of-range share per tumbling window; late rows are dropped."""
    v = F.col(value)
    outside = F.count_if((v < low) | (v > high))
    stats = stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("w")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(v).alias("mean"),
        (F.count_if(v.isNull()) / F.count(F.lit(1))).alias("null_share"), (outside / F.count(F.lit(1))).alias("outside_share"))
    return stats.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "rows", "mean", "null_share", "outside_share")


def sessions(stream: DataFrame, client: str, time: str, value: str, gap: str = "30 minutes", delay: str | None = "1 day") -> DataFrame:
    """Runs of a client's rows that are at most ``gap`` apart, once they are closed: the watermark has passed the
    last row by ``gap``. Without ``delay`` the stream has a watermark of its own. State is one row per open session.
    """
    timed = stream if delay is None else stream.withWatermark(time, delay)
    runs = timed.groupBy(client, F.session_window(time, gap).alias("s")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(value).alias("mean"), F.max(time).alias("last_at"))
    return runs.select(client, F.col("s.start").alias("first_at"), "last_at", "rows", "mean")


def bin_counts(value: Column, edges: list[float]) -> list[Column]:
    """Row count per bin between the edges, with an open bin on each side."""
    cuts = [None, *edges, None]
    out = []
    for i, (low, high) in enumerate(zip(cuts, cuts[1:])):
        inside = value.isNotNull()
        inside = inside if low is None else inside & (value >= low)
        inside = inside if high is None else inside & (value < high)
        out.append(F.count_if(inside).alias(f"bin_{i}"))
    return out


def profile(df: DataFrame, value: str, edges: list[float]) -> list[float]:
    """Share of rows per bin in the training data."""
    counts = list(df.agg(*bin_counts(F.col(value), edges)).first())
    total = sum(counts)
    return [c / total for c in counts] if total else [0.0] * len(counts)


def stability_index(shares: list[Column], baseline: list[float], floor: float = SMALLEST_SHARE) -> Column:
    """Population stability index: sum of (p - q) * ln(p / q), with a floor for empty bins."""
    out = F.lit(0.0)
    for p, q in zip(shares, baseline):
        p, q = F.greatest(p, F.lit(floor)), max(q, floor)
        out = out + (p - F.lit(q)) * (F.log(p) - F.lit(math.log(q)))
    return out


def drift(stream: DataFrame, time: str, value: str, edges: list[float], baseline: list[float], width: str = "1 day",
          delay: str = "1 day", floor: float = SMALLEST_SHARE) -> DataFrame:
    """Stability index per window against the training profile: one aggregation, bins as columns."""
    counts = stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("w")).agg(
        F.count(value).alias("rows"), *bin_counts(F.col(value), edges))
    shares = [F.try_divide(F.col(f"bin_{i}"), F.col("rows")) for i in range(len(edges) + 1)]
    return counts.select(F.col("w.start").alias("window_start"), "rows", stability_index(shares, baseline, floor).alias("psi"))
