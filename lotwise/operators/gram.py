"""Cross products of columns, the one aggregate that linear fits need."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def grams(df: DataFrame, values: list[Column], by: Column | None = None) -> dict[int, np.ndarray]:
    """Sums of z z' for z = (1, values...), by a whole-number key of few values (0 without ``by``).

    Tasks add up their own rows before the shuffle, one matrix per key; NULL counts as 0. An empty table has
    no keys.
    """
    d = len(values) + 1
    key = F.lit(0).cast("long") if by is None else by.cast("long")
    rows = df.select(key.alias("k"), *[F.coalesce(v.cast("double"), F.lit(0.0)).alias(f"v{i}") for i, v in enumerate(values)])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            keys = batch.column(0).to_numpy()
            z = np.column_stack([np.ones(len(keys)), *[c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]])
            for k in np.unique(keys):
                own = z[keys == k]
                sums[int(k)] = sums.get(int(k), 0) + own.T @ own
        yield pa.record_batch([pa.array(list(sums), pa.int64()), pa.array([m.ravel() for m in sums.values()], pa.list_(pa.float64()))], names=["k", "m"])

    cells = rows.mapInArrow(add_up, "k long, m array<double>").select("k", F.posexplode("m").alias("i", "v"))
    out: dict[int, np.ndarray] = {}
    for r in cells.groupBy("k", "i").agg(F.sum("v").alias("v")).collect():
        out.setdefault(r["k"], np.zeros(d * d))[r["i"]] = r["v"]
    return {k: m.reshape(d, d) for k, m in out.items()}
