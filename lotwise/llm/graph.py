"""Connected components of an edge table, by rounds that hang edges onto smaller neighbours."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from lotwise.sources.scratch import materialize


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node reachable.

    Each round first links the larger neighbours of a node with its smallest neighbour, then the smaller
    ones. Both are an aggregation and a join, so a node with very many neighbours is many rows of a join
    and never a list. Rounds end when the edges no longer change: then they are stars. Tables written
    between rounds cut the lineage.
    """
    links = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    links = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = _state(links)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        links = materialize(small.where("a <> b").distinct(), "links")
        now = _state(links)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def hang(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest vertex of each component after adding edges (a, b), within one block."""
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            short = root[root]
            if (short == root).all():
                break
            root = short
        if (root == before).all():
            break
    return root
