"""Approximate nearest neighbours over an inverted multi-index, reranked by exact distance."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.llm.multi_index import MultiIndex, main_size, matrix, sample, traverse, usable
from lotwise.llm.rows import hash_sample
from lotwise.sources.scratch import materialize

BLOCK = 4096
#: Queries that set the number of candidates, at most, and the share of their true neighbours to be reached.
TRIAL_QUERIES = 128
TARGET_RECALL = 0.97


def nearest(rows: DataFrame, is_query: Column, k: int = 10, recall: float = TARGET_RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of ``rows`` (vec_id, embedding) for each query row.

    Score is the Euclidean distance in doubles, ties go to the smaller vec_id. Rows with the query's id are
    no candidates; rows without an id, unusable vectors and those of another size than most take no part.
    Repeated rows count as often as they occur, and a repeated query row is answered once. An empty table
    gives no rows, and with k candidates or fewer all are returned.

    How many candidates a query collects is the number that reached ``recall`` of the true neighbours of at
    most 128 trial queries, each compared with all rows.
    """
    vectors = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"),
                          F.coalesce(is_query, F.lit(False)).alias("is_query"))
    vectors = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    size = main_size(vectors)
    empty = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not size:
        return empty
    vectors = vectors.where(F.size("vector") == size)
    n_rows, n_queries = vectors.agg(F.count(F.lit(1)), F.count(F.when(F.col("is_query"), 1))).first()
    if not n_queries:
        return empty
    index = MultiIndex.fit(sample(vectors, "vec_id"), n_rows)

    coded = materialize(vectors.mapInArrow(_with_cells(index), "vec_id long, vector array<double>, is_query boolean, i int, j int"), "cells")
    held = coded.groupBy("i", "j").count().collect()  # at most a row for each cell of the grid
    filled = np.zeros((len(index.first), len(index.second)), dtype=np.int64)
    for r in held:
        filled[r["i"], r["j"]] = r["count"]
    wanted = _candidates_for(coded, index, filled, k, recall)
    queries = coded.where("is_query").select(F.col("vec_id").alias("query_id"), "vector").dropDuplicates(["query_id", "vector"])
    queries = queries.repartition(math.ceil(n_queries / 64), "query_id")  # few rows, but much work for each
    visits = materialize(queries.mapInArrow(_visits(index, filled, wanted), "query_id long, query_key long, vector array<double>, i int, js array<int>"), "visits")
    left, right = _meeting(coded.select("i", "j", "vec_id", "vector"), visits, len(index.first), len(index.second))
    keys = ["i", "part", "block", "query_block"]

    def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(left) and len(right):
            x, ids, codes = np.stack(left["vector"]), left["vec_id"].to_numpy(), left["j"].to_numpy()
            visited = np.zeros(len(index.second), dtype=bool)
            for query_id, key, q, js in zip(right["query_id"], right["query_key"], right["vector"], right["js"]):
                visited[:] = False
                visited[js] = True
                at = np.flatnonzero(visited[codes] & (ids != query_id))
                if not len(at):
                    continue
                gap = x[at] - q
                far = np.sqrt((gap * gap).sum(1))
                if len(far) > k:
                    close = far <= np.partition(far, k - 1)[k - 1]
                    at, far = at[close], far[close]
                order = np.lexsort((ids[at], far))[:k]
                out += [(query_id, key, int(ids[at[o]]), float(far[o])) for o in order]
        return pd.DataFrame(out, columns=["query_id", "query_key", "vec_id", "score"]).astype(
            {"query_id": "int64", "query_key": "int64", "vec_id": "int64", "score": "float64"})

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(rerank, "query_id long, query_key long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _with_cells(index: MultiIndex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i, j = index.cells(matrix(batch.column(1), index.size)) if batch.num_rows else (np.empty(0), np.empty(0))
            yield pa.record_batch([*batch.columns, pa.array(i, pa.int32()), pa.array(j, pa.int32())],
                                  names=["vec_id", "vector", "is_query", "i", "j"])
    return run


def _meeting(entries: DataFrame, visits: DataFrame, first: int, second: int, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Both sides with the keys (i, part, block, query_block) on which they meet.

    A first code with more than a block of visits is cut into parts of its second codes, down to single cells, so
    an entry has one place however many queries there are. Only a part that still has more visits than a block holds its
    entries once for each block of them; one with more entries than a block shows its visits to each block of those.
    Parts that no query visits drop out.
    """
    cuts = np.ones(first, dtype=np.int64)
    for r in visits.groupBy("i").count().collect():  # at most a row for each first code
        cuts[r["i"]] = min(second, -(-r["count"] // block))
    cut = F.get(F.array(*[F.lit(int(c)) for c in cuts]), F.col("i"))
    entries = entries.withColumn("part", F.pmod(F.col("j"), cut).cast("int"))
    visits = visits.withColumn("cut", cut).withColumn("part", F.explode(F.array_distinct(F.transform("js", lambda j: F.pmod(j, F.col("cut")).cast("int")))))
    visits = visits.withColumn("js", F.filter("js", lambda j: F.pmod(j, F.col("cut")) == F.col("part"))).drop("cut")

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("i", "part").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(name))

    # at most a row for each cell of the grid
    parts = materialize(blocks(entries, "entry_blocks").join(blocks(visits, "visit_blocks"), ["i", "part"]), "parts")

    def numbers(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = entries.join(parts, ["i", "part"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), "entry_blocks").cast("int"))
    right = visits.join(parts, ["i", "part"]).withColumn("query_block", F.pmod(F.xxhash64("query_id", "query_key"), "visit_blocks").cast("int"))
    return (left.withColumn("query_block", numbers("visit_blocks")).drop("entry_blocks", "visit_blocks"),
            right.withColumn("block", numbers("entry_blocks")).drop("entry_blocks", "visit_blocks"))


def _visits(index: MultiIndex, filled: np.ndarray, wanted: int):
    """For each query the filled cells it visits, a row for each first code."""
    schema = pa.schema([("query_id", pa.int64()), ("query_key", pa.int64()), ("vector", pa.list_(pa.float64())), ("i", pa.int32()), ("js", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            x = matrix(batch.column(1), index.size) if batch.num_rows else np.empty((0, index.size))
            a, b = index.distances(x)
            for r, query_id in enumerate(batch.column(0).to_pylist()):
                cells: dict[int, list[int]] = {}
                seen = 0
                for i, j in traverse(a[r], b[r]):
                    if filled[i, j]:
                        cells.setdefault(i, []).append(j)
                        seen += int(filled[i, j])
                        if seen >= wanted:
                            break
                key = int(np.frombuffer(x[r].tobytes(), dtype=np.int64).sum())  # tells repeated ids apart
                rows += [(query_id, key, x[r], i, js) for i, js in cells.items()]
            columns = list(zip(*rows)) or [[]] * len(schema)
            yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


def _candidates_for(coded: DataFrame, index: MultiIndex, filled: np.ndarray, k: int, recall: float) -> int:
    """Candidates to collect, own row included, from the exact neighbours of the trial queries."""
    trial = hash_sample(coded.where("is_query").select("vec_id", "vector"), TRIAL_QUERIES, "vec_id").collect()
    ids, q = np.array([r["vec_id"] for r in trial]), np.array([r["vector"] for r in trial])

    def closest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            x = matrix(batch.column(1), index.size)
            rows = []
            for r in range(len(q)):
                gap = x - q[r]
                far = (gap * gap).sum(1)
                far[own == ids[r]] = np.inf
                at = np.argpartition(far, k - 1)[:k] if len(far) > k else np.arange(len(far))
                rows += [(r, float(far[t]), batch.column(2)[int(t)].as_py(), batch.column(3)[int(t)].as_py()) for t in at if np.isfinite(far[t])]
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, (pa.int32(), pa.float64(), pa.int32(), pa.int32()))],
                                  names=["r", "far", "i", "j"])

    near = coded.select("vec_id", "vector", "i", "j").mapInArrow(closest, "r int, far double, i int, j int")
    place = F.row_number().over(Window.partitionBy("r").orderBy("far", "i", "j"))
    true = near.withColumn("place", place).where(F.col("place") <= k).select("r", "i", "j").collect()  # k rows for each trial query
    if not true:
        return int(filled.sum())
    a, b = index.distances(q)
    needed = []
    for r in range(len(q)):
        cells = {(t["i"], t["j"]) for t in true if t["r"] == r}
        at: dict[tuple[int, int], int] = {}
        seen = 0
        for i, j in traverse(a[r], b[r]):
            seen += int(filled[i, j])
            if (i, j) in cells:
                at[i, j] = seen
                if len(at) == len(cells):
                    break
        needed += [at[t["i"], t["j"]] for t in true if t["r"] == r]
    needed.sort()
    return max(needed[min(len(needed) - 1, math.ceil(recall * len(needed)))], 4 * k)
