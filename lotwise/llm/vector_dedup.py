"""Embedding near-duplicates over an inverted multi-index: visit near cells until a target recall, then verify."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotwise.llm.graph import components, hang
from lotwise.llm.multi_index import MultiIndex, main_size, matrix, sample, traverse, unit, usable
from lotwise.llm.rows import hash_sample
from lotwise.sources.scratch import materialize

THRESHOLD = 0.93
BLOCK = 4096
#: Vectors that set the number of cells to visit, at first and at most, and the share of their links to be reached.
TRIAL_VECTORS = 1024
MOST_TRIAL_VECTORS = 16384
TARGET_RECALL = 0.995
#: So many trial vectors with a few links, but with some, are wanted: of 200 the target lets one go.
LINKED_VECTORS = 200
FEW_LINKS = 32
LEAST_CELLS = 8


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of (vec_id, embedding, label).

    Rows link when labels are equal and not null and the cosine is ``threshold`` or more. Null labels and
    unusable vectors, or vectors of another size than most, link with nothing. Rows of equal label and
    vector are one vertex with a number of copies, which are links of each other. Component_id is the
    smallest id of a component; rows without an id link too, and aren't kept. An empty table gives no rows.

    A pair is found if either vector visits the other's cell, and is counted once for each: by the visitor,
    and for the visited one too where it doesn't visit back. Blocks give out counts and a root for each
    vertex, never pairs. The number of visited cells is what reached ``recall`` of the links of trial vectors,
    each compared with all vectors of its label. Linked trial vectors weigh alike, and those of one link, of
    2 or 3, of 4 to 7 and so on must each reach it. The trial grows from 1,024 to 16,384 vectors until 200 of
    them have 1 to 31 links. If it doesn't get there, and isn't the whole table, every code whose cells can
    hold a link by their distance is visited, which is slower and loses none.
    """
    spark = rows.sparkSession
    own = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"), F.col("label"))
    linkable = F.col("label").isNotNull() & usable(F.col("vector"))
    size = main_size(own.where(linkable))
    linkable = linkable & (F.size("vector") == size)
    name = F.concat(F.hex(F.xxhash64("label", "vector")), F.hex(F.xxhash64(F.lit(1), "vector", "label")))
    named = own.withColumn("node", F.when(linkable, name))
    vertices = materialize(named.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies")), "vectors")
    n = vertices.count()
    if n:
        index = MultiIndex.fit(unit(sample(vertices, "node")), n)
        cells = _cells_to_visit(vertices, index, threshold, recall, n)
        found = materialize(_linked(vertices, index, cells, threshold), "vector_links")
    else:
        found = spark.createDataFrame([], "node string, root string, links long")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    of_vertex = vertices.select("node", "least", "copies").join(counts, "node", "left").join(joined, "node", "left")
    of_vertex = of_vertex.select(F.col("node").alias("_node"), "least", F.coalesce("component", "node").alias("component"),
                                 (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    least = of_vertex.groupBy("component").agg(F.min("least").alias("component_id"))
    result = materialize(of_vertex.join(least, "component").select("_node", "n_links", "component_id"), "vector_groups")
    linked = named.select("vec_id", "node").where("node is not null").join(result, F.col("node") == F.col("_node"))
    linked = linked.select("vec_id", F.col("n_links").cast("long"), "component_id")
    alone = named.where("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _first_cells(a: np.ndarray, b: np.ndarray, cells: int) -> list[tuple[int, int]]:
    out = []
    for cell in traverse(a, b):
        out.append(cell)
        if len(out) == cells:
            break
    return out


def _near_codes(index: MultiIndex, a: np.ndarray, threshold: float) -> list[list[int]]:
    """Codes of the first half whose cells can hold a vector as close as the threshold, from the distances to the centroids.

    A vector nearer to another centroid is beyond the plane halfway to it, and halves are no further apart than wholes.
    """
    own = a.argmin(1)
    between = np.sqrt(((index.first[own][:, None] - index.first[None]) ** 2).sum(2))
    near = a - a[np.arange(len(a)), own][:, None] <= 2 * between * (math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6) + 1e-9
    return [np.flatnonzero(r).tolist() for r in near]


def _linked(vertices: DataFrame, index: MultiIndex, cells: int | None, threshold: float) -> DataFrame:
    """(node, root, links): partial counts of links, and a vertex each node is connected with.

    Without a number of cells each vector meets all that may be close enough.
    """
    width = len(index.second)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            visits: list[list[int]] = []
            codes: list[list[int]] = []
            for at in range(0, batch.num_rows, 256):
                a, b = index.distances(unit(matrix(batch.column(2).slice(at, 256), index.size)))
                some = [[i * width + j for i, j in _first_cells(a[r], b[r], cells or 1)] for r in range(len(a))]
                visits += some
                codes += [sorted({c // width for c in v}) for v in some] if cells else _near_codes(index, a, threshold)
            yield pa.record_batch([*batch.columns, pa.array(visits, pa.list_(pa.int32())), pa.array(codes, pa.list_(pa.int32()))],
                                  names=["node", "label", "vector", "copies", "visits", "codes"])

    kinds = vertices.schema["label"].dataType.simpleString()
    coded = vertices.select("node", "label", "vector", "copies").mapInArrow(
        code, f"node string, label {kinds}, vector array<double>, copies long, visits array<int>, codes array<int>")
    coded = materialize(coded.withColumn("cell", F.col("visits")[0]), "vector_cells")
    first = lambda c: F.floor(c / width).cast("int")
    entries = coded.select("label", first(F.col("cell")).alias("i"), "node", "vector", "copies", "visits", "cell")
    queries = coded.select("label", F.explode("codes").alias("i"), "node", "vector", "copies", "visits", "cell")
    per_entry = entries.groupBy("label", "i").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    per_query = queries.groupBy("label", "i").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("query_blocks"))
    sizes = materialize(per_entry.join(per_query, ["label", "i"]), "vector_blocks")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    entries = entries.join(sizes, ["label", "i"]).withColumns(
        {"block": F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), "query_block": every("query_blocks")})
    queries = queries.join(sizes, ["label", "i"]).withColumns(
        {"query_block": F.pmod(F.xxhash64("node"), F.col("query_blocks")).cast("int"), "block": every("blocks")})
    keys = ["label", "i", "block", "query_block"]
    columns = [*keys, "node", "vector", "copies", "visits", "cell"]
    entries, queries = (d.select(*columns).toDF(*columns) for d in (entries, queries))

    def verify(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = [pd.DataFrame({"node": pd.Series(dtype=str), "root": pd.Series(dtype=str), "links": pd.Series(dtype="int64")})]
        if len(left) and len(right):
            parts.append(_count_links(left, right, threshold, cells is None))
        return pd.concat(parts)

    return entries.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
        verify, "node string, root string, links long")


def _count_links(left: pd.DataFrame, right: pd.DataFrame, threshold: float, all_meet: bool) -> pd.DataFrame:
    y, x = unit(np.stack(left["vector"])), unit(np.stack(right["vector"]))
    names = pd.unique(pd.concat([left["node"], right["node"]]))
    y_at, x_at = pd.Index(names).get_indexer(left["node"]), pd.Index(names).get_indexer(right["node"])
    y_cell, x_cell = left["cell"].to_numpy(), right["cell"].to_numpy()
    y_copies, x_copies = left["copies"].to_numpy(), right["copies"].to_numpy()
    y_visits, x_visits = np.stack(left["visits"]), np.stack(right["visits"])
    counts = np.zeros(len(names), dtype=np.int64)
    root = np.arange(len(names))
    step = max(1, 2_000_000 // len(left))
    for at in range(0, len(right), step):
        close_x, close_y = np.nonzero(x[at:at + step] @ y.T >= threshold)
        close_x = close_x + at
        for k in range(0, len(close_x), 500_000):
            p, q = close_x[k:k + 500_000], close_y[k:k + 500_000]
            keep = x_at[p] != y_at[q]
            if not all_meet:
                keep &= (x_visits[p] == y_cell[q][:, None]).any(1)
            p, q = p[keep], q[keep]
            np.add.at(counts, x_at[p], y_copies[q])
            if not all_meet:
                alone = ~(y_visits[q] == x_cell[p][:, None]).any(1)
                np.add.at(counts, y_at[q[alone]], x_copies[p[alone]])
            root = hang(root, x_at[p], y_at[q])
    used = np.flatnonzero(counts)
    return pd.DataFrame({"node": names[used], "root": names[root[used]], "links": counts[used]})


def _cells_to_visit(vertices: DataFrame, index: MultiIndex, threshold: float, recall: float, n: int) -> int | None:
    """Cells that reach the wanted share of the trial vectors' links; None if too few of them have links to tell."""
    size = TRIAL_VECTORS
    while True:
        weights: dict[int, list[tuple[int, float]]] = {}
        for r in _trial_ranks(vertices, index, threshold, size).orderBy("links", "rank").collect():  # at most a row for each cell and power of 2
            weights.setdefault(r["links"], []).append((r["rank"], r["vectors"]))
        few = sum(w for links, ranks in weights.items() if 2 ** links < FEW_LINKS for _, w in ranks)
        if size >= n or few >= LINKED_VECTORS - 0.5:
            break
        if size >= MOST_TRIAL_VECTORS:
            return None
        size = min(4 * size, MOST_TRIAL_VECTORS)
    cells = 0
    for ranks in weights.values():
        total, seen = sum(w for _, w in ranks), 0.0
        for rank, w in ranks:
            seen, cells = seen + w, max(cells, rank)
            if seen >= recall * total - 1e-9:
                break
    return min(len(index.first) * len(index.second), max(2 * cells, LEAST_CELLS))


def _trial_ranks(vertices: DataFrame, index: MultiIndex, threshold: float, size: int) -> DataFrame:
    """(links, rank, vectors) of trial vectors compared with every vector: how many of them, by the logarithm of
    their number of links, have links of which rank; a vector is spread evenly over its links. The rank is the fewer cells of both directions."""
    trial = hash_sample(vertices.select("node", "label", "vector"), size, "node").collect()
    names, labels = np.array([r["node"] for r in trial]), np.array([r["label"] for r in trial])
    q = unit(np.array([r["vector"] for r in trial]))
    width = len(index.second)

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many links of which rank each trial vector has."""
        tally: dict[tuple[int, int], int] = {}
        a, b = index.distances(q)
        own = a.argmin(1) * width + b.argmin(1)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(matrix(batch.column(2), index.size))
            xa, xb = index.distances(x)
            cell = xa.argmin(1) * width + xb.argmin(1)
            label, name = np.asarray(batch.column(1).to_pylist()), np.asarray(batch.column(0).to_pylist())
            step = max(1, 2_000_000 // len(x))
            for at in range(0, len(q), step):
                r, c = np.nonzero(q[at:at + step] @ x.T >= threshold)
                r = r + at
                keep = (labels[r] == label[c]) & (names[r] != name[c])
                r, c = r[keep], c[keep]
                same = own[r] == cell[c]
                for t, k in zip(*(v.tolist() for v in np.unique(r[same], return_counts=True))):
                    tally[t, 1] = tally.get((t, 1), 0) + k
                for t, u in zip(r[~same].tolist(), c[~same].tolist()):
                    i, j = divmod(int(cell[u]), width)
                    there = int((a[t][:, None] + b[t][None] < a[t][i] + b[t][j]).sum()) + 1
                    i, j = divmod(int(own[t]), width)
                    back = int((xa[u][:, None] + xb[u][None] < xa[u][i] + xb[u][j]).sum()) + 1
                    tally[t, min(there, back)] = tally.get((t, min(there, back)), 0) + 1
        yield pa.record_batch([pa.array([t for t, _ in tally], pa.int32()), pa.array([k for _, k in tally], pa.int32()),
                               pa.array(list(tally.values()), pa.int64())], names=["t", "rank", "n"])

    rows = vertices.select("node", "label", "vector").mapInArrow(ranks, "t int, rank int, n long")
    of_vector = rows.groupBy("t", "rank").agg(F.sum("n").alias("n")).groupBy("t").agg(
        F.sum("n").alias("all"), F.collect_list(F.struct("rank", "n")).alias("ranks"))
    each = of_vector.select(F.floor(F.log2("all") + 1e-9).cast("int").alias("links"), "all", F.explode("ranks").alias("r"))
    return each.groupBy("links", F.col("r.rank").alias("rank")).agg(F.sum(F.col("r.n") / F.col("all")).alias("vectors"))
