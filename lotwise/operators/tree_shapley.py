"""Exact Shapley values of tree ensembles, from the nodes of the fitted trees instead of re-scored rows.

A coalition's value is the expected prediction when only its members are known: at a split on an unknown
member the row goes both ways, by the training weight of the children. A leaf then gives each member on its
path a closed-form share, which depends only on which members let the row through.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotwise.operators.components import _entries
from lotwise.operators.encode import Preprocessor
from lotwise.sources.scratch import new_path

#: Members of a path up to which the shares of all codes are kept, and bytes of those that a task keeps.
MOST_BITS, TABLE_BYTES = 10, 64_000_000


@dataclass
class Node:
    """A split (``slot`` is set) or a leaf; ``weight`` is the training weight that reached it."""

    value: float
    weight: float
    slot: int = -1
    threshold: float = 0.0
    categories: tuple[float, ...] | None = None
    left: "Node | None" = None
    right: "Node | None" = None

    def goes_left(self, column: np.ndarray) -> np.ndarray:
        return column <= self.threshold if self.categories is None else np.isin(column, self.categories)


def read_trees(model) -> list[tuple[float, Node]]:
    """(weight, root) of each tree of a fitted tree, forest or boosting model, from its saved node table.

    The number of nodes is bounded by trees and depth, not by the data.
    """
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    path = new_path(spark, "trees")
    model.write().overwrite().save(path)
    table = spark.read.parquet(f"{path}/data")
    if "nodeData" in table.columns:
        table = table.select("treeID", "nodeData.*")
    else:
        table = table.withColumn("treeID", F.lit(0))
    rows: dict[int, dict[int, object]] = {}
    for r in table.collect():
        rows.setdefault(r["treeID"], {})[r["id"]] = r

    def build(nodes: dict, i: int) -> Node:
        r = nodes[i]
        node = Node(r["prediction"], r["impurityStats"][0])
        if r["leftChild"] >= 0:
            values = tuple(r["split"]["leftCategoriesOrThreshold"])
            node.slot = r["split"]["featureIndex"]
            if r["split"]["numCategories"] < 0:
                node.threshold = values[0]
            else:
                node.categories = values
            node.left, node.right = build(nodes, r["leftChild"]), build(nodes, r["rightChild"])
        return node

    n = len(rows)
    weights = list(getattr(model, "treeWeights", [1.0] * n))
    if hasattr(model, "trees") and model.__class__.__name__.startswith("RandomForest"):
        weights = [1.0 / n] * n
    return [(w, build(rows[t], 0)) for t, w in zip(sorted(rows), weights)]


def expected(node: Node) -> float:
    """The tree's prediction when nothing is known."""
    if node.left is None:
        return node.value
    share = node.left.weight / node.weight
    return share * expected(node.left) + (1 - share) * expected(node.right)


def leaf_shares(let_through: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Shapley values of the game in which a leaf counts 1 times the product over its members.

    A known member counts 1 or 0 (``let_through``, patterns x members), an unknown one its ``shares``. For each
    member the products over subsets of the others are the coefficients of a polynomial, one by subset size.
    """
    patterns, m = let_through.shape
    by_size = np.array([math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)])
    out = np.empty((patterns, m))
    for i in range(m):
        poly = np.ones((patterns, 1))
        for j in range(m):
            if j != i:
                grown = np.zeros((patterns, poly.shape[1] + 1))
                grown[:, :-1] = poly * shares[j]
                grown[:, 1:] += poly * let_through[:, j:j + 1]
                poly = grown
        out[:, i] = (let_through[:, i] - shares[i]) * (poly @ by_size)
    return out


class Shares:
    """Contributions to trees, for one batch of rows after the other.

    A row's code has a bit for each member of the path so far: whether the row passes all its splits. What leaves
    give by code is the same for all batches; it is kept up to ``TABLE_BYTES``. Two leaves of a split count as one.
    """

    def __init__(self, trees: list[tuple[float, Node]], members: list[int], n_members: int) -> None:
        self.trees, self.members, self.n_members = trees, members, n_members
        self.tables: dict[int, tuple[list[int], np.ndarray]] = {}
        self.bytes = 0

    def of(self, slots: Callable[[Node], dict[int, np.ndarray]], rows: int) -> np.ndarray:
        """(members x rows) shares; ``slots`` gives the values of each slot that a tree uses."""
        out = np.zeros((self.n_members, rows))
        for weight, root in self.trees:
            values = slots(root)

            def visit(node: Node, known: dict[int, float], code: np.ndarray) -> None:
                if node.left is None:
                    if known and node.value:
                        self._add(out, node, code, len(known), lambda: (list(known), self._leaf(node, known, weight)))
                    return
                left = node.goes_left(values[node.slot])
                member = self.members[node.slot]
                if node.left.left is None and node.right.left is None:
                    bits = len(known) + 1
                    self._add(out, node, code | left.astype(np.intp) << len(known), bits, lambda: self._pair(node, known, member, weight))
                    return
                bit = list(known).index(member) if member in known else len(known)
                for child, side in ((node.left, left), (node.right, ~left)):
                    side = side.astype(np.intp) << bit
                    below = code & (side | ~(1 << bit)) if member in known else code | side
                    visit(child, known | {member: known.get(member, 1.0) * child.weight / node.weight}, below)

            visit(root, {}, np.zeros(rows, dtype=np.intp))
        return out

    def _add(self, out: np.ndarray, node: Node, code: np.ndarray, bits: int, make) -> None:
        names, table = self.tables.get(id(node), (None, None))
        if names is None:
            names, give = make()
            if bits > MOST_BITS:  # only the codes that occur
                present, code = np.unique(code, return_inverse=True)
                table = give(present)
            else:
                table = give(np.arange(1 << bits))
                if self.bytes + table.nbytes <= TABLE_BYTES:
                    self.tables[id(node)] = names, table
                    self.bytes += table.nbytes
        for name, share in zip(names, table):
            out[name] += share.take(code)

    @staticmethod
    def _leaf(leaf: Node, known: dict[int, float], weight: float):
        """What the leaf gives its members (rows) for each code."""
        shares, places = np.array(list(known.values())), np.arange(len(known))
        return lambda codes: np.ascontiguousarray(leaf_shares((codes[:, None] >> places & 1).astype(float), shares).T) * (weight * leaf.value)

    def _pair(self, node: Node, known: dict[int, float], member: int, weight: float):
        """The same for both leaves of a split, whose side is the last bit of a code."""
        names, top = list(known | {member: 1.0}), len(known)
        bit = names.index(member)

        def give(codes: np.ndarray) -> np.ndarray:
            left, out = codes >> top & 1, np.zeros((len(names), len(codes)))
            for child, side in ((node.left, left), (node.right, 1 - left)):
                if child.value:
                    passed = side if member not in known else codes >> bit & side
                    below = codes & ~(1 << top) & ~(1 << bit) | passed << bit
                    out += self._leaf(child, known | {member: known.get(member, 1.0) * child.weight / node.weight}, weight)(below)
            return out

        return names, give


def contributions(trees: list[tuple[float, Node]], slots: dict[int, np.ndarray], members: list[int], n_members: int, rows: int) -> np.ndarray:
    """(members x rows) shares of a batch. ``slots`` has the values of each slot used, ``members`` the member of each slot."""
    return Shares(trees, members, n_members).of(lambda root: slots, rows)


def used_slots(node: Node) -> set[int]:
    return set() if node.left is None else {node.slot} | used_slots(node.left) | used_slots(node.right)


def slot_columns(encoder: Preprocessor) -> list[str]:
    """The input column behind each slot of an encoder's vector."""
    numeric = [n.split("__", 1)[1] for n in encoder.names if not n.startswith("cat__")]
    return numeric + [c for c, labels in encoder.labels.items() for _ in labels]


def tree_shapley(df: DataFrame, model, columns: list[str], key: str = "listing_id", features: str = "features") -> DataFrame:
    """(key, feature, contribution, base) of every row and feature.

    ``columns`` names the feature behind each slot of the vector; slots of one name (as one-hot encoding makes
    them) are one player. Contributions of a row add up to its prediction minus ``base``, the expected
    prediction, which is the same for all rows. A feature that no split uses has 0. Rows are scored where they
    lie, in Arrow batches: no shuffle, no background sample, and the model's nodes travel with the task.
    """
    trees = read_trees(model)
    names = list(dict.fromkeys(columns))
    members = [names.index(c) for c in columns]
    used = set().union(*(used_slots(root) for _, root in trees))
    base = math.fsum(w * expected(root) for w, root in trees)

    of_tree = [np.array(sorted(used_slots(root)), dtype=np.int64) for _, root in trees]
    size = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares = Shares(trees, members, len(names))
        mine = {id(root): slots for (_, root), slots in zip(trees, of_tree)}
        for batch in batches:
            n = len(batch)
            rows, slots, v, present = _entries(batch.column(1))
            if len(present) < n:
                raise ValueError("a row to explain has no vector")

            def values(root: Node) -> dict[int, np.ndarray]:
                """The slots of one tree at a time; rows stay sparse."""
                place = np.full(size, -1)
                place[mine[id(root)]] = np.arange(len(mine[id(root)]))
                at = place[slots]
                hit = np.flatnonzero(at >= 0)
                out = np.zeros((len(mine[id(root)]), n))
                out[at[hit], rows[hit]] = v[hit]
                return dict(zip(mine[id(root)].tolist(), out))

            out = shares.of(values, n)
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * len(names))
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(out.T).ravel()))
            yield pa.record_batch([batch.column(0), lists], names=[key, "_shares"])

    if not used:
        values = F.array_repeat(F.lit(0.0), len(names))
        rows = df.select(key, values.alias("_shares"))
    else:
        vectors = df.select(key, F.unwrap_udt(F.col(features)).alias("_v"))
        rows = vectors.mapInArrow(run, vectors.select(key, F.array(F.lit(0.0)).alias("_shares")).schema)
    entries = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("_shares").alias("contribution"))
    return rows.select(key, F.inline(entries), F.lit(base).alias("base"))
