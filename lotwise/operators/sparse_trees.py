"""Tree learners for many rows of wide sparse vectors.

Spark's learners turn each row into an array of all slots and add up a share of them for every tree and level, so a
row of 25 entries among 1,400 slots costs 50 times its entries. The learners here have the same parameters, cuts,
gains and stopping rules and return Spark's own models, but a pass reads only a row's entries: what the rows without
an entry add is the node's total less the others. One pass over the rows grows a level of all trees; histograms are
added up inside the tasks, shuffled by node, and only a node's best split comes to the driver.

Up to ``DENSE_CELLS`` rows times slots, and with settings that are not covered, Spark's learner does the work.
"""

from __future__ import annotations

import copy
import json
import math
import threading
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.regression import (DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel, GBTRegressor,
                                   RandomForestRegressionModel, RandomForestRegressor)
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lotwise.operators.components import _entries
from lotwise.sources.scratch import materialize, new_path

#: Rows times slots beyond which the arrays of Spark's learner (4 bytes a cell) take more than 128 MB.
DENSE_CELLS = 2 ** 25
#: Rows of one written block.
BLOCK_ROWS = 32_768
#: Rows whose codes are counted at a time.
PIECE_ROWS = 1_024
#: Histogram cells (three sums each) that a task holds at a time.
MOST_CELLS = 8_000_000
_EPSILON = 2.220446049250313e-16
_BLOCKS = "rows int, lengths binary, codes binary, target binary, bags binary"
_SUMS = "tree int, node int, part int, total binary, codes binary, sums binary"
_SPLITS = "tree int, node int, slot int, bin int, gain double, total array<double>, left array<double>"
_NODE = ("id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, leftChild int, "
         "rightChild int, split struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>")


@dataclass
class Bins:
    """Cuts of each slot; slots without a cut have no bins. Entries carry a code, one for each bin but that of zero."""

    cuts: list[np.ndarray]
    slots: np.ndarray = field(init=False)  # slots with cuts
    start: np.ndarray = field(init=False)  # first bin of each of these
    bin_slot: np.ndarray = field(init=False)  # slot, and place in the slot, of each bin
    bin_place: np.ndarray = field(init=False)
    zero: np.ndarray = field(init=False)  # per slot: place of the value 0
    coded: np.ndarray = field(init=False)  # bin of each code
    code: np.ndarray = field(init=False)  # code of each bin, -1 for that of zero
    first: np.ndarray = field(init=False)  # per slot: its first bin, -1 without cuts
    counts: np.ndarray = field(init=False)  # per slot: its cuts
    only: np.ndarray = field(init=False)  # per slot: its cut, if it has one

    def __post_init__(self) -> None:
        self.counts = np.array([len(c) for c in self.cuts], dtype=np.int64)
        self.only = np.array([c[0] if len(c) == 1 else np.nan for c in self.cuts])
        counts = np.array([len(c) + 1 if len(c) else 0 for c in self.cuts], dtype=np.int64)
        self.slots = np.flatnonzero(counts)
        ends = np.cumsum(counts)
        self.first = np.where(counts > 0, ends - counts, -1)
        self.start = self.first[self.slots]
        self.bin_slot = np.repeat(np.arange(len(counts)), counts)
        self.bin_place = np.arange(counts.sum()) - (ends - counts)[self.bin_slot]
        self.zero = np.array([np.searchsorted(c, 0.0) for c in self.cuts], dtype=np.int64)
        self.coded = np.flatnonzero(self.bin_place != self.zero[self.bin_slot])
        self.code = np.full(len(self.bin_slot), -1)
        self.code[self.coded] = np.arange(len(self.coded))

    def codes(self, slots: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Code of each entry, -1 for entries that fall where zero does and for slots without cuts."""
        out = np.full(len(slots), -1)
        # most slots are words with one cut, which need no search; NaN lies above all cuts
        one = np.flatnonzero(self.counts[slots] == 1)
        at = slots[one]
        out[one] = self.code[self.first[at] + ~(values[one] <= self.only[at])]
        many = np.flatnonzero(self.counts[slots] > 1)
        narrow = slots[many].astype(np.uint16 if len(self.cuts) <= 65_536 else np.int64)  # sorted by digits, which is faster
        order = many[np.argsort(narrow, kind="stable")]
        edges = np.flatnonzero(np.diff(slots[order], prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:]):
            at = order[a:b]
            slot = slots[at[0]]
            out[at] = self.code[self.first[slot] + np.searchsorted(self.cuts[slot], values[at])]
        return out


def cuts_of(values: np.ndarray, zeros: int, most: int) -> np.ndarray:
    """Cuts between the sampled values of a slot: between all of them, or between those next to even ranks."""
    seen, counts = np.unique(values[~np.isnan(values)], return_counts=True)
    if zeros:
        at = int(np.searchsorted(seen, 0.0))
        seen, counts = np.insert(seen, at, 0.0), np.insert(counts, at, zeros)
    middle = (seen[:-1] + seen[1:]) / 2
    if len(middle) < most:
        return middle
    step = (len(values) + zeros) / most
    out, goal, below = [], step, np.cumsum(counts)
    for i in range(1, len(seen)):
        if abs(below[i - 1] - goal) < abs(below[i] - goal):
            out.append(middle[i - 1])
            goal += step
    return np.array(out)


def find_bins(rows: DataFrame, size: int, count: int, most: int, seed: int) -> Bins:
    """Cuts from 10,000 rows, as Spark's learners do (more if there are over 100 bins); all rows if there are no more."""
    wanted = max(most * most, 10_000)
    some = rows.select("v") if count <= wanted else rows.select("v", F.rand(seed).alias("r")).orderBy("r").limit(wanted).select("v")
    table = some.toArrow()
    column = table.column("v").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    _, slots, v, _ = _entries(column)
    slots, v = slots[v != 0], v[v != 0]
    order = np.argsort(slots, kind="stable")
    parts = np.split(v[order], np.searchsorted(slots[order], np.arange(1, size)))
    return Bins([cuts_of(p, len(column) - len(p), min(most, count)) for p in parts])


def _code_type(bins: Bins) -> type:
    return np.uint16 if len(bins.coded) < 2 ** 16 else np.int32


class _Block:
    """Codes of a block's rows: side by side in a matrix, or one after the other where their lengths differ much."""

    def __init__(self, n: int, lengths: np.ndarray, codes: np.ndarray) -> None:
        self.ragged, self.lengths = len(lengths) > 0, lengths
        self.codes = codes.astype(np.intp) if self.ragged else codes.astype(np.intp).reshape(n, -1)
        self.start = np.cumsum(lengths) - lengths

    def sums(self, rows: np.ndarray, first: np.ndarray, weights: tuple[np.ndarray, ...], size: int) -> np.ndarray:
        """Sums of each weight by ``first`` plus code. Few rows at a time, so that what is made of them stays in the cache."""
        out = np.zeros((len(weights), size))
        spread = None if self.ragged else np.empty((PIECE_ROWS, self.codes.shape[1]))
        for a in range(0, len(rows), PIECE_ROWS):
            some = rows[a:a + PIECE_ROWS]
            key, each = self.of(some)
            key += np.repeat(first[a:a + PIECE_ROWS], each)
            for own, weight in zip(out, weights):
                if spread is None:
                    values = np.repeat(weight[some], each)
                else:
                    spread[:len(some)] = weight[some][:, None]
                    values = spread[:len(some)].ravel()
                np.add.at(own, key, values)
        return out

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray | int]:
        """The codes of the rows, and how many each has."""
        if not self.ragged:
            return self.codes[rows].ravel(), self.codes.shape[1]
        lengths = self.lengths[rows]
        at = np.repeat(self.start[rows] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        return self.codes[at], lengths


def write_blocks(rows: DataFrame, bins: Bins, trees: int, bagged: bool, seed: int) -> DataFrame:
    """The rows' codes, targets and bag counts, written once in blocks; the counts are drawn by task and block.

    Blocks are dealt evenly to as many files as there are cores: a level's pass lasts as long as its longest task.
    """
    cores, step = rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()
    while math.gcd(step, cores) > 1:  # so that the blocks of one task reach all files
        step += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held, made = [], 0, 0

        def block() -> pa.RecordBatch:
            lengths, codes, target = (np.concatenate(p) for p in zip(*kept))
            n, width = len(target), int(lengths.max())
            if n * width <= 2 * len(codes) + n:  # rows of about one length: filled up with a code that counts nowhere
                filled = np.full((n, width), len(bins.coded))
                filled[np.arange(width) < lengths[:, None]] = codes
                lengths, codes = lengths[:0], filled
            bags = b""
            if bagged:
                draw = np.random.default_rng([abs(seed), TaskContext.get().partitionId(), made])
                bags = draw.poisson(1.0, (trees, n)).astype(np.uint8).tobytes()
            values = [lengths.astype(np.int32).tobytes(), codes.astype(_code_type(bins)).tobytes(), target.tobytes(), bags]
            file = (TaskContext.get().partitionId() + made * step) % cores
            return pa.record_batch([pa.array([n], pa.int32()), *[pa.array([b], pa.binary()) for b in values], pa.array([file], pa.int32())],
                                   names=["rows", "lengths", "codes", "target", "bags", "file"])

        for batch in batches:
            if batch.column(0).null_count or batch.column(1).null_count or np.isnan(np.asarray(batch.column(1))).any():
                raise ValueError("a training row has no vector or no target")
            at, slots, v, _ = _entries(batch.column(0))
            codes = bins.codes(slots, v)
            at, codes = at[codes >= 0], codes[codes >= 0]
            kept.append((np.bincount(at, minlength=len(batch)), codes, np.asarray(batch.column(1), dtype=float)))
            held += len(batch)
            if held >= BLOCK_ROWS:
                yield block()
                kept, held, made = [], 0, made + 1
        if kept:
            yield block()

    blocks = rows.select("v", "y").mapInArrow(run, f"{_BLOCKS}, file int")
    return materialize(blocks.repartitionById(cores, "file").drop("file"), "tree-blocks")


@dataclass
class Tree:
    """Nodes by number: slot (-1: leaf), last place that goes left, children, sums of weight, target and its square."""

    slot: list[int] = field(default_factory=list)
    place: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    total: list[tuple[float, ...]] = field(default_factory=list)
    depth: int = 0

    def add(self, total: tuple[float, ...] = (0.0, 0.0, 0.0)) -> int:
        for name, value in (("slot", -1), ("place", 0), ("left", -1), ("right", -1), ("gain", -1.0), ("total", total)):
            getattr(self, name).append(value)
        return len(self.slot) - 1

    def value(self, node: int) -> float:
        return self.total[node][1] / self.total[node][0]


class _Walk:
    """Rows of a block by the places of the slots that the trees split on."""

    def __init__(self, trees: list[tuple], bins: Bins, n: int, block: _Block) -> None:
        used = np.unique(np.concatenate([t[0] for t in trees] + [np.zeros(0, int)]))
        used = used[used >= 0]
        self.column = np.full(len(bins.counts), -1)
        self.column[used] = np.arange(len(used))
        self.rows = np.arange(n)
        self.places = np.repeat(bins.zero[used].astype(np.uint16)[:, None], n, axis=1)
        if len(used):
            codes, lengths = block.of(self.rows)
            hit = np.append(self.column[bins.bin_slot[bins.coded]], -1)[codes]
            inside = np.flatnonzero(hit >= 0)
            self.places[hit[inside], np.repeat(self.rows, lengths)[inside]] = bins.bin_place[bins.coded][codes[inside]]

    def leaves(self, tree: tuple, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The nodes that the rows end in, with their rows in order."""
        slot, place, left, right = tree[:4]
        todo = [(0, rows)]
        while todo:
            node, at = todo.pop()
            if slot[node] < 0:
                yield node, at
            elif len(at):
                goes_left = self.places[self.column[slot[node]]].take(at) <= place[node]
                todo += [(right[node], at[~goes_left]), (left[node], at[goes_left])]

    def values(self, tree: tuple) -> np.ndarray:
        out = np.empty(len(self.rows))
        for node, rows in self.leaves(tree, self.rows):
            out[rows] = tree[5][node]
        return out


def _sent(tree: Tree) -> tuple:
    values = [t[1] / t[0] if t[0] else 0.0 for t in tree.total]
    return *(np.array(x, dtype=np.int64) for x in (tree.slot, tree.place, tree.left, tree.right)), tree.depth, np.array(values)


def _variance(w, s, q):
    return (q - s * s / w) / w


def best_split(total: np.ndarray, sums: np.ndarray, allowed: np.ndarray, bins: Bins, least: int, least_gain: float) -> tuple[int, int, float, np.ndarray]:
    """(slot, last place that goes left, gain, sums on the left) of the best split, the first of equals; slot -1: none."""
    hist = np.zeros((3, len(bins.bin_slot)))
    hist[:, bins.coded] = sums
    hist[:, bins.start + bins.zero[bins.slots]] = total[:, None] - np.add.reduceat(hist, bins.start, axis=1)
    ends = np.append(bins.start[1:], len(bins.bin_slot))
    for i in np.flatnonzero(ends - bins.start > 2):
        a, b = bins.start[i], ends[i]
        hist[:, a:b] = np.cumsum(hist[:, a:b], axis=1)
    rest = total[:, None] - hist
    ok = allowed[bins.bin_slot] & (hist[0] >= least) & (rest[0] >= least)
    ok[ends - 1] = False
    if not ok.any():
        return -1, 0, -1.0, np.zeros(3)
    at = np.flatnonzero(ok)
    l, r, w = hist[:, at], rest[:, at], total[0]
    gains = _variance(*total) - l[0] / w * _variance(*l) - r[0] / w * _variance(*r)
    k = int(np.argmax(gains))
    if gains[k] <= 0 or gains[k] < least_gain:
        return -1, 0, -1.0, np.zeros(3)
    b = at[k]
    return int(bins.bin_slot[b]), int(bins.bin_place[b]), float(gains[k]), hist[:, b]


def _grow(blocks: DataFrame, bins: Bins, size: int, trees: int, depth: int, subset: int, least: int, least_gain: float, seed: int,
          before: list[tuple[float, tuple]] = ()) -> list[Tree]:
    """Trees grown level by level. ``before`` are weighted trees whose error the targets are (twice what is left)."""
    bins = copy.copy(bins)
    bins.cuts = []  # thousands of small arrays that no level needs; each task would read them
    grown = [Tree() for _ in range(trees)]
    open_nodes = [(t, grown[t].add()) for t in range(trees)]
    width = max(1, MOST_CELLS // max(1, len(bins.coded)))
    for level in range(depth):
        splits = []
        for a in range(0, len(open_nodes), width):
            splits += _level(blocks, bins, size, [_sent(t) for t in grown], open_nodes[a:a + width], subset, least, least_gain, seed, before)
        found = {(r["tree"], r["node"]): r for r in splits}
        following = []
        for t, node in open_nodes:
            tree, r = grown[t], found.get((t, node))
            if r is None:  # no row was drawn
                continue
            tree.total[node] = total = tuple(r["total"])
            if r["slot"] < 0:
                continue
            low = tuple(r["left"])
            high = tuple(x - y for x, y in zip(total, low))
            tree.slot[node], tree.place[node], tree.gain[node], tree.depth = r["slot"], r["bin"], r["gain"], level + 1
            tree.left[node], tree.right[node] = tree.add(low), tree.add(high)
            for child, sums in ((tree.left[node], low), (tree.right[node], high)):
                if level + 1 < depth and abs(_variance(*sums)) >= _EPSILON:
                    following.append((t, child))
        open_nodes = following
        if not open_nodes:
            break
    return grown


def _level(blocks: DataFrame, bins: Bins, size: int, trees: list[tuple], nodes: list[tuple[int, int]], subset: int, least: int,
           least_gain: float, seed: int, before: list[tuple[float, tuple]]) -> list:
    """One row for each open node: its sums and its best split."""
    by_tree: dict[int, list[int]] = {}
    for t, node in nodes:
        by_tree.setdefault(t, []).append(node)
    n_codes = len(bins.coded)
    code_slot = bins.bin_slot[bins.coded]

    # the slots that a node may split on
    drawn = np.ones((len(nodes), size), dtype=bool)
    if subset < size:
        drawn[:] = False
        for row, (t, node) in zip(drawn, nodes):
            row[np.random.default_rng([abs(seed), 1, t, node]).choice(size, subset, replace=False)] = True
    packed, at_node = np.packbits(drawn, axis=1), {key: i for i, key in enumerate(nodes)}

    def allowed(keys: list[tuple[int, int]]) -> np.ndarray:
        return np.unpackbits(packed[[at_node[k] for k in keys]], axis=1, count=size).astype(bool)

    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        wide = n_codes + 1  # the last one is that of filled up rows
        for batch in batches:
            for i in range(len(batch)):
                n = batch.column(0)[i].as_py()
                lengths, codes, y, bags = (np.frombuffer(batch.column(k)[i].as_buffer(), d)
                                           for k, d in ((1, np.int32), (2, _code_type(bins)), (3, np.float64), (4, np.uint8)))
                block = _Block(n, lengths, codes)
                walk = _Walk([*[b for _, b in before], *trees], bins, n, block)
                if before:
                    y = 2 * (y - sum(w * walk.values(b) for w, b in before))
                for t, at in by_tree.items():
                    place = {node: k for k, node in enumerate(at)}
                    w = bags[t * n:(t + 1) * n].astype(float) if len(bags) else np.ones(n)
                    if t not in sums:
                        sums[t] = np.zeros((3, len(at))), np.zeros((3, len(at), wide))
                    # rows node by node, so that a node's sums lie close
                    found = [(place[node], rows) for node, rows in walk.leaves(trees[t], np.flatnonzero(w)) if node in place and len(rows)]
                    if not found:
                        continue
                    rows = np.concatenate([r for _, r in found])
                    node = np.repeat([k for k, _ in found], [len(r) for _, r in found])
                    weights = w, w * y, w * y * y
                    total, cells = sums[t]
                    total += [np.bincount(node, own[rows], len(at)) for own in weights]
                    cells += block.sums(rows, node * wide, weights, len(at) * wide).reshape(cells.shape)
        part = TaskContext.get().partitionId()
        for t, (total, cells) in sums.items():
            out, chosen = [], allowed([(t, n) for n in by_tree[t]])[:, code_slot]
            for k, n in enumerate(by_tree[t]):
                if total[0, k]:
                    codes = np.flatnonzero((cells[0, k, :-1] != 0) & chosen[k])
                    out.append((t, n, part, total[:, k].tobytes(), codes.astype(np.int32).tobytes(), cells[:, k, codes].tobytes()))
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), [pa.int32()] * 3 + [pa.binary()] * 3)],
                                      names=["tree", "node", "part", "total", "codes", "sums"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, cells = None, np.zeros(3), np.zeros((3, n_codes))

        def done() -> pa.RecordBatch:
            slot, place, gain, left = best_split(total, cells, allowed([now])[0], bins, least, least_gain)
            values = [*now, slot, place, gain, total.tolist(), left.tolist()]
            kinds = [pa.int32()] * 4 + [pa.float64()] + [pa.list_(pa.float64())] * 2
            return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)],
                                   names=["tree", "node", "slot", "bin", "gain", "total", "left"])

        for batch in batches:
            for i in range(len(batch)):
                key = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                if now is not None and key != now:
                    yield done()
                    total, cells = np.zeros(3), np.zeros((3, n_codes))
                now = key
                codes = np.frombuffer(batch.column(4)[i].as_buffer(), np.int32)
                total += np.frombuffer(batch.column(3)[i].as_buffer())
                cells[:, codes] += np.frombuffer(batch.column(5)[i].as_buffer()).reshape(3, -1)
        if now is not None:
            yield done()

    # few tasks, so that the histograms that are shuffled don't grow with the rows
    tasks = max(1, blocks.sparkSession.sparkContext.defaultParallelism)
    sums = blocks.coalesce(tasks).mapInArrow(histograms, _SUMS)
    ordered = sums.repartition(min(tasks, len(nodes)), "tree", "node").sortWithinPartitions("tree", "node", "part")
    return ordered.mapInArrow(choose, _SPLITS).collect()


def _node_rows(tree: Tree, bins: Bins) -> list[tuple]:
    """The nodes from the root on, left before right, as Spark saves them; leaves side by side of one value are one."""
    rows: list = []

    def add(node: int) -> int:
        at = len(rows)
        rows.append(None)
        total = tree.total[node]
        stats = (tree.value(node), float(_variance(*total)), list(total), int(round(total[0])))
        if tree.slot[node] >= 0:
            left = add(tree.left[node])
            right = add(tree.right[node])
            if rows[left][6] >= 0 or rows[right][6] >= 0 or rows[left][1] != rows[right][1]:
                cut = float(bins.cuts[tree.slot[node]][tree.place[node]])
                rows[at] = (at, *stats, tree.gain[node], left, right, (tree.slot[node], [cut], -1))
                return at
            del rows[at + 1:]
        rows[at] = (at, *stats, -1.0, -1, -1, (-1, [], -1))
        return at

    add(0)
    return rows


def _saved(estimator, spark, kind, trees: list[Tree], weights: list[float], bins: Bins, size: int):
    """Spark's model of the trees, read from a folder in the format that Spark's models are saved in."""
    path = new_path(spark, "tree-model")
    plain = lambda params: {p.name: v for p, v in params.items()}
    own, default = plain(estimator._paramMap), plain(estimator._defaultParamMap)

    def metadata(cls: str, uid: str, own: dict, default: dict, **more) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.regression.{cls}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
                           "uid": uid, "paramMap": own, "defaultParamMap": default, **more})

    def write(text: str) -> None:
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/metadata")

    if kind is DecisionTreeRegressionModel:
        write(metadata(kind.__name__, estimator.uid, own, default, numFeatures=size))
        spark.createDataFrame(_node_rows(trees[0], bins), _NODE).coalesce(1).write.parquet(f"{path}/data")
        return kind.load(path)
    write(metadata(kind.__name__, estimator.uid, own, default, numFeatures=size, numTrees=len(trees)))
    rows = [(t, row) for t, tree in enumerate(trees) for row in _node_rows(tree, bins)]
    nested = StructType([StructField("treeID", IntegerType()), StructField("nodeData", StructType.fromDDL(_NODE))])
    spark.createDataFrame(rows, nested).coalesce(1).write.parquet(f"{path}/data")
    single = DecisionTreeRegressor()
    of_tree = [(t, metadata("DecisionTreeRegressionModel", f"{estimator.uid}_{t}", {}, plain(single._defaultParamMap)), float(w))
               for t, w in enumerate(weights)]
    spark.createDataFrame(of_tree, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    return kind.load(path)


class _Rows:
    """What the fits on the same rows have in common. It is made by the first that asks, the others wait for it."""

    def __init__(self, trees: int) -> None:
        self.trees, self.lock, self.made = trees, threading.Lock(), {}

    def once(self, key: tuple, make: Callable[[], object]):
        with self.lock:
            lock, made = self.made.setdefault(key, (threading.Lock(), []))
        with lock:
            if not made:
                made.append(make())
            return made[0]


_shared: WeakKeyDictionary[DataFrame, _Rows] = WeakKeyDictionary()


def share_rows(dataset: DataFrame, estimators: list) -> None:
    """Fits of these estimators on this very frame will write its blocks once, with the bags of the largest forest."""
    _shared[dataset] = _Rows(max([e.getNumTrees() for e in estimators if isinstance(e, SparseForest)], default=0))


def _fit(estimator, kind, dataset: DataFrame, plain: Callable[[DataFrame], object]):
    value = lambda name: estimator.getOrDefault(name)
    covered = value("minWeightFractionPerNode") == 0.0 and not estimator.isSet("weightCol") and not value("leafCol")
    subset = value("featureSubsetStrategy") if estimator.hasParam("featureSubsetStrategy") else "all"
    if kind is RandomForestRegressionModel:
        subset = "onethird" if subset == "auto" and value("numTrees") > 1 else subset
        covered = covered and value("bootstrap")
    elif kind is GBTRegressionModel:
        covered = covered and value("lossType") == "squared" and not estimator.isSet("validationIndicatorCol")
    subset = "all" if subset == "auto" else subset
    covered = covered and subset in ("all", "onethird") and (not estimator.hasParam("subsamplingRate") or value("subsamplingRate") == 1.0)
    features, label, seed, most = value("featuresCol"), value("labelCol"), value("seed"), value("maxBins")
    n_trees = value("numTrees") if kind is RandomForestRegressionModel else 1
    bagged = kind is RandomForestRegressionModel
    rows_of = _shared.get(dataset) or _Rows(n_trees if bagged else 0)

    def sizes() -> tuple[int, int]:
        first = dataset.select(features).first()
        size = 0 if first is None or first[0] is None else first[0].size
        return size, dataset.count() if size and covered else 0

    size, count = rows_of.once((features, "sizes"), sizes) if covered else (0, 0)
    if not size or count * size <= DENSE_CELLS:
        return plain(dataset)
    spark = dataset.sparkSession
    rows = dataset.select(F.unwrap_udt(F.col(features)).alias("v"), F.col(label).cast("double").alias("y"))

    def written() -> tuple[Bins, DataFrame | None]:
        bins = find_bins(rows, size, count, most, seed)
        return bins, write_blocks(rows, bins, rows_of.trees, rows_of.trees > 0, seed) if len(bins.slots) else None

    bins, blocks = rows_of.once((features, label, seed, most), written)
    if blocks is None:
        return plain(dataset)
    if not bagged:
        blocks = blocks.withColumn("bags", F.lit(b""))
    subset = math.ceil(size / 3) if subset == "onethird" else size
    grow = lambda seed, before=(): _grow(blocks, bins, size, n_trees, value("maxDepth"), subset, value("minInstancesPerNode"),
                                         value("minInfoGain"), seed, before)
    if kind is not GBTRegressionModel:
        trees = grow(seed)
        weights = [1.0] * n_trees
    else:
        trees, weights = [], []
        for m in range(value("maxIter")):
            trees += grow(seed + m, [(w, _sent(t)) for w, t in zip(weights, trees)])
            weights.append(value("stepSize") if m else 1.0)
    return estimator._copyValues(_saved(estimator, spark, kind, trees, weights, bins, size))


class _Sharing:
    def fitMultiple(self, dataset: DataFrame, paramMaps: list):
        share_rows(dataset, [self.copy(p) for p in paramMaps])
        return super().fitMultiple(dataset, paramMaps)


class SparseTree(_Sharing, DecisionTreeRegressor):
    def _fit(self, dataset: DataFrame):
        return _fit(self, DecisionTreeRegressionModel, dataset, super()._fit)


class SparseForest(_Sharing, RandomForestRegressor):
    """Rows are drawn by task and block, slots by tree and node; Spark's forest draws both otherwise."""

    def _fit(self, dataset: DataFrame):
        return _fit(self, RandomForestRegressionModel, dataset, super()._fit)


class SparseBoosting(_Sharing, GBTRegressor):
    def _fit(self, dataset: DataFrame):
        return _fit(self, GBTRegressionModel, dataset, super()._fit)
