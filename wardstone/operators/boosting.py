"""Boosted trees of large tables, grown from histograms over small blocks of codes.

The trees are those of ``GBTClassifier``: the same cut points, row samples, column
samples, gains and leaf values, drawn from the same seeds, so a table's model does
not depend on which of the two grew it but for the last digits of sums. Spark's
learner keeps some hundreds of bytes a row and visits every column of every row at
each level. Here a part of the table is one block: columns are cut into bins once,
neighbouring columns are joined into a code of two bytes as long as few of their
combinations occur in the block, and a level counts codes instead of columns. A
level is one Spark job over the blocks; what comes to the driver is a sum per node,
column and bin, whose size is set by the depth, the columns and ``BINS``.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import count, takewhile

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstone.session import scratch_path

#: Bins of a column, and rows that its cut points are taken from; both as Spark's learner has them by default.
BINS = 32
SAMPLED = 10_000
#: Combinations of joined columns that a code may have.
CODES = 4096
#: Trees after which the blocks' state is made again from the dealt rows, so that no lineage grows with the trees.
TREES_PER_LINEAGE = 30

_U64 = (1 << 64) - 1
_UNIT = 2.0**-53


# ---- the random numbers of Spark's learner ----


def _murmur(data: bytes, seed: int) -> int:
    h = seed & 0xFFFFFFFF
    for at in range(0, len(data), 4):
        k = int.from_bytes(data[at : at + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        h ^= (k << 15 | k >> 17) * 0x1B873593 & 0xFFFFFFFF
        h = ((h << 13 | h >> 19) * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def _first_state(seed: int) -> int:
    data = (seed & _U64).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _step(s):
    """The next state of one generator, or of an array of them."""
    if isinstance(s, np.ndarray):
        s = s ^ s << np.uint64(21)
        s ^= s >> np.uint64(35)
        return s ^ s << np.uint64(4)
    s ^= s << 21 & _U64
    s ^= s >> 35
    return s ^ s << 4 & _U64


def _doubles_of(seed: int) -> Iterator[float]:
    s = _first_state(seed)
    while True:
        high = _step(s)
        s = _step(high)
        yield (((high & (1 << 26) - 1) << 27) + (s & (1 << 27) - 1)) * _UNIT


def _ahead(columns: np.ndarray, states: np.ndarray) -> np.ndarray:
    """States after as many steps as the matrix stands for: the sum of its columns where a state's bit is set."""
    out = np.zeros_like(states)
    for bit in range(64):
        out ^= np.where(states >> np.uint64(bit) & np.uint64(1), columns[bit], np.uint64(0))
    return out


@lru_cache(maxsize=64)
def _jumps(each: int, lanes: int) -> list[np.ndarray]:
    """The matrices of 1, 2, 4 and more lanes of so many doubles, by squaring."""
    matrix = np.uint64(1) << np.arange(64, dtype=np.uint64)
    power, steps = _step(matrix), 2 * each
    while steps:
        if steps & 1:
            matrix = _ahead(power, matrix)
        power, steps = _ahead(power, power), steps >> 1
    found = [matrix]
    while 1 << len(found) < lanes:
        found.append(_ahead(found[-1], found[-1]))
    return found


def doubles(seed: int, n: int) -> np.ndarray:
    """The first ``n`` doubles of a seed, drawn in lanes that start where the lane before ends."""
    lanes = 1 << max(1, (n.bit_length() + 1) // 2)
    each = -(-n // lanes)
    states = np.array([_first_state(seed)], dtype=np.uint64)
    for jump in _jumps(each, lanes):
        states = np.concatenate([states, _ahead(jump, states)])
    out = np.empty((each, lanes))
    for row in range(each):
        high = _step(states)
        states = _step(high)
        out[row] = (((high & np.uint64((1 << 26) - 1)) << np.uint64(27)) + (states & np.uint64((1 << 27) - 1))) * _UNIT
    return out.T.ravel()[:n]


def _longs(seed: int) -> Iterator[int]:
    """The whole numbers of ``java.util.Random``."""
    s, mask = (seed ^ 0x5DEECE66D) & (1 << 48) - 1, (1 << 48) - 1
    signed = lambda v: v - (1 << 32) if v >> 31 else v
    while True:
        high = (s * 0x5DEECE66D + 0xB) & mask
        s = (high * 0x5DEECE66D + 0xB) & mask
        value = (signed(high >> 16) << 32) + signed(s >> 16) & _U64
        yield value - (1 << 64) if value >> 63 else value


def _columns_of_node(columns: int, wanted: int, seed: int) -> list[int]:
    """A node's sample of columns, in the order in which their gains are compared."""
    kept, draw = list(range(wanted)), _doubles_of(seed)
    for seen in range(wanted, columns):
        at = int(next(draw) * (seen + 1))
        if at < wanted:
            kept[at] = seen
    return kept


def _sample(part_seed: int, share: float) -> Iterator[int]:
    """Places of a part's sampled rows, without end."""
    draw, at = _doubles_of(part_seed), 0
    if share >= 1:
        yield from count()
    if share > 0.4:
        yield from (place for place in count() if next(draw) <= share)
    while True:
        at += int(np.log(max(next(draw), 5e-11)) / np.log1p(-share))
        yield at
        at += 1


# ---- cut points ----


def _cuts(values: np.ndarray, weights: np.ndarray, expected: float, most: int) -> np.ndarray:
    """Cut points of a column from its sampled values, of which there should be so many by weight."""
    here = values != 0
    if not here.any():
        return np.empty(0)
    distinct, at = np.unique(values[here], return_inverse=True)
    weight = np.bincount(at.ravel(), weights[here])
    missing = expected - weight.sum()
    if missing > np.finfo(float).eps * here.sum() * 100:
        zero = np.searchsorted(distinct, 0.0)
        distinct, weight = np.insert(distinct, zero, 0.0), np.insert(weight, zero, missing)
    between = (distinct[:-1] + distinct[1:]) / 2.0
    if len(between) <= most:
        return between
    stride, upto, found = expected / (most + 1), np.cumsum(weight), []
    target = stride
    for i, (before, now) in enumerate(zip(upto[:-1].tolist(), upto[1:].tolist())):
        if abs(before - target) < abs(now - target):
            found.append(i)
            target += stride
    return between[found]


def _arrays(rows: DataFrame, features: str, label: str) -> DataFrame:
    weight = F.col("weight").cast("double") if "weight" in rows.columns else F.lit(1.0)
    return rows.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), weight.alias("w"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _places(by_part: dict[int, int], share: float, seed: int) -> list[tuple[int]]:
    """The sampled rows' numbers, as ``monotonically_increasing_id`` counts them."""
    drawn = _step(_first_state(seed)) & 0xFFFFFFFF
    seeds = _longs(drawn - (1 << 32) if drawn >> 31 else drawn)
    found = []
    for part in range(max(by_part) + 1):
        places = _sample(next(seeds), share)
        found += [((part << 33) + place,) for place in takewhile(lambda at, rows=by_part.get(part, 0): at < rows, places)]
    return found


def cut_points(arrays: DataFrame, seed: int) -> list[np.ndarray]:
    """Cut points of every column, from a sample of some ``SAMPLED`` rows of the dealt table."""
    parts = arrays.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"), F.sum("w").alias("w")).collect()
    by_part, weight = {r["part"]: r["n"] for r in parts}, sum(r["w"] for r in parts)
    rows = sum(by_part.values())
    share = min(1.0, SAMPLED / rows)
    taken = arrays.sparkSession.createDataFrame(_places(by_part, share, seed), "at long")
    numbered = arrays.withColumn("at", F.monotonically_increasing_id())
    sampled = numbered.join(F.broadcast(taken), "at", "left_semi").select("x", "w").toArrow()  # some SAMPLED rows
    x = sampled.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(sampled.num_rows, -1)
    w = sampled.column("w").to_numpy()
    return [_cuts(x[:, f], w, share * weight, min(BINS, rows) - 1) for f in range(x.shape[1])]


# ---- blocks ----


@dataclass
class Block:
    """A part of the table. ``codes`` has a row per group of joined columns; ``bins`` gives a group's columns their bin by code."""

    part: int
    codes: np.ndarray
    bins: list[np.ndarray]
    sign: np.ndarray
    weight: np.ndarray | None
    margin: np.ndarray | None = None
    target: np.ndarray | None = None
    sampled: np.ndarray | None = None


def joined(binned: np.ndarray, counts: list[int], most: int = CODES) -> tuple[np.ndarray, list[np.ndarray]]:
    """Codes of a block's columns, neighbours joined while at most so many of their combinations occur.

    Takes bins as a row per column, and gives a row of codes per group and, per
    group, the bin of each of its columns by code.
    """
    n = binned.shape[1]
    codes, bins = [], []
    code, table = np.zeros(n, dtype=np.int64), np.zeros((0, 1), dtype=np.uint8)
    for column, many in zip(binned, counts):
        both = code * many + column
        there = np.bincount(both, minlength=table.shape[1] * many) > 0
        if there.sum() > most and len(table):
            codes.append(code.astype(np.uint16))
            bins.append(table)
            both, table = column.astype(np.int64), np.zeros((0, 1), dtype=np.uint8)
            there = np.bincount(both, minlength=many) > 0
        shown = np.flatnonzero(there)
        code = (np.cumsum(there) - 1)[both]
        table = np.vstack([table[:, shown // many], (shown % many).astype(np.uint8)])
    codes.append(code.astype(np.uint16))
    bins.append(table)
    return np.stack(codes), bins


def _blocks(arrays: DataFrame, cuts: list[np.ndarray], weighted: bool) -> RDD:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        binned, y, w = [], [], []
        for batch in batches:
            x = _matrix(batch) if batch.num_rows else np.empty((0, len(cuts)))
            binned.append(np.stack([np.searchsorted(c, x[:, f]).astype(np.uint8) for f, c in enumerate(cuts)]))
            y.append(batch.column(1).to_numpy())
            w.append(batch.column(2).to_numpy())
        if not binned:
            return
        codes, bins = joined(np.concatenate(binned, axis=1), [len(c) + 1 for c in cuts])
        sign = (np.concatenate(y) * 2 - 1).astype(np.int8)
        block = Block(TaskContext.get().partitionId(), codes, bins, sign, np.concatenate(w) if weighted else None)
        yield pa.RecordBatch.from_pydict({"block": [pickle.dumps(block)]}, schema=pa.schema([("block", pa.binary())]))

    return arrays.mapInArrow(build, "block binary").rdd.map(lambda row: pickle.loads(row[0]))


# ---- trees ----


@dataclass
class Grown:
    """A tree while it grows, as lists by node: the column and the last bin that go left, the children, and sums over the node's rows."""

    column: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    sums: list[np.ndarray] = field(default_factory=list)
    impurity: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, sums: np.ndarray, impurity: float) -> int:
        for values, value in ((self.column, -1), (self.cut, -1), (self.left, -1), (self.right, -1), (self.sums, sums), (self.impurity, impurity), (self.gain, -1.0)):
            values.append(value)
        return len(self.column) - 1

    def value(self, node: int) -> float:
        weight, total = self.sums[node][:2].tolist()
        return total / weight if weight else 0.0


def nodes_of(block: Block, tree: Grown) -> np.ndarray:
    """The node that each row of a block has come to."""
    n = block.codes.shape[1]
    node = np.zeros(n, dtype=np.int64)
    if tree.column[0] < 0:
        return node
    places = {}
    for group, table in enumerate(block.bins):
        for row in table:
            places[len(places)] = (group, row)
    groups, starts, goto = [], [], []
    for at, column in enumerate(tree.column):
        group, row = places[max(column, 0)]
        groups.append(group * n)
        starts.append(sum(map(len, goto)))
        goto.append(np.where(row <= tree.cut[at], tree.left[at], tree.right[at]) if column >= 0 else np.full(len(row), at))
    groups, starts, goto = np.array(groups), np.array(starts), np.concatenate(goto)
    codes, rows = block.codes.ravel(), np.arange(n)
    for _ in range(_depth(tree)):
        node = goto[starts[node] + codes[groups[node] + rows]]
    return node


def _depth(tree: Grown, node: int = 0) -> int:
    return 0 if tree.column[node] < 0 else 1 + max(_depth(tree, tree.left[node]), _depth(tree, tree.right[node]))


def advance(block: Block, trees: list[tuple[Grown, float]], seed: int, share: float) -> Block:
    """The block with its margins after further trees, and the targets and the row sample of the next one."""
    margin = np.zeros(len(block.sign)) if block.margin is None else block.margin
    for tree, rate in trees:
        margin = margin + rate * np.array([tree.value(i) for i in range(len(tree.column))])[nodes_of(block, tree)]
    begun, sign = block.margin is not None or bool(trees), block.sign.astype(np.float64)
    target = 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin)) if begun else sign
    sampled = doubles(seed + block.part + 1, len(margin)) < share
    return Block(block.part, block.codes, block.bins, block.sign, block.weight, margin, target, sampled)


def sums_by_bin(block: Block, tree: Grown, nodes: list[int], counts: list[int]) -> np.ndarray:
    """Sums of weight, target, its square, and rows where they have weights, per column's bin and node, over a block's sampled rows."""
    many = len(nodes)
    place = np.full(len(tree.column), many)
    place[nodes] = np.arange(many)
    at = np.where(block.sampled, place[nodes_of(block, tree)], many)
    keep = np.flatnonzero(at < many)
    at, target = at[keep], block.target[keep]
    weight = None if block.weight is None else block.weight[keep]
    added = [None, target, target * target] if weight is None else [weight, weight * target, weight * target * target, None]
    starts = np.concatenate([[0], np.cumsum(counts)])
    out, column = np.zeros((starts[-1], len(added), many)), 0
    for codes, table in zip(block.codes, block.bins):
        size, both = table.shape[1], np.empty((table.shape[1], len(added), many))
        index = codes[keep] * np.int64(many) + at
        for i, each in enumerate(added):
            both[:, i] = np.bincount(index, each, size * many).reshape(size, many)
        for bins in table:
            order = np.argsort(bins, kind="stable")
            shown, first = np.unique(bins[order], return_index=True)
            out[starts[column] + shown] = np.add.reduceat(both[order], first, axis=0)
            column += 1
    return out


def _impurity(sums: np.ndarray) -> np.ndarray:
    """Variance of the target, from sums of weight, target and square along the first axis."""
    weight, total, square = sums[0], sums[1], sums[2]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(weight == 0, 0.0, (square - total * total / weight) / weight)


@dataclass
class Split:
    """The best split of a node, and the node's own sums and impurity. ``column`` is -1 where no split is valid."""

    own: np.ndarray
    impurity: float
    column: int = -1
    cut: int = -1
    gain: float = -np.inf
    sides: tuple[np.ndarray, ...] = ()


def best_splits(sums: np.ndarray, counts: list[int], chosen: list[list[int]], impurities: list[float], min_rows: int) -> list[Split]:
    """The best split of each node from its sums by column and bin. The first of equal gains wins, columns in the order chosen.

    A node whose impurity is not known, NaN, gets it from its sums.
    """
    width, (_, kinds, many) = max(counts), sums.shape
    padded = np.zeros((len(counts), width, kinds, many))
    padded[np.arange(width) < np.array(counts)[:, None]] = sums
    upto = np.moveaxis(np.cumsum(padded, axis=1), (0, 1, 2, 3), (2, 3, 0, 1))  # by sum, node, column, bin
    left, right = upto[..., :-1], upto[..., -1:] - upto[..., :-1]
    whole, rows = left + right, 0 if kinds == 3 else 3
    first = [next((c for c in columns if counts[c] > 1), columns[0]) for columns in chosen]
    own = whole[:, np.arange(many), first, 0] if width > 1 else upto[:, np.arange(many), first, 0]
    known = np.array(impurities)
    known = np.where(np.isnan(known), _impurity(own), known)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = known[:, None, None] - left[0] / whole[0] * _impurity(left) - right[0] / whole[0] * _impurity(right)
        valid = (left[rows] >= min_rows) & (right[rows] >= min_rows) & (gain >= 0) & (np.arange(width - 1) < np.array(counts)[:, None] - 1)
    gain, found = np.where(valid, gain, -np.inf), []
    for k, columns in enumerate(chosen):
        found.append(Split(own[:, k], float(known[k])))
        if not valid[k, columns].any():
            continue
        column = columns[int(np.argmax(gain[k, columns].max(axis=1)))]
        cut = int(np.argmax(gain[k, column]))
        sides = tuple(side[:, k, column, cut].copy() for side in (left, right))
        found[-1] = Split(own[:, k], float(known[k]), column, cut, float(gain[k, column, cut]), sides)
    return found


def grow(state: RDD, counts: list[int], depth: int, wanted: int, min_rows: int, seed: int) -> Grown:
    """One tree over the blocks' targets and sampled rows, a job per level.

    Of two children only the one of fewer rows is counted; the other has what its parent has besides.
    """
    tree, seeds = Grown(), _longs(seed)
    tree.add(np.zeros(0), float("nan"))
    open_nodes, counted, rest, above = [0], [0], {}, {}
    for _ in range(depth):
        chosen = [_columns_of_node(len(counts), wanted, next(seeds)) for _ in open_nodes]
        found = state.map(lambda block, nodes=counted: (block.part, sums_by_bin(block, tree, nodes, counts))).collect()
        by_block = [sums for _, sums in sorted(found, key=lambda pair: pair[0])]  # added up in one order, however they were dealt to tasks
        sums = sum(by_block[1:], by_block[0])
        held = {node: sums[..., k] for k, node in enumerate(counted)}
        held |= {node: above[parent] - held[other] for node, (parent, other) in rest.items()}
        splits = best_splits(np.stack([held[n] for n in open_nodes], axis=2), counts, chosen, [tree.impurity[n] for n in open_nodes], min_rows)
        opened, counted, rest, above = [], [], {}, held
        for node, split in zip(open_nodes, splits):
            if node == 0:
                tree.sums[0], tree.impurity[0] = split.own, split.impurity
            if split.column < 0:
                tree.impurity[node] = -1.0  # as Spark marks a node of which no split is valid
            elif split.gain > 0:
                tree.gain[node], tree.column[node], tree.cut[node] = split.gain, split.column, split.cut
                sides = tree.left[node], tree.right[node] = tuple(tree.add(s, float(_impurity(s))) for s in split.sides)
                both = [c for c in sides if abs(tree.impurity[c]) >= np.finfo(float).eps]
                opened += both
                both.sort(key=lambda c: tree.sums[c][0])
                counted += both[:1]
                rest |= {c: (node, both[0]) for c in both[1:]}
        open_nodes = opened[::-1]  # the last child is split first, as in the learner's stack
        if not open_nodes:
            break
    return _pruned(tree)


def _pruned(tree: Grown) -> Grown:
    """The tree without splits whose two sides are leaves of one value."""
    for node in reversed(range(len(tree.column))):
        if tree.column[node] >= 0:
            sides = tree.left[node], tree.right[node]
            if all(tree.column[c] < 0 for c in sides) and tree.value(sides[0]) == tree.value(sides[1]):
                tree.column[node] = tree.cut[node] = tree.left[node] = tree.right[node] = -1
                tree.gain[node] = -1.0
    return tree


# ---- the fitted model ----

_NODES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
    "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def _node_rows(number: int, tree: Grown, cuts: list[np.ndarray]) -> list[tuple]:
    rows: list[tuple] = []

    def visit(node: int) -> int:
        at = len(rows)
        rows.append(())
        sums, inner = tree.sums[node], tree.column[node] >= 0
        left, right = (visit(tree.left[node]), visit(tree.right[node])) if inner else (-1, -1)
        split = (tree.column[node], [float(cuts[tree.column[node]][tree.cut[node]])], -1) if inner else (-1, [], -1)
        stats = [float(v) for v in sums[:3]]
        rows[at] = (number, (at, tree.value(node), tree.impurity[node], stats, int(round(float(sums[-1 if len(sums) > 3 else 0]))), tree.gain[node], left, right, split))
        return at

    visit(0)
    return rows


#: Settings that a tree of an ensemble keeps.
_TREE_SETTINGS = {
    "cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB",
    "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed", "weightCol",
}


def _about(kind: str, uid: str, spark: SparkSession, learner: GBTClassifier, names: set[str] | None = None, **more) -> str:
    settings = {p.name: (v, learner.isSet(p)) for p, v in learner.extractParamMap().items() if names is None or p.name in names}
    given, default = ({n: v for n, (v, by_caller) in settings.items() if by_caller == which} for which in (True, False))
    about = {"class": f"org.apache.spark.ml.{kind}", "timestamp": 0, "sparkVersion": spark.version, "uid": uid}
    return json.dumps({**about, "paramMap": given, "defaultParamMap": default, **more})


def as_model(spark: SparkSession, learner: GBTClassifier, trees: list[Grown], rates: list[float], cuts: list[np.ndarray]) -> GBTClassificationModel:
    """The trees as Spark's own model: written in its format to the shared folder and loaded from there."""
    path = scratch_path(spark, "boosted")
    about = _about("classification.GBTClassificationModel", learner.uid, spark, learner, numFeatures=len(cuts), numTrees=len(trees))
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    kind = "regression.DecisionTreeRegressionModel"
    heads = [(i, _about(kind, f"{learner.uid}_{i}", spark, learner, _TREE_SETTINGS), rate) for i, rate in enumerate(rates)]
    spark.createDataFrame(heads, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [row for i, tree in enumerate(trees) for row in _node_rows(i, tree, cuts)]
    spark.createDataFrame(nodes, _NODES).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


def fit(rows: DataFrame, learner: GBTClassifier) -> GBTClassificationModel:
    """Fits the learner's settings to dealt rows of numeric features, which it lets go of storage once they are blocks."""
    spark, seed, share = rows.sparkSession, learner.getSeed(), learner.getSubsamplingRate()
    arrays = _arrays(rows, learner.getFeaturesCol(), learner.getLabelCol())
    cuts = cut_points(arrays, seed)
    counts = [len(c) + 1 for c in cuts]
    wanted = int(np.ceil(float(learner.getFeatureSubsetStrategy()) * len(cuts)))
    base = _blocks(arrays, cuts, "weight" in rows.columns).persist(StorageLevel.MEMORY_AND_DISK)
    state, trees, rates = None, [], []
    try:
        tasks = min(base.count(), spark.sparkContext.defaultParallelism)  # a task takes several blocks where cores are fewer
        rows.unpersist()
        for m in range(learner.getMaxIter()):
            source, new = (base, list(zip(trees, rates))) if m % TREES_PER_LINEAGE == 0 else (state, [(trees[-1], rates[-1])])
            before = state
            state = source.map(lambda block, new=new, m=m: advance(block, new, seed + m, share)).persist(StorageLevel.MEMORY_AND_DISK)
            trees.append(grow(state.coalesce(tasks), counts, learner.getMaxDepth(), wanted, learner.getMinInstancesPerNode(), seed + m))
            rates.append(learner.getStepSize() if m else 1.0)
            if before is not None:
                before.unpersist()
    finally:
        for held in (state, base):
            if held is not None:
                held.unpersist()
    return as_model(spark, learner, trees, rates, cuts)
