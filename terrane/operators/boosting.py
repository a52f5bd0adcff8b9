"""Boosted regression trees over blocks of binned rows.

The trees are MLlib's: its sample and rule for the split points, its gains, leaves and pruning,
and its model. Rows stand in blocks of arrays, a byte a feature, the target and the guess of the
trees so far, where MLlib keeps some objects a row; each level of a tree is one pass that adds
them up by node and bin. Sums are rounded as MLlib rounds them, so that ties fall alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession

from terrane.functions.columns import column
from terrane.session import importable, settings

# Parameters these trees know; others are MLlib's.
KNOWN = {"maxIter", "maxDepth", "stepSize", "maxBins", "minInfoGain"}
# Bins fit in a byte, and a pass's sums (three doubles a node and bin) in what a task may send.
_MOST_BINS = 256
_MOST_SUMS = 1 << 16
# Rows of a block.
_BLOCK_ROWS = 1 << 16
# A task's start takes as long as a million rows, so no task of a pass has fewer; their number is a
# multiple of what most machines have of cores, but follows the rows alone.
_TASK_ROWS = 1 << 20, 1 << 22
_TASKS = 24
# MLlib's: rows that split points are taken from, if the bins squared are not more.
_SAMPLE = 10_000
_EPSILON = 2.0**-52
_BLOCKS = "bins binary, target binary, guess binary"
_LEVEL = StorageLevel.MEMORY_AND_DISK
# A block is as large as thousands of rows.
_FEW_BLOCKS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "16"}


@dataclass
class Node:
    """A node: rows, sum and squares of the target; a split if it is none of the leaves."""

    sums: np.ndarray
    valid: bool = True
    gain: float = 0.0
    feature: int = -1
    left_bins: np.ndarray | None = None
    left: Node | None = None
    right: Node | None = None

    @property
    def prediction(self) -> float:
        return float(self.sums[1] / self.sums[0]) if self.sums[0] else 0.0

    @property
    def impurity(self) -> float:
        return float(_variance(*self.sums))


def suited(trees: GBTRegressor, named: set[str], rows: int, arities: Mapping[int, int], features: int) -> bool:
    """Whether the trees can be fitted here: known parameters, bins and sums within bounds."""
    bins = trees.getMaxBins()
    return (
        named <= KNOWN
        and trees.getMaxDepth() >= 1
        and max(bins, *arities.values(), 0) <= min(_MOST_BINS, rows)
        and (bins * features << (trees.getMaxDepth() - 1)) <= _MOST_SUMS
    )


def fit(
    rows: DataFrame, trees: GBTRegressor, target: str, inputs: Sequence[str], arities: Mapping[int, int], count: int
) -> GBTRegressionModel:
    """The model of the trees on `count` rows; `arities` are the categories of features by place.

    Sums are added up in the order of partitions, so the same partitions give the same trees.
    """
    spark = rows.sparkSession
    numbers = rows.select(*[column(name).cast("double").alias(f"c{k}") for k, name in enumerate([target, *inputs])])
    points = _split_points(numbers, trees, arities, len(inputs), count)
    edges = [arities[k] if k in arities else points[k] for k in range(len(inputs))]
    widths = [edge if isinstance(edge, int) else len(edge) + 1 for edge in edges]
    weights = [1.0] + [trees.getStepSize()] * (trees.getMaxIter() - 1)
    importable(spark)
    # One or two at a time: blocks before a tree's predictions are added, and after.
    kept = [numbers.coalesce(_tasks(count)).mapInArrow(_to_blocks(edges), _BLOCKS).persist(_LEVEL)]
    roots: list[Node] = []
    try:
        kept[0].count()
        with settings(spark, _FEW_BLOCKS):
            for _ in weights:
                if roots:
                    added = _added(roots[-1], weights[len(roots) - 1], widths)
                    kept.append(kept[-1].mapInArrow(added, _BLOCKS).persist(_LEVEL))
                # The gradient of a squared residual is twice the residual.
                roots.append(_tree(kept, trees, widths, arities, 2.0 if roots else 1.0))
    finally:
        for blocks in kept:
            blocks.unpersist()
    return _model(spark, trees, roots, weights, points, arities, len(inputs))


def _tasks(count: int) -> int:
    least, most = _TASK_ROWS
    return max(1, min(_TASKS * -(-count // (_TASKS * most)), count // least))


def _split_points(
    numbers: DataFrame, trees: GBTRegressor, arities: Mapping[int, int], features: int, count: int
) -> dict[int, np.ndarray]:
    """MLlib's split points of each feature that is no category, from the sample it would draw."""
    continuous = [k for k in range(features) if k not in arities]
    spark, bins = numbers.sparkSession, trees.getMaxBins()
    needed = max(bins * bins, _SAMPLE)
    share = needed / count if needed < count else 1.0
    drawn = numbers.select(*[f"c{k + 1}" for k in continuous])
    if share < 1.0 and continuous:
        seed = spark._jvm.org.apache.spark.util.random.XORShiftRandom(trees.getSeed()).nextInt()
        sample = drawn._jdf.javaRDD().sample(False, share, seed)
        drawn = DataFrame(spark._jsparkSession.createDataFrame(sample, drawn._jdf.schema()), spark)
    sample = np.array([tuple(row) for row in drawn.collect()] if continuous else [], float)
    return {k: _points(sample[:, i], bins - 1, share * count) for i, k in enumerate(continuous)}


def _points(sample: np.ndarray, most: int, expected: float) -> np.ndarray:
    """Middles between values where parts of equal numbers end; zeros are what is left of the
    expected number, as for MLlib, which does not count them."""
    nonzero = sample[sample != 0]
    values, weights = np.unique(nonzero, return_counts=True)
    if not len(values):
        return np.empty(0)
    weights = weights.astype(float)
    zeros = expected - weights.sum()
    if zeros > _EPSILON * len(nonzero) * 100:
        place = int(np.searchsorted(values, 0.0))
        values, weights = np.insert(values, place, 0.0), np.insert(weights, place, zeros)
    middles = (values[:-1] + values[1:]) / 2.0
    if len(middles) <= most:
        return middles
    stride = expected / (most + 1)
    found, goal, upto = [], stride, np.cumsum(weights)
    for k, middle in enumerate(middles):
        if abs(upto[k] - goal) < abs(upto[k + 1] - goal):
            found.append(middle)
            goal += stride
    return np.array(found)


def _to_blocks(edges: Sequence[int | np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def packed(rows: pa.Table) -> pa.RecordBatch:
        values = [rows.column(k).to_numpy() for k in range(rows.num_columns)]
        if not all(np.isfinite(v).all() for v in values):
            raise ValueError("targets and features must be finite numbers")
        bins = np.empty((len(edges), rows.num_rows), np.uint8)
        for k, (edge, value) in enumerate(zip(edges, values[1:])):
            bins[k] = value if isinstance(edge, int) else np.searchsorted(edge, value)
        target = values[0].astype(np.float32)
        return _block(bins, target if (target == values[0]).all() else values[0], np.empty(0))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            while rows >= _BLOCK_ROWS:
                table = pa.Table.from_batches(waiting)
                yield packed(table.slice(0, _BLOCK_ROWS))
                waiting = table.slice(_BLOCK_ROWS).to_batches()
                rows -= _BLOCK_ROWS
        if rows:
            yield packed(pa.Table.from_batches(waiting))

    return blocks


def _block(*parts: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([np.ascontiguousarray(part).tobytes()], pa.binary()) for part in parts]
    return pa.RecordBatch.from_arrays(columns, names=["bins", "target", "guess"])


def _arrays(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bins by feature, targets (in half the bytes if that loses nothing) and what the trees so far
    make of them, which is nothing before the first."""
    for batch in batches:
        for parts in zip(*batch.columns):
            bins, target, guess = (part.as_buffer() for part in parts)
            rows = bins.size // features
            yield (
                np.frombuffer(bins, np.uint8).reshape(features, rows),
                np.frombuffer(target, f"f{target.size // rows}"),
                np.frombuffer(guess, np.float64),
            )


def _levels(root: Node, depth: int, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """By level, the feature of each place and whether a bin goes right; leaves send all left."""
    found, level = [], [root]
    for _ in range(depth):
        features = np.array([max(node.feature, 0) if node else 0 for node in level], np.int64)
        right = np.zeros((len(level), width), np.int64)
        for place, node in enumerate(level):
            if node and node.left:
                right[place, : len(node.left_bins)] = ~node.left_bins
        found.append((features, right))
        level = [child for node in level for child in ((node.left, node.right) if node else (None, None))]
    return found


def _places(bins: np.ndarray, levels: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The place of each row in the level below the given ones."""
    rows = bins.shape[1]
    flat, own = bins.reshape(-1), np.arange(rows)
    places = np.zeros(rows, np.int64)
    for features, right in levels:
        if len(features) == 1:
            places = right[0].take(bins[features[0]])
        else:
            values = flat.take((features * rows).take(places) + own)
            places = 2 * places + right.reshape(-1).take(places * right.shape[1] + values)
    return places


def _sums(levels: Sequence[tuple[np.ndarray, np.ndarray]], widths: Sequence[int]):
    """A pass: rows, sum and squares by place and bin, of all rows of a task."""
    starts, total = np.cumsum([0, *widths[:-1]]), sum(widths)
    cells = total << len(levels)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((3, cells))
        for bins, target, guess in _arrays(batches, len(widths)):
            rest = target - guess if guess.size else target.astype(float)
            base, squares = _places(bins, levels) * total, rest * rest
            for start, own in zip(starts, bins):
                cell = base + start
                cell += own
                found[0] += np.bincount(cell, minlength=cells)
                found[1] += np.bincount(cell, rest, cells)
                found[2] += np.bincount(cell, squares, cells)
        yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], names=["sums"])

    return summed


def _added(root: Node, rate: float, widths: Sequence[int]):
    """A pass that adds the tree's predictions to the guesses."""
    depth, level = _depth(root), [root]
    levels = _levels(root, depth, max(widths))
    for _ in range(depth):  # a leaf's rows go left to the end
        level = [
            child for node in level for child in ((node.left, node.right) if node and node.left else (node, None))
        ]
    shares = np.array([rate * node.prediction if node else 0.0 for node in level])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, target, guess in _arrays(batches, len(widths)):
            own = shares.take(_places(bins, levels))
            yield _block(bins, target, guess + own if guess.size else own)

    return added


def _depth(node: Node) -> int:
    return 1 + max(_depth(node.left), _depth(node.right)) if node.left else 0


def _tree(
    kept: list[DataFrame], trees: GBTRegressor, widths: Sequence[int], arities: Mapping[int, int], scale: float
) -> Node:
    """One tree of the last blocks, a pass a level; those before go once the first has read them."""
    root, total = Node(np.zeros(3)), sum(widths)
    level: list[Node | None] = [root]
    for depth in range(trees.getMaxDepth()):
        passes = _sums(_levels(root, depth, max(widths)), widths)
        found = np.zeros((3, total << depth))
        for row in kept[-1].mapInArrow(passes, "sums binary").collect():
            found += np.frombuffer(row["sums"]).reshape(3, -1)
        while len(kept) > 1:
            kept.pop(0).unpersist()
        found = found.reshape(3, len(level), total) * np.array([1.0, scale, scale * scale]).reshape(3, 1, 1)
        below: list[Node | None] = []
        for place, node in enumerate(level):
            if node is not None:
                _split(node, found[:, place], widths, arities, trees.getMinInfoGain(), depth == 0)
            children = (node.left, node.right) if node is not None else (None, None)
            # Where all targets are alike there is nothing to split.
            below += [child if child and abs(child.impurity) >= _EPSILON else None for child in children]
        level = below
        if not any(level):
            break
    return root


def _variance(rows: Any, total: Any, squares: Any) -> Any:
    safe = np.where(rows > 0, rows, 1.0)
    return np.where(rows > 0, (squares - total * total / safe) / safe, 0.0)


def _split(
    node: Node, sums: np.ndarray, widths: Sequence[int], arities: Mapping[int, int], least: float, is_root: bool
) -> None:
    """Give the node the split of the highest gain, the first of equals, if any gains."""
    start, best = 0, -np.inf
    impurity = None if is_root else node.impurity
    for feature, width in enumerate(widths):
        own, start = sums[:, start : start + width], start + width
        if width < 2:
            continue
        order = np.arange(width)
        if feature in arities:
            means = np.where(own[0] > 0, own[1] / np.where(own[0] > 0, own[0], 1.0), np.finfo(float).max)
            order = np.argsort(means, kind="stable")
        upto = np.cumsum(own[:, order], axis=1)
        left = upto[:, :-1]
        right = upto[:, -1:] - left
        if impurity is None:
            node.sums = left[:, 0] + right[:, 0]
            impurity = node.impurity
        rows = left[0] + right[0]
        rows = np.where(rows > 0, rows, 1.0)
        gains = impurity - left[0] / rows * _variance(*left) - right[0] / rows * _variance(*right)
        gains = np.where((left[0] >= 1) & (right[0] >= 1) & (gains >= least), gains, -np.inf)
        place = int(np.argmax(gains))
        if gains[place] > best:
            best, node.feature = float(gains[place]), feature
            node.left_bins = np.isin(np.arange(width), order[: place + 1])
            sides = Node(left[:, place].copy()), Node(right[:, place].copy())
    if impurity is None:  # no feature has two bins
        node.sums = sums[:, : widths[0]].sum(axis=1)
    node.valid = best > -np.inf
    if best > 0:
        node.gain, (node.left, node.right) = best, sides
    else:
        node.feature, node.left_bins = -1, None


def _model(
    spark: SparkSession,
    trees: GBTRegressor,
    roots: Sequence[Node],
    weights: Sequence[float],
    points: Mapping[int, np.ndarray],
    arities: Mapping[int, int],
    features: int,
) -> GBTRegressionModel:
    """MLlib's model of the trees."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml

    def doubles(values: Sequence[float]) -> Any:
        array = gateway.new_array(jvm.double, len(values))
        for k, value in enumerate(values):
            array[k] = float(value)
        return array

    def built(node: Node) -> tuple[Any, float | None]:
        """The node, and its prediction if it is a leaf."""
        sums = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(doubles(node.sums), int(node.sums[0]))
        if node.left is not None:
            (left, one), (right, other) = built(node.left), built(node.right)
            if one is not None and one == other:
                return ml.tree.LeafNode(one, node.impurity, sums), one
            if node.feature in arities:
                kept = doubles(np.flatnonzero(node.left_bins))
                split = ml.tree.CategoricalSplit(node.feature, kept, arities[node.feature])
            else:
                threshold = points[node.feature][int(node.left_bins.sum()) - 1]
                split = ml.tree.ContinuousSplit(node.feature, float(threshold))
            return ml.tree.InternalNode(node.prediction, node.impurity, node.gain, left, right, split, sums), None
        impurity = node.impurity if node.valid else -1.0
        return ml.tree.LeafNode(node.prediction, impurity, sums), node.prediction

    made = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(roots))
    for k, root in enumerate(roots):
        made[k] = ml.regression.DecisionTreeRegressionModel(built(root)[0], features)
    model = GBTRegressionModel(ml.regression.GBTRegressionModel(trees.uid, made, doubles(weights), features))
    return trees._copyValues(model)
